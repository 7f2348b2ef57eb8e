"""Ordered target statistics beside a plain loop."""

import hashlib

from pyspark.sql import functions as F

from riskweft.operators import encoding as en
from riskweft.plans import models as md
from riskweft.session import stage

ROWS = [(i, ["x", "y", None, "", "null"][i % 5], i % 3, int((i * 7) % 10 < 4)) for i in range(120)]
SCHEMA = "row_id long, color string, size int, Y int"


def plain(rows, at):
    prior = sum(r[3] for r in rows) / len(rows)
    seen, out = {}, {}
    for r in sorted(rows, key=lambda r: (hashlib.md5(f"{r[0]}:42".encode()).hexdigest(), r[0])):
        total, count = seen.get(r[at], (0, 0))
        out[r[0]] = (total + prior) / (count + 1)
        seen[r[at]] = (total + r[3], count + 1)
    return out, {k: (t + prior) / (n + 1) for k, (t, n) in seen.items()}, prior


def test_no_row_sees_its_own_label(spark):
    stats, coded = en.fit_target_statistics(spark.createDataFrame(ROWS, SCHEMA).repartition(4), ["color", "size"])
    got = {r["row_id"]: (r["color"], r["size"], r["Y"]) for r in coded.collect()}
    for place, at in ((0, 1), (1, 2)):
        want, _, _ = plain(ROWS, at)
        assert all(abs(got[i][place] - want[i]) < 1e-12 for i in want)
    assert {i: g[2] for i, g in got.items()} == {r[0]: r[3] for r in ROWS}
    flipped = [(*r[:3], 1 - r[3]) if r[0] == 17 else r for r in ROWS]
    after = {r["row_id"]: r["color"] for r in en.ordered_statistics(spark.createDataFrame(flipped, SCHEMA), ["color"], prior=stats.prior).withColumnsRenamed({"key": "row_id", "_target_0": "color"}).collect()}
    assert abs(after[17] - got[17][0]) < 1e-12 and any(abs(after[i] - got[i][0]) > 1e-12 for i in after)


def test_scoring_uses_all_rows_and_the_prior_for_unseen(spark):
    stats, _ = en.fit_target_statistics(spark.createDataFrame(ROWS, SCHEMA), ["color", "size"])
    _, color, prior = plain(ROWS, 1)
    _, size, _ = plain(ROWS, 2)
    new = spark.createDataFrame([(1, "x", 0, 0), (2, None, 9, 0), (3, "new", None, 0), (4, "", 2, 0), (5, "null", 1, 0)], SCHEMA)
    got = {r["row_id"]: (r[stats.coded("color")], r[stats.coded("size")]) for r in stats.transform(new).collect()}
    want = {1: (color["x"], size[0]), 2: (color[None], prior), 3: (prior, prior), 4: (color[""], size[2]), 5: (color["null"], size[1])}
    assert all(abs(a - b) < 1e-12 for i in want for a, b in zip(got[i], want[i]))
    assert stats.coded("row_id") == "row_id"


def test_copies_of_a_key_stand_at_one_place(spark):
    rows = [(1, "x", 0, 1)] * 3 + [(2, "x", 0, 0)]
    got = {(r["row_id"], r["color"]) for r in en.fit_target_statistics(spark.createDataFrame(rows, SCHEMA), ["color"])[1].collect()}
    # Whichever key stands first sees nothing but the prior, three times.
    assert len(got) == 2 and any(abs(v - 0.75) < 1e-12 for _, v in got)


def test_a_million_categories(spark):
    df = stage(spark.range(1_000_000).select(
        F.col("id").alias("row_id"), F.concat(F.lit("c"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))).alias("color"), F.lit(1).alias("size"), (F.col("id") % 2).cast("int").alias("Y")))
    # A third of all rows share one category, the others have one each.
    stats, coded = en.fit_target_statistics(df, ["color"])
    assert stats.table.count() == 666_667
    row = coded.agg(F.count("color").alias("n"), F.count_if(F.abs(F.col("color") - stats.prior) > 1e-9).alias("moved")).first()
    assert row["n"] == 1_000_000 and 300_000 < row["moved"] <= 333_334


def test_native_categories_of_a_boosted_model(spark):
    rows = [(i, float(i % 4), i % 5, 1, float(i % 11), int(i % 5 in (1, 3))) for i in range(400)]
    df = stage(spark.createDataFrame(rows, "row_id long, X2 double, X3 int, X4 int, X5 double, Y int"))
    fitted = md.fit(md.ModelSpec("catboost", params={"iterations": 10, "depth": 2, "learning_rate": 0.5}), df, ["X2", "X3", "X4", "X5"], categorical=["X2", "X3", "X4"])
    scored = fitted.score(df, ["row_id", "Y"]).collect()
    assert min(r["score"] for r in scored if r["Y"]) > max(r["score"] for r in scored if not r["Y"])
    unseen = spark.createDataFrame([(1, 99.0, 77, None, None, 0)], df.schema)
    assert 0 < fitted.score(unseen, ["row_id"]).first()["score"] < 1
