import pytest
from pyspark.sql import functions as F

from riskweft.operators import monitoring as mo, projection as pr, quality as q, splitting as sp
from riskweft.session import staging_path
from riskweft.sources import tables as tb


def issues_frame(spark, education=6):
    rows = [(None, 25, 1, 1, 1, 0, 100, 10, 1), (200.0, 30, 2, education, 2, -1, 200, 20, 0), (200.0, 30, 2, education, 2, -1, 200, 20, 0)]
    return spark.createDataFrame(
        rows, "LIMIT_BAL double, AGE int, SEX int, EDUCATION int, MARRIAGE int, PAY_0 int, BILL_AMT1 int, PAY_AMT1 int, Y int"
    )


def test_issue_tables(spark):
    df = issues_frame(spark)
    found = {r["column"]: r["details"] for r in q.inconsistent_values(df).collect()}
    assert found == {"EDUCATION": "6"}
    assert q.missing_table(df, df.columns).first()["column"] == "LIMIT_BAL"
    features = [c for c in df.columns if c != "Y"]
    assert q.duplicate_summary(df, features).first()["duplicate_rows"] == 1
    assert q.inconsistent_values(issues_frame(spark, 2)).count() == 0
    assert set(q.eda_report(df)) >= {"target_distribution", "inconsistent_values", "default_rate_by_numeric_bin"}


def test_schema_report(spark):
    df = spark.range(50).select(
        F.col("id").alias("ID"), F.when(F.col("id") > 0, F.col("id").cast("double")).alias("LIMIT_BAL"), (F.col("id") % 2).cast("int").alias("Y")
    )
    got = {(r["section"], r["name"]): r["value"] for r in q.schema_report(df, min_rows=1, min_features=1).collect()}
    assert got[("missing", "LIMIT_BAL")] == 1 and ("leakage_risk", "ID") in got and got[("shape", "n_rows")] == 50
    with pytest.raises(ValueError, match="small dataset"):
        q.schema_report(df, min_features=1)
    with pytest.raises(ValueError, match="feature set"):
        q.schema_report(df, min_rows=1)


def test_bins_and_histogram(spark):
    df = spark.createDataFrame([(float(v), int(v > 5), 7.0) for v in [1, 1, 1, 1, 5, 6, 7, 8, 9, 10]], "x double, Y int, k double")
    bins = q.rate_by_bin(df, ["x", "k"]).orderBy("bin").collect()
    assert {r["feature"] for r in bins} == {"x"} and sum(r["observations"] for r in bins) == 10
    assert bins[0]["bin_lo"] == 1.0 and bins[0]["observations"] == 4
    hist = q.histogram(df, ["x", "k"])
    assert hist.count() == 40 and hist.where("feature = 'x' and bin = 19").first()["count"] == 1
    assert hist.where("feature = 'k' and count > 0").first()["bin"] == 10


def test_duplicate_columns(spark):
    df = spark.range(30).select(
        F.col("id").alias("row_id"), F.col("id").alias("a"), F.col("id").cast("double").alias("b"), (29 - F.col("id")).alias("c"), F.lit(1).alias("d")
    )
    assert q.duplicate_columns(df, ["a", "b", "c", "d"], "row_id") == ["b"]
    row = q.feature_audit(df, "t").first()
    assert row["duplicate_features"] == 1 and row["constant_columns"] == 1 and row["rows"] == 30 and row["max_abs_value"] == 29


def test_identifier_and_column_choice():
    assert pr.identifier_columns(["ID", "cust_id", "idx", "X1", "paid"]) == ["ID", "cust_id"]
    assert pr.pick_columns(["a", "b", "c"], ["c", "z"], 2) == ["c", "a"]


def test_label_errors(spark):
    def labels(values, kind):
        return spark.createDataFrame([(v,) for v in values], f"Y {kind}")

    assert [r["Y"] for r in tb.normalize_label(labels([" Yes", "no", "TRUE"], "string")).collect()] == [1, 0, 1]
    assert sorted(r["Y"] for r in tb.normalize_label(labels([True, False], "boolean")).collect()) == [0, 1]
    for bad, kind, text in (([0, 1, 2], "int", "binary"), ([1, 1], "int", "binary"), (["yes", "maybe"], "string", "binary"), ([0, 1, None], "int", "missing"), ([None], "int", "empty")):
        with pytest.raises(ValueError, match=text):
            tb.normalize_label(labels(bad, kind))


def test_manifest(spark):
    df = spark.range(100).select(F.col("id").alias("row_id"), (F.col("id") % 2).cast("int").alias("Y"))
    split = sp.stratified_split(df)
    path = staging_path(spark, "manifest")
    tb.write_manifest(split, path)
    manifest = tb.read_manifest(spark, path)
    assert tb.check_manifest(tb.apply_manifest(df, manifest), manifest) == {"train_rows": 70, "validation_rows": 15, "test_rows": 15}
    moved = split.withColumn("split", F.when(F.col("split") == "train", "test").otherwise(F.col("split")))
    with pytest.raises(ValueError, match="disagree"):
        tb.check_manifest(moved, manifest)
    twice = manifest.unionByName(manifest.limit(1).withColumn("split", F.lit("validation")))
    with pytest.raises(ValueError, match="overlap"):
        tb.check_manifest(split, twice)


def test_json_has_no_infinities(spark):
    df = spark.createDataFrame([(1, float("inf")), (2, float("nan")), (3, 0.5)], "id int, v double")
    path = staging_path(spark, "json")
    tb.write_json(df, path)
    assert {r["id"]: r["v"] for r in tb.read_json(spark, path, "id int, v double").collect()} == {1: None, 2: None, 3: 0.5}


def test_small_domains(spark):
    df = spark.range(1000).select((F.col("id") % 12).alias("a"), (F.col("id") % 13).alias("b"), F.when(F.col("id") % 12 > 0, F.col("id") % 12).alias("c"))
    assert q.small_domain_columns(df, ["a", "b", "c"]) == ["a", "c"]


def test_alerts_need_a_run(spark):
    values = [0.8, 0.7, 0.8, 0.7, 0.6, 0.7, 0.9, 0.7]
    df = spark.createDataFrame([(i, "auc", v, v < 0.75) for i, v in enumerate(values)], "period int, metric string, value double, below boolean")
    (row,) = mo.persistent_alerts(df, "period").collect()
    assert (row["first_period"], row["last_period"], row["periods"], row["worst"]) == (3, 5, 3, 0.6)


def test_drift_of_equal_samples_is_zero(spark):
    df = spark.range(200).select((F.col("id") % 50).cast("double").alias("x"), (F.col("id") < 100).alias("now"))
    assert mo.psi(df, ["x"], F.col("now")).first()["psi"] == pytest.approx(0.0)
    assert mo.ks_distance(df, ["x"], F.col("now")).first()["ks"] == pytest.approx(0.0)
