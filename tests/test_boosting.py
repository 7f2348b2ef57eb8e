"""Boosted trees beside a plain version that scans every split of every row set."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweft.plans import boosting as bo, models as md
from riskweft.session import stage

COLUMNS = ("a", "b", "c")
BORDERS = ((0.5, 1.5, 2.5), (0.25, 0.5, 0.75), (0.0,))


def rows_of(n=240, seed=3):
    r = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        a, b, c = float(r.integers(4)), float(r.random()), [None, math.nan, -1.0, 1.0][int(r.integers(4))]
        y = int(r.random() < 1 / (1 + math.exp(-(a - 1.5 + 2 * (b > 0.5) - (c == 1.0)))))
        rows.append((i, a, b, c, y, float(1 + i % 3)))
    return rows


def table(spark, rows):
    return stage(spark.createDataFrame(rows, "row_id long, a double, b double, c double, Y int, w double"))


def plain(rows, growth):
    """Trees as {path: (column, bin, gradient, hessian, rows)} by scanning all candidates of all nodes."""
    def binned(value, borders):
        return len(borders) + 1 if value is None or math.isnan(value) else sum(b < value for b in borders)

    bins = [[binned(r[1 + j], BORDERS[j]) for j in range(3)] for r in rows]
    label, weight = [r[4] for r in rows], [r[5] for r in rows]
    base = math.log(sum(w * y for w, y in zip(weight, label)) / sum(w * (1 - y) for w, y in zip(weight, label)))
    margin = [base] * len(rows)
    shrink = lambda g: math.copysign(max(abs(g) - growth.l1, 0.0), g)
    trees = []
    for _ in range(growth.rounds):
        p = [1 / (1 + math.exp(-m)) for m in margin]
        grad = [round(w * (q - y) * bo.SCALE) for w, q, y in zip(weight, p, label)]
        hess = [round(w * q * (1 - q) * bo.SCALE) for w, q in zip(weight, p)]

        def sums(rows_in):
            return sum(grad[i] for i in rows_in), sum(hess[i] for i in rows_in), len(rows_in)

        def score(s):
            h = s[1] / bo.SCALE + growth.l2
            return shrink(s[0] / bo.SCALE) ** 2 / h if h > 0 else 0.0

        def candidates(rows_in, free=False):
            widest = max(map(len, BORDERS)) + 1
            for j in range(3):
                for b in range(widest):
                    left = [i for i in rows_in if bins[i][j] <= b]
                    right = [i for i in rows_in if bins[i][j] > b]
                    least = 1 if free else max(1, growth.min_rows)
                    if len(left) < least or len(right) < least:
                        continue
                    if not free and min(sums(left)[1], sums(right)[1]) / bo.SCALE < growth.min_hessian:
                        continue
                    yield score(sums(left)) + score(sums(right)) - score(sums(rows_in)), j, b, left, right

        nodes = {"": list(range(len(rows)))}
        inner = {}
        if growth.symmetric:
            for level in range(growth.depth):
                total = {}
                here = [q for q in nodes if len(q) == level and q not in inner]
                for q in here:
                    for gain, j, b, *_ in candidates(nodes[q], True):
                        total[j, b] = total.get((j, b), 0.0) + gain
                best = min(total, key=lambda k: (-total[k], k), default=None)
                if best is None or total[best] <= max(growth.min_gain, 0.0):
                    break
                for q in here:
                    if nodes[q]:
                        inner[q] = (*best, *sums(nodes[q]))
                        nodes[q + "l"] = [i for i in nodes[q] if bins[i][best[0]] <= best[1]]
                        nodes[q + "r"] = [i for i in nodes[q] if bins[i][best[0]] > best[1]]
        else:
            leaves, open_ = 1, [""]
            while open_:
                found = []
                for q in open_:
                    best = min(candidates(nodes[q]), key=lambda x: (-x[0], x[1], x[2]), default=None) if len(q) < growth.depth else None
                    if best is not None and best[0] > max(growth.min_gain, 0.0):
                        found.append((-best[0], open_.index(q), q, best))
                if not found or (growth.max_leaves and leaves >= growth.max_leaves):
                    break
                _, _, q, (_, j, b, left, right) = min(found, key=lambda x: x[:2]) if growth.max_leaves else min(found, key=lambda x: len(x[2]))
                inner[q] = (j, b, *sums(nodes[q]))
                nodes[q + "l"], nodes[q + "r"] = left, right
                open_.remove(q)
                open_ += [q + "l", q + "r"]
                leaves += 1
        leaf = {q: sums(i) for q, i in nodes.items() if q not in inner and i}
        trees.append((inner, leaf))
        for q, s in leaf.items():
            h = s[1] / bo.SCALE + growth.l2
            value = -growth.learning_rate * shrink(s[0] / bo.SCALE) / h if h > 0 else 0.0
            for i in nodes[q]:
                margin[i] += value
    return trees, [1 / (1 + math.exp(-m)) for m in margin]


def shape(model):
    """Trees in the form of the plain version."""
    out = []
    for tree in model.trees:
        paths, inner, leaf = {0: ""}, {}, {}
        for node, column in enumerate(tree.column):
            if column >= 0:
                inner[paths[node]] = (column, tree.bin[node], *tree.sums[node])
                paths[tree.left[node]], paths[tree.right[node]] = paths[node] + "l", paths[node] + "r"
            elif tree.sums[node][2]:
                leaf[paths[node]] = tree.sums[node]
        out.append((inner, leaf))
    return out


GROWTHS = {
    "levels": bo.Growth(3, 0.3, 3, l2=1.0),
    "penalties": bo.Growth(3, 0.5, 4, l2=0.5, l1=2.0, min_gain=0.7, min_hessian=4.0),
    "leaves": bo.Growth(3, 0.1, None, 6, min_rows=5, min_hessian=1e-3),
    "leaves and depth": bo.Growth(2, 0.1, 2, 4, l2=1.0),
    "two leaves": bo.Growth(2, 0.1, None, 2),
    "symmetric": bo.Growth(3, 0.3, 3, l2=3.0, symmetric=True),
    "nothing to gain": bo.Growth(2, 0.3, 3, min_gain=1e9),
}


def wanted(df, growth):
    return bo.Wanted(bo.Training(df, COLUMNS, "Y", (F.col("w"),), "row_id", BORDERS), growth)


@pytest.mark.parametrize("block_rows", [bo.BLOCK_ROWS, 50])
def test_against_plain_version(spark, block_rows):
    rows = rows_of()
    df = table(spark, rows).repartition(3)
    training = bo.Training(df, COLUMNS, "Y", (F.col("w"),), "row_id", BORDERS)
    # All in one call: models that share passes grow as if they were alone.
    models = bo.fit_models(spark, {n: bo.Wanted(training, g) for n, g in GROWTHS.items()}, block_rows=block_rows)
    for name, growth in GROWTHS.items():
        trees, scores = plain(rows, growth)
        assert shape(models[name]) == trees, name
        got = df.select("row_id", models[name].probability([F.col(c) for c in COLUMNS]).alias("p")).collect()
        assert max(abs(r["p"] - scores[r["row_id"]]) for r in got) < 1e-12


def test_samples_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(bo, "REFRESH", 3)
    rows = rows_of(400, 5)
    growth = bo.Growth(8, 0.3, 3, l2=1.0, row_share=0.6, column_share=0.67)
    one = bo.fit_models(spark, {0: wanted(table(spark, rows).coalesce(1), growth)})[0]
    other = bo.fit_models(spark, {0: wanted(table(spark, rows[::-1]).repartition(5), growth)}, block_rows=64)[0]
    assert shape(one) == shape(other)
    roots = [t[0].get("", t[1].get(""))[-1] for t in shape(one)]
    assert len(set(roots)) > 1 and all(180 < n < 300 for n in roots)
    assert all(len(growth.columns_of(t, 3)) == 2 for t in range(8)) and len({tuple(growth.columns_of(t, 3)) for t in range(8)}) > 1


def test_leaves_follow_from_the_published_table(spark):
    growth = bo.Growth(4, 0.3, 3, l2=2.0, l1=0.5)
    nodes = bo.tree_table(spark, {"m": bo.fit_models(spark, {0: wanted(table(spark, rows_of()), growth)})[0]})
    nodes.createOrReplaceTempView("nodes")
    wrong = spark.sql(
        "select * from nodes where (feature is null) <> (leaf is not null) or abs(leaf + 0.3 * sign(gradient) * greatest(abs(gradient) - 0.5, 0) / (hessian + 2.0)) > 1e-12"
    )
    sums = spark.sql(
        "select p.node from nodes p join nodes l on l.tree = p.tree and l.node = p.left_node join nodes r on r.tree = p.tree and r.node = p.right_node"
        " where abs(p.gradient - l.gradient - r.gradient) > 1e-9 or abs(p.hessian - l.hessian - r.hessian) > 1e-9 or p.n_rows <> l.n_rows + r.n_rows"
    )
    assert wrong.isEmpty() and sums.isEmpty() and nodes.where("feature is not null").count() > 4


def test_quantile_borders(spark):
    df = spark.createDataFrame([(float(i % 7), float(i), None, math.nan if i % 2 else 1.0) for i in range(1000)], "few double, many double, none double, odd double")
    few, many, none, odd = bo.borders_of(df, df.columns)
    assert few.tolist() == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0] and len(many) == bo.BINS - 1 and not len(none) and not len(odd)
    assert bo.bins_of(np.array([-1.0, 0.0, 0.5, 6.0, math.nan, math.inf]), few).tolist() == [0, 0, 1, 6, 7, 6]


def test_one_class_is_refused(spark):
    with pytest.raises(ValueError, match="both classes"):
        bo.fit_models(spark, {0: wanted(table(spark, [(*r[:4], 1, 1.0) for r in rows_of(20)]), GROWTHS["levels"])})


def test_families_in_one_call(spark):
    df = table(spark, rows_of(300))
    specs = {
        "xgboost": md.ModelSpec("xgboost", params={"n_estimators": 5, "reg_alpha": 0.5, "gamma": 0.1}, weighting="scale_balanced"),
        "hist": md.ModelSpec("hist_gradient_boosting", params={"max_iter": 5, "max_leaf_nodes": 5, "l2_regularization": 1.0}),
        "logistic": md.ModelSpec("logistic_regression", params={"max_iter": 5}),
    }
    data = df.withColumn("c", F.lit(0.0))
    fitted = md.fit_many(spark, {n: md.Fit(s, data, COLUMNS) for n, s in specs.items()})
    alone = md.fit(specs["hist"], data, COLUMNS)
    assert list(fitted) == list(specs) and shape(fitted["hist"].model) == shape(alone.model)
    assert all(len([c for c in t.column if c < 0]) <= 5 for t in fitted["hist"].model.trees)
    assert abs(sum(fitted["xgboost"].importances) - 1) < 1e-9
    scores = fitted["xgboost"].score(data, ["row_id", "Y"])
    assert scores.columns == ["row_id", "Y", "score"] and scores.where("score > 0 and score < 1").count() == 300


def test_row_weights_choose_the_rows(spark):
    """Weight zero takes a row out, as if it were not in the table."""
    df = table(spark, rows_of(300))
    spec = md.ModelSpec("hist_gradient_boosting", params={"max_iter": 4, "min_samples_leaf": 3})
    kept = bo.Training(df.where("row_id < 200"), COLUMNS, "Y", (F.lit(1.0),), "row_id", BORDERS)
    masked = bo.Training(df, COLUMNS, "Y", (F.when(F.col("row_id") < 200, 1.0).otherwise(0.0),), "row_id", BORDERS)
    both = bo.fit_models(spark, {n: bo.Wanted(t, md.growth_of(spec)) for n, t in (("kept", kept), ("masked", masked))})
    assert shape(both["kept"]) == shape(both["masked"])


def test_whole_models_in_tasks_equal_passes(spark, monkeypatch):
    monkeypatch.setattr(bo, "REFRESH", 2)
    growths = {**GROWTHS, "sampled": bo.Growth(6, 0.3, 4, l2=1.0, row_share=0.6, column_share=0.67), "deep": bo.Growth(4, 0.2, 6, l2=1.0)}
    df = table(spark, rows_of(500, 9)).repartition(4)
    training = bo.Training(df, COLUMNS, "Y", (F.col("w"), F.when(F.col("row_id") % 5 > 0, 2.5).otherwise(0.0)), "row_id", BORDERS)
    wanted_ = {(n, j): bo.Wanted(training, g, j) for n, g in growths.items() for j in range(2)}
    ways = [bo.fit_models(spark, wanted_, block_rows=rows, task_bytes=most) for rows, most in ((64, 1 << 30), (64, 0), (bo.BLOCK_ROWS, 0))]
    for n in wanted_:
        assert ways[0][n].trees == ways[1][n].trees == ways[2][n].trees, n


def test_jobs_do_not_grow_with_trees_where_a_table_fits_a_task(spark):
    """A job for each level of each tree made small tables as slow as large ones."""
    df = table(spark, rows_of())
    jobs = []
    for rounds in (2, 12):
        spark.sparkContext.setJobGroup(f"rounds {rounds}", "")
        bo.fit_models(spark, {0: wanted(df, bo.Growth(rounds, 0.3, 3, l2=1.0))})
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"rounds {rounds}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1] > 0


def test_jobs_are_dealt_out_over_tables_and_tasks():
    job = lambda m, rounds: bo._Job(m, 0, 0.0, bo.Growth(rounds, 0.1, 4), 3, 5)
    dealt = bo._dealt({0: [job(0, 800), job(1, 100), job(2, 200), job(3, 500)], 1: [job(4, 50)]}, 4)
    assert [(p, sorted(j.model for j in js)) for p, js in dealt] == [(0, [0]), (0, [1, 2, 3]), (1, [4])]
