import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import scores
from riskweft.operators import diagnostics as dg, ordered as od, ranking as rk, scoring as sc


def counts(labels, values, t):
    y, s = np.array(labels), np.array(values)
    p = s >= t
    return tuple(int(x) for x in ((~p & (y == 0)).sum(), (p & (y == 0)).sum(), (~p & (y == 1)).sum(), (p & (y == 1)).sum()))


def auc(labels, values):
    pos = [s for y, s in zip(labels, values) if y]
    neg = [s for y, s in zip(labels, values) if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def ap(labels, values):
    total, last = 0.0, 0.0
    for t in sorted(set(values), reverse=True):
        tn, fp, fn, tp = counts(labels, values, t)
        recall = tp / (tp + fn)
        total += (recall - last) * tp / (tp + fp)
        last = recall
    return total


A = ([0, 0, 1, 1], [0.1, 0.7, 0.8, 0.4])
B = ([0, 0, 1, 1, 1, 0], [0.2, 0.4, 0.6, 0.7, 0.8, 0.3])
C = ([0, 1, 0, 1, 0, 1, 0, 0, 1, 0], [0.08, 0.72, 0.31, 0.68, 0.22, 0.54, 0.41, 0.12, 0.49, 0.03])
rng = np.random.default_rng(11)
D = ([int(x) for x in rng.integers(0, 2, 200)], [float(x) for x in np.where(rng.random(200) < 0.3, 0.25, rng.random(200))])


def test_confusion_and_metrics(spark):
    r = sc.evaluate(scores(spark, *A), 0.5).first()
    assert (r["tn"], r["fp"], r["fn"], r["tp"]) == (1, 1, 1, 1)
    assert r["precision_positive"] == r["recall_positive"] == r["f1_binary"] == 0.5


@pytest.mark.parametrize("data", [A, B, C, D])
def test_rank_metrics_by_brute_force(spark, data, monkeypatch):
    monkeypatch.setattr(od, "ROWS_PER_RANGE", 5)
    r = sc.rank_metrics(sc.fold_scores(scores(spark, *data))).first()
    assert r["roc_auc"] == pytest.approx(auc(*data), abs=1e-12)
    assert r["average_precision"] == pytest.approx(ap(*data), abs=1e-12)


@pytest.mark.parametrize("data", [B, C, D])
def test_threshold_table_by_brute_force(spark, data):
    folded = sc.fold_scores(scores(spark, *data))
    got = {r["threshold"]: (r["tn"], r["fp"], r["fn"], r["tp"]) for r in sc.threshold_counts(folded).collect()}
    expected = sorted({0.5, *np.round(np.array(data[1]), 6).tolist()})
    assert sorted(got) == expected
    for t in expected:
        assert got[t] == counts(*data, t), t


@pytest.mark.parametrize("data", [B, C, D])
def test_fast_search_equals_full_search(spark, data):
    folded = sc.fold_scores(scores(spark, *data))
    table = sc.threshold_table(folded)
    for objective in ("f1", "precision"):
        fast = sc.fast_threshold(sc.threshold_counts(folded), objective=objective).first()["threshold"]
        assert fast == sc.objective_threshold(table, objective=objective).first()["threshold"]


def test_tradeoff(spark):
    folded = sc.fold_scores(scores(spark, *B))
    table = sc.threshold_table(folded)
    assert table.select("roc_auc").distinct().count() == 1 and table.where("passes_recall_gate").count() > 0
    r = sc.tradeoff_summary(table, folded).first()
    assert r["max_f1"] >= r["f1_at_point_five"] and r["max_f1"] == 1.0 and r["max_f1_threshold"] == 0.6


def test_best_threshold_tiers(spark):
    useless = ([1, 0, 0, 1], [0.1, 0.9, 0.8, 0.2])
    best = sc.best_threshold(sc.threshold_table(sc.fold_scores(scores(spark, *useless)))).first()
    assert best["recall_positive"] >= 0.6 and best["threshold"] == 0.1
    none = sc.threshold_table(sc.fold_scores(scores(spark, *B))).where("recall_positive < 0.6")
    assert sc.best_threshold(none).first()["recall_positive"] == none.agg(F.max("recall_positive")).first()[0]


def test_curves(spark):
    folded = sc.fold_scores(scores(spark, *C))
    roc = sc.roc_curve(folded).orderBy(F.desc("threshold")).collect()
    assert (roc[0]["fpr"], roc[0]["tpr"]) == (0.0, 0.0) and (roc[-1]["fpr"], roc[-1]["tpr"]) == (1.0, 1.0)
    assert sc.pr_curve(folded).where("threshold is null").first()["precision"] == 1.0


def gates(spark, a, f, r):
    return spark.range(1).select(sc.passes_gates(F.lit(a), F.lit(r), F.lit(f)).alias("ok"), sc.gate_status(F.lit(a), F.lit(r), F.lit(f)).alias("s")).first()


def test_gate_bounds(spark):
    assert gates(spark, 0.75, 0.65, 0.60)["ok"] and gates(spark, 0.75, 0.65, 0.60)["s"] == "PASS"
    assert not gates(spark, 0.80, 0.64, 0.70)["ok"] and gates(spark, 0.80, 0.64, 0.70)["s"] == "VALID_BUT_F1_LOW"
    assert gates(spark, 0.70, 0.70, 0.70)["s"] == "FAIL"


# Published confusion counts with the derived values they must give.
GOLDEN = [
    ("XGBoost_A3", "VALIDATION", 0.7816975032079083, 2900, 605, 388, 607, 0.5500679655641142, 0.7019440372498916, 0.786657135012403, 3),
    ("CatBoost_A3", "VALIDATION", 0.7811007964214797, 2912, 593, 393, 602, 0.5497716894977169, 0.7024923058354957, 0.7876764718372347, 1),
    ("hard_negative_best", "VALIDATION", 0.7808593609990035, 2919, 586, 398, 597, 0.5482093663911846, 0.7019850701788817, 0.7877577405137971, 2),
    ("cascade_best", "VALIDATION", 0.7741037570161795, 2829, 676, 396, 599, 0.5277533039647577, 0.6842332641666284, 0.7715143086347831, 4),
    ("segmented_thresholds", "TRAIN_OOF", 0.7816975032079083, 1995, 1510, 216, 779, 0.47442143727161995, 0.5862310125476364, 0.64859590897937, None),
    ("T0_A3", "TRAIN_OOF", 0.787645614541989, 13620, 2735, 1836, 2809, 0.5513789380704681, 0.7038432523177465, 0.7888602580242049, None),
    ("T1_PAY_confirmation", "TRAIN_OOF", 0.7884671143713602, 13540, 2815, 1816, 2829, 0.5499076683837107, 0.7019350079170612, 0.7867083481997056, None),
]


def test_golden_reranking(spark):
    rows = [("R", g[0], "m", g[1], *g[2:7]) for g in GOLDEN]
    df = spark.createDataFrame(
        rows, "round string, experiment string, model string, selection_source string, auc double, tn bigint, fp bigint, fn bigint, tp bigint"
    )
    got = {r["experiment"]: r for r in rk.rerank(df).collect()}
    for name, _, _, _, _, _, _, f1, macro, weighted, rank in GOLDEN:
        r = got[name]
        assert (r["f1_binary"], r["f1_macro"], r["f1_weighted"]) == pytest.approx((f1, macro, weighted), abs=1e-12)
        assert r["rank_if_valid"] == rank
    assert not got["segmented_thresholds"]["passes_all_A1_gates"]
    winner = rk.freeze_winner(rk.rerank(df), "XGBoost_A3").first()
    assert winner["experiment"] == "CatBoost_A3" and winner["all_gates_pass"]


def test_precision_needed(spark):
    got = spark.range(1).select(dg.precision_needed(F.lit(0.6100502512562814)).alias("p")).first()["p"]
    assert got == pytest.approx(0.6955, abs=5e-5)


def test_groups_are_independent(spark):
    parts = [scores(spark, *d).withColumn("model", F.lit(n)) for n, d in (("b", B), ("c", C))]
    both = sc.best_threshold(sc.threshold_table(sc.fold_scores(parts[0].unionByName(parts[1]), ["model"]), ["model"]), ["model"]).collect()
    for r in both:
        alone = sc.best_threshold(sc.threshold_table(sc.fold_scores(scores(spark, *(B if r["model"] == "b" else C))))).first()
        assert r["threshold"] == alone["threshold"] and r["roc_auc"] == alone["roc_auc"]
