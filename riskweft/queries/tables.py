"""Source, sink and manifest queries (SRC*, SNK*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweft.operators import scoring as sc, splitting as sp
from riskweft.queries.features import rounded
from riskweft.queries.metrics import BY, CTES, TIERED, best_sql, table
from riskweft.queries.registry import query
from riskweft.queries.scores import scored_wide, scores_long, with_scores
from riskweft.queries.splits import RANKED_SQL, SPLIT_SQL, _fold_sql, keyed
from riskweft.session import staging_path
from riskweft.sources import tables as tb
from riskweft.sources.contract import FEATURES
from riskweft.sources.panel import panel, with_panel


@query("src1_load_table", with_panel("select row_id, " + ", ".join(FEATURES) + ", Y from panel"))
def src1_load_table(spark, sf):
    """Written as CSV, read back with an explicit schema and checked."""
    path = staging_path(spark, "csv")
    tb.write_table(panel(spark, sf), path, "csv")
    return tb.load_risk_table(spark, path, "csv", tb.risk_schema(), min_rows=1)


_LABEL_TEXT = (
    "case when Y=1 and row_id%3=0 then ' TRUE' when Y=1 and row_id%3=1 then 'yes ' when Y=1 then '1'"
    " when row_id%3=0 then 'No' when row_id%3=1 then ' false ' else '0' end"
)


@query("src2_binary_label", with_panel("select row_id, Y as label from panel"))
def src2_binary_label(spark, sf):
    df = panel(spark, sf).selectExpr("row_id", f"{_LABEL_TEXT} as label")
    return tb.normalize_label(df, "label")


@query("src2_numeric_label", with_panel("select row_id, Y as label from panel"))
def src2_numeric_label(spark, sf):
    """Fractions are cut off: 1.9 is 1 and 0.9 is 0."""
    return tb.normalize_label(panel(spark, sf).selectExpr("row_id", "Y + 0.9D as label"), "label")


@query(
    "src3_read_experiments",
    with_scores(
        "select model, threshold, round(f1_binary,9) as f1_binary, round(recall_positive,9) as recall_positive, 'six_decimals' as grid from ("
        + best_sql(TIERED, columns="*") + ")",
        *CTES,
    ),
)
def src3_read_experiments(spark, sf):
    """Experiment rows with parameters as JSON text, written as CSV and read back typed."""
    best = sc.best_threshold(table(spark, sf)[0], BY).select(
        "model", "threshold", "f1_binary", "recall_positive", F.to_json(F.struct(F.lit("six_decimals").alias("grid"))).alias("hyperparameters")
    )
    path = staging_path(spark, "experiments")
    tb.write_table(best, path, "csv")
    back = tb.with_parameters(tb.read_table(
        spark, path, "csv", "model string, threshold double, f1_binary double, recall_positive double, hyperparameters string"
    ))
    return rounded(back.select("model", "threshold", "f1_binary", "recall_positive", F.col("hyperparameters")["grid"].alias("grid")), 9, ("threshold",))


@query("snk1_write_table", with_scores("select model, row_id, label, score from scores"))
def snk1_write_table(spark, sf):
    path = staging_path(spark, "scores")
    tb.write_table(scores_long(spark, sf), path, "parquet", partition_by=["model"])
    return tb.read_table(spark, path, "parquet", "row_id bigint, label int, score double, model string")


@query(
    "snk2_write_json",
    with_scores(
        "select model, score as threshold, round(cast(cfp as double)/nn, 9) as fpr, round(cast(ctp as double)/np, 9) as tpr from cum"
        " union all select model, null, 0.0, 0.0 from totals",
        *CTES[:3],
    ),
)
def snk2_write_json(spark, sf):
    """ROC points: the infinite first threshold is written as null."""
    points = rounded(sc.roc_curve(sc.fold_scores(scores_long(spark, sf), BY), BY), 9, ("threshold",))
    path = staging_path(spark, "json")
    tb.write_json(points, path)
    return tb.read_json(spark, path, "model string, threshold double, fpr double, tpr double")


@query(
    "snk3_fold_store",
    f"select fold, count(*) as rows, cast(sum(Y) as bigint) as positives, count(distinct row_id) as keys from ({_fold_sql(3)}) group by fold",
)
def snk3_fold_store(spark, sf):
    """Two folds written, the store re-opened, the missing fold added, nothing written twice."""
    folds = sp.stratified_folds(keyed(spark, sf), 3)
    path = staging_path(spark, "folds")

    def rows(i):
        part = folds.where(F.col("fold") == i).select("row_id", F.col("Y").alias("label"), (F.col("row_id") % 7 / 7).alias("score"))
        return part.select("*", *[F.lit(0.0).alias(c) for c in ("auc", "f1_binary", "elapsed_seconds")])

    store = tb.FoldStore(spark, path)
    for i in (0, 2):
        store.save(i, rows(i))
    resumed = tb.FoldStore(spark, path)
    for i in range(3):
        if i not in resumed.finished():
            resumed.save(i, rows(i))
    return resumed.load().groupBy("fold").agg(F.count(F.lit(1)).alias("rows"), F.sum("label").alias("positives"), F.count_distinct("row_id").alias("keys"))


@query(
    "snk4_prediction_table",
    with_scores(
        "select row_id as row_identifier, Y as y_true, early_returns as probability_default_1, 0.25::double as frozen_threshold,"
        " cast(case when early_returns >= 0.25 then 1 else 0 end as integer) as y_pred from scored"
    ),
)
def snk4_prediction_table(spark, sf):
    predictions = tb.prediction_table(scored_wide(spark, sf), 0.25, label="Y", score="early_returns")
    path = staging_path(spark, "predictions")
    tb.write_table(predictions, path)
    return tb.read_table(spark, path)


@query("snk5_split_manifest", with_panel("select row_id, split from split_table where split <> 'test'", RANKED_SQL, SPLIT_SQL))
def snk5_split_manifest(spark, sf):
    path = staging_path(spark, "manifest")
    tb.write_manifest(sp.stratified_split(keyed(spark, sf)), path)
    return tb.read_manifest(spark, path)


@query(
    "src4_check_manifest",
    with_panel(
        "select cast(0 as bigint) as manifest_only, cast(0 as bigint) as table_only, cast(0 as bigint) as overlaps,"
        " count(*) filter (where split='train') as train_rows, count(*) filter (where split='validation') as validation_rows,"
        " count(*) filter (where split='test') as test_rows from split_table",
        RANKED_SQL, SPLIT_SQL,
    ),
)
def src4_check_manifest(spark, sf):
    keys = keyed(spark, sf)
    path = staging_path(spark, "manifest")
    tb.write_manifest(sp.stratified_split(keys), path)
    manifest = tb.read_manifest(spark, path)
    applied = tb.apply_manifest(keys, manifest)
    tb.check_manifest(applied, manifest)
    return tb.manifest_differences(applied, manifest)
