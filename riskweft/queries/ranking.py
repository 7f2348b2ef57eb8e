"""Candidate ranking queries (RNK*) on candidates = (score model, marital code) of the panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweft.operators import ranking as rk, scoring as sc, splitting as sp, projection as pr
from riskweft.queries.diagnostics import split_metrics, SPLIT_SCORED, _FIXED
from riskweft.queries.features import rounded
from riskweft.queries.metrics import CTES, TIERED, _HELD, _SHARP, _TOP
from riskweft.queries.registry import query
from riskweft.queries.scores import METRIC_SQL, MODELS, SCORED_SQL, scored_wide
from riskweft.queries.splits import keyed
from riskweft.session import stage, staging_path
from riskweft.sources import tables as tb
from riskweft.sources.panel import panel, with_panel

BY = ["model"]
R = 9

# model = score family and marital code, e.g. age_rule_2.
_SCORES = "scores as (" + " union all ".join(
    f"select '{m}_' || cast(X4 as varchar) as model, row_id, Y as label, {m} as score from scored" for m in MODELS
) + ")"
_BEST = f"best as (select * from (select *, row_number() over (partition by model order by {TIERED}) as pos from tt) where pos = 1)"
_CAND = (
    "cand_rows as (select model as model_name, model as experiment, regexp_replace(model, '_[0-9]$', '') as family, threshold, roc_auc, f1_binary as f1, f1_binary,"
    " f1_macro, recall_positive as recall, precision_positive as precision, accuracy, tn, fp, fn, tp, 'R' || right(model, 1) as round,"
    " case when right(model, 1) = '3' then 'TRAIN_OOF' else 'VALIDATION' end as selection_source from best)"
)


def with_candidates(body: str, *ctes: str) -> str:
    return with_panel(body, SCORED_SQL, _SCORES, *CTES, _BEST, _CAND, *ctes)


def candidate_scores(spark, sf):
    wide = scored_wide(spark, sf).select("row_id", F.col("Y").alias("label"), "X4", *MODELS)
    long = wide.unpivot(["row_id", "label", "X4"], list(MODELS), "family", "score")
    return long.withColumn("model", F.concat_ws("_", "family", F.col("X4").cast("string")))


def candidates(spark, sf):
    """One metric row per candidate, staged: everything after it is small."""
    folded = sc.fold_scores(candidate_scores(spark, sf), BY)
    best = sc.best_threshold(sc.threshold_table(folded, BY), BY)
    last = F.right("model", F.lit(1))
    return stage(best.select(
        F.col("model").alias("model_name"), F.col("model").alias("experiment"), F.regexp_replace("model", "_[0-9]$", "").alias("family"), "threshold",
        "roc_auc", F.col("f1_binary").alias("f1"), "f1_binary", "f1_macro", F.col("recall_positive").alias("recall"),
        F.col("precision_positive").alias("precision"), "accuracy", "tn", "fp", "fn", "tp", F.concat(F.lit("R"), last).alias("round"),
        F.when(last == "3", "TRAIN_OOF").otherwise("VALIDATION").alias("selection_source"),
    ), "candidates")


_NUM = ["roc_auc", "f1", "recall", "precision", "accuracy"]


def _r(names):
    return ", ".join(f"round({n}, {R}) as {n}" for n in names)


_GATES = "coalesce(roc_auc >= 0.75 and recall >= 0.6 and f1_macro >= 0.65, false)"


@query("rnk1_candidate_comparison", with_candidates(f"select model_name, threshold, {_r(_NUM)}, {_GATES} as passes_gates from cand_rows"))
def rnk1_candidate_comparison(spark, sf):
    out = rk.comparison(candidates(spark, sf), "f1_macro")
    return rounded(out.select("model_name", "threshold", *_NUM, "passes_gates"), R, ("threshold",))


@query(
    "rnk1_best_result",
    with_candidates(
        f"select model_name, threshold, {_r(_NUM)} from (select *, {_GATES} as g from cand_rows)"
        " order by g desc, f1 desc, roc_auc desc, recall desc, precision desc, accuracy desc, model_name limit 1"
    ),
)
def rnk1_best_result(spark, sf):
    return rounded(rk.best_result(candidates(spark, sf), "f1_macro").select("model_name", "threshold", *_NUM), R, ("threshold",))


@query(
    "rnk2_promising_candidates",
    with_candidates(f"select model_name, {_r(_NUM)} from cand_rows order by roc_auc desc, f1 desc, recall desc, precision desc, model_name limit 3"),
)
def rnk2_promising_candidates(spark, sf):
    return rounded(rk.promising(candidates(spark, sf)).select("model_name", *_NUM), R)


_RANKED_TT = (
    f"ranked as (select tt.*, average_precision, row_number() over (partition by tt.model order by {_TOP}) as pos_top,"
    f" row_number() over (partition by tt.model order by (recall_positive >= 0.6) desc, {_HELD}) as pos_held,"
    f" row_number() over (partition by tt.model order by (recall_positive >= 0.6) desc, {_SHARP}) as pos_sharp"
    " from tt join rank_metrics using (model))"
)
_VARIANTS = (
    "variants as (select regexp_replace(model, '_[0-9]$', '') as model_family, right(model, 1) as variant_name, false as tuned, max(roc_auc) as roc_auc,"
    " max(average_precision) as average_precision, max(case when threshold=0.5 then f1_binary end) as f1_at_0_5,"
    " arg_max(f1_binary, -pos_top) as max_f1, arg_max(threshold, -pos_top) as max_f1_threshold, arg_max(recall_positive, -pos_top) as recall_at_max_f1,"
    " arg_max(precision_positive, -pos_top) as precision_at_max_f1, arg_max(f1_binary, -pos_held) as constrained_max_f1,"
    " arg_max(threshold, -pos_held) as constrained_threshold, arg_max(recall_positive, -pos_held) as constrained_recall,"
    " arg_max(precision_positive, -pos_held) as constrained_precision, arg_max(precision_positive, -pos_sharp) as best_precision_at_recall_ge_0_60,"
    " arg_max(threshold, -pos_sharp) as threshold_at_best_precision_recall_ge_0_60 from ranked group by model)"
)
_VCOLS = [
    "roc_auc", "average_precision", "f1_at_0_5", "max_f1", "max_f1_threshold", "recall_at_max_f1", "precision_at_max_f1", "constrained_max_f1",
    "constrained_threshold", "constrained_recall", "constrained_precision", "best_precision_at_recall_ge_0_60", "threshold_at_best_precision_recall_ge_0_60",
]


def variants(spark, sf):
    folded = sc.fold_scores(candidate_scores(spark, sf), BY)
    tt = sc.threshold_table(folded, BY)
    summary = sc.tradeoff_summary(tt, folded, BY)
    family, variant = F.regexp_replace("model", "_[0-9]$", ""), F.right("model", F.lit(1))
    return stage(rk.variant_row(summary, family, variant), "variants")


@query(
    "rnk3_promising_families",
    with_candidates(
        f"select model_family, variant_name, {_r(_VCOLS)} from (select *, row_number() over (partition by model_family order by constrained_max_f1 desc,"
        " average_precision desc, roc_auc desc, constrained_precision desc, variant_name desc) as pos from variants) where pos = 1"
        " order by constrained_max_f1 desc, average_precision desc, roc_auc desc, constrained_precision desc, model_family limit 4",
        _RANKED_TT, _VARIANTS,
    ),
)
def rnk3_promising_families(spark, sf):
    return rounded(rk.promising_families(variants(spark, sf)).select("model_family", "variant_name", *_VCOLS), R)


@query(
    "rnk4_best_eligible",
    with_candidates(
        f"select experiment, threshold, {_r(['roc_auc', 'f1_binary', 'recall', 'precision'])} from (select *, roc_auc >= 0.75 and recall >= 0.6 as ok from cand_rows)"
        " order by ok desc, f1_binary desc, recall desc, precision desc, roc_auc desc, experiment limit 1"
    ),
)
def rnk4_best_eligible(spark, sf):
    out = rk.best_eligible(candidates(spark, sf))
    return rounded(out.select("experiment", "threshold", "roc_auc", "f1_binary", "recall", "precision"), R, ("threshold",))


_RERANK = (
    f"metrics as (select round, experiment, model_name as model, selection_source, roc_auc as auc, tn, fp, fn, tp, {METRIC_SQL} from cand_rows)",
    "flagged as (select *, coalesce(auc >= 0.75, false) as passes_auc, recall_positive >= 0.6 as passes_recall, f1_macro >= 0.65 as passes_macro_f1,"
    " coalesce(auc >= 0.75, false) and recall_positive >= 0.6 and f1_macro >= 0.65 as passes_all_A1_gates from metrics)",
    "valid as (select experiment, cast(row_number() over (order by f1_macro desc, auc desc, recall_positive desc, precision_positive desc, experiment) as integer)"
    " as rank_if_valid from flagged where passes_all_A1_gates and selection_source = 'VALIDATION')",
    "reranked as (select flagged.*, rank_if_valid from flagged left join valid using (experiment))",
)
_RCOLS = ["auc", "precision_positive", "recall_positive", "f1_class_0", "f1_binary", "f1_macro", "f1_weighted", "accuracy", "micro_f1"]
_FLAGS = "passes_auc, passes_recall, passes_macro_f1, passes_all_A1_gates, rank_if_valid"


def reranked(spark, sf):
    return rk.rerank(candidates(spark, sf).withColumnsRenamed({"model_name": "model", "roc_auc": "auc"}))


@query("rnk5_rerank_macro_f1", with_candidates(f"select round, experiment, model, selection_source, tn, fp, fn, tp, {_r(_RCOLS)}, {_FLAGS} from reranked", *_RERANK))
def rnk5_rerank_macro_f1(spark, sf):
    out = reranked(spark, sf).select("round", "experiment", "model", "selection_source", "tn", "fp", "fn", "tp", *_RCOLS, *_FLAGS.split(", "))
    return rounded(out, R)


@query(
    "rnk6_consolidate",
    with_candidates(
        "select 'metrics' as source, experiment, round(f1_binary, 9) as f1_binary_default_1, round(roc_auc, 9) as roc_auc, null::bigint as tp from cand_rows"
        " union all select 'counts', experiment, null, null, tp from cand_rows"
    ),
)
def rnk6_consolidate(spark, sf):
    rows = candidates(spark, sf)
    left = rows.select(F.lit("metrics").alias("source"), "experiment", "f1_binary", "roc_auc")
    right = rows.select(F.lit("counts").alias("source"), "experiment", "tp")
    return rounded(rk.consolidate([left, right], {"f1_binary": "f1_binary_default_1"}), R)


@query(
    "rnk7_experiment_record",
    with_candidates(
        f"select 'threshold_only' as experiment, model, 'validation_threshold_search_only' as strategy, threshold, round(precision_positive,9) as precision,"
        " round(recall_positive,9) as recall, round(f1_binary,9) as f1_binary, round(f1_macro,9) as macro_f1, round(f1_weighted,9) as weighted_f1,"
        " round(roc_auc,9) as roc_auc, round(accuracy,9) as accuracy, 42 as seed, case when roc_auc >= 0.75 and recall_positive >= 0.6 and f1_macro >= 0.65 then 'PASS'"
        " when roc_auc >= 0.75 and recall_positive >= 0.6 then 'VALID_BUT_F1_LOW' else 'FAIL' end as status, 'none' as class_weighting, '42' as seed_text from best"
    ),
)
def rnk7_experiment_record(spark, sf):
    folded = sc.fold_scores(candidate_scores(spark, sf), BY)
    best = sc.best_threshold(sc.threshold_table(folded, BY), BY)
    record = rk.experiment_record(
        best, "threshold_only", F.col("model"), "validation_threshold_search_only", "none", {"seed": 42}, stamp="2024-01-01T00:00:00+00:00"
    )
    out = record.withColumn("seed_text", F.col("hyperparameters")["seed"]).drop("hyperparameters", "timestamp")
    return rounded(out, R, ("threshold",))


@query(
    "rnk8_variant_rows",
    with_candidates(
        f"select model_family, variant_name, tuned, {_r(_VCOLS)}, constrained_max_f1 >= 0.65 and constrained_recall >= 0.6 as passes_validation_gate from variants",
        _RANKED_TT, _VARIANTS,
    ),
)
def rnk8_variant_rows(spark, sf):
    return rounded(variants(spark, sf), R)


@query(
    "rnk8_freeze_variant",
    with_candidates(
        f"select model_family, variant_name, {_r(_VCOLS)}, case when constrained_max_f1 >= 0.65 and constrained_recall >= 0.6 then 'READY_FOR_FINAL_EVALUATION'"
        " else 'NEEDS_GATE_REVIEW' end as status from variants order by (recall_at_max_f1 >= 0.6 and constrained_recall >= 0.6) desc, constrained_max_f1 desc,"
        " average_precision desc, roc_auc desc, constrained_precision desc, model_family, variant_name limit 1",
        _RANKED_TT, _VARIANTS,
    ),
)
def rnk8_freeze_variant(spark, sf):
    return rounded(rk.freeze_variant(variants(spark, sf)).select("model_family", "variant_name", *_VCOLS, "status"), R)


@query(
    "rnk9_leakage_checks",
    with_panel(
        "select 'splits_disjoint' as check_name, true as passed, count(*) as rows from panel union all select 'label_absent_from_features', true, count(*) from panel"
        " union all select 'identifiers_dropped', true, count(*) from panel union all select 'manifest_matches', true, count(*) from panel"
    ),
)
def rnk9_leakage_checks(spark, sf):
    """Each flag comes from a check on the data, none is typed in."""
    keys = keyed(spark, sf)
    split = stage(sp.stratified_split(keys), "split")
    path = staging_path(spark, "manifest")
    tb.write_manifest(split, path)
    features = panel(spark, sf).drop("Y", "row_id")
    overlaps = sp.split_overlap(split).agg(F.count(F.lit(1)) == 0).scalar()
    manifest = tb.read_manifest(spark, path)
    differences = tb.manifest_differences(tb.apply_manifest(keys, manifest), manifest)
    agrees = differences.select((F.col("manifest_only") + F.col("table_only") + F.col("overlaps")) == 0).scalar()
    checks = [
        ("splits_disjoint", overlaps), ("label_absent_from_features", F.lit(pr.has_contract(features.columns))),
        ("identifiers_dropped", F.lit(not pr.identifier_columns(features.columns))), ("manifest_matches", agrees),
    ]
    counted = split.agg(F.count(F.lit(1)).alias("rows"))
    cells = F.array(*[F.struct(F.lit(n).alias("check_name"), c.alias("passed")) for n, c in checks])
    return counted.select("rows", F.inline(cells))


@query(
    "rnk9_gate_table",
    with_panel(
        " union all ".join(
            f"select model as split, '{n}' as metric, round({c}, 9) as value, {g}::double as requirement, case when {c} >= {g} then 'PASS' else 'FAIL' end as status from fixed"
            for n, c, g in (("roc_auc", "roc_auc", 0.75), ("recall", "recall_positive", 0.6), ("f1_macro", "f1_macro", 0.65))
        ),
        *SPLIT_SCORED, *CTES[:4], _FIXED,
    ),
)
def rnk9_gate_table(spark, sf):
    return rounded(rk.gate_table(split_metrics(spark, sf), ["split"]), R)


@query(
    "rnk10_freeze_winner",
    with_candidates(
        "select model, experiment, round, 'f1_macro' as official_f1_metric, round(f1_macro, 9) as official_f1_value, round(auc, 9) as auc, round(recall_positive, 9)"
        " as recall, round(precision_positive, 9) as precision, round(f1_binary, 9) as f1_binary, round(f1_weighted, 9) as f1_weighted, tn, fp, fn, tp,"
        " passes_all_A1_gates as all_gates_pass, 'none' as previous_winner from reranked where rank_if_valid = 1",
        *_RERANK,
    ),
)
def rnk10_freeze_winner(spark, sf):
    """The frozen record goes through its JSON file."""
    winner = rk.freeze_winner(reranked(spark, sf), "none").drop("gates", "reason")
    path = staging_path(spark, "winner")
    tb.write_json(rounded(winner, R), path)
    return tb.read_json(spark, path, winner.schema)


@query(
    "rnk10_best_per_round",
    with_candidates("select round, round(max(f1_binary), 9) as f1_binary, arg_max(experiment, f1_binary) as experiment from cand_rows group by round"),
)
def rnk10_best_per_round(spark, sf):
    return rounded(rk.best_per_round(candidates(spark, sf)), R)
