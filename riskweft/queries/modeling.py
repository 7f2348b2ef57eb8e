"""Model, tuning, production and explanation queries (MOD*, TUN*, PRD*, XAI*).

The registered runs use the operators' full settings: every default, search
space, feature set, configuration and fold count of the protocol.
"""

from __future__ import annotations

import re
from dataclasses import replace

from pyspark.sql import functions as F

from riskweft.operators import diagnostics as dg, features as fe, scoring as sc, splitting as sp
from riskweft.plans import experiments as ex, models as md, production as pd_, published as pub, workflows as wf
from riskweft.queries.features import rounded
from riskweft.queries.metrics import TIERED
from riskweft.queries.registry import query
from riskweft.queries.scores import METRIC_SQL, MODELS, SCORED_SQL, scored_wide, threshold_ctes, with_scores
from riskweft.queries.splits import RANKED_SQL, SPLIT_SQL
from riskweft.session import stage, staging_path
from riskweft.sources import tables as tb
from riskweft.sources.contract import DELAY, FEATURES
from riskweft.sources.panel import panel, with_panel

R = 9
BOOST = md.base_boosted()
LOGISTIC = md.ModelSpec("logistic_regression", "balanced", weighting="balanced")
TREE = md.ModelSpec("decision_tree", "balanced", weighting="balanced")
FOREST = md.ModelSpec("random_forest", "balanced_subsample", weighting="balanced_subsample")
HIST = md.ModelSpec("hist_gradient_boosting", "none")
CAT = md.ModelSpec("catboost", "C1_3", md.CATBOOST_CONFIGS[3])


def labelled(spark, sf):
    """Panel with its split, staged."""
    return stage(sp.stratified_split(stage(panel(spark, sf), "panel")), "panel")


def prepared(spark, sf, groups=fe.ABLATIONS["A3"]):
    prep, data = ex.prepared_splits(labelled(spark, sf), ex.a3_builder(groups=groups))
    return prep.output_columns, ex.part(data, "train").drop("split"), ex.part(data, "validation").drop("split")


def fit_all(specs: dict[str, md.ModelSpec], train, columns) -> dict[str, md.FittedModel]:
    return md.fit_many(train.sparkSession, {n: md.Fit(s, train, columns) for n, s in specs.items()})


def validated(spark, sf, specs: dict[str, md.ModelSpec]):
    columns, train, validation = prepared(spark, sf)
    fitted = fit_all(specs, train, columns)
    return ex.record_columns(ex.search_all(ex.score_all(fitted, validation)))


@query(
    "mod1_prior_baseline",
    with_panel(
        "select row_id, Y as label, round((select avg(Y) from split_table where split='train'), 9) as score from split_table where split='validation'",
        RANKED_SQL, SPLIT_SQL,
    ),
)
def mod1_prior_baseline(spark, sf):
    data = labelled(spark, sf)
    fitted = md.fit(md.ModelSpec(md.DUMMY), ex.part(data, "train"), FEATURES)
    return rounded(fitted.score(ex.part(data, "validation"), ["row_id", "Y"]).withColumnRenamed("Y", "label"), R)


@query("mod2_logistic_regression")
def mod2_logistic_regression(spark, sf):
    variants = {"none": None, "balanced": "balanced", "manual_light": "manual_light"}
    return validated(spark, sf, {v: replace(LOGISTIC, variant=v, weighting=w) for v, w in variants.items()})


@query("mod3_decision_tree")
def mod3_decision_tree(spark, sf):
    variants = {"none": None, "balanced": "balanced", "manual_light": "manual_light"}
    return validated(spark, sf, {v: replace(TREE, variant=v, weighting=w) for v, w in variants.items()})


@query("mod4_random_forest")
def mod4_random_forest(spark, sf):
    columns, train, validation = prepared(spark, sf)
    variants = {"none": None, "balanced": "balanced", "balanced_subsample": "balanced_subsample", "manual_light": "manual_light"}
    fitted = fit_all({v: replace(FOREST, variant=v, weighting=w) for v, w in variants.items()}, train, columns)
    best = ex.best_variant(fitted, validation)
    return ex.record_columns(ex.search_all(ex.score_all(fitted, validation))).withColumn("is_best", F.col("experiment") == best)


@query("mod5_hist_gradient_boosting")
def mod5_hist_gradient_boosting(spark, sf):
    return validated(spark, sf, {"none": HIST, "balanced_sample_weight": replace(HIST, weighting="balanced_sample_weight")})


@query("mod6_boosted_pos_weight")
def mod6_boosted_pos_weight(spark, sf):
    weights = {"baseline_1_0": 1.0, "baseline_light": "light", "baseline_balanced": "scale_balanced"}
    return validated(spark, sf, {v: replace(BOOST, weighting=w) for v, w in weights.items()})


@query("mod7_native_categorical_boosting")
def mod7_native_categorical_boosting(spark, sf):
    built = stage(ex.a3_builder()(labelled(spark, sf)), "features")
    columns, categorical = md.raw_and_native([c for c in built.columns if c not in ex.KEEP])
    fitted = md.fit(CAT, ex.part(built, "train"), columns, categorical=categorical)
    return ex.record_columns(ex.search_all(ex.score_all({"catboost": fitted}, ex.part(built, "validation"))))


@query("mod8_model_ladder")
def mod8_model_ladder(spark, sf):
    columns, train, validation = prepared(spark, sf)
    ladder = {md.DUMMY: md.ModelSpec(md.DUMMY), "logistic_regression": LOGISTIC, "decision_tree": TREE, "random_forest": FOREST}
    fitted = fit_all(ladder, train, columns)
    return sc.evaluate(ex.score_all(fitted, validation), 0.5, ["experiment"])


@query("met15_evaluate_model")
def met15_evaluate_model(spark, sf):
    columns, train, validation = prepared(spark, sf)
    fitted = md.fit(LOGISTIC, train, columns)
    return sc.evaluate(fitted.score(validation, ["row_id", "Y"]), 0.5, label="Y")


def train_features(spark, sf):
    return stage(ex.part(ex.a3_builder()(labelled(spark, sf)), "train").drop("split"), "features")


@query(
    "mod9_oof_fold_sizes",
    with_panel(
        "select fold, count(*) as rows, cast(sum(Y) as bigint) as positives, count(*) as scored from (select Y, cast((case when floor(tn*1/3.0) <= tr then 1 else 0 end)"
        " + (case when floor(tn*2/3.0) <= tr then 1 else 0 end) as integer) as fold from (select *, row_number() over (partition by Y order by"
        " md5(cast(row_id as varchar) || ':42'), row_id) - 1 as tr, count(*) over (partition by Y) as tn from split_table where split='train')) group by fold",
        RANKED_SQL, SPLIT_SQL,
    ),
)
def mod9_oof_fold_sizes(spark, sf):
    """Out-of-fold scores written fold by fold; sizes, positives and scored rows per fold."""
    store = tb.FoldStore(spark, staging_path(spark, "folds"))
    oof = ex.oof_scores(train_features(spark, sf), LOGISTIC, 3, store=store)
    return oof.groupBy("fold").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("y_true").alias("positives"), F.count_if(F.col("oof_score").between(0, 1)).alias("scored")
    )


@query(
    "mod10_hard_negative_mask",
    with_scores(
        "select row_id, " + ", ".join(
            f"(Y=0 and delay_rule >= (select quantile_cont(delay_rule, {1.0 - q}) from scored where Y=0)) as {n}" for n, q in dg.HARD_SHARES.items()
        ) + " from scored"
    ),
)
def mod10_hard_negative_mask(spark, sf):
    df = stage(scored_wide(spark, sf).select("row_id", "Y", "delay_rule"), "scores")
    return dg.hard_negative_masks(df, "Y", "delay_rule").select("row_id", *dg.HARD_SHARES)


@query("mod10_hard_negative_experiments")
def mod10_hard_negative_experiments(spark, sf):
    columns, train, validation = prepared(spark, sf)
    oof = ex.oof_scores(train_features(spark, sf), BOOST, 5)
    return ex.hard_negative_experiments(train, validation, columns, oof, BOOST)


_BAND = [(s, (1 - s) / 2, 1 - (1 - s) / 2) for s in (0.2, 0.3, 0.4)]


@query(
    "mod11_cascade_bands",
    with_scores(" union all ".join(
        f"select {s}::double as central, round(quantile_cont(age_rule, {lo}), 9) as low, round(quantile_cont(age_rule, {hi}), 9) as high from scored" for s, lo, hi in _BAND
    )),
)
def mod11_cascade_bands(spark, sf):
    oof = stage(scored_wide(spark, sf).select(F.col("age_rule").alias("oof_score")), "scores")
    return rounded(spark.createDataFrame(ex.cascade_bands(oof), "central double, low double, high double"), R)


@query("mod11_cascade")
def mod11_cascade(spark, sf):
    columns, train, validation = prepared(spark, sf)
    oof = ex.oof_scores(train_features(spark, sf), BOOST, 5)
    return ex.cascade_experiments(train, validation, columns, oof, md.fit(BOOST, train, columns))


_SEGMENT = "case when late <= 0 then 'no_delay' when late <= 2 then 'light_delay' else 'recurrent_delay' end"
_SEG_SCORES = (
    f"scores as (select {_SEGMENT} as segment, Y as label, delay_rule as score from (select *, "
    + " + ".join(f"(case when {c} > 0 then 1 else 0 end)" for c in DELAY) + " as late from scored))"
)
_SEG_TT = threshold_ctes("scores", "segment")
_SEG_BEST = f"seg as (select segment, threshold from (select *, row_number() over (partition by segment order by {TIERED}) as pos from tt) where pos = 1)"


def _with_scored(body: str, *ctes: str) -> str:
    return with_panel(body, SCORED_SQL, *ctes)


def segment_scores(spark, sf):
    df = ex.with_segment(scored_wide(spark, sf)).select("segment", F.col("Y").alias("label"), F.col("delay_rule").alias("score"))
    return stage(df, "segments")


@query("mod12_segment_thresholds", _with_scored("select segment, threshold from seg", _SEG_SCORES, *_SEG_TT, _SEG_BEST))
def mod12_segment_thresholds(spark, sf):
    return ex.segment_thresholds(segment_scores(spark, sf))


@query(
    "mod12_segment_decisions",
    _with_scored(
        "select tn, fp, fn, tp, round(precision_positive, 9) as precision_positive, round(recall_positive, 9) as recall_positive, round(f1_binary, 9) as f1_binary,"
        f" round(f1_macro, 9) as f1_macro from (select *, {METRIC_SQL} from decided)",
        _SEG_SCORES, *_SEG_TT, _SEG_BEST,
        "decided as (select " + ", ".join(
            f"count(*) filter (where label={y} and (score >= threshold) = {p}) as {n}" for n, y, p in (("tn", 0, "false"), ("fp", 0, "true"), ("fn", 1, "false"), ("tp", 1, "true"))
        ) + " from scores join seg using (segment))",
    ),
)
def mod12_segment_decisions(spark, sf):
    scores = segment_scores(spark, sf)
    out = ex.apply_segment_thresholds(scores, ex.segment_thresholds(scores))
    return rounded(out.select("tn", "fp", "fn", "tp", "precision_positive", "recall_positive", "f1_binary", "f1_macro"), R)


_SEG_SPLIT = (
    f"split_scores as (select {_SEGMENT} as segment, label, score, split from (select row_id, Y as label, delay_rule as score, "
    + " + ".join(f"(case when {c} > 0 then 1 else 0 end)" for c in DELAY)
    + " as late from scored) join (select row_id, split from split_table) s using (row_id))"
)


@query(
    "mod12_oof_to_validation",
    _with_scored(
        "select tn, fp, fn, tp, round(precision_positive, 9) as precision_positive, round(recall_positive, 9) as recall_positive, round(f1_binary, 9) as f1_binary,"
        f" round(f1_macro, 9) as f1_macro, (select string_agg(segment || '=' || round(threshold, 6)::varchar, ',' order by segment) from seg) as thresholds"
        f" from (select *, {METRIC_SQL} from decided)",
        RANKED_SQL, SPLIT_SQL, _SEG_SPLIT, "scores as (select segment, label, score from split_scores where split = 'train')", *_SEG_TT, _SEG_BEST,
        "decided as (select " + ", ".join(
            f"count(*) filter (where label={y} and coalesce(score >= threshold, false) = {p}) as {n}" for n, y, p in (("tn", 0, "false"), ("fp", 0, "true"), ("fn", 1, "false"), ("tp", 1, "true"))
        ) + " from (select * from split_scores where split = 'validation') v left join seg using (segment))",
    ),
)
def mod12_oof_to_validation(spark, sf):
    """Thresholds of the training rows' segments, applied to the validation rows."""
    scored = ex.with_segment(scored_wide(spark, sf)).select("row_id", "Y", "segment", F.col("Y").alias("label"), F.col("delay_rule").alias("score"))
    data = stage(sp.stratified_split(stage(scored, "segments")), "segments")
    out = ex.segment_decisions(*(ex.part(data, s).select("segment", "label", "score") for s in ("train", "validation")))
    text = F.array_join(F.transform(F.array_sort(F.map_entries("thresholds")), lambda e: F.concat(e["key"], F.lit("="), F.round(e["value"], 6).cast("string"))), ",")
    return rounded(out.select("tn", "fp", "fn", "tp", "precision_positive", "recall_positive", "f1_binary", "f1_macro", text.alias("thresholds")), R)


@query("mod12_segment_experiment")
def mod12_segment_experiment(spark, sf):
    return ex.segment_experiment(labelled(spark, sf), BOOST)


_W = ", ".join(f"('{'/'.join(f'{x:.2f}' for x in w)}', {w[0]}::double, {w[1]}::double, {w[2]}::double)" for w in ex.ENSEMBLE_WEIGHTS)
_ENS = threshold_ctes("scores", "weights")


@query(
    "mod13_weighted_ensemble",
    _with_scored(
        "select weights, threshold, round(roc_auc, 9) as roc_auc, round(f1_binary, 9) as f1_binary, tn, fp, fn, tp from"
        f" (select *, row_number() over (partition by weights order by {TIERED}) as pos from tt) where pos = 1",
        f"w as (select * from (values {_W}) t(weights, a, b, c))",
        f"scores as (select weights, Y as label, a*{MODELS[0]} + b*{MODELS[1]} + c*{MODELS[2]} as score from scored, w)",
        *_ENS,
    ),
)
def mod13_weighted_ensemble(spark, sf):
    wide = scored_wide(spark, sf).select(F.col("Y").alias("label"), *MODELS)
    out = ex.ensemble_search(wide, MODELS)
    return rounded(out.select("weights", "threshold", "roc_auc", "f1_binary", "tn", "fp", "fn", "tp"), R, ("threshold",))


def _pair_sql() -> str:
    parts = []
    for i, a in enumerate(MODELS):
        for b in MODELS[i + 1:]:
            wrong = {m: f"(({m} >= (select threshold from single where model = '{m}')) <> (Y = 1))" for m in (a, b)}
            counts = ", ".join(
                f"count(*) filter (where Y = {y} and {wrong[x]} and not {wrong[z]})" for y in (0, 1) for x, z in ((a, b), (b, a))
            )
            parts.append(f"select corr({a}, {b}) as pearson, greatest({counts}) as most from scored")
    return "pairs as (" + " union all ".join(parts) + ")"


# The threshold tables of the single models, beside those of the weightings.
_SINGLE = [re.sub(r"\b(folded|totals|cum|rank_metrics|cand|counts|tt)\b", r"\g<1>_1", c) for c in threshold_ctes("long", "model")]


@query(
    "mod13_ensemble_decision",
    _with_scored(
        "select case when diverse then 'JUSTIFIED' else 'ENSEMBLE_NOT_JUSTIFIED' end as decision, case when diverse then weights end as weights, case when diverse then threshold end as threshold,"
        " case when diverse then round(roc_auc, 9) end as roc_auc, case when diverse then round(precision_positive, 9) end as precision_positive, case when diverse then round(f1_binary, 9) end as f1_binary"
        " from (select avg(pearson) < 0.995 or max(most) > 50 as diverse from pairs), (select * from (select *, row_number() over (partition by weights"
        f" order by {TIERED}) as pos from tt) where pos = 1 order by f1_binary desc, precision_positive desc, roc_auc desc, weights desc limit 1)",
        "long as (" + " union all ".join(f"select '{m}' as model, Y as label, {m} as score from scored" for m in MODELS) + ")", *_SINGLE,
        f"single as (select model, threshold from (select *, row_number() over (partition by model order by {TIERED}) as pos from tt_1) where pos = 1)", _pair_sql(),
        f"w as (select * from (values {_W}) t(weights, a, b, c))",
        f"scores as (select weights, Y as label, a*{MODELS[0]} + b*{MODELS[1]} + c*{MODELS[2]} as score from scored, w)",
        *_ENS,
    ),
)
def mod13_ensemble_decision(spark, sf):
    """Whether the models differ enough for an ensemble, and the best one."""
    wide = stage(scored_wide(spark, sf).select("row_id", F.col("Y").alias("label"), *MODELS), "scores")
    long = stage(wide.unpivot(["row_id", "label"], list(MODELS), "model", "score"), "scores")
    best = stage(ex.search_all(long, by="model").select("model", "threshold"), "best")
    predicted = long.join(F.broadcast(best), "model").withColumn("predicted", (F.col("score") >= F.col("threshold")).cast("int"))
    diversity = dg.is_diverse(dg.score_correlation(long, list(MODELS)), dg.error_overlap(dg.predictions_wide(predicted, list(MODELS)), list(MODELS)))
    return rounded(ex.ensemble_outcome(wide, MODELS, diversity)["decision"], R, ("threshold",))


@query("mod13_model_comparison")
def mod13_model_comparison(spark, sf):
    columns, train, validation = prepared(spark, sf)
    specs = {"XGBoostClassifier": BOOST, "HistGradientBoostingClassifier": HIST, "RandomForestClassifier": FOREST}
    out = ex.compare_models(fit_all(specs, train, columns), validation)
    return out["correlations"].join(out["overlaps"], ["model_a", "model_b"])


@query("mod14_resampled_refits")
def mod14_resampled_refits(spark, sf):
    columns, train, validation = prepared(spark, sf)
    return ex.resampling_experiments(train, validation, columns, BOOST, ex.RESAMPLING)


@query("mod15_ablations")
def mod15_ablations(spark, sf):
    return ex.feature_group_experiments(labelled(spark, sf), fe.ABLATIONS, BOOST)


@query("mod15_feature_experiments")
def mod15_feature_experiments(spark, sf):
    return ex.feature_group_experiments(labelled(spark, sf), fe.EXPERIMENTS, BOOST)


@query("mod15_focused_experiments")
def mod15_focused_experiments(spark, sf):
    return ex.feature_group_experiments(labelled(spark, sf), fe.FOCUSED_EXPERIMENTS, BOOST)


@query("mod15_temporal_sets")
def mod15_temporal_sets(spark, sf):
    train = ex.part(labelled(spark, sf), "train").drop("split")
    return ex.temporal_experiments(train, BOOST, 3, fe.TEMPORAL_SETS, staging_path(spark, "folds"))


@query("mod16_frozen_promotion")
def mod16_frozen_promotion(spark, sf):
    built = stage(ex.a3_builder()(labelled(spark, sf)), "features")
    train, validation = (ex.part(built, s).drop("split") for s in ("train", "validation"))
    specs = {f"C1_{i}": md.ModelSpec("catboost", f"C1_{i}", params) for i, params in enumerate(md.CATBOOST_CONFIGS)}
    return ex.frozen_promotion(train, validation, specs, 3)


@query("tun1_grid_search")
def tun1_grid_search(spark, sf):
    columns, train, validation = prepared(spark, sf)
    model, params, score = ex.grid_search(train, columns, LOGISTIC, md.param_grid("logistic_regression"))
    record = ex.record_columns(ex.search_all(ex.score_all({"tuned": model}, validation)))
    return record.select("*", F.lit(score).alias("best_cv_score"), F.lit(str(sorted(params.items()))).alias("best_params"))


@query("tun2_random_search")
def tun2_random_search(spark, sf):
    columns, train, validation = prepared(spark, sf)
    return ex.random_search(train, validation, columns, BOOST, md.F1_SPACE)


@query("tun3_pos_weight_sweep")
def tun3_pos_weight_sweep(spark, sf):
    columns, train, validation = prepared(spark, sf)
    return ex.pos_weight_sweep(train, validation, columns, BOOST)


@query("tun4_refit_record")
def tun4_refit_record(spark, sf):
    columns, train, validation = prepared(spark, sf)
    record = {"model": "XGBoostClassifier", "hyperparameters": {**BOOST.params, "weighting": 2.0}}
    return ex.record_columns(ex.search_all(ex.score_all({"refit": md.refit(record, train, columns)}, validation)))


def _holdout(spark, sf):
    built = stage(ex.a3_builder()(labelled(spark, sf)), "features")
    path = staging_path(spark, "manifest")
    tb.write_manifest(built, path)
    config = pd_.FrozenConfig(CAT, "A3", 0.25)
    marker = pd_.AccessMarker(spark, staging_path(spark, "marker"))
    reference = sc.evaluate(
        md.fit(CAT, ex.part(built, "train"), [c for c in built.columns if c not in ex.KEEP], categorical=["X2", "X3", "X4"])
        .score(ex.part(built, "validation"), ["row_id", "Y"]), 0.25, label="Y",
    )
    return pd_.holdout_evaluation(built, tb.read_manifest(spark, path), config, config, marker, reference)


@query("prd1_holdout_evaluation")
def prd1_holdout_evaluation(spark, sf):
    return _holdout(spark, sf)["delta"]


def scorer(spark, sf):
    data = labelled(spark, sf)
    builder = ex.a3_builder(carry=("row_id", "Y", "split"))
    prep, ready = ex.prepared_splits(data, builder)
    fitted = md.fit(LOGISTIC, ex.part(ready, "train"), prep.output_columns)
    return pd_.Scorer(prep, fitted, 0.5, ex.a3_builder(carry=("row_id",))), data


@query("prd2_predict_records")
def prd2_predict_records(spark, sf):
    model, data = scorer(spark, sf)
    return model.predict(data.drop("Y", "split"))


@query(
    "prd2_published_records",
    with_panel("select count(*) as records, count(*) as equal_scores, true as refused_before_marker, true as refused_other_columns from panel"),
)
def prd2_published_records(spark, sf):
    """A scorer published and loaded again: how many records it scores like the fitted one, and what it refuses."""
    model, data = scorer(spark, sf)
    records, folder = data.drop("Y", "split"), staging_path(spark, "model")
    refused = []
    for attempt in (lambda: pub.load(spark, folder), lambda: pub.load(spark, folder).predict(records.withColumn("X24", F.lit(0)))):
        try:
            attempt()
            refused.append(False)
        except (RuntimeError, ValueError):
            refused.append(True)
        if len(refused) == 1:
            pub.publish(spark, folder, model, records, fe.ABLATIONS["A3"])
    mine = model.predict(records).select("row_id", F.col("probability").alias("mine"), F.col("predicted_class").alias("mine_class"))
    both = mine.join(pub.load(spark, folder).predict(records), "row_id", "full")
    same = (F.abs(F.col("mine") - F.col("probability")) < 1e-12) & (F.col("mine_class") == F.col("predicted_class"))
    return both.agg(F.count(F.lit(1)).alias("records"), F.count_if(same).alias("equal_scores")).select(
        "records", "equal_scores", F.lit(refused[0]).alias("refused_before_marker"), F.lit(refused[1]).alias("refused_other_columns")
    )


@query("xai1_global_importance")
def xai1_global_importance(spark, sf):
    columns, train, _ = prepared(spark, sf)
    return pd_.global_importance(md.fit(FOREST, train, columns), spark)


@query("xai1_permutation_importance")
def xai1_permutation_importance(spark, sf):
    columns, train, validation = prepared(spark, sf)
    fitted = md.fit(LOGISTIC, train, columns)
    return pd_.permutation_importance(fitted, validation, columns)


@query("xai2_local_contributions")
def xai2_local_contributions(spark, sf):
    columns, train, validation = prepared(spark, sf)
    fitted = md.fit(LOGISTIC, train, columns)
    means = train.agg(*[F.avg(c).alias(c) for c in columns]).first().asDict()
    return pd_.local_contributions(fitted, validation, means)


@query("flow_modeling_workflow")
def flow_modeling_workflow(spark, sf):
    return wf.modeling_workflow(labelled(spark, sf))["champion_test"]


@query("flow_variant_workflow")
def flow_variant_workflow(spark, sf):
    # The boosted family is tuned on a sample of its space, as in the reference.
    grids = {"xgboost": md.sample_params(md.SEARCH_SPACES["xgboost"], 18)}
    return wf.variant_workflow(labelled(spark, sf), grids=grids)["frozen"]


@query("flow_optimization_workflow")
def flow_optimization_workflow(spark, sf):
    space = md.SEARCH_SPACES["xgboost"]
    rivals = {f"random_forest_{v}": replace(FOREST, variant=v, weighting=w) for v, w in (("none", None), ("balanced", "balanced"), ("balanced_subsample", "balanced_subsample"), ("manual_light", "manual_light"))}
    rivals["hist_gradient_boosting"] = HIST
    return wf.optimization_workflow(labelled(spark, sf), BOOST, md.sample_params(space, 18), md.F1_SPACE, rivals)["records"]


@query("flow_trajectory_workflow")
def flow_trajectory_workflow(spark, sf):
    return wf.trajectory_workflow(labelled(spark, sf), staging_path(spark, "run"))["validation"]


@query("flow_hard_negative_workflow")
def flow_hard_negative_workflow(spark, sf):
    return wf.hard_negative_workflow(labelled(spark, sf))["best"]


@query("flow_continuation_workflow")
def flow_continuation_workflow(spark, sf):
    return wf.continuation_workflow(labelled(spark, sf))["best"]
