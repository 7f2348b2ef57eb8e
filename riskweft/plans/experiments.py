"""Experiment building blocks: scoring, out-of-fold scores, weighting, cascade, segments, ensembles, tuning."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, replace
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, functions as F

from riskweft.operators import diagnostics as dg, prep as pp, ranking as rk, scoring as sc, splitting as sp
from riskweft.operators.features import ABLATIONS, TEMPORAL_SETS, behavioral_features, feature_set
from riskweft.operators.quantiles import bracketed_quantiles
from riskweft.plans import models as md
from riskweft.session import side_by_side, stage
from riskweft.sources.contract import DELAY, SEED
from riskweft.sources.tables import FoldStore

KEEP = ("row_id", "Y", "split")


def prepared_splits(df: DataFrame, builder: Callable[[DataFrame], DataFrame]) -> tuple[pp.Preparation, DataFrame]:
    """Features, train-only preparation and every split transformed, staged once for all models."""
    prep, out = pp.build_and_prepare(stage(builder(df), "features"), keep=KEEP)
    return prep, stage(out, "prepared")


def a3_builder(trajectory: Sequence[str] = (), groups: Sequence[str] = ABLATIONS["A3"], carry: Sequence[str] = KEEP) -> Callable[[DataFrame], DataFrame]:
    if trajectory:
        return lambda df: feature_set(df, groups, trajectory, carry)
    return lambda df: behavioral_features(df, groups, carry)


def part(df: DataFrame, split: str) -> DataFrame:
    return df.where(F.col("split") == split)


def score_all(fitted: dict[str, md.FittedModel], df: DataFrame, label: str = "Y") -> DataFrame:
    """(experiment, row_id, label, score) of all models over one table, staged."""
    parts = [m.score(df, ["row_id", label]).select(F.lit(n).alias("experiment"), "row_id", F.col(label).alias("label"), "score") for n, m in fitted.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return stage(out, "scores")


def search_all(scores: DataFrame, by: str = "experiment", objective: str | None = None) -> DataFrame:
    """Best threshold and metrics of every experiment in one grouped search."""
    folded = sc.fold_scores(scores, [by])
    table = sc.threshold_table(folded, [by], rank_columns=("roc_auc", "average_precision"))
    return sc.best_threshold(table, [by]) if objective is None else sc.objective_threshold(table, [by], objective)


def record_columns(best: DataFrame, keep: Sequence[str] = ("experiment",)) -> DataFrame:
    valid = F.col("valid_candidate")
    return best.select(
        *keep, "average_precision", F.col("roc_auc").alias("auc"), "precision", "recall", "f1_binary", "f1_macro", "f1_weighted", "threshold",
        "tp", "fp", "tn", "fn", valid,
    )


# --- out-of-fold scores ----------------------------------------------------------------------------


@dataclass(frozen=True)
class OofRun:
    """One out-of-fold run: train holds row_id, the label and already built, label-free features."""

    train: DataFrame
    spec: md.ModelSpec
    store: FoldStore | None = None
    native: bool = False


def _fold_fit(run: OofRun, folds: DataFrame, i: int, label: str) -> tuple[md.Fit, DataFrame]:
    """The fit on all folds but one, with the preparation of its own rows, and the held-out rows ready to be scored."""
    fit_rows, held = folds.where(F.col("fold") != i).drop("fold"), folds.where(F.col("fold") == i).drop("fold")
    keep = ("row_id", label)
    if run.native:
        columns = [c for c in run.train.columns if c not in keep]
        return md.Fit(run.spec, fit_rows, columns, label, categorical=md.raw_and_native(columns)[1]), held
    prep = pp.fit_preparation(fit_rows, keep=keep)
    return md.Fit(run.spec, pp.transform(prep, fit_rows, keep), prep.output_columns, label), pp.transform(prep, held, keep)


def oof_many(runs: dict[str, OofRun], k: int = 3, label: str = "Y", seed: int = SEED) -> dict[str, DataFrame]:
    """(row_index, y_true, oof_score, fold) of each run: each row scored once, by a model that has not seen its fold.

    All folds of all runs are independent fits and are handed over together.
    Runs on the same table share its folds; runs with the same native columns
    also share the tables of their fits. Folds found in a store are not computed
    again.
    """
    spark, started = next(iter(runs.values())).train.sparkSession, time.monotonic()
    trains = {id(run.train): run.train for run in runs.values()}
    staged = side_by_side(spark, [lambda t=t: stage(sp.stratified_folds(t, k, label=label, seed=seed), "folds") for t in trains.values()])
    folded = dict(zip(trains, staged))
    done = {name: run.store.finished() if run.store else set() for name, run in runs.items()}
    missing = [(name, i) for name in runs for i in range(k) if i not in done[name]]
    first = {(id(runs[name].train), runs[name].native, i): runs[name] for name, i in reversed(missing)}
    shared = dict(zip(first, side_by_side(spark, [partial(_fold_fit, run, folded[train], i, label) for (train, _, i), run in first.items()])))
    tasks, held = {}, {}
    for name, i in missing:
        common, held[name, i] = shared[id(runs[name].train), runs[name].native, i]
        tasks[name, i] = replace(common, spec=runs[name].spec)
    fitted = md.fit_many(spark, tasks) if tasks else {}
    elapsed = (time.monotonic() - started) / max(1, len(tasks))

    def scored(name: str, i: int) -> DataFrame:
        rows = fitted[name, i].score(held[name, i], ["row_id", label]).select("row_id", F.col(label).cast("int").alias("label"), "score")
        if runs[name].store is None:
            return rows.withColumn("fold", F.lit(i))
        rows = stage(rows, "fold")
        folded_scores = sc.fold_scores(rows)
        auc = sc.rank_metrics(folded_scores).first()["roc_auc"]
        f1 = sc.fast_threshold(sc.threshold_counts(folded_scores)).first()["f1_binary"]
        runs[name].store.save(i, rows.select("*", F.lit(auc).alias("auc"), F.lit(f1).alias("f1_binary"), F.lit(elapsed).alias("elapsed_seconds")))
        return rows

    parts = dict(zip(missing, side_by_side(spark, [partial(scored, name, i) for name, i in missing])))

    def whole(name: str, run: OofRun) -> DataFrame:
        result = run.store.load() if run.store else stage(reduce(DataFrame.unionByName, [parts[name, i] for i in range(k)]), "oof")
        oof = result.select(F.col("row_id").alias("row_index"), F.col("label").alias("y_true"), F.col("score").alias("oof_score"), "fold")
        require_one_score(oof, run.train)
        return oof

    return dict(zip(runs, side_by_side(spark, [partial(whole, name, run) for name, run in runs.items()])))


def oof_scores(
    train: DataFrame, spec: md.ModelSpec, k: int = 3, label: str = "Y", store: FoldStore | None = None, seed: int = SEED, native: bool = False,
) -> DataFrame:
    """One run of oof_many."""
    return oof_many({"": OofRun(train, spec, store, native)}, k, label, seed)[""]


def _named_scores(oofs: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        oof.select(F.lit(name).alias("experiment"), F.col("row_index").alias("row_id"), F.col("y_true").alias("label"), F.col("oof_score").alias("score")) for name, oof in oofs.items()
    ])


def require_one_score(oof: DataFrame, train: DataFrame) -> None:
    """Every training row exactly once, none without a score."""
    doubled = oof.groupBy("row_index").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("oof_score").isNull()).alias("missing"))
    both = train.select(F.col("row_id").alias("row_index")).join(doubled, "row_index", "full")
    bad = both.where((F.coalesce("n", F.lit(0)) != 1) | (F.coalesce("missing", F.lit(0)) > 0))
    if not bad.isEmpty():
        raise AssertionError("every training row must receive exactly one out-of-fold score")


# --- weighting, cascade, segments, ensemble ---------------------------------------------------------


def with_hard_negatives(oof: DataFrame) -> DataFrame:
    marked = dg.hard_negative_masks(oof, "y_true", "oof_score")
    any_mark = F.lit(False)
    for n in dg.HARD_SHARES:
        any_mark = any_mark | F.col(n)
    return marked.withColumn("is_hard_negative", any_mark)


def hard_negative_experiments(train: DataFrame, validation: DataFrame, columns: Sequence[str], oof: DataFrame, base: md.ModelSpec) -> DataFrame:
    """Baseline and refits with heavier hard negatives under the recall gate: the baseline's threshold by F1, the refits' by precision."""
    marked = stage(with_hard_negatives(oof).withColumnRenamed("row_index", "row_id").drop("y_true", "fold", "oof_score"), "marks")
    joined = stage(train.join(marked, "row_id"), "weighted")
    plans = [(name, weight, md.BASE_POS_WEIGHT) for name in dg.HARD_SHARES for weight in (2.0, 3.0)] + [("top_10pct", 2.0, 1.0)]
    # The baseline stands on the joined table too, with weight one, so all models share their passes.
    tasks = {"baseline": md.Fit(base, joined, columns)}
    for name, weight, scale in plans:
        row_weight = F.when(F.col(name), weight).otherwise(1.0)
        tasks[f"hn_{name}_{weight:g}_spw_{scale:g}"] = md.Fit(replace(base, weighting=scale), joined, columns, row_weight=row_weight)
    fitted = md.fit_many(train.sparkSession, tasks)
    scores = score_all(fitted, validation)
    first = search_all(scores.where("experiment = 'baseline'"), objective="f1")
    return record_columns(first.unionByName(search_all(scores.where("experiment <> 'baseline'"), objective="precision")))


def cascade_bands(oof: DataFrame, shares: Sequence[float] = (0.20, 0.30, 0.40)) -> list[tuple[float, float, float]]:
    """(share, low, high): exact score bounds of the central share of out-of-fold scores."""
    probs = {}
    for i, s in enumerate(shares):
        probs[f"lo{i}"], probs[f"hi{i}"] = (1 - s) / 2, 1 - (1 - s) / 2
    row = bracketed_quantiles(oof, {"score": F.col("oof_score")}, probs)["score"]
    return [(s, row[f"lo{i}"], row[f"hi{i}"]) for i, s in enumerate(shares)]


def cascade_experiments(train: DataFrame, validation: DataFrame, columns: Sequence[str], oof: DataFrame, first: md.FittedModel, max_iter: int = 1000) -> DataFrame:
    """A second-stage logistic model for the ambiguous middle band replaces the first score there."""
    scored = stage(train.join(oof.select(F.col("row_index").alias("row_id"), F.col("oof_score").alias("stage1_score")), "row_id"), "stage1")
    held = stage(first.score(validation, score="stage1_score"), "stage1")
    spec = md.ModelSpec("logistic_regression", "specialist", {"max_iter": max_iter}, "balanced")
    bands = {f"cascade_central_{round(share * 100, 6):g}": (low, high) for share, low, high in cascade_bands(oof)}
    inner = {name: scored.where(F.col("stage1_score").between(low, high)) for name, (low, high) in bands.items()}
    specialists = md.fit_many(train.sparkSession, {name: md.Fit(spec, band, [*columns, "stage1_score"]) for name, band in inner.items()})
    parts, facts = [], []
    for name, (low, high) in bands.items():
        inside = F.col("stage1_score").between(low, high)
        parts.append(specialists[name].score(held, ["row_id", "Y", "stage1_score"]).select(
            F.lit(name).alias("experiment"), "row_id", F.col("Y").alias("label"), F.when(inside, F.col("score")).otherwise(F.col("stage1_score")).alias("score")
        ))
        row = inner[name].agg(F.count(F.lit(1)).alias("n"), F.avg("Y").alias("rate")).first()
        facts.append((name, low, high, row["n"], row["rate"]))
    scores = parts[0]
    for p in parts[1:]:
        scores = scores.unionByName(p)
    info = train.sparkSession.createDataFrame(
        facts, "experiment string, ambiguous_lower double, ambiguous_upper double, ambiguous_train_count bigint, ambiguous_positive_rate double"
    )
    return record_columns(search_all(stage(scores, "cascade"), objective="precision")).join(info, "experiment")


def delay_segment(cells: Sequence[Column]) -> Column:
    late = sum((F.when(c > 0, 1).otherwise(0) for c in cells), F.lit(0))
    return F.when(late <= 0, "no_delay").when(late <= 2, "light_delay").otherwise("recurrent_delay")


def segment_thresholds(scores: DataFrame, segment: str = "segment") -> DataFrame:
    """(segment, threshold) from one grouped search over (segment, label, score)."""
    folded = sc.fold_scores(scores, [segment])
    return sc.best_threshold(sc.threshold_table(folded, [segment]), [segment]).select(segment, "threshold")


def apply_segment_thresholds(scores: DataFrame, thresholds: DataFrame, segment: str = "segment") -> DataFrame:
    """Global counts and metrics of the per-segment decisions; a segment without threshold predicts 0."""
    # Three segments: the threshold table is safe to broadcast.
    joined = scores.join(F.broadcast(thresholds), segment, "left")
    decided = joined.withColumn("predicted", F.coalesce((F.col("score") >= F.col("threshold")).cast("int"), F.lit(0)))
    counts = sc.with_metrics(sc.confusion(decided))
    ranks = sc.rank_metrics(sc.fold_scores(scores))
    return counts.withColumn("roc_auc", ranks.select("roc_auc").scalar())


def with_segment(df: DataFrame) -> DataFrame:
    return df.withColumn("segment", delay_segment([F.col(c) for c in DELAY]))


def segment_decisions(chosen_on: DataFrame, applied_to: DataFrame, segment: str = "segment") -> DataFrame:
    """One row: thresholds per segment found on the first scores, and the metrics of their decisions on the second; both are (segment, label, score)."""
    thresholds = stage(segment_thresholds(chosen_on, segment), "thresholds")
    # Three segments.
    listed = thresholds.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(segment, "threshold")))).alias("thresholds"))
    return apply_segment_thresholds(applied_to, thresholds, segment).withColumn("thresholds", listed.scalar())


def segment_experiment(df: DataFrame, spec: md.ModelSpec, k: int = 5) -> DataFrame:
    """Thresholds per delay segment from out-of-fold scores of the training rows, applied to the validation scores of the model of all training rows."""
    builder = a3_builder()
    prep, data = prepared_splits(df, builder)
    built = stage(part(builder(df), "train").drop("split"), "features")
    segments = with_segment(df).select("row_id", "segment")
    oof = oof_scores(built, spec, k).select(F.col("row_index").alias("row_id"), F.col("y_true").alias("label"), F.col("oof_score").alias("score"))
    fitted = md.fit(spec, part(data, "train"), prep.output_columns)
    held = stage(fitted.score(part(data, "validation"), ["row_id", "Y"]).withColumnRenamed("Y", "label"), "scores")
    return segment_decisions(oof.join(segments, "row_id"), held.join(segments, "row_id"))


# The compared weight triples.
ENSEMBLE_WEIGHTS = (
    (1.0, 0.0, 0.0), (0.8, 0.1, 0.1), (0.7, 0.15, 0.15), (0.6, 0.2, 0.2),
    (0.5, 0.25, 0.25), (0.5, 0.4, 0.1), (0.4, 0.4, 0.2), (0.4, 0.3, 0.3),
)


def ensemble_scores(wide: DataFrame, models: Sequence[str], label: str = "label") -> DataFrame:
    """(weights, label, score): one row per weight triple and input row; folded right away by the search."""
    cells = [
        F.struct(
            F.lit("/".join(f"{x:.2f}" for x in w)).alias("weights"),
            (F.lit(w[0]) * F.col(models[0]) + F.lit(w[1]) * F.col(models[1]) + F.lit(w[2]) * F.col(models[2])).alias("score"),
        )
        for w in ENSEMBLE_WEIGHTS
    ]
    return wide.select(F.col(label).alias("label"), F.inline(F.array(*cells)))


def ensemble_search(wide: DataFrame, models: Sequence[str], label: str = "label") -> DataFrame:
    folded = sc.fold_scores(ensemble_scores(wide, models, label), ["weights"])
    return sc.best_threshold(sc.threshold_table(folded, ["weights"]), ["weights"])


def compare_models(fitted: dict[str, md.FittedModel], validation: DataFrame) -> dict[str, DataFrame]:
    """Records, score correlations, error overlaps and, if the models differ enough, weighted ensembles."""
    names = list(fitted)
    scores = score_all(fitted, validation)
    best = stage(search_all(scores), "best")
    long = scores.withColumnRenamed("experiment", "model")
    # One threshold per compared model.
    predicted = long.join(F.broadcast(best.select(F.col("experiment").alias("model"), "threshold")), "model").withColumn(
        "predicted", (F.col("score") >= F.col("threshold")).cast("int")
    )
    correlation = stage(dg.score_correlation(long, names), "correlation")
    overlap = stage(dg.error_overlap(dg.predictions_wide(predicted, names), names), "overlap")
    diversity = dg.is_diverse(correlation, overlap)
    out = {"comparison": record_columns(best), "correlations": correlation, "overlaps": overlap, "diversity": diversity}
    if len(names) == 3:
        out |= ensemble_outcome(dg.predictions_wide(long, names, value="score"), names, diversity)
    return out


def ensemble_outcome(wide: DataFrame, models: Sequence[str], diversity: DataFrame, label: str = "label") -> dict[str, DataFrame]:
    """decision: one row that says whether an ensemble is justified, with the best one if so; ensemble: all weightings if so."""
    # One row with one flag.
    if not diversity.first()["diverse"]:
        nothing = "weights string, threshold double, roc_auc double, precision_positive double, f1_binary double"
        row = wide.sparkSession.createDataFrame([("ENSEMBLE_NOT_JUSTIFIED",) + (None,) * 5], f"decision string, {nothing}")
        return {"decision": row}
    ensemble = stage(ensemble_search(wide, models, label), "ensemble")
    order = [F.desc(c) for c in ("f1_binary", "precision_positive", "roc_auc")]
    best = ensemble.orderBy(*order, F.desc("weights")).limit(1)
    picked = best.select(F.lit("JUSTIFIED").alias("decision"), "weights", "threshold", "roc_auc", "precision_positive", "f1_binary")
    return {"decision": picked, "ensemble": ensemble}


# --- experiment series -------------------------------------------------------------------------------


def feature_group_experiments(df: DataFrame, sets: dict[str, Sequence[str]], spec: md.ModelSpec) -> DataFrame:
    """One fixed model per named feature set, compared on validation."""
    spark = df.sparkSession
    ready = dict(zip(sets, side_by_side(spark, [partial(prepared_splits, df, a3_builder(groups=groups)) for groups in sets.values()])))
    fitted = md.fit_many(df.sparkSession, {n: md.Fit(spec, part(data, "train"), prep.output_columns) for n, (prep, data) in ready.items()})
    parts = side_by_side(spark, [partial(score_all, {n: fitted[n]}, part(data, "validation")) for n, (_, data) in ready.items()])
    scores = reduce(DataFrame.unionByName, parts)
    sizes = []
    for name, groups in sets.items():
        prep = ready[name][0]
        sizes.append((name, "+".join(groups), 23, len(prep.engineered_columns), len(prep.output_columns)))
    info = df.sparkSession.createDataFrame(
        sizes, "experiment string, feature_groups string, n_original_features int, n_new_features int, n_model_features int"
    )
    return record_columns(search_all(scores)).join(info, "experiment")


def resampling_experiments(train: DataFrame, validation: DataFrame, columns: Sequence[str], spec: md.ModelSpec, plans: Iterable[tuple[str, float]]) -> DataFrame:
    plans = list(plans)
    made = side_by_side(train.sparkSession, [lambda s=s, r=r: stage(sp.resample(train, r, s), "resampled") for s, r in plans])
    tables = {f"{strategy}_{ratio:g}": table for (strategy, ratio), table in zip(plans, made)}
    fitted = md.fit_many(train.sparkSession, {n: md.Fit(spec, t, columns) for n, t in tables.items()})
    return record_columns(search_all(score_all(fitted, validation)))


RESAMPLING = tuple((s, r) for s in ("undersampling", "oversampling") for r in (3.0, 2.0, 1.5, 1.0))


def temporal_experiments(df: DataFrame, spec: md.ModelSpec, k: int = 3, sets: dict[str, Sequence[str]] | None = None, store_root: str | None = None) -> DataFrame:
    """Out-of-fold records per trajectory set; train is a table of raw columns and the label."""
    runs, sizes, sets = {}, [], sets or TEMPORAL_SETS
    tables = side_by_side(df.sparkSession, [lambda g=g: stage(a3_builder(g, carry=("row_id", "Y"))(df), "features") for g in sets.values()])
    for (name, groups), built in zip(sets.items(), tables):
        runs[name] = OofRun(built, spec, FoldStore(df.sparkSession, f"{store_root}/{name}") if store_root else None)
        sizes.append((name, "A3+" + ("+".join(groups) or "none"), len(built.columns) - 2))
    parts = _named_scores(oof_many(runs, k))
    info = df.sparkSession.createDataFrame(sizes, "experiment string, feature_set string, n_features int")
    return record_columns(search_all(parts, objective="f1")).join(info, "experiment")


def frozen_promotion(train: DataFrame, validation: DataFrame, specs: dict[str, md.ModelSpec], k: int = 3, native: bool = True) -> DataFrame:
    """Configuration and threshold come from out-of-fold scores on train; validation is scored once with both frozen."""
    parts = _named_scores(oof_many({name: OofRun(train, spec, native=native) for name, spec in specs.items()}, k))
    records = stage(search_all(parts, objective="f1"), "oof")
    chosen = records.orderBy(F.desc("f1_binary"), F.desc("precision"), F.desc("roc_auc"), "experiment").first()
    columns = [c for c in train.columns if c not in ("row_id", "Y")]
    categorical = md.raw_and_native(columns)[1] if native else []
    fitted = md.fit(specs[chosen["experiment"]], train, columns, categorical=categorical)
    result = sc.evaluate(fitted.score(validation, ["row_id", "Y"]), chosen["threshold"], label="Y")
    return result.select(
        F.lit(chosen["experiment"]).alias("experiment"), F.lit(chosen["threshold"]).alias("frozen_threshold"), F.lit(chosen["f1_binary"]).alias("oof_f1"),
        "roc_auc", "precision_positive", "recall_positive", "f1_binary", "f1_macro", "f1_weighted", "tn", "fp", "fn", "tp",
    )


# --- tuning ------------------------------------------------------------------------------------------


def grid_search(train: DataFrame, columns: Sequence[str], spec: md.ModelSpec, grid: Sequence[dict], k: int = 3, label: str = "Y", parallelism: int = 4) -> tuple[md.FittedModel, dict, float]:
    """Cross-validated search on fixed stratified folds, refitted by average precision.

    Every fold of every point is an independent fit with the weights and the
    penalty of its own rows; one grouped plan scores them all.
    """
    folds = stage(sp.stratified_folds(train, k, label=label), "folds")
    specs = [spec.with_params(**point) for point in grid]
    others = [folds.where(F.col("fold") != i).drop("fold") for i in range(k)]
    tasks = {(j, i): md.Fit(point, others[i], columns, label) for j, point in enumerate(specs) for i in range(k)}
    fitted = md.fit_many(train.sparkSession, tasks, parallelism)
    parts = [
        model.score(folds.where(F.col("fold") == i), [label]).select(F.lit(j).alias("point"), F.lit(i).alias("fold"), F.col(label).alias("label"), "score")
        for (j, i), model in fitted.items()
    ]
    keys = ["point", "fold"]
    precision = sc.rank_metrics(sc.fold_scores(reduce(DataFrame.unionByName, parts), keys), keys)
    best = precision.groupBy("point").agg(F.avg("average_precision").alias("ap")).orderBy(F.desc("ap"), "point").first()
    chosen = specs[best["point"]]
    return md.fit(chosen, train, columns, label), {"weighting": spec.weighting, **grid[best["point"]]}, best["ap"]


def random_search(train: DataFrame, validation: DataFrame, columns: Sequence[str], spec: md.ModelSpec, space: dict[str, list], count: int = 12) -> DataFrame:
    """Sampled settings, each with its own threshold search on validation."""
    sampled = md.sample_params(space, count, spec.seed)
    fitted = md.fit_many(train.sparkSession, {f"config_{i}": md.Fit(spec.with_params(**p), train, columns) for i, p in enumerate(sampled)})
    info = train.sparkSession.createDataFrame(
        [(f"config_{i}", {k: str(v) for k, v in p.items()}) for i, p in enumerate(sampled)], "experiment string, hyperparameters map<string,string>"
    )
    return record_columns(search_all(score_all(fitted, validation))).join(info, "experiment")


def pos_weight_sweep(train: DataFrame, validation: DataFrame, columns: Sequence[str], spec: md.ModelSpec, label: str = "Y") -> DataFrame:
    grid = [r["scale_pos_weight"] for r in sp.pos_weight_grid(train, label).collect()]
    fitted = md.fit_many(train.sparkSession, {f"scale_pos_weight_sweep:{w}": md.Fit(replace(spec, weighting=w), train, columns, label) for w in grid})
    return record_columns(search_all(score_all(fitted, validation, label)))


def best_variant(fitted: dict[str, md.FittedModel], validation: DataFrame) -> str:
    best = search_all(score_all(fitted, validation))
    order = [F.desc(c) for c in ("f1_binary", "recall", "precision", "roc_auc")]
    return best.orderBy(*order, "experiment").first()["experiment"]


def variant_round(train: DataFrame, validation: DataFrame, columns: Sequence[str], specs: Sequence[md.ModelSpec]) -> DataFrame:
    """Comparison row of every model variant, all evaluated in one grouped plan."""
    fitted = md.fit_many(train.sparkSession, {f"{s.family}/{s.variant}": md.Fit(s, train, columns) for s in specs})
    scores = score_all(fitted, validation)
    folded = sc.fold_scores(scores, ["experiment"])
    table = sc.threshold_table(folded, ["experiment"])
    summary = sc.tradeoff_summary(table, folded, ["experiment"])
    name = F.split("experiment", "/")
    return rk.variant_row(summary, name[0], name[1])
