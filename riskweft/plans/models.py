"""Distributed model training: Spark ML for linear models, trees and forests, boosting.py for boosted families.

A model is a specification (family, variant, parameters, weighting); fitting
gives an object that adds a score column to any table with the same columns.
The contract is protocol and quality, not digits.
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import partial
from typing import Any

from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskweft.functions.rowmath import quoted
from riskweft.operators.encoding import TargetStatistics, fit_target_statistics
from riskweft.operators.splitting import class_sizes, class_weight
from riskweft.plans import boosting as bo
from riskweft.session import side_by_side
from riskweft.sources.contract import CATEGORICAL, SEED

DUMMY = "dummy_classifier"
#: Bins of a numeric column; a nominal column with more categories gets one bin for each.
MIN_BINS = 64
#: Rows of a partition that a logistic model iterates over.
ITERATED_ROWS = 1 << 15
#: Leaf penalty of the symmetric family where the settings name none.
LEAF_L2 = 3.0
FAMILIES = (DUMMY, "logistic_regression", "decision_tree", "random_forest", "hist_gradient_boosting", "xgboost", "catboost")

# Default and searched settings of each family.
DEFAULTS: dict[str, dict[str, Any]] = {
    DUMMY: {},
    "logistic_regression": {"C": 1.0, "penalty": "l2", "max_iter": 2000},
    "decision_tree": {"min_samples_leaf": 50, "max_depth": 30},
    "random_forest": {"n_estimators": 300, "min_samples_leaf": 1, "max_depth": 30, "max_features": "sqrt"},
    "hist_gradient_boosting": {"max_iter": 100, "learning_rate": 0.1, "max_depth": None, "max_leaf_nodes": 31, "min_samples_leaf": 20, "l2_regularization": 0.0},
    "xgboost": {
        "n_estimators": 400, "max_depth": 4, "learning_rate": 0.05, "min_child_weight": 3, "subsample": 0.85, "colsample_bytree": 0.85,
        "reg_lambda": 5.0, "reg_alpha": 0.0, "gamma": 0.0,
    },
    "catboost": {"iterations": 250, "depth": 6, "learning_rate": 0.05},
}
BOOSTED_BASE = {
    "n_estimators": 200, "max_depth": 4, "learning_rate": 0.03, "min_child_weight": 1, "subsample": 0.85, "colsample_bytree": 0.7, "reg_lambda": 5.0, "reg_alpha": 0.5,
}
BASE_POS_WEIGHT = 2.640743
CATBOOST_CONFIGS = (
    {"iterations": 300, "depth": 4, "learning_rate": 0.05},
    {"iterations": 300, "depth": 5, "learning_rate": 0.05},
    {"iterations": 400, "depth": 6, "learning_rate": 0.03},
    {"iterations": 250, "depth": 6, "learning_rate": 0.05},
)
SEARCH_SPACES: dict[str, dict[str, list]] = {
    "logistic_regression": {"C": [0.3, 1.0, 3.0], "penalty": ["l1", "l2"], "weighting": [None, "balanced", "manual_light"]},
    "decision_tree": {"max_depth": [6, 10, 14], "min_samples_leaf": [25, 50], "weighting": [None, "balanced", "manual_light"]},
    "random_forest": {
        "n_estimators": [200, 400], "max_depth": [8, 12], "min_samples_leaf": [5, 25], "weighting": ["balanced_subsample", None, "manual_light"],
    },
    "hist_gradient_boosting": {
        "learning_rate": [0.03, 0.05, 0.1], "max_iter": [200, 400], "max_leaf_nodes": [15, 31], "max_depth": [None, 6], "min_samples_leaf": [20, 50],
        "l2_regularization": [0.0, 0.1, 1.0],
    },
    "xgboost": {
        "n_estimators": [200, 400, 800], "max_depth": [3, 4, 5, 6], "learning_rate": [0.03, 0.05, 0.1], "min_child_weight": [1, 3, 5],
        "subsample": [0.7, 0.85, 1.0], "colsample_bytree": [0.7, 0.85, 1.0], "reg_lambda": [1.0, 5.0, 10.0], "reg_alpha": [0.0, 0.5, 1.0],
        "weighting": [1.0, "light", "scale_balanced"],
    },
}
#: What the search after threshold tuning draws from: the tuning space and the minimum gain.
F1_SPACE = {**SEARCH_SPACES["xgboost"], "gamma": [0.0, 0.25, 0.5]}
BOOSTED = ("hist_gradient_boosting", "xgboost", "catboost")


@dataclass(frozen=True)
class ModelSpec:
    family: str
    variant: str = "base"
    params: dict[str, Any] = field(default_factory=dict)
    weighting: str | float | None = None
    seed: int = SEED

    def __post_init__(self):
        if self.family not in FAMILIES:
            raise ValueError(f"unsupported model family: {self.family}")

    @property
    def settings(self) -> dict[str, Any]:
        return {**DEFAULTS[self.family], **self.params}

    def with_params(self, **params) -> ModelSpec:
        weighting = params.pop("weighting", self.weighting)
        return replace(self, params={**self.params, **params}, weighting=weighting)


@dataclass(frozen=True)
class FittedModel:
    spec: ModelSpec
    columns: tuple[str, ...]
    model: Any
    prior: float | None = None
    statistics: TargetStatistics | None = None

    def score(self, df: DataFrame, keep: Sequence[str] | None = None, score: str = "score") -> DataFrame:
        """Kept columns (default: all) and the positive-class probability."""
        kept = [quoted(c) for c in (df.columns if keep is None else keep)]
        if self.prior is not None:
            return df.select(*kept, F.lit(self.prior).alias(score))
        if isinstance(self.model, bo.BoostedModel):
            if self.statistics is not None:
                df = self.statistics.transform(df, kept)
                return df.select(*kept, self.model.probability([F.col(quoted(self.statistics.coded(c))) for c in self.columns]).alias(score))
            return df.select(*kept, self.model.probability([F.col(quoted(c)) for c in self.columns]).alias(score))
        scored = self.model.transform(df.withColumns(dict(zip(_inputs(self.columns), (F.col(quoted(c)) for c in self.columns)))))
        return scored.select(*kept, vector_to_array("probability")[1].alias(score))

    @property
    def stage(self):
        return self.model.stages[-1]

    @property
    def importances(self) -> list[float]:
        """Share of each column in the gains of all splits, for tree models."""
        values = self.model.importances() if isinstance(self.model, bo.BoostedModel) else self.stage.featureImportances.toArray()
        return [float(v) for v in values]


def _inputs(columns: Sequence[str]) -> list[str]:
    """Names for the columns that the ML stages accept, whatever characters the columns have."""
    return [f"_in_{i}" for i in range(len(columns))]


def _estimator(spec: ModelSpec, total_weight: float, bins: int = MIN_BINS):
    s = spec.settings
    common = {"featuresCol": "_features", "labelCol": "_label", "weightCol": "_weight"}
    if spec.family == "logistic_regression":
        # C scales the summed loss; Spark's penalty scales the mean loss.
        return LogisticRegression(
            maxIter=s["max_iter"], regParam=1.0 / (s["C"] * total_weight), elasticNetParam=1.0 if s["penalty"] == "l1" else 0.0,
            standardization=False, **common,
        )
    tree = {"seed": spec.seed, "maxBins": bins, **common}
    if spec.family == "decision_tree":
        return DecisionTreeClassifier(maxDepth=min(30, s["max_depth"]), minInstancesPerNode=s["min_samples_leaf"], **tree)
    if spec.family == "random_forest":
        return RandomForestClassifier(
            numTrees=s["n_estimators"], maxDepth=s["max_depth"], minInstancesPerNode=s["min_samples_leaf"],
            featureSubsetStrategy=str(s["max_features"]), **tree,
        )
    raise ValueError(f"no estimator for {spec.family}")


def growth_of(spec: ModelSpec) -> bo.Growth:
    """How a boosted family grows its trees."""
    s = spec.settings
    if spec.family == "hist_gradient_boosting":
        return bo.Growth(
            s["max_iter"], s["learning_rate"], s["max_depth"], s["max_leaf_nodes"], min_hessian=1e-3, min_rows=s["min_samples_leaf"], l2=s["l2_regularization"], seed=spec.seed,
        )
    if spec.family == "xgboost":
        return bo.Growth(
            s["n_estimators"], s["learning_rate"], s["max_depth"], min_hessian=s["min_child_weight"], l2=s["reg_lambda"], l1=s["reg_alpha"], min_gain=s["gamma"],
            row_share=s["subsample"], column_share=s["colsample_bytree"], seed=spec.seed,
        )
    return bo.Growth(s["iterations"], s["learning_rate"], s["depth"], l2=s.get("l2_leaf_reg", LEAF_L2), symmetric=True, seed=spec.seed)


def fit(spec: ModelSpec, train: DataFrame, columns: Sequence[str], label: str = "Y", row_weight: Column | None = None, categorical: Sequence[str] = ()) -> FittedModel:
    """Fit on the given columns; categorical ones are indexed and handed over as nominal features, or as target statistics to boosted families."""
    if spec.family in BOOSTED:
        return fit_many(train.sparkSession, {0: Fit(spec, train, columns, label, row_weight, categorical)})[0]
    negatives, positives = class_sizes(train, label)
    if spec.family == DUMMY:
        return FittedModel(spec, tuple(columns), None, positives / (negatives + positives))
    weight = class_weight(F.col(label), spec.weighting, negatives, positives)
    if row_weight is not None:
        weight = weight * row_weight
    names = _inputs(columns)
    data = train.select(*[F.col(quoted(c)).alias(n) for c, n in zip(columns, names)], F.col(label).cast("double").alias("_label"), weight.cast("double").alias("_weight"))
    total = 0.0
    if spec.family == "logistic_regression":
        total = data.agg(F.sum("_weight")).first()[0]
        # Each of many iterations is a job over all partitions, so a partition should be worth its task.
        data = data.coalesce(-(-(negatives + positives) // ITERATED_ROWS))
    stages, inputs, bins = [], names, MIN_BINS
    if categorical:
        indexed = {n: f"{n}_index" for c, n in zip(columns, names) if c in categorical}
        indexer = StringIndexer(inputCols=list(indexed), outputCols=list(indexed.values()), handleInvalid="keep", stringOrderType="alphabetAsc").fit(data)
        # One bin for each category, and one for those that training has not seen.
        bins = max(bins, *(len(labels) + 1 for labels in indexer.labelsArray))
        stages.append(indexer)
        inputs = [indexed.get(n, n) for n in names]
    stages += [VectorAssembler(inputCols=inputs, outputCol="_features"), _estimator(spec, total, bins)]
    return FittedModel(spec, tuple(columns), Pipeline(stages=stages).fit(data))


@dataclass(frozen=True)
class Fit:
    """A fit that is still to be made."""

    spec: ModelSpec
    train: DataFrame
    columns: Sequence[str]
    label: str = "Y"
    row_weight: Column | None = None
    categorical: Sequence[str] = ()

    def __call__(self) -> FittedModel:
        return fit(self.spec, self.train, self.columns, self.label, self.row_weight, self.categorical)


def fit_many(spark: SparkSession, tasks: dict[Any, Fit], parallelism: int = 4) -> dict[Any, FittedModel]:
    """Independent fits. Boosted models all share their passes; of the others a few run at a time, so that one's last tasks do not idle the executors."""
    boosted = {n: t for n, t in tasks.items() if t.spec.family in BOOSTED}
    with ThreadPoolExecutor(parallelism) as pool:
        started = {n: pool.submit(inheritable_thread_target(spark)(t)) for n, t in tasks.items() if n not in boosted}
        found = _fit_boosted(spark, boosted) if boosted else {}
        found |= {n: f.result() for n, f in started.items()}
    return {n: found[n] for n in tasks}


def _fit_boosted(spark: SparkSession, tasks: dict[Any, Fit]) -> dict[Any, FittedModel]:
    """Fits on the same table and columns stand on one binned table, each with its own row weight."""
    groups: dict[tuple, list[Any]] = {}
    for name, t in tasks.items():
        groups.setdefault((id(t.train), tuple(t.columns), t.label, tuple(t.categorical)), []).append(name)

    def prepared(group: tuple, names: list[Any]) -> tuple[dict, TargetStatistics | None]:
        _, columns, label, categorical = group
        train = tasks[names[0]].train
        negatives, positives = class_sizes(train, label)
        weights: list[Column] = []
        slots: dict[tuple, int] = {}
        for n in names:
            slot = (tasks[n].spec.weighting, id(tasks[n].row_weight))
            if slot not in slots:
                weight = class_weight(F.col(quoted(label)), tasks[n].spec.weighting, negatives, positives)
                slots[slot] = len(weights)
                weights.append(weight if tasks[n].row_weight is None else weight * tasks[n].row_weight)
        frame, key = train, "row_id" if "row_id" in train.columns else None
        coded = None
        if categorical:
            coded, frame = fit_target_statistics(train, categorical, label, key or "row_id")
        training = bo.Training(frame, tuple(columns), label, tuple(weights), key)
        return {n: bo.Wanted(training, growth_of(tasks[n].spec), slots[tasks[n].spec.weighting, id(tasks[n].row_weight)]) for n in names}, coded

    wanted, statistics = {}, {}
    for found, coded in side_by_side(spark, [partial(prepared, *g) for g in groups.items()]):
        wanted |= found
        statistics |= dict.fromkeys(found, coded)
    models = bo.fit_models(spark, wanted)
    return {n: FittedModel(t.spec, tuple(t.columns), models[n], statistics=statistics[n]) for n, t in tasks.items()}


def base_boosted(**overrides) -> ModelSpec:
    """The fixed boosted model that the feature experiments share."""
    return ModelSpec("xgboost", "fixed", {**BOOSTED_BASE, **overrides}, BASE_POS_WEIGHT)


def candidate_ladder() -> dict[str, ModelSpec]:
    return {
        DUMMY: ModelSpec(DUMMY, "prior"),
        "logistic_regression": ModelSpec("logistic_regression", weighting="balanced"),
        "decision_tree": ModelSpec("decision_tree", weighting="balanced"),
        "random_forest": ModelSpec("random_forest", weighting="balanced_subsample"),
    }


def variant_specs() -> list[ModelSpec]:
    """Every family with its controlled weighting variants."""
    plain = {
        "logistic_regression": ("none", "balanced", "manual_light"),
        "decision_tree": ("none", "balanced", "manual_light"),
        "random_forest": ("none", "balanced", "balanced_subsample", "manual_light"),
        "hist_gradient_boosting": ("none", "balanced_sample_weight"),
    }
    specs = [ModelSpec(DUMMY, "prior")]
    specs += [ModelSpec(f, v, weighting=None if v == "none" else v) for f, vs in plain.items() for v in vs]
    boosted = {"baseline_1_0": 1.0, "baseline_light": 1.5, "baseline_balanced": "scale_balanced"}
    return specs + [ModelSpec("xgboost", v, weighting=w) for v, w in boosted.items()]


def param_grid(family: str) -> list[dict[str, Any]]:
    if family not in SEARCH_SPACES:
        raise ValueError(f"no tuning space configured for {family}")
    space = SEARCH_SPACES[family]
    return [dict(zip(space, values)) for values in itertools.product(*space.values())]


def sample_params(space: dict[str, list], count: int, seed: int = SEED) -> list[dict[str, Any]]:
    """Seeded sample without repeats from the product of the value lists."""
    everything = [dict(zip(space, values)) for values in itertools.product(*space.values())]
    return random.Random(seed).sample(everything, min(count, len(everything)))


def refit(record: dict[str, Any], train: DataFrame, columns: Sequence[str], label: str = "Y") -> FittedModel:
    """Rebuild a recorded configuration: {model, hyperparameters, class_weighting}."""
    families = {
        "XGBoostClassifier": "xgboost", "RandomForestClassifier": "random_forest", "HistGradientBoostingClassifier": "hist_gradient_boosting",
    }
    if record["model"] not in families:
        raise ValueError(f"unsupported model in record: {record['model']}")
    params = dict(record["hyperparameters"])
    weighting = params.pop("weighting", record.get("class_weighting"))
    return fit(ModelSpec(families[record["model"]], "refit", params, weighting), train, columns, label)


def raw_and_native(columns: Sequence[str]) -> tuple[list[str], list[str]]:
    """Columns of a native-categorical model and which of them are categorical."""
    return list(columns), [c for c in CATEGORICAL if c in columns]
