"""Published models: what a scorer needs, as tables in one folder.

A folder holds the preparation, the model, the threshold and the hash of the
feature columns. It counts once its marker is there, which is written last and
names the rows of every table; a folder without it, or with other rows, is
refused. Batch and stream scorers load the folder instead of training.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from riskweft.operators import prep as pp, projection as pr
from riskweft.operators.encoding import TargetStatistics
from riskweft.plans import boosting as bo, experiments as ex, models as md, production as pd_

FACTS = (
    "family string, variant string, settings string, columns array<string>, column_hash string, threshold double, prior double, base double, growth string,"
    " feature_groups array<string>, trajectories array<string>, coded array<string>, target_prior double, target_weight double"
)
TABLES = {
    "facts": FACTS, "plan": "kind string, position int, name string", "numeric": "name string, median double, mean double, std double",
    "categories": "name string, position int, value string, is_mode boolean", "borders": "feature string, position int, border double",
    "trees": f"model string, {bo.TREE_TABLE}, bin int, column int, g bigint, h bigint", "statistics": "place int, category string, total bigint, count bigint",
}
MARKER = "table string, n_rows bigint"
KINDS = ("feature_columns", "numeric_columns", "categorical_columns", "engineered_columns", "dropped_columns", "leakage_columns")


@dataclass(frozen=True)
class Published:
    """A loaded scorer and what it was published with."""

    scorer: pd_.Scorer
    column_hash: str

    def predict(self, df: DataFrame, keep: Sequence[str] = ("row_id",)) -> DataFrame:
        self.check(df, keep)
        return self.scorer.predict(df, keep)

    def predict_stream(self, stream: DataFrame, path: str, checkpoint: str, keep: Sequence[str] = ("row_id",)) -> StreamingQuery:
        self.check(stream, keep)
        return self.scorer.predict_stream(stream, path, checkpoint, keep)

    def check(self, df: DataFrame, keep: Sequence[str] = ("row_id",)) -> None:
        """Refuse a table whose feature columns are not the published ones, by name and order."""
        if feature_hash(self.scorer, df, keep) != self.column_hash:
            raise ValueError("feature columns differ from the published ones")


def feature_hash(scorer: pd_.Scorer, df: DataFrame, keep: Sequence[str] = ("row_id",)) -> str:
    built = scorer.builder(df) if scorer.builder else df
    return pr.column_hash([c for c in built.columns if c not in keep])


def _tree_rows(model: bo.BoostedModel) -> list[tuple]:
    rows = []
    for row in model.tree_rows():
        tree = model.trees[row[0]]
        g, h, _ = tree.sums[row[1]]
        rows.append(("model", *row, tree.bin[row[1]], tree.column[row[1]], g, h))
    return rows


def publish(
    spark: SparkSession, folder: str, scorer: pd_.Scorer, sample: DataFrame, groups: Sequence[str], trajectories: Sequence[str] = (), keep: Sequence[str] = ("row_id",),
) -> None:
    """Write a scorer whose features come from the named groups; sample is a table of the raw columns, of which only the names are read."""
    if _marker(spark, folder) is not None:
        raise FileExistsError(f"a model is published in {folder}")
    fitted, prep, coded = scorer.model, scorer.prep, scorer.model.statistics
    boosted = fitted.model if isinstance(fitted.model, bo.BoostedModel) else None
    settings = {"params": fitted.spec.params, "weighting": fitted.spec.weighting, "seed": fitted.spec.seed}
    rows: dict[str, list[tuple]] = {
        "facts": [(
            fitted.spec.family, fitted.spec.variant, json.dumps(settings), list(fitted.columns), feature_hash(scorer, sample, keep), float(scorer.threshold), fitted.prior,
            boosted.base if boosted else None, json.dumps(asdict(boosted.growth)) if boosted else None, list(groups), list(trajectories),
            list(coded.columns) if coded else None, coded.prior if coded else None, coded.weight if coded else None,
        )],
        "plan": [(kind, i, c) for kind in KINDS for i, c in enumerate(getattr(prep, kind))] if prep else [],
        "numeric": [(c, f.median, f.mean, f.std) for c, f in prep.numeric.items()] if prep else [],
        "categories": [(c, i, v, v == f.mode) for c, f in prep.categories.items() for i, v in enumerate(f.values)] if prep else [],
        "borders": [(c, i, float(b)) for c, values in zip(boosted.columns, boosted.borders) for i, b in enumerate(values)] if boosted else [],
        "trees": _tree_rows(boosted) if boosted else [],
    }
    written = {}
    for name, table in rows.items():
        spark.createDataFrame(table, TABLES[name]).write.mode("overwrite").parquet(f"{folder}/{name}")
        written[name] = len(table)
    statistics = coded.table.select("place", "category", "total", "count") if coded else spark.createDataFrame([], TABLES["statistics"])
    statistics.write.mode("overwrite").parquet(f"{folder}/statistics")
    written["statistics"] = _table(spark, folder, "statistics").count()
    if fitted.model is not None and not boosted:
        fitted.model.write().overwrite().save(f"{folder}/pipeline")
    spark.createDataFrame(list(written.items()), MARKER).coalesce(1).write.mode("overwrite").parquet(f"{folder}/published")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}")


def _marker(spark: SparkSession, folder: str) -> dict[str, int] | None:
    try:
        found = {r["table"]: r["n_rows"] for r in spark.read.schema(MARKER).parquet(f"{folder}/published").collect()}
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return found or None


def load(spark: SparkSession, folder: str) -> Published:
    """The scorer of a published folder. What comes to the driver is a model; target statistics stay a table."""
    marker = _marker(spark, folder)
    if marker is None:
        raise RuntimeError(f"no finished model in {folder}")
    tables = {name: _table(spark, folder, name) for name in TABLES}
    for name, n in marker.items():
        if tables[name].count() != n:
            raise RuntimeError(f"table {name} in {folder} is not the published one")
    facts = tables["facts"].first()
    settings = json.loads(facts["settings"])
    spec = md.ModelSpec(facts["family"], facts["variant"], settings["params"], settings["weighting"], settings["seed"])
    statistics = None
    if facts["coded"] is not None:
        statistics = TargetStatistics(tuple(facts["coded"]), tables["statistics"], facts["target_prior"], facts["target_weight"])
    if facts["growth"] is not None:
        model = _boosted(tables, facts)
    else:
        model = PipelineModel.load(f"{folder}/pipeline") if facts["prior"] is None else None
    fitted = md.FittedModel(spec, tuple(facts["columns"]), model, facts["prior"], statistics)
    builder = ex.a3_builder(facts["trajectories"], facts["feature_groups"], carry=("row_id",))
    return Published(pd_.Scorer(_preparation(tables), fitted, facts["threshold"], builder), facts["column_hash"])


def _boosted(tables: dict[str, DataFrame], facts) -> bo.BoostedModel:
    borders: dict[str, list[float]] = {c: [] for c in facts["columns"]}
    for r in tables["borders"].orderBy("feature", "position").collect():
        borders[r["feature"]].append(r["border"])
    trees: list[bo.Tree] = []
    for r in tables["trees"].orderBy("tree", "node").collect():
        if r["node"] == 0:
            trees.append(bo.Tree())
        t = trees[-1]
        t.add((r["g"], r["h"], r["n_rows"]), len(r["path"]))
        t.column[-1], t.bin[-1] = r["column"], r["bin"]
        if r["column"] >= 0:
            t.left[-1], t.right[-1], t.gain[-1] = r["left_node"], r["right_node"], r["gain"]
    return bo.BoostedModel(tuple(facts["columns"]), tuple(np.array(borders[c], np.float64) for c in facts["columns"]), facts["base"], bo.Growth(**json.loads(facts["growth"])), tuple(trees))


def _preparation(tables: dict[str, DataFrame]) -> pp.Preparation | None:
    plan: dict[str, list[str]] = {k: [] for k in KINDS}
    for r in tables["plan"].orderBy("kind", "position").collect():
        plan[r["kind"]].append(r["name"])
    if not plan["feature_columns"]:
        return None
    numeric = {r["name"]: pp.NumericFit(r["median"], r["mean"], r["std"]) for r in tables["numeric"].collect()}
    values: dict[str, list[str]] = {}
    modes: dict[str, str] = {}
    for r in tables["categories"].orderBy("name", "position").collect():
        values.setdefault(r["name"], []).append(r["value"])
        if r["is_mode"]:
            modes[r["name"]] = r["value"]
    categories = {c: pp.CategoryFit(modes[c], tuple(v)) for c, v in values.items()}
    return pp.Preparation(*(tuple(plan[k]) for k in KINDS), numeric, categories)
