"""Preprocessing learned on the training rows and applied as one projection."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from riskweft.functions.rowmath import quoted, text_literal
from riskweft.operators.features import behaviour_names
from riskweft.operators.quantiles import bracketed_quantiles
from riskweft.operators.projection import has_contract, identifier_columns, split_columns_by_type
from riskweft.sources.contract import CATEGORICAL


@dataclass(frozen=True)
class NumericFit:
    median: float
    mean: float
    std: float


@dataclass(frozen=True)
class CategoryFit:
    mode: str
    values: tuple[str, ...]


@dataclass(frozen=True)
class Preparation:
    """Column plan and, once fitted, the learned values: a few numbers per column."""

    feature_columns: tuple[str, ...]
    numeric_columns: tuple[str, ...]
    categorical_columns: tuple[str, ...]
    engineered_columns: tuple[str, ...]
    dropped_columns: tuple[str, ...]
    leakage_columns: tuple[str, ...]
    numeric: dict[str, NumericFit] = field(default_factory=dict)
    categories: dict[str, CategoryFit] = field(default_factory=dict)

    @property
    def output_columns(self) -> list[str]:
        """Scaled numeric columns first, then one indicator per learned category."""
        indicators = [f"{c}_{v}" for c in self.categorical_columns if c in self.categories for v in self.categories[c].values]
        return [c for c in self.numeric_columns if c in self.numeric] + indicators


def plan_columns(df: DataFrame, drop: Sequence[str] = (), keep: Sequence[str] = ("row_id", "Y")) -> Preparation:
    """Decide the role of every column; reads metadata only."""
    candidates = [c for c in df.columns if c not in keep]
    leaks = identifier_columns(candidates)
    dropped = list(dict.fromkeys([*drop, *leaks]))
    used = [c for c in candidates if c not in dropped]
    if has_contract(candidates):
        categorical = [c for c in used if c in CATEGORICAL]
    else:
        numeric, _ = split_columns_by_type(df.select(*map(quoted, used)))
        categorical = [c for c in used if c not in numeric]
    engineered = set(behaviour_names())
    return Preparation(
        tuple(used), tuple(c for c in used if c not in categorical), tuple(categorical),
        tuple(c for c in used if c in engineered), tuple(dropped), tuple(leaks),
    )


def _number(c: str) -> str:
    return f"nanvl(cast({quoted(c)} as double), cast(null as double))"


def fit_preparation(train: DataFrame, drop: Sequence[str] = (), keep: Sequence[str] = ("row_id", "Y"), split: str | None = None) -> Preparation:
    """Learn medians, moments after imputation, modes and category lists from training rows only."""
    if split is not None:
        train = train.where(F.col(split) == "train").drop(split)
    plan = plan_columns(train, drop, keep)
    numeric, categories = {}, {}
    if plan.numeric_columns:
        numbers = train.selectExpr(*[f"{_number(c)} as {quoted(c)}" for c in plan.numeric_columns])
        found = bracketed_quantiles(numbers, {c: F.col(quoted(c)) for c in plan.numeric_columns}, {"median": 0.5})
        medians = {c: q["median"] for c, q in found.items() if q["median"] is not None}
        filled = {c: f"coalesce({quoted(c)}, {_literal(m)})" for c, m in medians.items()}
        if filled:
            moments = numbers.agg(*[F.expr(f"struct(avg({v}), stddev_pop({v}))").alias(c) for c, v in filled.items()]).first()
            numeric = {c: NumericFit(medians[c], moments[c][0], moments[c][1]) for c in plan.numeric_columns if c in medians}
    if plan.categorical_columns:
        texts = train.select(*[F.col(quoted(c)).cast("string").alias(c) for c in plan.categorical_columns])
        counts = (
            texts.unpivot([], list(map(quoted, plan.categorical_columns)), "column", "value").where("value is not null").groupBy("column", "value").count()
        )
        # One name for each column of the result, which the schema holds in any case.
        found: dict[str, list[tuple[str, int]]] = {}
        for row in counts.collect():
            found.setdefault(row["column"], []).append((row["value"], row["count"]))
        for c, values in found.items():
            ordered = sorted(values, key=lambda vn: _natural(vn[0]))
            top = max(n for _, n in ordered)
            categories[c] = CategoryFit(next(v for v, n in ordered if n == top), tuple(v for v, _ in ordered))
    return Preparation(
        plan.feature_columns, plan.numeric_columns, plan.categorical_columns, plan.engineered_columns,
        plan.dropped_columns, plan.leakage_columns, numeric, categories,
    )


def _natural(value: str):
    """Numbers in numeric order, other text after them in text order."""
    try:
        return (0, float(value), value)
    except ValueError:
        return (1, 0.0, value)


def _literal(value: float) -> str:
    """A double literal that reads back to the same value."""
    return f"double('{value!r}')"


def impute_number(c: str, fit: NumericFit) -> str:
    return f"coalesce({_number(c)}, {_literal(fit.median)})"


def scale(value: str, fit: NumericFit) -> str:
    return f"({value} - {_literal(fit.mean)}) / {_literal(fit.std if fit.std else 1.0)}"


def impute_category(c: str, fit: CategoryFit) -> str:
    return f"coalesce(cast({quoted(c)} as string), {text_literal(fit.mode)})"


def transform(prep: Preparation, df: DataFrame, keep: Sequence[str] = ("row_id", "Y")) -> DataFrame:
    """Kept columns, scaled numbers, indicators: one projection, the same columns for every split.

    A category that training has not seen gives zeros in all its indicators.
    """
    if not prep.numeric and not prep.categories:
        raise ValueError("preparation has not been fitted")
    kept = [c for c in keep if c in df.columns]
    numbers = [f"{scale(impute_number(c, prep.numeric[c]), prep.numeric[c])} as {quoted(c)}" for c in prep.numeric_columns if c in prep.numeric]
    indicators = [
        f"cast({impute_category(c, prep.categories[c])} = {text_literal(v)} as double) as {quoted(f'{c}_{v}')}"
        for c in prep.categorical_columns if c in prep.categories for v in prep.categories[c].values
    ]
    return df.selectExpr(*map(quoted, kept), *numbers, *indicators)


def impute(prep: Preparation, df: DataFrame, keep: Sequence[str] = ("row_id", "Y")) -> DataFrame:
    kept = [c for c in keep if c in df.columns]
    return df.selectExpr(
        *map(quoted, kept), *[f"{impute_number(c, prep.numeric[c])} as {quoted(c)}" for c in prep.numeric_columns if c in prep.numeric],
        *[f"{impute_category(c, prep.categories[c])} as {quoted(c)}" for c in prep.categorical_columns if c in prep.categories],
    )


def fitted_values(prep: Preparation, df: DataFrame) -> DataFrame:
    """The learned values as rows (column, kind, median, mean, std, mode, categories)."""
    rows = [(c, "numeric", f.median, f.mean, f.std, None, None) for c, f in prep.numeric.items()]
    rows += [(c, "categorical", None, None, None, f.mode, list(f.values)) for c, f in prep.categories.items()]
    return df.sparkSession.createDataFrame(
        rows, "column string, kind string, median double, mean double, std double, mode string, categories array<string>"
    )


def describe(prep: Preparation, df: DataFrame) -> DataFrame:
    """(role, position, column) rows, plus the steps applied to each kind of column."""
    rows = [
        (role, i, c)
        for role in ("feature", "numeric", "categorical", "engineered", "dropped", "leakage")
        for i, c in enumerate(getattr(prep, f"{role}_columns"))
    ]
    if prep.numeric_columns:
        rows += [("numeric_step", 0, "median_imputer"), ("numeric_step", 1, "standard_scaler")]
    if prep.categorical_columns:
        rows += [("categorical_step", 0, "most_frequent_imputer"), ("categorical_step", 1, "one_hot_encoder")]
    return df.sparkSession.createDataFrame(rows, "role string, position int, column string")


def build_and_prepare(
    df: DataFrame, builder: Callable[[DataFrame], DataFrame] | None = None, drop: Sequence[str] = (), keep: Sequence[str] = ("row_id", "Y", "split"),
) -> tuple[Preparation, DataFrame]:
    """Apply a feature builder, fit on split = 'train', transform every split."""
    built = builder(df) if builder else df
    prep = fit_preparation(built.where("split = 'train'"), drop, keep)
    return prep, transform(prep, built, keep)
