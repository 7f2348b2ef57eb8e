"""Column-level operators: renames, contracts, selection, coercion, predicates."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from riskweft.functions.rowmath import finite_or_zero, number, quoted
from riskweft.sources.contract import (
    BILL, CATEGORICAL, DELAY, FEATURES, LABEL, MIN_FEATURES, MIN_ROWS, PAYMENT, SEMANTIC_NAMES,
)

IDENTIFIER = re.compile(r"(^id$|_id$)", re.IGNORECASE)


def has_contract(columns: Sequence[str]) -> bool:
    return set(FEATURES) <= set(columns) and LABEL not in columns


def require_contract(columns: Sequence[str]) -> None:
    """Refuse a table that lacks an input column or still carries the label."""
    missing = [c for c in FEATURES if c not in columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    if LABEL in columns:
        raise ValueError(f"label column {LABEL!r} must not be part of the features")


def semantic_rename(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in SEMANTIC_NAMES.items() if k in df.columns})


def semantic_audit(spark: SparkSession, columns: Sequence[str]) -> DataFrame:
    """One row per contract column: position, business name and role."""
    require_contract(columns)
    role = {
        **{c: "categorical" for c in CATEGORICAL},
        **{c: "ordinal_delay" for c in DELAY},
        **{c: "bill" for c in BILL},
        **{c: "payment" for c in PAYMENT},
    }
    rows = [(i + 1, c, SEMANTIC_NAMES[c], role.get(c, "other")) for i, c in enumerate(FEATURES)]
    return spark.createDataFrame(rows, "position int, column string, semantic_name string, role string")


def identifier_columns(columns: Sequence[str]) -> list[str]:
    return [c for c in columns if IDENTIFIER.search(c)]


def split_columns_by_type(df: DataFrame) -> tuple[list[str], list[str]]:
    """(numeric or boolean, everything else), both in table order."""
    plain = (T.NumericType, T.BooleanType)
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, plain)]
    return numeric, [c for c in df.columns if c not in numeric]


def pick_columns(columns: Sequence[str], priority: Sequence[str], limit: int) -> list[str]:
    """Priority names that exist, then the others in table order, at most limit."""
    first = [c for c in priority if c in columns]
    rest = [c for c in columns if c not in first]
    return (first + rest)[:limit]


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: F.expr(number(c, types[c])) for c in columns})


def clean_numbers(df: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    """null, NaN and infinities to 0 in one projection."""
    return df.selectExpr(*[quoted(f.name) if f.name in skip else f"{finite_or_zero(f.name, f.dataType)} as {quoted(f.name)}" for f in df.schema.fields])


def predict(score: Column, threshold: Column | float) -> Column:
    threshold = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (score >= threshold).cast("int")


def outcome(label: Column, predicted: Column) -> Column:
    hit, truth = predicted == 1, label == 1
    return (
        F.when(truth & hit, "TP").when(~truth & hit, "FP").when(~truth & ~hit, "TN").when(truth & ~hit, "FN")
    )


def require_shape(df: DataFrame, features: Sequence[str], min_rows: int = MIN_ROWS, min_features: int = MIN_FEATURES) -> int:
    """Row count if the table is large enough; the feature check needs no job."""
    if len(features) < min_features:
        raise ValueError(f"unexpectedly small feature set: {len(features)} features")
    rows = df.count()
    if rows < min_rows:
        raise ValueError(f"unexpectedly small dataset: {rows} rows")
    return rows


def column_hash(columns: Sequence[str]) -> str:
    return hashlib.sha256("\n".join(columns).encode("utf-8")).hexdigest()


def audit_column_order(left: DataFrame, right: DataFrame, categorical: Sequence[str] = CATEGORICAL) -> dict:
    """Both tables must offer the same columns in the same order and the same categorical list."""
    if left.columns != right.columns:
        raise ValueError("feature order differs between the two tables")
    present = [c for c in categorical if c in left.columns]
    if present != [c for c in categorical if c in right.columns]:
        raise ValueError("categorical columns differ between the two tables")
    return {"number_features": len(left.columns), "feature_order_hash": column_hash(left.columns), "categorical": present}


def stringify(df: DataFrame, columns: Sequence[str] = tuple(CATEGORICAL)) -> DataFrame:
    return df.withColumns({c: F.col(quoted(c)).cast("string") for c in columns if c in df.columns})


def min_max_scores(df: DataFrame, value: str, score: str = "score") -> DataFrame:
    """Rescale decision values to [0, 1]; a constant column becomes 0.5.

    The bounds come in as one scalar subquery: one aggregate row, one scan, no join.
    """
    bounds = df.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high"))).scalar()
    low, high = bounds["low"], bounds["high"]
    scaled = F.coalesce(F.try_divide(F.col(value) - low, high - low), F.lit(0.5))
    return df.withColumn(score, F.when(F.col(value).isNotNull(), scaled))
