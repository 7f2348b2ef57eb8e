"""Within-row arithmetic over a short fixed block of columns, as SQL expression text.

Arguments and results are expression strings for selectExpr: one call per
output column whatever its size. Everything is a closed form over scalar
columns, so it stays in generated code: no lambda, no Python in the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

EPSILON = "1e-12D"


def quoted(name: str) -> str:
    """A column name as SQL text, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def text_literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def total(parts: Sequence[str]) -> str:
    return "(" + " + ".join(parts) + ")"


def number(name: str, dtype: T.DataType) -> str:
    """Numeric coercion of a column; text that is no number and NaN become null."""
    name = quoted(name)
    if isinstance(dtype, (T.IntegralType, T.DecimalType, T.BooleanType)):
        return f"cast({name} as double)"
    if isinstance(dtype, T.NumericType):
        return f"nanvl(cast({name} as double), cast(null as double))"
    return f"nanvl(try_cast({name} as double), cast(null as double))"


def finite_or_zero(name: str, dtype: T.DataType) -> str:
    """A column with null, NaN and infinities as 0."""
    name = quoted(name)
    kind = dtype.simpleString()
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        bad = f"{name} is null or isnan({name}) or abs({name}) = double('Infinity')"
        return f"case when {bad} then cast(0 as {kind}) else {name} end"
    if isinstance(dtype, T.StringType):
        return f"coalesce({name}, '0.0')"
    return f"coalesce({name}, cast(0 as {kind}))"


def safe_ratio(numerator: str, denominator: str) -> str:
    """numerator/denominator, and 0 where the denominator is null or (almost) 0."""
    return f"coalesce(try_divide({numerator}, case when abs({denominator}) > {EPSILON} then {denominator} end), 0D)"


def count_true(conditions: Sequence[str]) -> str:
    return total([f"case when {c} then 1 else 0 end" for c in conditions])


def any_true(conditions: Sequence[str]) -> str:
    return "(" + " or ".join(f"coalesce({c}, false)" for c in conditions) + ")"


def row_sum(cells: Sequence[str]) -> str:
    return total([f"coalesce({c}, 0D)" for c in cells])


def row_count(cells: Sequence[str]) -> str:
    return total([f"case when {c} is null then 0 else 1 end" for c in cells])


def row_mean(cells: Sequence[str]) -> str:
    return f"try_divide({row_sum(cells)}, {row_count(cells)})"


def row_std(cells: Sequence[str], mean: str) -> str:
    """Population standard deviation of the non-null cells around a given row mean."""
    squares = row_sum([f"({c} - {mean}) * ({c} - {mean})" for c in cells])
    return f"sqrt(try_divide({squares}, {row_count(cells)}))"


def row_median(cells: Sequence[str]) -> str:
    ordered = sorted_cells(cells)
    low = f"get({ordered}, cast(floor((size({ordered}) - 1) / 2) as int))"
    return f"(({low} + get({ordered}, cast(floor(size({ordered}) / 2) as int))) / 2)"


def sorted_cells(cells: Sequence[str]) -> str:
    return f"sort_array(array_compact(array({', '.join(cells)})))"


def largest(cells: Sequence[str]) -> str:
    return f"greatest({', '.join(cells)})"


def smallest(cells: Sequence[str]) -> str:
    return f"least({', '.join(cells)})"


def slope(cells: Sequence[str]) -> str:
    """Least-squares slope against position; null as soon as one cell is null."""
    middle = (len(cells) - 1) / 2
    weights = [i - middle for i in range(len(cells))]
    return f"({total([f'{c} * ({w}D)' for c, w in zip(cells, weights)])} / {sum(w * w for w in weights)}D)"


def longest_run(conditions: Sequence[str]) -> str:
    current, lengths = "0", []
    for condition in conditions:
        current = f"case when {condition} then {current} + 1 else 0 end"
        lengths.append(current)
    return largest(lengths)


def first_position(conditions: Sequence[str]) -> str:
    """Position of the first true condition, or the number of conditions."""
    return "case " + " ".join(f"when {c} then {i}" for i, c in enumerate(conditions)) + f" else {len(conditions)} end"


def steps(cells: Sequence[str]) -> list[str]:
    """Differences to the neighbour on the left."""
    return [f"({b} - {a})" for a, b in zip(cells, cells[1:])]


def mean_second_difference(cells: Sequence[str]) -> str:
    d = steps(cells)
    return f"(({d[-1]} - {d[0]}) / {len(d) - 1}D)"


def recent_minus_old(cells: Sequence[str]) -> str:
    half = len(cells) // 2
    return f"({total(cells[:half])} / {half}D - {total(cells[half:])} / {half}D)"


def recency_weighted(cells: Sequence[str]) -> str:
    n = len(cells)
    return f"({total([f'{c} * {n - i}D' for i, c in enumerate(cells)])} / {n * (n + 1) // 2}D)"
