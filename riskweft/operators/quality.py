"""Data-quality checks and profiling. Every result is a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from riskweft.functions.rowmath import number, quoted, text_literal
from riskweft.operators.ordered import long_form
from riskweft.operators.projection import pick_columns, require_shape, split_columns_by_type
from riskweft.operators.quantiles import bracketed_quantiles, quantile_table
from riskweft.operators.splitting import class_sizes
from riskweft.session import stage
from riskweft.sources.contract import MIN_FEATURES, MIN_ROWS

MISSING = "<MISSING>"
SMALL_DOMAIN = 12

# Preferred columns and valid codes of the risk table.
NUMERIC_PRIORITY = ("LIMIT_BAL", "AGE", "BILL_AMT1", "BILL_AMT2", "PAY_AMT1", "PAY_AMT2")
RELATION_PRIORITY = ("SEX", "EDUCATION", "MARRIAGE", "PAY_0", "PAY_2", "PAY_3")
VALID_CODES = {"SEX": (1, 2), "EDUCATION": (1, 2, 3, 4), "MARRIAGE": (1, 2, 3)}
STATUS_COLUMNS = ("PAY_0", "PAY_2", "PAY_3", "PAY_4", "PAY_5", "PAY_6")
STATUS_RANGE = (-2, 9)
AGE_RANGE = (18, 100)


def missing_test(df: DataFrame, column: str) -> str:
    floating = isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType))
    name = quoted(column)
    return f"{name} is null or isnan({name})" if floating else f"{name} is null"


def _coerced(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.selectExpr(*map(quoted, keep), *[f"{number(c, types[c])} as {quoted(c)}" for c in columns])


def label_distribution(df: DataFrame, label: str = "Y") -> DataFrame:
    counts = df.groupBy(F.col(quoted(label)).cast("int").alias("target")).agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumn("rate", F.col("count") / counts.agg(F.sum("count")).scalar()).orderBy("target")


def missing_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, missing_count, missing_rate) of every column: one wide aggregate, no shuffle of rows."""
    cells = ", ".join(f"named_struct('column', {text_literal(c)}, 'missing_count', count_if({missing_test(df, c)}))" for c in columns)
    wide = df.agg(F.expr(f"array({cells})").alias("cells"), F.count(F.lit(1)).alias("n"))
    return wide.select("n", F.inline("cells")).select(
        "column", "missing_count", F.coalesce(F.try_divide("missing_count", "n"), F.lit(0.0)).alias("missing_rate")
    )


def missing_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return missing_counts(df, columns).where("missing_count > 0").orderBy(F.desc("missing_count"), "column")


def duplicate_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows after the first of each group of equal rows; nulls are equal to each other."""
    groups = df.groupBy(*map(quoted, columns)).agg(F.count(F.lit(1)).alias("n"))
    surplus = F.coalesce(F.sum(F.col("n") - 1), F.lit(0))
    return groups.agg(surplus.alias("duplicate_rows"), F.sum("n").alias("n")).select(
        "duplicate_rows", F.coalesce(F.try_divide("duplicate_rows", "n"), F.lit(0.0)).alias("duplicate_rate")
    )


QUARTILES = {"p25": 0.25, "p50": 0.50, "p75": 0.75}


def moments(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, feature, count, mean, std, min, max) from one wide aggregate."""
    def cell(c: str) -> str:
        q = quoted(c)
        return f"named_struct('feature', {text_literal(c)}, 'count', count({q}), 'mean', avg({q}), 'std', stddev_samp({q}), 'min', min({q}), 'max', max({q}))"

    wide = df.groupBy(*by).agg(F.expr(f"array({', '.join(cell(c) for c in columns)})").alias("cells"))
    return wide.select(*by, F.inline("cells"))


def descriptive_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std (ddof 1), min, quartiles, max: one row per feature."""
    numbers = _coerced(df, columns)
    quartiles = quantile_table(numbers, {c: F.col(quoted(c)) for c in columns}, QUARTILES)
    return moments(numbers, columns).join(quartiles, "feature", "left").select(
        "feature", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def numeric_distribution(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same statistics after numeric coercion, without the count."""
    return descriptive_stats(df, columns).withColumnRenamed("p50", "median").select(
        "feature", "min", "p25", "median", "p75", "max", "mean", "std"
    )


def few_values(df: DataFrame, columns: Sequence[str], limit: int, null: bool = False) -> dict[str, int]:
    """How many distinct values each column with at most limit of them has, null counted as one if asked for.

    The sketch only rules columns out: d distinct values fill at most d
    registers, so an estimate above twice the limit cannot come from d <= limit.
    The rest - columns with few values - is counted exactly.
    """
    if not columns:
        return {}
    sketch = df.agg(*[F.approx_count_distinct(quoted(c)).alias(c) for c in columns]).first()
    candidates = [c for c in columns if sketch[c] <= 2 * limit + 2]
    if not candidates:
        return {}
    texts = df.select(*[F.col(quoted(c)).cast("string").alias(c) for c in candidates])
    values = texts.unpivot([], list(map(quoted, candidates)), "column", "value").groupBy("column", "value").count()
    counts = (values if null else values.where("value is not null")).groupBy("column").count().collect()
    return {r["column"]: r["count"] for r in counts if r["count"] <= limit}


def small_domain_columns(df: DataFrame, columns: Sequence[str], limit: int = SMALL_DOMAIN) -> list[str]:
    """Columns with at most limit distinct values, null counted as one."""
    found = few_values(df, columns, limit, null=True)
    return [c for c in columns if c in found]


def rate_by_category(df: DataFrame, columns: Sequence[str], label: str = "Y") -> DataFrame:
    """(column, value, default_rate, observations); numeric columns with a large domain are left out."""
    numeric, _ = split_columns_by_type(df.select(*map(quoted, columns)))
    kept_numeric = set(small_domain_columns(df, [c for c in columns if c in numeric]))
    used = [c for c in columns if c not in numeric or c in kept_numeric]
    if not used:
        raise ValueError("no column with a small domain to group by")
    texts = df.select(quoted(label), *[F.coalesce(F.col(quoted(c)).cast("string"), F.lit(MISSING)).alias(c) for c in used])
    grouped = texts.unpivot([quoted(label)], list(map(quoted, used)), "column", "value").groupBy("column", "value").agg(
        F.avg(quoted(label)).alias("default_rate"), F.count(F.lit(1)).alias("observations")
    )
    return grouped.orderBy("column", F.desc("default_rate"), F.desc("observations"), "value")


def bin_edges(numbers: DataFrame, columns: Sequence[str], bins: int) -> dict[str, list[float]]:
    """Quantile cut points of each column without repeats.

    The number of bins is min(bins, distinct values); columns with one value have none.
    """
    # Adding 0.0 makes a negative zero the same text as a plain one.
    few = few_values(numbers.select(*[(F.col(quoted(c)) + F.lit(0.0)).alias(c) for c in columns]), columns, bins)
    filled = numbers.agg(*[F.count(quoted(c)).alias(c) for c in columns]).first()
    edges = {}
    for k in range(2, bins + 1):
        chosen = [c for c in columns if filled[c] and few.get(c, bins) == k]
        if chosen:
            points = {f"q{i}": i / k for i in range(k + 1)}
            found = bracketed_quantiles(numbers, {c: F.col(quoted(c)) for c in chosen}, points)
            edges |= {c: list(dict.fromkeys(found[c].values())) for c in chosen}
    return edges


def literal_edges(edges: Sequence[float]) -> Column:
    """Numbers as an array; its text reads back to the same values."""
    return F.expr("array(" + ", ".join(f"double('{e!r}')" for e in edges) + ")")


def edges_below(value: Column, edges: Column) -> Column:
    return F.size(F.filter(edges, lambda e: e < value))


def bin_number(value: Column, edges: Column) -> Column:
    """1-based right-closed bin; the first bin also holds its lower edge."""
    return F.greatest(F.lit(1), edges_below(value, edges))


def rate_by_bin(df: DataFrame, columns: Sequence[str], label: str = "Y", bins: int = 5) -> DataFrame:
    """(feature, bin, bin_lo, bin_hi, default_rate, observations); missing values form a bin of their own."""
    numbers = _coerced(df, columns, [label])
    edges = bin_edges(numbers, columns, bins)
    cells = [
        F.struct(
            F.lit(c).alias("feature"), F.when(F.col(quoted(c)).isNotNull(), bin_number(F.col(quoted(c)).cast("double"), literal_edges(e))).alias("bin"),
            F.col(quoted(label)).alias("hit"),
        )
        for c, e in edges.items()
    ]
    if not cells:
        return df.sparkSession.createDataFrame([], "feature string, bin int, bin_lo double, bin_hi double, default_rate double, observations bigint")
    # Summed in the task: what is shuffled is one row for each feature and bin.
    grouped = numbers.select(F.inline(F.array(*cells))).groupBy("feature", "bin").agg(F.sum("hit").alias("hits"), F.count(F.lit(1)).alias("observations"))
    # One row per requested column: safe to broadcast.
    bounds = df.sparkSession.createDataFrame(list(edges.items()), "feature string, edges array<double>")
    return grouped.join(F.broadcast(bounds), "feature").select(
        "feature", "bin", F.get("edges", F.col("bin") - 1).alias("bin_lo"), F.get("edges", F.col("bin")).alias("bin_hi"),
        (F.col("hits") / F.col("observations")).alias("default_rate"), "observations",
    )


def inconsistent_values(df: DataFrame) -> DataFrame:
    """(column, issue, details): unexpected codes as a sorted list, implausible ages as a count. One pass over the rows."""
    hits = []
    for column, valid in VALID_CODES.items():
        if column in df.columns:
            hits.append((column, "unexpected_category", lambda v, valid=valid: ~v.isin(*valid)))
    for column in STATUS_COLUMNS:
        if column in df.columns:
            hits.append((column, "unexpected_repayment_status", lambda v: ~v.between(*STATUS_RANGE)))
    cells = []
    for column, issue, broken in hits:
        value = F.expr(number(column, df.schema[column].dataType)).cast("bigint")
        cells.append(F.when(broken(value), F.struct(F.lit(column).alias("column"), F.lit(issue).alias("issue"), value.alias("value"))))
    if "AGE" in df.columns:
        age = F.expr(number("AGE", df.schema["AGE"].dataType))
        cells.append(F.when(
            (age < AGE_RANGE[0]) | (age > AGE_RANGE[1]),
            F.struct(F.lit("AGE").alias("column"), F.lit("possible_age_outlier").alias("issue"), F.lit(0).cast("bigint").alias("value")),
        ))
    if not cells:
        return df.sparkSession.createDataFrame([], "column string, issue string, details string")
    found = df.select(F.explode(F.array_compact(F.array(*cells))).alias("e")).select("e.*")
    # Fold to distinct codes first, so the list is built from codes and not from rows.
    codes = found.groupBy("column", "issue", "value").agg(F.count(F.lit(1)).alias("n"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list("value")), lambda v: v.cast("string")), ",")
    return codes.groupBy("column", "issue").agg(
        F.when(F.col("issue") == "possible_age_outlier", F.sum("n").cast("string")).otherwise(listed).alias("details")
    )


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 20) -> DataFrame:
    """(feature, bin, bin_lo, bin_hi, count): equal-width bins over the observed range, the last one closed."""
    numbers = _coerced(df, columns)
    spans = moments(numbers, columns).where("count > 0").select(
        "feature",
        F.when(F.col("min") == F.col("max"), F.col("min") - 0.5).otherwise(F.col("min")).alias("lo"),
        F.when(F.col("min") == F.col("max"), F.col("max") + 0.5).otherwise(F.col("max")).alias("hi"),
    )
    place = F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins)
    # spans has one row per requested column.
    counted = long_form(numbers, columns).where("value is not null").join(F.broadcast(spans), "feature").groupBy(
        "feature", F.least(F.lit(bins - 1), place).cast("int").alias("bin")
    ).agg(F.count(F.lit(1)).alias("count"))
    width = (F.col("hi") - F.col("lo")) / bins
    frame = spans.select("feature", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return frame.join(counted, ["feature", "bin"], "left").select(
        "feature", "bin", (F.col("lo") + width * F.col("bin")).alias("bin_lo"), (F.col("lo") + width * (F.col("bin") + 1)).alias("bin_hi"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def _facts(one_row: DataFrame, names: Sequence[str], values: dict[tuple, Column]) -> DataFrame:
    """Turn the columns of a one-row table into (names..., value) rows."""
    cells = [
        F.struct(*[F.lit(k).cast("string").alias(n) for n, k in zip(names, key)], value.cast("double").alias("value"))
        for key, value in values.items()
    ]
    return one_row.select(F.inline(F.array(*cells)))


def schema_report(
    df: DataFrame, label: str = "Y", identifiers: Sequence[str] = ("ID",), min_rows: int = MIN_ROWS, min_features: int = MIN_FEATURES
) -> DataFrame:
    """Long report (section, name, value, text): shape, label, missing, dtype, issue and leakage rows."""
    features = [c for c in df.columns if c != label]
    require_shape(df, features, min_rows, min_features)
    class_sizes(df, label)
    spark = df.sparkSession
    numbers = df.agg(F.count(F.lit(1)).cast("double").alias("n_rows"), F.avg(quoted(label)).alias("positive_rate"))
    shape = _facts(numbers, ("section", "name"), {
        ("shape", "n_rows"): F.col("n_rows"),
        ("shape", "n_features"): F.lit(float(len(features))),
        ("target", "positive_rate"): F.col("positive_rate"),
    })
    duplicates = duplicate_summary(df, features).select(
        F.lit("shape").alias("section"), F.lit("duplicate_rows").alias("name"), F.col("duplicate_rows").cast("double").alias("value")
    )
    missing = missing_counts(df, features).where("missing_count > 0").select(
        F.lit("missing").alias("section"), F.col("column").alias("name"), F.col("missing_count").cast("double").alias("value")
    )
    issues = duplicates.where("value > 0").select(F.lit("issue").alias("section"), F.lit("duplicate rows").alias("name"), "value").unionByName(
        missing.groupBy().agg(F.count(F.lit(1)).cast("double").alias("value")).where("value > 0").select(
            F.lit("issue").alias("section"), F.lit("missing values").alias("name"), "value"
        )
    )
    counted = shape.unionByName(duplicates).unionByName(missing).unionByName(issues).withColumn("text", F.lit(None).cast("string"))
    facts = [("target", "name", None, label)]
    facts += [("dtype", f.name, None, f.dataType.simpleString()) for f in df.schema.fields if f.name != label]
    facts += [("leakage_risk", c, None, None) for c in features if c in identifiers]
    return counted.unionByName(spark.createDataFrame(facts, "section string, name string, value double, text string"))


def eda_summary(df: DataFrame, label: str = "Y", max_categories: int = 10) -> DataFrame:
    """Long summary (section, column, key, value): shape, label counts, describe, top categories."""
    features = [c for c in df.columns if c != label]
    numeric, other = split_columns_by_type(df.select(*map(quoted, features)))
    n_rows = df.agg(F.count(F.lit(1)).cast("double").alias("value"), F.avg(quoted(label)).alias("rate"))
    shape = _facts(n_rows, ("section", "column", "key"), {
        ("shape", None, "rows"): F.col("value"),
        ("shape", None, "features"): F.lit(float(len(features))),
        ("target", label, "positive_rate"): F.col("rate"),
    })
    labels = label_distribution(df, label).select(
        F.lit("target").alias("section"), F.lit(label).alias("column"), F.col("target").cast("string").alias("key"), F.col("count").cast("double").alias("value")
    )
    result = shape.unionByName(labels)
    if numeric:
        stats = descriptive_stats(df, numeric).withColumn("count", F.col("count").cast("double"))
        names = {"count": "count", "mean": "mean", "std": "std", "min": "min", "p25": "25%", "p50": "50%", "p75": "75%", "max": "max"}
        described = stats.withColumnsRenamed(names).unpivot(["feature"], list(names.values()), "key", "value").where("value is not null")
        result = result.unionByName(described.select(F.lit("numeric").alias("section"), F.col("feature").alias("column"), "key", "value"))
    if other:
        result = result.unionByName(top_categories(df, other, max_categories).select(
            F.lit("categorical").alias("section"), "column", F.col("value").alias("key"), F.col("n").cast("double").alias("value")
        ))
    return result


def top_categories(df: DataFrame, columns: Sequence[str], limit: int) -> DataFrame:
    """(column, value, n): the most frequent values per column, ties by value.

    The lists are cut in two steps: within hash slices of the folded values,
    then over the limit x slices survivors, so a large domain never meets one task.
    """
    texts = df.select(*[F.coalesce(F.col(quoted(c)).cast("string"), F.lit(MISSING)).alias(c) for c in columns])
    counts = texts.unpivot([], list(map(quoted, columns)), "column", "value").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    sliced = counts.withColumn("_slice", F.pmod(F.xxhash64("value"), F.lit(256)))
    order = [F.desc("n"), F.asc("value")]
    local = Window.partitionBy("column", "_slice").orderBy(*order)
    final = Window.partitionBy("column").orderBy(*order)
    survivors = sliced.withColumn("_r", F.row_number().over(local)).where(F.col("_r") <= limit)
    return survivors.withColumn("_r", F.row_number().over(final)).where(F.col("_r") <= limit).select("column", "value", "n")


def relation_columns(df: DataFrame, label: str = "Y", limit: int = 6) -> list[str]:
    features = [c for c in df.columns if c != label]
    first = [c for c in RELATION_PRIORITY if c in features]
    if len(first) < limit:
        small = small_domain_columns(df, [c for c in features if c not in first])
        first += small
    return first[:limit]


def eda_report(df: DataFrame, label: str = "Y", max_numeric: int = 6, max_relation: int = 6) -> dict[str, DataFrame]:
    """All profiling tables of a labelled table, by section name."""
    features = [c for c in df.columns if c != label]
    numeric, _ = split_columns_by_type(df.select(*map(quoted, features)))
    chosen = pick_columns(numeric, NUMERIC_PRIORITY, min(max_numeric, len(numeric)))
    related = relation_columns(df, label, max_relation)
    spark = df.sparkSession
    selected = [("numeric", i, c) for i, c in enumerate(chosen)] + [("relation", i, c) for i, c in enumerate(related)]
    return {
        "target_distribution": label_distribution(df, label),
        "descriptive_stats": descriptive_stats(df, chosen),
        "missing_values": missing_table(df, features),
        "duplicate_summary": duplicate_summary(df, features),
        "numeric_distribution_summary": numeric_distribution(df, chosen),
        "default_rate_by_category": rate_by_category(df, related, label),
        "default_rate_by_numeric_bin": rate_by_bin(df, chosen, label),
        "inconsistent_values": inconsistent_values(df),
        "selected_columns": spark.createDataFrame(selected, "kind string, position int, column string"),
    }


def feature_audit(df: DataFrame, name: str, key: str = "row_id") -> DataFrame:
    """One row: size, types, missing, infinite, constant, near-constant and duplicated columns, largest magnitude."""
    columns = [c for c in df.columns if c != key]
    fields = {f.name: f.dataType for f in df.schema.fields}
    numeric, _ = split_columns_by_type(df.select(*map(quoted, columns)))
    numeric = [c for c in numeric if not isinstance(fields[c], T.BooleanType)]
    integers = [c for c in numeric if isinstance(fields[c], T.IntegralType)]
    floats = [c for c in numeric if isinstance(fields[c], T.FractionalType)]

    missing = [f"count_if({missing_test(df, c)})" for c in columns]
    infinite = [f"count_if(abs({quoted(c)}) = double('Infinity'))" for c in floats]
    biggest = [f"max(abs({number(c, fields[c])}))" for c in numeric]
    wide = df.agg(
        F.count(F.lit(1)).alias("rows"), F.expr(" + ".join(["0L", *missing])).alias("nan"), F.expr(" + ".join(["0L", *infinite])).alias("inf"),
        F.expr(f"greatest({', '.join(['0D', '0D', *biggest])})").alias("max_abs_value"),
    )
    distinct = _value_counts_up_to(df, columns, 0.001)
    constant = sum(n <= 1 for n in distinct.values())
    facts = {
        "columns": len(columns), "number_numeric": len(numeric), "number_integer": len(integers), "number_float": len(floats),
        "number_string": sum(isinstance(fields[c], T.StringType) for c in columns),
        "number_bool": sum(isinstance(fields[c], T.BooleanType) for c in columns),
        "duplicate_column_names": len(columns) - len(set(columns)), "duplicate_features": len(duplicate_columns(df, columns, key)),
    }
    last = {"constant_columns": constant, "near_constant_columns": len(distinct)}
    return wide.select(
        F.lit(name).alias("feature_set"), "rows", *[F.lit(v).alias(n) for n, v in facts.items()], "nan", "inf",
        *[F.lit(v).cast("bigint").alias(n) for n, v in last.items()], "max_abs_value",
    )


def _value_counts_up_to(df: DataFrame, columns: Sequence[str], share: float) -> dict[str, int]:
    """Distinct values, null counted as one, of the columns that have at most max(2, share x rows) of them.

    A sketch decides all columns that are clearly above or below the limit; only
    those near it, and those with few values, are counted exactly.
    """
    if not columns:
        return {}
    cells = [F.struct(F.approx_count_distinct(quoted(c)), F.count_if(F.col(quoted(c)).isNull())).alias(f"c{i}") for i, c in enumerate(columns)]
    sketch = df.agg(F.count(F.lit(1)).alias("rows"), *cells).first()
    limit = max(2, int(sketch["rows"] * share))
    about = {c: sketch[f"c{i}"][0] + (sketch[f"c{i}"][1] > 0) for i, c in enumerate(columns)}
    sure = {c: n for c, n in about.items() if 100 < n < limit / 2}
    near = [c for c, n in about.items() if c not in sure and n <= 2 * limit + 2]
    if not near:
        return sure
    texts = df.select(*[F.col(quoted(c)).cast("string").alias(c) for c in near])
    values = texts.unpivot([], list(map(quoted, near)), "column", "value").groupBy("column", "value").agg(F.lit(1).alias("one"))
    exact = {r["column"]: r["n"] for r in values.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    return sure | {c: n for c, n in exact.items() if n <= limit}


def duplicate_columns(df: DataFrame, columns: Sequence[str], key: str) -> list[str]:
    """Columns equal, row by row, to an earlier column.

    Order-free fingerprints over (key, value) pick the candidates in one pass,
    an exact comparison in a second pass confirms them.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}

    def plain(c: str) -> Column:
        dtype = fields[c]
        return F.expr(f"{number(c, dtype)} + 0D") if isinstance(dtype, T.NumericType) else F.col(quoted(c)).cast("string")

    prints = df.agg(*[
        F.struct(F.bit_xor(F.xxhash64(F.col(quoted(key)), plain(c))), F.count(plain(c))).alias(c) for c in columns
    ]).first()
    groups: dict[tuple, list[str]] = {}
    for c in columns:
        kind = "number" if isinstance(fields[c], T.NumericType) else "text"
        groups.setdefault((kind, *prints[c]), []).append(c)
    pairs = [(g[0], c) for g in groups.values() for c in g[1:]]
    if not pairs:
        return []
    differing = df.agg(*[F.count_if(~plain(a).eqNullSafe(plain(b))).alias(b) for a, b in pairs]).first()
    return [b for _, b in pairs if differing[b] == 0]
