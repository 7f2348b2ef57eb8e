"""Profiling queries (EDA*) and column-level queries (PRJ*)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskweft.operators import features as fe, projection as pr, quality as q
from riskweft.queries.features import BEHAVIOUR_SQL, CELLS_SQL, RATIOS_SQL, STATS_SQL, inputs, rounded, select_sql, _merge
from riskweft.queries.registry import ORACLE, query
from riskweft.session import stage
from riskweft.sources.contract import FEATURES, SEMANTIC_NAMES
from riskweft.sources.panel import panel, with_panel

# The panel under business names, with gaps and codes outside their range.
_PASS = [c for c in FEATURES if c not in ("X1", "X2", "X3", "X4", "X5")]
PROFILE = [
    "row_id as ID", "case when balance < 0 then null else X1 end as LIMIT_BAL", "X2 as SEX", "X3 as EDUCATION", "X4 as MARRIAGE",
    "cast(15 + row_id % 90 as integer) as AGE", *[f"{c} as {SEMANTIC_NAMES[c]}" for c in _PASS],
    "case when X4 = 0 then null else segment end as SEGMENT", "Y",
]
PROFILE_SQL = "profile as (select " + ", ".join(PROFILE) + " from panel)"
NUMERIC = list(q.NUMERIC_PRIORITY)
RELATION = ["SEX", "EDUCATION", "MARRIAGE", "PAY_0", "PAY_2", "AGE", "SEGMENT"]
FEATURE_COLUMNS = [t.split(" as ")[-1] for t in PROFILE if t != "Y"]
DIGITS = 6


def profile(spark, sf) -> DataFrame:
    return panel(spark, sf, extra=True).selectExpr(*PROFILE)


def staged_profile(spark, sf) -> DataFrame:
    return stage(profile(spark, sf), "profile")


def with_profile(body: str, *ctes: str) -> str:
    return with_panel(body, PROFILE_SQL, *ctes)


def long_sql(columns, keep: str = "", value: str = "cast({c} as double)") -> str:
    prefix = f"{keep}, " if keep else ""
    return " union all ".join(f"select {prefix}'{c}' as feature, {value.format(c=c)} as value from profile" for c in columns)


@query(
    "eda3_label_distribution",
    with_panel("select Y as target, count(*) as count, count(*)/cast(sum(count(*)) over () as double) as rate from panel group by Y"),
)
def eda3_label_distribution(spark, sf):
    return q.label_distribution(panel(spark, sf))


_MISSING = " union all ".join(
    f"select '{c}' as \"column\", cast(sum(case when {c} is null then 1 else 0 end) as bigint) as missing_count, count(*) as n from profile"
    for c in FEATURE_COLUMNS
)


@query(
    "eda4_missing_table",
    with_profile(f'select "column", missing_count, round(cast(missing_count as double)/n, 9) as missing_rate from ({_MISSING}) where missing_count > 0'),
)
def eda4_missing_table(spark, sf):
    return rounded(q.missing_table(profile(spark, sf), FEATURE_COLUMNS), 9)


DUPLICATE_KEYS = ["SEX", "EDUCATION", "MARRIAGE", "PAY_0", "PAY_2", "SEGMENT"]


@query(
    "eda5_duplicate_summary",
    with_profile(
        "select cast(sum(n-1) as bigint) as duplicate_rows, round(sum(n-1)/cast(sum(n) as double), 9) as duplicate_rate from"
        f" (select count(*) as n from profile group by {', '.join(DUPLICATE_KEYS)})"
    ),
)
def eda5_duplicate_summary(spark, sf):
    return rounded(q.duplicate_summary(profile(spark, sf), DUPLICATE_KEYS), 9)


_STATS = (
    "stats as (select feature, count(value) as count, round(avg(value),{d}) as mean, round(stddev_samp(value),{d}) as std, round(min(value),{d}) as min,"
    " round(quantile_cont(value, 0.25),{d}) as p25, round(quantile_cont(value, 0.5),{d}) as p50, round(quantile_cont(value, 0.75),{d}) as p75,"
    " round(max(value),{d}) as max from ({long}) group by feature)"
)


def stats_cte(columns) -> str:
    return _STATS.format(d=DIGITS, long=long_sql(columns))


@query("eda6_descriptive_stats", with_profile("select * from stats", stats_cte(NUMERIC)))
def eda6_descriptive_stats(spark, sf):
    return rounded(q.descriptive_stats(staged_profile(spark, sf), NUMERIC), DIGITS)


@query(
    "eda7_numeric_distribution",
    with_profile("select feature, min, p25, p50 as median, p75, max, mean, std from stats", stats_cte(NUMERIC)),
)
def eda7_numeric_distribution(spark, sf):
    # Amounts arrive as text and are coerced.
    text = staged_profile(spark, sf).withColumns({c: F.col(c).cast("string") for c in NUMERIC})
    return rounded(q.numeric_distribution(text, NUMERIC), DIGITS)


_CATEGORY = " union all ".join(
    f"select '{c}' as \"column\", coalesce(cast({c} as varchar), '<MISSING>') as value, Y from profile" for c in RELATION if c != "AGE"
)


@query(
    "eda8_rate_by_category",
    with_profile(f'select "column", value, round(avg(Y), 9) as default_rate, count(*) as observations from ({_CATEGORY}) group by 1, 2'),
)
def eda8_rate_by_category(spark, sf):
    return rounded(q.rate_by_category(staged_profile(spark, sf), RELATION), 9)


def _bin_sql(columns, bins=5) -> str:
    """Edges per feature by its own bin count, then a right-closed bin."""
    def edges(k):
        return "[" + ", ".join(f"quantile_cont(value, {i}/{k}.0)" for i in range(k + 1)) + "]"

    pick = " ".join(f"when least({bins}, count(distinct value)) = {k} then {edges(k)}" for k in range(2, bins + 1))
    return (
        f"long as ({long_sql(columns, 'Y')}),\n"
        f"raw_edges as (select feature, case {pick} end as e from long where value is not null group by feature having count(distinct value) >= 2),\n"
        "edges as (select feature, list_sort(list_distinct(e)) as e from raw_edges),\n"
        "binned as (select long.feature, e, Y, case when value is not null then greatest(1, len(list_filter(e, lambda x: x < value))) end as bin"
        " from long join edges using (feature))"
    )


@query(
    "eda9_rate_by_bin",
    with_profile(
        "select feature, cast(bin as integer) as bin, round(any_value(e)[bin], 6) as bin_lo, round(any_value(e)[bin+1], 6) as bin_hi,"
        " round(sum(Y)/cast(count(*) as double), 9) as default_rate, count(*) as observations from binned group by feature, bin",
        _bin_sql([*NUMERIC, "SEX", "MARRIAGE"]),
    ),
)
def eda9_rate_by_bin(spark, sf):
    out = q.rate_by_bin(staged_profile(spark, sf), [*NUMERIC, "SEX", "MARRIAGE"])
    return out.select(
        "feature", "bin", F.round("bin_lo", 6).alias("bin_lo"), F.round("bin_hi", 6).alias("bin_hi"),
        F.round("default_rate", 9).alias("default_rate"), "observations",
    )


def _unexpected(column: str, test: str, issue: str) -> str:
    return (
        f"select '{column}' as \"column\", '{issue}' as issue, string_agg(cast(v as varchar), ',' order by v) as details"
        f" from (select distinct {column} as v from profile where {test}) having count(*) > 0"
    )


_ISSUES = [
    _unexpected("SEX", "SEX not in (1,2)", "unexpected_category"),
    _unexpected("EDUCATION", "EDUCATION not in (1,2,3,4)", "unexpected_category"),
    _unexpected("MARRIAGE", "MARRIAGE not in (1,2,3)", "unexpected_category"),
    *[_unexpected(c, f"{c} < -2 or {c} > 9", "unexpected_repayment_status") for c in q.STATUS_COLUMNS],
    "select 'AGE', 'possible_age_outlier', cast(count(*) as varchar) from profile where AGE < 18 or AGE > 100 having count(*) > 0",
]


@query("eda10_inconsistent_values", with_profile(" union all ".join(_ISSUES)))
def eda10_inconsistent_values(spark, sf):
    return q.inconsistent_values(profile(spark, sf))


def _section(name: str, sql: str) -> str:
    return f"select '{name}' as section, count(*) as rows from ({sql})"


_RELATED = " union all ".join(
    f"select '{c}' as c, cast({c} as varchar) as v from profile group by all" for c in q.RELATION_PRIORITY
)


@query(
    "eda11_report_sections",
    " union all ".join([
        _section("target_distribution", ORACLE["eda3_label_distribution"]), _section("descriptive_stats", ORACLE["eda6_descriptive_stats"]),
        _section("missing_values", ORACLE["eda4_missing_table"]), _section("duplicate_summary", ORACLE["eda5_duplicate_summary"]),
        _section("numeric_distribution_summary", ORACLE["eda7_numeric_distribution"]), _section("default_rate_by_category", with_profile(_RELATED)),
        _section("default_rate_by_numeric_bin", f"select * from ({ORACLE['eda9_rate_by_bin']}) where feature in {tuple(NUMERIC)}"), _section("inconsistent_values", ORACLE["eda10_inconsistent_values"]),
        f"select 'selected_columns', cast({len(NUMERIC) + len(q.RELATION_PRIORITY)} as bigint)",
    ]),
)
def eda11_report_sections(spark, sf):
    """Row count of every table of the report bundle."""
    report = q.eda_report(staged_profile(spark, sf))
    out = None
    for name, part in report.items():
        counted = part.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("section"), "rows")
        out = counted if out is None else out.unionByName(counted)
    return out


@query(
    "eda12_histogram",
    with_profile(
        "select s.feature, cast(b as integer) as bin, round(lo + (hi-lo)/20.0*b, 6) as bin_lo, round(lo + (hi-lo)/20.0*(b+1), 6) as bin_hi,"
        " coalesce(c, 0) as count from spans s, range(20) t(b) left join counted on counted.feature = s.feature and counted.bin = b",
        f"long as ({long_sql(NUMERIC)})",
        "spans as (select feature, case when min(value)=max(value) then min(value)-0.5 else min(value) end as lo,"
        " case when min(value)=max(value) then max(value)+0.5 else max(value) end as hi from long group by feature)",
        "counted as (select feature, least(19, floor((value-lo)/(hi-lo)*20)) as bin, count(*) as c from long join spans using (feature)"
        " where value is not null group by 1, 2)",
    ),
)
def eda12_histogram(spark, sf):
    out = q.histogram(staged_profile(spark, sf), NUMERIC)
    return out.select("feature", "bin", F.round("bin_lo", 6).alias("bin_lo"), F.round("bin_hi", 6).alias("bin_hi"), "count")


_TYPES = {
    **{c: "double" for c in ("LIMIT_BAL", *[SEMANTIC_NAMES[x] for x in _PASS if int(x[1:]) >= 12])},
    **{c: "int" for c in ("SEX", "EDUCATION", "MARRIAGE", "AGE", *q.STATUS_COLUMNS)}, "ID": "bigint", "SEGMENT": "string",
}


@query(
    "eda1_schema_report",
    with_profile(
        "select 'shape' as section, 'n_rows' as name, cast(count(*) as double) as value, cast(null as varchar) as text from profile"
        f" union all select 'shape', 'n_features', {len(FEATURE_COLUMNS)}.0, null"
        " union all select 'target', 'positive_rate', round(avg(Y), 9), null from profile union all select 'target', 'name', null, 'Y'"
        " union all select 'shape', 'duplicate_rows', 0.0, null"
        " union all select 'issue', 'missing values', cast(sum(case when missing_count > 0 then 1 else 0 end) as double), null from m having sum(missing_count) > 0"
        " union all select 'missing', \"column\", cast(missing_count as double), null from m where missing_count > 0"
        " union all select 'leakage_risk', 'ID', null, null "
        + "".join(f" union all select 'dtype', '{c}', null, '{t}'" for c, t in _TYPES.items()),
        f"m as ({_MISSING})",
    ),
)
def eda1_schema_report(spark, sf):
    return rounded(q.schema_report(staged_profile(spark, sf), min_rows=1), 9)


_NUMERIC_ALL = [c for c in FEATURE_COLUMNS if c != "SEGMENT"]
_KEYS = {"count": "count", "mean": "mean", "std": "std", "min": "min", "p25": "25%", "p50": "50%", "p75": "75%", "max": "max"}


@query(
    "eda2_summary",
    with_profile(
        "select 'shape' as section, cast(null as varchar) as \"column\", 'rows' as key, cast(count(*) as double) as value from profile"
        f" union all select 'shape', null, 'features', {len(FEATURE_COLUMNS)}.0"
        " union all select 'target', 'Y', 'positive_rate', round(avg(Y), 6) from profile"
        " union all select 'target', 'Y', cast(Y as varchar), cast(count(*) as double) from profile group by Y"
        + "".join(f" union all select 'numeric', feature, '{k}', cast({c} as double) from stats" for c, k in _KEYS.items())
        + " union all select 'categorical', 'SEGMENT', v, cast(n as double) from (select coalesce(SEGMENT, '<MISSING>') as v, count(*) as n"
        " from profile group by 1 order by n desc, v limit 10)",
        stats_cte(_NUMERIC_ALL),
    ),
)
def eda2_summary(spark, sf):
    return rounded(q.eda_summary(staged_profile(spark, sf)), DIGITS)


# --- EDA13 on the A3 feature set -------------------------------------------------------------------

_A3_COLUMNS = [*FEATURES, *_merge(*[BEHAVIOUR_SQL[g] for g in fe.ABLATIONS["A3"]])]
_A3_SQL = "a3 as (" + select_sql(_merge(*[BEHAVIOUR_SQL[g] for g in fe.ABLATIONS["A3"]]), 6, raw=True) + ")"
_A3_LONG = " union all ".join(f"select {i} as pos, '{c}' as c, row_id, cast({c} as double) as v from a3" for i, c in enumerate(_A3_COLUMNS))


@query(
    "eda13_feature_audit",
    with_panel(
        "select 'A3' as feature_set, (select count(*) from a3) as rows, 62 as columns, 62 as number_numeric, 10 as number_integer, 52 as number_float,"
        " 0 as number_string, 0 as number_bool, 0 as duplicate_column_names,"
        " cast((select count(*) from prints p where exists (select 1 from prints o where o.fp = p.fp and o.pos < p.pos)) as integer) as duplicate_features,"
        " cast(0 as bigint) as nan, cast(0 as bigint) as inf,"
        " (select count(*) from prints where d <= 1) as constant_columns,"
        " (select count(*) from prints where d <= greatest(2, floor((select count(*) from a3)*0.001))) as near_constant_columns,"
        " (select round(max(abs(v)), 4) from l) as max_abs_value",
        CELLS_SQL, RATIOS_SQL, STATS_SQL, _A3_SQL, f"l as ({_A3_LONG})",
        "prints as (select pos, c, md5(string_agg(cast(v as varchar), ',' order by row_id)) as fp, count(distinct v) as d from l group by pos, c)",
    ),
)
def eda13_feature_audit(spark, sf):
    a3 = stage(rounded(fe.behavioral_features(inputs(spark, sf), fe.ABLATIONS["A3"]), 6), "a3")
    return rounded(q.feature_audit(a3, "A3"), 4)


# --- PRJ -------------------------------------------------------------------------------------------


@query("prj1_semantic_rename", with_panel("select row_id, " + ", ".join(f"{k} as {v}" for k, v in SEMANTIC_NAMES.items()) + " from panel"))
def prj1_semantic_rename(spark, sf):
    return pr.semantic_rename(inputs(spark, sf))


_ROLES = {c: "other" for c in ("X1", "X5")}
_ROLES.update({c: "categorical" for c in ("X2", "X3", "X4")})
_ROLES.update({f"X{i}": "ordinal_delay" for i in range(6, 12)})
_ROLES.update({f"X{i}": "bill" for i in range(12, 18)})
_ROLES.update({f"X{i}": "payment" for i in range(18, 24)})


@query(
    "prj1_semantic_audit",
    with_panel(" union all ".join(
        f"select {i + 1} as position, '{c}' as \"column\", '{SEMANTIC_NAMES[c]}' as semantic_name, '{_ROLES[c]}' as role, count({c}) as present from panel"
        for i, c in enumerate(FEATURES)
    )),
)
def prj1_semantic_audit(spark, sf):
    """The audit rows with the number of present values behind each column."""
    df = inputs(spark, sf)
    audit = pr.semantic_audit(spark, [c for c in df.columns if c != "row_id"])
    present = q.moments(df, FEATURES).select(F.col("feature").alias("column"), F.col("count").alias("present"))
    return audit.join(present, "column")


@query("prj2_schema_contract", with_panel("select count(*) as rows, true as has_contract, false as label_accepted from panel"))
def prj2_schema_contract(spark, sf):
    df = panel(spark, sf).drop("row_id")
    try:
        pr.require_contract(df.columns)
        accepted = True
    except ValueError:
        accepted = False
    features = df.drop("Y")
    pr.require_contract(features.columns)
    return features.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(pr.has_contract(features.columns)).alias("has_contract"), F.lit(accepted).alias("label_accepted")
    )


@query("prj3_drop_identifiers", with_profile("select " + ", ".join(c for c in FEATURE_COLUMNS if c != "ID") + " from profile"))
def prj3_drop_identifiers(spark, sf):
    df = profile(spark, sf).drop("Y")
    return df.drop(*pr.identifier_columns(df.columns))


@query(
    "prj4_column_partition",
    with_profile(
        " union all ".join(
            f"select '{c}' as \"column\", '{'categorical' if c == 'SEGMENT' else 'numeric'}' as kind, count({c}) as present from profile"
            for c in FEATURE_COLUMNS
        )
    ),
)
def prj4_column_partition(spark, sf):
    df = profile(spark, sf).drop("Y")
    numeric, other = pr.split_columns_by_type(df)
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(kind).alias("kind"), F.count(c).alias("present"))
        for kind, names in (("numeric", numeric), ("categorical", other)) for c in names
    ])
    return df.agg(cells.alias("cells")).select(F.inline("cells"))


@query("prj5_priority_columns", with_profile("select LIMIT_BAL, AGE, BILL_AMT1, BILL_AMT2, PAY_AMT1, PAY_AMT2, ID, SEX from profile"))
def prj5_priority_columns(spark, sf):
    df = profile(spark, sf)
    return df.select(*pr.pick_columns(df.columns, q.NUMERIC_PRIORITY, 8))


@query(
    "prj6_numeric_coercion",
    "select o_orderkey, try_cast(split_part(o_orderpriority, '-', 1) as double) as priority, try_cast(o_orderstatus as double) as status,"
    " try_cast(o_orderpriority as double) as whole from orders",
)
def prj6_numeric_coercion(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet").select(
        "o_orderkey", F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).alias("priority"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("whole"),
    )
    return pr.coerce_numeric(orders, ["priority", "status", "whole"])


@query(
    "prj7_clean_numbers",
    with_panel(
        "select row_id, case when balance < 0 then 0.0 else X1 end as limit_bal,"
        " case when X12 = 0 then 0.0 else X18 / X12 end as ratio, case when X4 = 0 then 0 else X4 end as code from panel"
    ),
)
def prj7_clean_numbers(spark, sf):
    df = panel(spark, sf, extra=True).selectExpr(
        "row_id", "case when balance < 0 then double('NaN') else X1 end as limit_bal",
        "case when X12 = 0 then double('Infinity') else X18 / X12 end as ratio", "case when X4 = 0 then null else X4 end as code",
    )
    return pr.clean_numbers(df, skip=("row_id",))


@query("prj10_basic_shape", with_panel("select count(*) as rows, 23 as features from panel"))
def prj10_basic_shape(spark, sf):
    df = panel(spark, sf)
    pr.require_shape(df, FEATURES, min_rows=1)
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("features", F.lit(len(FEATURES)))


@query(
    "prj11_column_hash",
    with_panel("select count(*) as rows, 62 as number_features, sha256('" + "' || chr(10) || '".join(_A3_COLUMNS) + "') as feature_order_hash from panel"),
)
def prj11_column_hash(spark, sf):
    df = inputs(spark, sf)
    left = fe.behavioral_features(df, fe.ABLATIONS["A3"]).drop("row_id")
    right = fe.feature_set(df, fe.ABLATIONS["A3"]).drop("row_id")
    audit = pr.audit_column_order(left, right)
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(audit["number_features"]).alias("number_features"), F.lit(audit["feature_order_hash"]).alias("feature_order_hash")
    )


@query("prj12_stringify", with_panel("select row_id, cast(X2 as varchar) as X2, cast(X3 as varchar) as X3, cast(X4 as varchar) as X4 from panel"))
def prj12_stringify(spark, sf):
    return pr.stringify(panel(spark, sf).select("row_id", "X2", "X3", "X4"))
