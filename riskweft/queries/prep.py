"""Preprocessing queries (PP*): fitted on the training split of the profile table."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweft.operators import prep as pp, splitting as sp
from riskweft.queries.features import rounded
from riskweft.queries.quality import PROFILE_SQL, profile
from riskweft.queries.registry import query
from riskweft.queries.splits import RANKED_SQL, SPLIT_SQL
from riskweft.session import stage
from riskweft.sources.panel import with_panel

NUM = ["LIMIT_BAL", "AGE", "PAY_0", "BILL_AMT1", "PAY_AMT1"]
CAT = ["SEGMENT", "GRADE"]
COLUMNS = ["ID", *NUM, *CAT]
KEEP = ("ID", "Y", "split")
GRADE = "case when EDUCATION in (5, 6) and split = 'train' then null else concat('g', cast(EDUCATION as string)) end"


def split_profile(spark, sf):
    """Profile columns with the split; grades g5 and g6 occur outside the training rows only."""
    df = profile(spark, sf).withColumn("row_id", F.col("ID"))
    split = sp.stratified_split(stage(df.select("ID", "row_id", *NUM, "SEGMENT", "EDUCATION", "Y"), "profile"))
    return stage(split.selectExpr("ID", *NUM, "SEGMENT", f"{GRADE} as GRADE", "Y", "split"), "split")


BASE_SQL = (
    "base as (select p.ID, p.LIMIT_BAL, p.AGE, p.PAY_0, p.BILL_AMT1, p.PAY_AMT1, p.SEGMENT,"
    " case when p.EDUCATION in (5, 6) and s.split = 'train' then null else concat('g', cast(p.EDUCATION as varchar)) end as GRADE, p.Y, s.split"
    " from profile p join split_table s on s.row_id = p.ID)"
)
_NUMBERS = " union all ".join(f"select '{c}' as \"column\", cast({c} as double) as v from base where split='train'" for c in NUM)
_TEXTS = " union all ".join(f"select '{c}' as \"column\", {c} as v from base where split='train'" for c in CAT)
FIT_SQL = [
    f"med as (select \"column\", quantile_cont(v, 0.5) as median from ({_NUMBERS}) group by 1)",
    f"mom as (select \"column\", any_value(median) as median, avg(coalesce(v, median)) as mean, stddev_pop(coalesce(v, median)) as std"
    f" from ({_NUMBERS}) join med using (\"column\") group by 1)",
    f"cats as (select \"column\", v, count(*) as n from ({_TEXTS}) where v is not null group by 1, 2)",
    "modes as (select \"column\", arg_max(v, n * 1000 - r) as mode, list(v order by v) as categories"
    " from (select *, row_number() over (partition by \"column\" order by v) as r from cats) group by 1)",
]


def with_base(body: str) -> str:
    return with_panel(body, PROFILE_SQL, RANKED_SQL, SPLIT_SQL, BASE_SQL, *FIT_SQL)


def _m(c, what):
    return f"(select {what} from mom where \"column\"='{c}')"


def _mode(c):
    return f"(select mode from modes where \"column\"='{c}')"


@query(
    "pp1_column_plan",
    with_base(
        "select 'feature' as role, \"column\", count(*) as rows from (select unnest(['" + "','".join([*NUM, *CAT]) + "']) as \"column\" from base) group by 2"
        " union all select 'numeric', \"column\", count(*) from (select unnest(['" + "','".join(NUM) + "']) as \"column\" from base) group by 2"
        " union all select 'categorical', \"column\", count(*) from (select unnest(['" + "','".join(CAT) + "']) as \"column\" from base) group by 2"
        " union all select role, 'ID', count(*) from (select unnest(['dropped', 'leakage']) as role from base) group by 1"
    ),
)
def pp1_column_plan(spark, sf):
    df = split_profile(spark, sf)
    plan = pp.plan_columns(df, keep=("Y", "split"))
    rows = df.agg(F.count(F.lit(1))).scalar()
    return pp.describe(plan, df).where("role not like '%step'").select("role", "column", rows.alias("rows"))


@query(
    "pp2_fitted_values",
    with_base(
        "select \"column\", 'numeric' as kind, round(median, 6) as median, round(mean, 6) as mean, round(std, 6) as std, cast(null as varchar) as mode,"
        " cast(null as varchar) as categories from mom union all"
        " select \"column\", 'categorical', null, null, null, mode, array_to_string(categories, ',') from modes"
    ),
)
def pp2_fitted_values(spark, sf):
    df = split_profile(spark, sf)
    prep = pp.fit_preparation(df, keep=KEEP, split="split")
    return rounded(pp.fitted_values(prep, df).withColumn("categories", F.array_join("categories", ",")), 6)


@query("pp3_median_imputation", with_base("select ID, " + ", ".join(f"round(coalesce(cast({c} as double), {_m(c, 'median')}), 6) as {c}" for c in NUM) + " from base"))
def pp3_median_imputation(spark, sf):
    df = split_profile(spark, sf)
    prep = pp.fit_preparation(df, keep=KEEP, split="split")
    return rounded(pp.impute(prep, df, ("ID",)).select("ID", *NUM), 6)


_SCALED = ", ".join(
    f"round((coalesce(cast({c} as double), {_m(c, 'median')}) - {_m(c, 'mean')}) / {_m(c, 'case when std = 0 then 1 else std end')}, 6) + 0.0 as {c}" for c in NUM
)


@query("pp4_standard_scaling", with_base(f"select ID, {_SCALED} from base"))
def pp4_standard_scaling(spark, sf):
    df = split_profile(spark, sf)
    prep = pp.fit_preparation(df, keep=KEEP, split="split")
    return rounded(pp.transform(prep, df, ("ID",)).select("ID", *NUM), 6)


@query("pp5_mode_imputation", with_base("select ID, " + ", ".join(f"coalesce({c}, {_mode(c)}) as {c}" for c in CAT) + " from base"))
def pp5_mode_imputation(spark, sf):
    df = split_profile(spark, sf)
    prep = pp.fit_preparation(df, keep=KEEP, split="split")
    return pp.impute(prep, df, ("ID",)).select("ID", *CAT)


def _indicator_names():
    # Grades seen in training (5 and 6 are not) and the segments of the customer table.
    segments = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    return [("SEGMENT", s) for s in segments] + [("GRADE", f"g{i}") for i in (0, 1, 2, 3, 4)]


_ONE_HOT = ", ".join(f"cast(case when coalesce({c}, {_mode(c)}) = '{v}' then 1 else 0 end as double) as \"{c}_{v}\"" for c, v in _indicator_names())


@query("pp6_one_hot", with_base(f"select ID, {_ONE_HOT} from base"))
def pp6_one_hot(spark, sf):
    df = split_profile(spark, sf)
    prep = pp.fit_preparation(df, keep=KEEP, split="split")
    out = pp.transform(prep, df, ("ID",))
    return out.select("ID", *[c for c in out.columns if c not in ("ID", *NUM)])


@query("pp7_transform_all_splits", with_base(f"select ID, Y, split, {_SCALED}, {_ONE_HOT} from base"))
def pp7_transform_all_splits(spark, sf):
    df = split_profile(spark, sf)
    prep, out = pp.build_and_prepare(df, keep=KEEP)
    return rounded(out, 6)


def _listed(role: str, columns) -> str:
    return " union all ".join(f"select '{role}' as role, {i} as position, '{c}' as \"column\"" for i, c in enumerate(columns))


@query(
    "pp8_describe",
    " union all ".join([
        _listed("feature", [*NUM, *CAT]), _listed("numeric", NUM), _listed("categorical", CAT),
        _listed("numeric_step", ["median_imputer", "standard_scaler"]), _listed("categorical_step", ["most_frequent_imputer", "one_hot_encoder"]),
    ]),
)
def pp8_describe(spark, sf):
    df = split_profile(spark, sf)
    return pp.describe(pp.fit_preparation(df, keep=KEEP, split="split"), df)
