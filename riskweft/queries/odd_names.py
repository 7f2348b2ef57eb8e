"""The profile under names with a dash, a space, a dot, a quote and a backtick: results must not depend on names."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweft.functions.rowmath import quoted
from riskweft.operators import prep as pp, projection as pr, quality as q
from riskweft.plans import experiments as ex, models as md
from riskweft.queries import prep as prep_queries, quality as quality_queries
from riskweft.queries.features import rounded
from riskweft.queries.prep import CAT, KEEP, NUM, split_profile
from riskweft.queries.quality import DIGITS, FEATURE_COLUMNS, NUMERIC, RELATION, staged_profile
from riskweft.queries.registry import ORACLE, query

ODD = {"LIMIT_BAL": "limit-bal", "AGE": "age in years", "BILL_AMT1": "bill.amt", "PAY_AMT1": "pay'amt", "SEX": "s`ex", "SEGMENT": "seg.ment of", "GRADE": "gr`a'de"}


def odd(columns):
    return [ODD.get(c, c) for c in columns]


def _named(base: str, column: str) -> str:
    """The oracle of a base row with the odd names in one of its columns."""
    cases = " ".join(f"when '{k}' then '{v.replace(chr(39), chr(39) * 2)}'" for k, v in ODD.items())
    return f"select * replace (case \"{column}\" {cases} else \"{column}\" end as \"{column}\") from ({ORACLE[base]})"


def _renamed(base: str, names: dict[str, str]) -> str:
    """The oracle of a base row with odd column names."""
    listed = ", ".join(f'"{k}" as "{v}"' for k, v in names.items())
    return f"select {listed} from ({ORACLE[base]})"


def odd_profile(spark, sf):
    return staged_profile(spark, sf).withColumnsRenamed(ODD)


@query("eda2_odd_names", _named("eda2_summary", "column"))
def eda2_odd_names(spark, sf):
    return rounded(q.eda_summary(odd_profile(spark, sf)), DIGITS)


@query("eda4_odd_names", _named("eda4_missing_table", "column"))
def eda4_odd_names(spark, sf):
    return rounded(q.missing_table(odd_profile(spark, sf), odd(FEATURE_COLUMNS)), 9)


@query("eda6_odd_names", _named("eda6_descriptive_stats", "feature"))
def eda6_odd_names(spark, sf):
    return rounded(q.descriptive_stats(odd_profile(spark, sf), odd(NUMERIC)), DIGITS)


@query("eda8_odd_names", _named("eda8_rate_by_category", "column"))
def eda8_odd_names(spark, sf):
    return rounded(q.rate_by_category(odd_profile(spark, sf), odd(RELATION)), 9)


@query("eda12_odd_names", _named("eda12_histogram", "feature"))
def eda12_odd_names(spark, sf):
    out = q.histogram(odd_profile(spark, sf), odd(NUMERIC))
    return out.select("feature", "bin", F.round("bin_lo", 6).alias("bin_lo"), F.round("bin_hi", 6).alias("bin_hi"), "count")


def odd_split(spark, sf):
    return split_profile(spark, sf).withColumnsRenamed(ODD)


_INDICATORS = {f"{c}_{v}": f"{ODD[c]}_{v}" for c, v in prep_queries._indicator_names()}


@query("pp7_odd_names", _renamed("pp7_transform_all_splits", {"ID": "ID", "Y": "Y", "split": "split", **{c: ODD.get(c, c) for c in NUM}, **_INDICATORS}))
def pp7_odd_names(spark, sf):
    _, out = pp.build_and_prepare(odd_split(spark, sf), keep=KEEP)
    return out.select(*[(F.round(quoted(c), 6) if out.schema[c].dataType.simpleString() == "double" else F.col(quoted(c))).alias(c) for c in out.columns])


@query("pp5_odd_names", _renamed("pp5_mode_imputation", {"ID": "ID", **{c: ODD[c] for c in CAT}}))
def pp5_odd_names(spark, sf):
    df = odd_split(spark, sf)
    return pp.impute(pp.fit_preparation(df, keep=KEEP, split="split"), df, ("ID",)).select("ID", *map(quoted, odd(CAT)))


@query(
    "prj7_odd_names",
    quality_queries.with_profile(
        'select ID, coalesce(LIMIT_BAL, 0) as "limit-bal", AGE as "age in years", SEX as "s`ex", coalesce(SEGMENT, \'0.0\') as "seg.ment of" from profile'
    ),
)
def prj7_odd_names(spark, sf):
    cleaned = pr.clean_numbers(pr.coerce_numeric(odd_profile(spark, sf), ["limit-bal"]), ("ID",))
    return cleaned.select("ID", *map(quoted, ("limit-bal", "age in years", "s`ex", "seg.ment of")))


@query(
    "mod2_odd_names",
    prep_queries.with_base("select split, count(*) as rows, cast(sum(Y) as bigint) as positives, count(*) as scored, true as same from base where split <> 'train' group by split"),
)
def mod2_odd_names(spark, sf):
    """A model fitted under odd names scores every row like one fitted under plain names."""
    scored = []
    for df in (odd_split(spark, sf), split_profile(spark, sf)):
        prep, out = pp.build_and_prepare(df, keep=KEEP)
        spec = md.ModelSpec("logistic_regression", "balanced", {"max_iter": 20}, "balanced")
        scored.append(md.fit(spec, ex.part(out, "train"), prep.output_columns).score(out.where("split <> 'train'"), ["ID", "Y", "split"]))
    both = scored[0].join(scored[1].select("ID", F.col("score").alias("plain")), "ID")
    return both.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("Y").cast("bigint").alias("positives"), F.count("score").alias("scored"),
        F.bool_and(F.abs(F.col("score") - F.col("plain")) < 1e-9).alias("same"),
    )
