"""Split, fold, sampling and weight queries (SPL*, SMP*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweft.operators import splitting as sp
from riskweft.queries.features import rounded
from riskweft.queries.registry import query
from riskweft.session import stage
from riskweft.sources.contract import FEATURES, SEED
from riskweft.sources.panel import panel, with_panel

RANKED_SQL = (
    f"ranked as (select *, row_number() over (partition by Y order by md5(cast(row_id as varchar) || ':{SEED}'), row_id) - 1 as rnk,"
    " count(*) over (partition by Y) as class_n, count(*) over () as n from panel)"
)
SPLIT_SQL = """
sized as (select *, cast(floor(n*0.7+1e-9) as bigint) as n_train, cast(sum(Y) over () as bigint) as positives from ranked),
sized2 as (select *, n - n_train - cast(ceil((n-n_train)*0.15/0.3) as bigint) as n_val,
  cast(floor(positives*n_train/cast(n as double)+0.5) as bigint) as pos_train from sized),
sized3 as (select *, cast(floor(positives*n_val/cast(n as double)+0.5) as bigint) as pos_val from sized2),
cuts as (select *, case when Y=1 then pos_train else n_train-pos_train end as c1,
  case when Y=1 then pos_train+pos_val else n_train-pos_train+n_val-pos_val end as c2 from sized3),
split_table as (select *, case when rnk < c1 then 'train' when rnk < c2 then 'validation' else 'test' end as split from cuts)
"""


def keyed(spark, sf):
    """(row_id, Y), staged: the split operators read it several times."""
    return stage(panel(spark, sf).select("row_id", "Y"), "keys")


@query("spl1_stratified_split", with_panel("select row_id, Y, split from split_table", RANKED_SQL, SPLIT_SQL))
def spl1_stratified_split(spark, sf):
    return sp.stratified_split(keyed(spark, sf))


@query(
    "spl2_split_summary",
    with_panel(
        "select split, count(*) as rows, cast(23 as integer) as features, round(avg(Y), 9) as positive_rate from split_table group by split",
        RANKED_SQL, SPLIT_SQL,
    ),
)
def spl2_split_summary(spark, sf):
    return rounded(sp.summarize_splits(sp.stratified_split(keyed(spark, sf)), len(FEATURES)), 9)


@query(
    "spl3_overlap_guard",
    """select c_custkey as row_id, min(split) as first_split, max(split) as last_split from (
         select c_custkey, 'train' as split from customer where c_acctbal < 5000
         union all select c_custkey, 'test' from customer where c_acctbal >= 4900)
       group by c_custkey having min(split) <> max(split)""",
)
def spl3_overlap_guard(spark, sf):
    customer = spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_custkey").alias("row_id"), "c_acctbal")
    left = customer.where("c_acctbal < 5000").select("row_id", F.lit("train").alias("split"))
    right = customer.where("c_acctbal >= 4900").select("row_id", F.lit("test").alias("split"))
    return sp.split_overlap(left.unionByName(right))


def _fold_sql(k: int) -> str:
    cuts = " + ".join(f"(case when floor(class_n*{i}/{k}.0) <= rnk then 1 else 0 end)" for i in range(1, k))
    return with_panel(f"select row_id, Y, cast({cuts} as integer) as fold from ranked", RANKED_SQL)


@query("spl4_stratified_folds_k5", _fold_sql(5))
def spl4_stratified_folds_k5(spark, sf):
    return sp.stratified_folds(keyed(spark, sf), 5)


@query("spl4_stratified_folds_k3", _fold_sql(3))
def spl4_stratified_folds_k3(spark, sf):
    return sp.stratified_folds(keyed(spark, sf), 3)


@query(
    "smp1_undersample",
    with_panel(
        "select row_id, Y from ranked where Y=1 or rnk < least(class_n, cast(round_even((n-class_n)*2.0, 0) as bigint))", RANKED_SQL
    ),
)
def smp1_undersample(spark, sf):
    return sp.resample(keyed(spark, sf), 2.0, "undersampling")


@query(
    "smp2_oversample",
    with_panel(
        "select row_id, Y from panel where Y=0 union all select r.row_id, r.Y from draws join ranked r on r.Y=1 and r.rnk = draws.rnk",
        RANKED_SQL,
        "sizes as (select sum(Y)::bigint as np, sum(1-Y)::bigint as nn from panel)",
        "numbers as (select unnest(range(greatest(np, cast(round_even(nn/1.5, 0) as bigint)))) as i, np from sizes)",
        f"draws as (select (('0x' || substr(md5(cast(i as varchar) || ':{SEED}'), 1, 15))::bigint) % np as rnk from numbers)",
    ),
)
def smp2_oversample(spark, sf):
    return sp.resample(keyed(spark, sf), 1.5, "oversampling")


@query(
    "smp3_class_weights",
    with_panel(
        "select row_id, Y, round(case when Y=1 then n/(2.0*np) else n/(2.0*nn) end, 9) as balanced,"
        " case when Y=1 then 2.0::double else 1.0::double end as manual_light,"
        " round(case when Y=1 then cast(nn as double)/np else 1.0 end, 9) as pos_balanced,"
        " round(case when Y=1 then (1.0+cast(nn as double)/np)/2.0 else 1.0 end, 9) as pos_light"
        " from panel, (select count(*) as n, sum(Y)::bigint as np, sum(1-Y)::bigint as nn from panel)"
    ),
)
def smp3_class_weights(spark, sf):
    df = keyed(spark, sf)
    neg, pos = sp.class_sizes(df, "Y")
    modes = {"balanced": "balanced", "manual_light": "manual_light", "pos_balanced": "scale_balanced", "pos_light": "light"}
    return rounded(df.select("row_id", "Y", *[sp.class_weight(F.col("Y"), m, neg, pos).alias(n) for n, m in modes.items()]), 9)


@query(
    "smp4_pos_weight_grid",
    with_panel(
        "select distinct round_even(w, 6) as scale_pos_weight from (select unnest([1.0::double, r*0.5, r*0.75, r, r*1.25, r*1.5]) as w"
        " from (select cast(sum(1-Y) as double)/sum(Y) as r from panel))"
    ),
)
def smp4_pos_weight_grid(spark, sf):
    return sp.pos_weight_grid(panel(spark, sf))
