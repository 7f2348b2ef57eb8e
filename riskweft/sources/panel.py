"""The wide risk table, derived from the order tables.

One row per customer. Period k (0 = newest) is the calendar year 2001-k; the
delay block is the worst shipping lag in steps of 300 days, the bill block the
ordered amount, the payment block the finished amount. The label says that at
least 40 % of the customer's lines came back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

NEWEST_YEAR = 2001
PERIODS = range(6)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _order_lines(lineitem: DataFrame) -> DataFrame:
    """Lines folded to one row per order before any join: lineitem has no key and may be skewed."""
    # Money adds up in whole units (cents x percent), which is exact and much cheaper than wide decimals.
    paid = F.round(F.col("l_extendedprice") * 100).cast("bigint") * (100 - F.round(F.col("l_discount") * 100).cast("bigint"))
    early = F.col("l_linenumber") <= 3
    returned = F.col("l_returnflag") == "R"
    return lineitem.groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("last_ship"),
        F.sum(F.when(F.col("l_linestatus") == "F", paid)).alias("paid"),
        F.count(F.lit(1)).alias("lines"),
        F.count_if(returned).alias("returned"),
        F.count_if(early).alias("early_lines"),
        F.count_if(early & returned).alias("early_returned"),
    )


def _delay_code(lag: Column) -> Column:
    level = F.greatest(F.lit(-2), F.least(F.lit(8), F.floor(lag / 300).cast("int")))
    return F.when(lag.isNull(), F.lit(-2)).otherwise(level).cast("int")


def panel(spark: SparkSession, sf_dir: str, extra: bool = False) -> DataFrame:
    """row_id, X1..X23, Y; with extra also early_share (early view of the return share), balance and segment."""
    lines = _order_lines(read_table(spark, sf_dir, "lineitem"))
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    dated = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        "o_custkey",
        F.year("o_orderdate").alias("yr"),
        F.datediff("last_ship", "o_orderdate").alias("lag"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("price"),
        "paid", "lines", "returned", "early_lines", "early_returned",
    )

    def in_period(k: int, value: str) -> Column:
        return F.when(F.col("yr") == NEWEST_YEAR - k, F.col(value))

    per_customer = dated.groupBy("o_custkey").agg(
        *[F.max(in_period(k, "lag")).alias(f"lag{k}") for k in PERIODS],
        *[F.sum(in_period(k, "price")).alias(f"bill{k}") for k in PERIODS],
        *[F.sum(in_period(k, "paid")).alias(f"paid{k}") for k in PERIODS],
        *[F.sum(c).alias(c) for c in ("lines", "returned", "early_lines", "early_returned")],
    )
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment")
    key = F.col("c_custkey")
    out = customer.join(per_customer, key == F.col("o_custkey"), "left")

    def amount(name: str, unit: float) -> Column:
        return F.coalesce(F.col(name) / F.lit(unit), F.lit(0.0))

    share = F.try_divide(F.col("returned"), F.col("lines"))
    columns = [
        key.alias("row_id"),
        F.abs("c_acctbal").alias("X1"),
        (key % 2 + 1).cast("int").alias("X2"),
        (key % 7).cast("int").alias("X3"),
        (F.col("c_nationkey") % 4).cast("int").alias("X4"),
        (21 + key % 60).cast("int").alias("X5"),
        *[_delay_code(F.col(f"lag{k}")).alias(f"X{6 + k}") for k in PERIODS],
        *[amount(f"bill{k}", 100.0).alias(f"X{12 + k}") for k in PERIODS],
        *[amount(f"paid{k}", 10000.0).alias(f"X{18 + k}") for k in PERIODS],
        F.when(F.coalesce(share, F.lit(0.0)) >= 0.40, 1).otherwise(0).cast("int").alias("Y"),
    ]
    if extra:
        early = F.try_divide(F.col("early_returned"), F.col("early_lines"))
        columns += [
            F.coalesce(early, F.lit(0.0)).alias("early_share"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"),
        ]
    return out.select(*columns)


def _panel_sql() -> str:
    lag = ", ".join(f"max(case when yr={NEWEST_YEAR - k} then lag end) as lag{k}" for k in PERIODS)
    bill = ", ".join(f"sum(case when yr={NEWEST_YEAR - k} then price end) as bill{k}" for k in PERIODS)
    paid = ", ".join(f"sum(case when yr={NEWEST_YEAR - k} then paid end) as paid{k}" for k in PERIODS)
    x_lag = ", ".join(
        f"cast(case when lag{k} is null then -2 else greatest(-2, least(8, floor(lag{k}/300.0))) end as integer) as X{6 + k}"
        for k in PERIODS
    )
    x_bill = ", ".join(f"coalesce(cast(bill{k} as double), 0.0) as X{12 + k}" for k in PERIODS)
    x_paid = ", ".join(f"coalesce(cast(paid{k} as double), 0.0) as X{18 + k}" for k in PERIODS)
    return f"""
order_lines as (
  select l_orderkey, max(l_shipdate) as last_ship,
         sum(case when l_linestatus='F' then cast(l_extendedprice as decimal(18,2)) * (1 - cast(l_discount as decimal(4,2))) end) as paid,
         count(*) as lines,
         sum(case when l_returnflag='R' then 1 else 0 end) as returned,
         sum(case when l_linenumber<=3 then 1 else 0 end) as early_lines,
         sum(case when l_linenumber<=3 and l_returnflag='R' then 1 else 0 end) as early_returned
  from lineitem group by l_orderkey),
dated as (
  select o_custkey, year(o_orderdate) as yr, date_diff('day', o_orderdate, last_ship) as lag,
         cast(o_totalprice as decimal(18,2)) as price, paid, lines, returned, early_lines, early_returned
  from orders left join order_lines on o_orderkey = l_orderkey),
per_customer as (
  select o_custkey, {lag}, {bill}, {paid}, sum(lines) as lines, sum(returned) as returned,
         sum(early_lines) as early_lines, sum(early_returned) as early_returned
  from dated group by o_custkey),
panel as (
  select c_custkey as row_id, abs(c_acctbal) as X1, cast(c_custkey%2+1 as integer) as X2,
         cast(c_custkey%7 as integer) as X3, cast(c_nationkey%4 as integer) as X4, cast(21+c_custkey%60 as integer) as X5,
         {x_lag}, {x_bill}, {x_paid},
         cast(case when coalesce(cast(returned as double)/nullif(lines,0), 0.0) >= 0.40 then 1 else 0 end as integer) as Y,
         coalesce(cast(early_returned as double)/nullif(early_lines,0), 0.0) as early_share,
         c_acctbal as balance, c_mktsegment as segment
  from customer left join per_customer on c_custkey = o_custkey)"""


PANEL_SQL = _panel_sql().strip()


def with_panel(body: str, *ctes: str) -> str:
    """Oracle text: WITH panel, then further CTEs, then the final select."""
    return "with " + ",\n".join([PANEL_SQL, *[c.strip() for c in ctes]]) + "\n" + body.strip()
