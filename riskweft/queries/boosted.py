"""Boosted trees and target statistics, recomputed node by node in SQL.

The trees are small, so that SQL can say every step: gradients, the sums of all
candidate splits, gains, the growth rule and the leaves. Models with the full
settings are in modeling.py.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweft.operators import splitting as sp
from riskweft.operators.encoding import ordered_statistics
from riskweft.plans import boosting as bo
from riskweft.queries.features import rounded
from riskweft.queries.registry import query
from riskweft.queries.splits import RANKED_SQL, SPLIT_SQL
from riskweft.session import stage
from riskweft.sources.contract import CATEGORICAL, DELAY
from riskweft.sources.panel import panel, with_panel

BORDERS = tuple(float(b) for b in range(-2, 8))
POSITIVE = 2.5
LEVELWISE = bo.Growth(3, 0.3, 2, min_hessian=1.0, l2=1.0, l1=0.05, min_gain=0.01)
LEAFWISE = bo.Growth(3, 0.1, None, 3, min_hessian=1e-3, min_rows=20, l2=0.1)
SYMMETRIC = bo.Growth(3, 0.3, 2, l2=3.0, symmetric=True)

_MAX_DEPTH = 2


def _shrunk(g: str, l1: float) -> str:
    return f"greatest(abs({g}) - {l1!r}, 0)"


def trees_sql(growth: bo.Growth) -> str:
    """DuckDB text for growth.rounds trees of at most two levels over the delay columns."""
    columns = ", ".join(f"({i}, '{c}')" for i, c in enumerate(DELAY))
    borders = ", ".join(f"({b!r}::double)" for b in BORDERS)
    scale = float(bo.SCALE)
    ctes = [
        f"cols as (select * from (values {columns}) t(col, feature))", f"borders as (select * from (values {borders}) t(b))",
        f"t0 as (select row_id, {', '.join(DELAY)}, Y, case when Y = 1 then {POSITIVE!r} else 1.0 end::double as w,"
        f" (select ln(sum(case when Y = 1 then {POSITIVE!r} else 0 end)::double / sum(1 - Y)) from split_table where split = 'train') as m from split_table where split = 'train')",
    ]

    def score(g: str, h: str) -> str:
        return f"(({_shrunk(g, growth.l1)}) * ({_shrunk(g, growth.l1)}) / ({h} + {growth.l2!r}))"

    for t in range(growth.rounds):
        ctes.append(
            f"g{t} as (select *, round_even(w * (p - Y) * {scale!r}, 0)::bigint as g, round_even(w * p * (1 - p) * {scale!r}, 0)::bigint as h"
            f" from (select *, 1.0 / (1.0 + exp(-m)) as p from t{t}))"
        )
        ctes.append(f"n{t}_0 as (select *, '' as path from g{t})")
        for d in range(_MAX_DEPTH):
            here = f"{t}_{d}"
            long = " union all ".join(f"select row_id, path, g, h, {i} as col, {c}::double as x from n{here}" for i, c in enumerate(DELAY))
            ctes.append(
                f"c{here} as (select path, col, b, coalesce(sum(g) filter (x <= b), 0) as gl, coalesce(sum(h) filter (x <= b), 0) as hl, count(*) filter (x <= b) as nl,"
                f" sum(g) as g, sum(h) as h, count(*) as n from ({long}), borders where length(path) = {d} group by path, col, b)"
            )
            ctes.append(
                f"k{here} as (select *, {score('dl', 'el')} + {score('dr', 'er')} - {score('dg', 'eg')} as gain from (select *, gl / {scale!r} as dl, hl / {scale!r} as el,"
                f" (g - gl) / {scale!r} as dr, (h - hl) / {scale!r} as er, g / {scale!r} as dg, h / {scale!r} as eg, n - nl as nr from c{here})"
                + (" where nl > 0 and nl < n" if growth.symmetric else f" where nl >= {growth.min_rows} and nr >= {growth.min_rows} and el >= {growth.min_hessian!r} and er >= {growth.min_hessian!r}") + ")"
            )
            if growth.symmetric:
                ctes.append(f"o{here} as (select col, b, total from (select col, b, sum(gain) as total from k{here} group by col, b) where total > 0 order by total desc, col, b limit 1)")
                ctes.append(
                    f"s{here} as (select c.path, c.col, c.b, o.total as gain, gl, hl, nl, g, h, n from c{here} c join o{here} o on o.col = c.col and o.b = c.b)"
                )
            else:
                best = f"select *, row_number() over (partition by path order by gain desc, col, b) as place from k{here} where gain > {max(growth.min_gain, 0.0)!r}"
                # Three leaves: of the two children only the one with the larger gain is split again.
                most = f" order by gain desc, path limit {1 if growth.max_leaves else 1 << d}"
                ctes.append(f"s{here} as (select path, col, b, gain, gl, hl, nl, g, h, n from ({best}) where place = 1{most})")
            x = "case s.col " + " ".join(f"when {i} then n.{c}" for i, c in enumerate(DELAY)) + " end"
            ctes.append(
                f"n{t}_{d + 1} as (select n.* exclude (path), case when s.path is null then n.path when {x} <= s.b then n.path || 'l' else n.path || 'r' end as path"
                f" from n{here} n left join s{here} s on s.path = n.path)"
            )
        last = f"n{t}_{_MAX_DEPTH}"
        ctes.append(
            f"l{t} as (select path, sum(g) as g, sum(h) as h, count(*) as n, -{growth.learning_rate!r} * (sign(sum(g)) * {_shrunk(f'sum(g) / {scale!r}', growth.l1)})"
            f" / (sum(h) / {scale!r} + {growth.l2!r}) as leaf from {last} group by path)"
        )
        ctes.append(f"t{t + 1} as (select n.* exclude (path, p, g, h, m), m + leaf as m from {last} n join l{t} on l{t}.path = n.path)")
    parts = []
    for t in range(growth.rounds):
        parts.append(f"select {t} as tree, path, null as feature, null::double as threshold, null::double as gain, g, h, n, leaf from l{t}")
        for d in range(_MAX_DEPTH):
            parts.append(f"select {t}, s.path, feature, b, gain, g, h, n, null from s{t}_{d} s join cols on cols.col = s.col")
    body = (
        f"select tree::int as tree, path, feature, threshold, round(gain, 6) as gain, round(g / {scale!r}, 6) as gradient, round(h / {scale!r}, 6) as hessian, n::bigint as n_rows,"
        f" round(leaf, 9) as leaf from ({' union all '.join(parts)})"
    )
    return with_panel(body, RANKED_SQL, SPLIT_SQL, *[c.replace(" as (", " as materialized (", 1) for c in ctes])


def grown(spark, sf, growth: bo.Growth):
    data = stage(sp.stratified_split(stage(panel(spark, sf), "panel")).where("split = 'train'"), "panel")
    weight = F.when(F.col("Y") == 1, POSITIVE).otherwise(1.0)
    training = bo.Training(data, tuple(DELAY), "Y", (weight,), "row_id", tuple(BORDERS for _ in DELAY))
    table = bo.tree_table(spark, {"model": bo.fit_models(spark, {"model": bo.Wanted(training, growth)})["model"]})
    empty = (F.col("n_rows") > 0) | F.col("feature").isNotNull()
    picked = table.where(empty).select("tree", "path", "feature", "threshold", "gain", "gradient", "hessian", "n_rows", "leaf")
    return rounded(rounded(picked, 6, ("threshold", "leaf")), 9)


@query("mod6_levelwise_trees", trees_sql(LEVELWISE))
def mod6_levelwise_trees(spark, sf):
    """Level-wise growth with leaf penalties, minimum gain, minimum hessian and a weight on positives."""
    return grown(spark, sf, LEVELWISE)


@query("mod5_leafwise_trees", trees_sql(LEAFWISE))
def mod5_leafwise_trees(spark, sf):
    """Best-first growth to three leaves, with a minimum of rows and an L2 penalty."""
    return grown(spark, sf, LEAFWISE)


@query("mod7_symmetric_trees", trees_sql(SYMMETRIC))
def mod7_symmetric_trees(spark, sf):
    """One split for all nodes of a level."""
    return grown(spark, sf, SYMMETRIC)


_BEFORE = ", ".join(
    f"round((coalesce(sum(Y) over (partition by {c} order by md5(cast(row_id as varchar) || ':42'), row_id rows between unbounded preceding and 1 preceding), 0) + prior)"
    f" / (count(*) over (partition by {c} order by md5(cast(row_id as varchar) || ':42'), row_id rows between unbounded preceding and 1 preceding) + 1), 9) as target_{c}"
    for c in CATEGORICAL
)


@query(
    "mod7_target_statistics",
    with_panel(f"select row_id, {_BEFORE} from (select *, avg(Y) over () as prior from split_table where split = 'train')", RANKED_SQL, SPLIT_SQL),
)
def mod7_target_statistics(spark, sf):
    """Running target mean of each nominal column, in hash order and without the row itself."""
    data = stage(sp.stratified_split(stage(panel(spark, sf), "panel")).where("split = 'train'"), "panel")
    names = {f"_target_{i}": f"target_{c}" for i, c in enumerate(CATEGORICAL)}
    return rounded(ordered_statistics(data, CATEGORICAL).withColumnsRenamed({"key": "row_id", **names}), 9)
