"""Feature-group queries and their SQL oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskweft.operators import features as fe
from riskweft.queries.registry import query
from riskweft.sources.contract import FEATURES
from riskweft.sources.panel import panel, with_panel

DIGITS = 6


def rounded(df: DataFrame, digits: int = DIGITS, skip: tuple = ()) -> DataFrame:
    """Doubles rounded for comparison; other types as they are."""
    doubles = {f.name for f in df.schema.fields if f.dataType.simpleString() == "double" and f.name not in skip}
    # Adding 0.0 turns a negative zero into a plain one.
    return df.select(*[(F.round(c, digits) + 0.0).alias(c) if c in doubles else F.col(c) for c in df.columns])


# --- oracle text: cells p, b, a and limit l; ratios u and c; row statistics -------------------------


def _sum(values):
    return "(" + " + ".join(values) + ")"


def _cells(tag):
    return [f"{tag}{i}" for i in range(6)]


def _mean(values):
    return f"({_sum(values)} / {len(values)}.0)"


def _std(values, mean):
    return f"sqrt({_sum([f'({v}-{mean})*({v}-{mean})' for v in values])} / {len(values)}.0)"


def _slope(values):
    return f"({_sum([f'{v}*({i - 2.5})' for i, v in enumerate(values)])} / 17.5)"


def _ratio(n, d):
    return f"(case when abs({d}) > 1e-12 then ({n}) / ({d}) else 0.0 end)"


def _count(conditions):
    return _sum([f"(case when {c} then 1 else 0 end)" for c in conditions])


def _run(conditions):
    """Longest run of true by counting, for each length, whether any window is all true."""
    n = len(conditions)
    tests = []
    for length in range(n, 0, -1):
        windows = [" and ".join(f"({c})" for c in conditions[i:i + length]) for i in range(n - length + 1)]
        tests.append("when " + " or ".join(f"({w})" for w in windows) + f" then {length}")
    return "(case " + " ".join(tests) + " else 0 end)"


def _first(conditions):
    return "(case " + " ".join(f"when {c} then {i}" for i, c in enumerate(conditions)) + f" else {len(conditions)} end)"


def _steps(values):
    return [f"({b}-{a})" for a, b in zip(values, values[1:])]


def _accel(values):
    d = _steps(values)
    return f"(({d[-1]} - {d[0]}) / 4.0)"


def _rvo(values):
    return f"({_sum(values[:3])}/3.0 - {_sum(values[3:])}/3.0)"


def _rw(values):
    return f"({_sum([f'{v}*{6 - i}.0' for i, v in enumerate(values)])} / 21.0)"


P, B, A, U, C = (_cells(t) for t in "pbauc")
CELLS_SQL = (
    "cells as (select *, "
    + ", ".join(f"cast(X{6 + i} as double) as p{i}, X{12 + i} as b{i}, X{18 + i} as a{i}" for i in range(6))
    + ", abs(X1) as l from panel)"
)
RATIOS_SQL = (
    "ratios as (select *, "
    + ", ".join(f"{_ratio(f'b{i}', 'l')} as u{i}, {_ratio(f'a{i}', f'abs(b{i})')} as c{i}" for i in range(6))
    + " from cells)"
)
STATS_SQL = (
    "means as (select *, "
    + ", ".join(f"{_mean(_cells(t))} as mean_{t}" for t in "pbau")
    + " from ratios),\nstats as (select *, "
    + ", ".join(f"{_std(_cells(t), f'mean_{t}')} as std_{t}" for t in "pbau")
    + f", cast({_count([f'{x} > 0' for x in P])} as double) as late"
    + ", cast(case when " + " or ".join(f"{x} >= 3" for x in P) + " then 1 else 0 end as double) as severe from means)"
)


def _median(tag):
    values = ", ".join(_cells(tag))
    return f"((list_sort([{values}]))[3] + (list_sort([{values}]))[4]) / 2.0"


BEHAVIOUR_SQL = {
    "round1": {
        "count_pay_delay_gt0": "late", "max_pay_delay": f"greatest({', '.join(P)})", "recent_pay_delay": "p0",
        "mean_pay_delay": "mean_p", "pay_delay_trend": _slope(P), "avg_bill_amt": "mean_b",
        "max_bill_amt": f"greatest({', '.join(B)})", "min_bill_amt": f"least({', '.join(B)})", "bill_std": "std_b",
        "bill_growth": "b0 - b5", "avg_pay_amt": "mean_a", "max_pay_amt": f"greatest({', '.join(A)})", "pay_std": "std_a",
        "pay_to_bill_ratio": _ratio("mean_a", "abs(mean_b)"), "utilization_proxy": _ratio("mean_b", "l"),
    },
    "pay": {
        "pay_delay_count": "late", "pay_delay_max": f"greatest({', '.join(P)})", "pay_delay_mean": "mean_p",
        "pay_delay_std": "std_p", "pay_recent_delay": "p0", "pay_recent_3m_mean": _mean(P[:3]),
        "pay_old_3m_mean": _mean(P[3:]), "pay_delay_trend_v2": _slope(P),
        "pay_consecutive_delay": f"cast({_run([f'{x} > 0' for x in P])} as double)", "pay_any_severe_delay": "severe",
    },
    "bill": {
        "bill_mean": "mean_b", "bill_median": _median("b"), "bill_max": f"greatest({', '.join(B)})",
        "bill_min": f"least({', '.join(B)})", "bill_std_v2": "std_b",
        "bill_range": f"greatest({', '.join(B)}) - least({', '.join(B)})", "bill_recent": "b0",
        "bill_recent_3m_mean": _mean(B[:3]), "bill_previous_3m_mean": _mean(B[3:]), "bill_trend": _slope(B),
        "bill_change_recent": "b0 - b1", "bill_growth_ratio": _ratio("b0 - b5", "abs(b5)"),
        "bill_cv": _ratio("std_b", "abs(mean_b)"),
    },
    "payment": {
        "payment_mean": "mean_a", "payment_median": _median("a"), "payment_max": f"greatest({', '.join(A)})",
        "payment_min": f"least({', '.join(A)})", "payment_std_v2": "std_a", "payment_total": _sum(A),
        "payment_recent": "a0", "payment_recent_3m_mean": _mean(A[:3]), "payment_trend": _slope(A),
        "payment_change_recent": "a0 - a1", "payment_cv": _ratio("std_a", "abs(mean_a)"),
    },
    "ratios": {
        **{f"payment_to_bill_ratio_m{i + 1}": f"c{i}" for i in range(6)},
        "payment_to_bill_ratio_mean": _mean(C), "payment_to_bill_ratio_min": f"least({', '.join(C)})",
        "payment_to_bill_ratio_recent": "c0",
        **{f"utilization_m{i + 1}": f"u{i}" for i in range(6)},
        "utilization_mean": "mean_u", "utilization_max": f"greatest({', '.join(U)})", "utilization_recent": "u0",
        "utilization_trend": _slope(U), "utilization_cv": _ratio("std_u", "abs(mean_u)"),
    },
    "trends": {
        "bill_slope": _slope(B), "payment_slope": _slope(A), "utilization_slope": _slope(U), "delay_slope": _slope(P),
        "payment_consistency": f"1.0 - greatest({_ratio('std_a', 'abs(mean_a)')}, 0.0)", "bill_volatility": "std_b",
        "payment_volatility": "std_a", "delay_utilization_interaction": "p0 * u0",
        "delay_payment_ratio_interaction": "p0 * c0", "delay_count_utilization_interaction": "late * mean_u",
        "severe_delay_low_payment_interaction": "severe * (1.0 - least(c0, 1.0))",
    },
}


def _signs(values):
    return [f"sign({d})" for d in _steps(values)]


def _sign_changes(values):
    s = _signs(values)
    return _count([f"{x} <> {y}" for x, y in zip(s, s[1:])])


def _rises(values):
    return _count([f"{d} > 0" for d in _steps(values)])


def _falls(values):
    return _count([f"{d} < 0" for d in _steps(values)])


_S = [f"(b{i} - a{i})" for i in range(6)]


def _walk(name, v):
    return {
        **{f"{name}_delta_{i + 1}": d for i, d in enumerate(_steps(v))},
        f"{name}_pct_change": _ratio(f"{v[0]} - {v[5]}", f"abs({v[5]})"),
        f"{name}_slope_temporal": _slope(v), f"{name}_acceleration": _accel(v), f"{name}_recent_vs_old": _rvo(v),
        f"{name}_recency_weighted_mean": _rw(v), f"{name}_increase_count": _rises(v), f"{name}_decrease_count": _falls(v),
    }


def trajectory_sql(weight: str) -> dict:
    return {
        "pay_trajectory": {
            "delay_worsening_count": _rises(P), "delay_improving_count": _falls(P),
            "delay_stable_count": _count([f"{d} = 0" for d in _steps(P)]), "delay_transition_count": _sign_changes(P),
            "delay_recent_vs_old": _rvo(P), "delay_acceleration": _accel(P), "delay_recovery_count": _falls(P),
            "months_since_last_delay": _first([f"{x} <= 0" for x in P]),
            "months_since_last_severe_delay": _first([f"{x} < 3" for x in P]),
            "longest_delay_streak": _run([f"{x} > 0" for x in P]), "longest_no_delay_streak": _run([f"{x} <= 0" for x in P]),
            "recent_weighted_delay": _rw(P), "delay_direction": "sign(p0 - p5)", "delay_slope": _slope(P),
            "delay_curvature": _accel(P), "delay_recent_acceleration": "((p1-p0)+(p2-p1))/2.0 - ((p4-p3)+(p5-p4))/2.0",
        },
        "bill_payment_trajectory": {
            **_walk("bill", B), **_walk("payment", A),
            "bill_direction_changes": f"1 + {_sign_changes(B)}", "bill_monotonic_increase_count": _rises(B),
            "bill_monotonic_decrease_count": _falls(B), "payment_recovery_count": _rises(A),
        },
        "shortfall_coverage": {
            "shortfall_mean": _mean(_S), "shortfall_recent": _S[0], "shortfall_max": f"greatest({', '.join(_S)})",
            "shortfall_slope": _slope(_S), "shortfall_acceleration": _accel(_S),
            "shortfall_positive_count": _count([f"{s} > 0" for s in _S]), "shortfall_streak": _run([f"{s} > 0" for s in _S]),
            "recent_shortfall_ratio": _ratio(_S[0], "abs(b0)"), "coverage_mean": _mean(C), "coverage_recent": "c0",
            "coverage_min": f"least({', '.join(C)})", "coverage_slope": _slope(C), "coverage_acceleration": _accel(C),
            "low_coverage_count": _count([f"{x} < 0.5" for x in C]), "low_coverage_streak": _run([f"{x} < 0.5" for x in C]),
            "coverage_recovery_count": _rises(C),
        },
        "utilization_interactions": {
            "utilization_recent_temporal": "u0", "utilization_mean_temporal": _mean(U),
            "utilization_slope_temporal": _slope(U), "utilization_acceleration": _accel(U),
            "high_utilization_count": _count([f"{x} > 0.75" for x in U]),
            "utilization_increase_streak": _run([f"{d} > 0" for d in _steps(U)]),
            "delay_worsening_utilization_increase": f"{weight} * {_rises(U)}",
            "delay_worsening_low_coverage": f"{weight} * (1.0 - least(u0, 1.0))",
            "recent_delay_shortfall": "p0 * (b0 - a0)", "delay_recovery_payment_recovery": f"{_falls(P)} * {_rises(A)}",
        },
    }


LATE_WEIGHT = _count([f"{x} > 0" for x in P])


def select_sql(columns: dict, digits: int = DIGITS, raw: bool = False) -> str:
    """Final select of feature columns; raw adds the untouched inputs."""
    parts = ["row_id"]
    if raw:
        parts += [f"round({c}, {digits}) + 0.0 as {c}" if c == "X1" or int(c[1:]) >= 12 else c for c in FEATURES]
    for name, text in columns.items():
        if name in fe.TRAJECTORY_COUNTS:
            parts.append(f"cast({text} as bigint) as {name}")
        else:
            parts.append(f"round(cast({text} as double), {digits}) + 0.0 as {name}")
    return "select " + ", ".join(parts) + " from stats"


def features_oracle(columns: dict, raw: bool = False) -> str:
    return with_panel(select_sql(columns, raw=raw), CELLS_SQL, RATIOS_SQL, STATS_SQL)


def inputs(spark, sf):
    return panel(spark, sf).drop("Y")


def _register_behaviour(op: str, group: str) -> None:
    @query(f"{op}_{group}_features", features_oracle(BEHAVIOUR_SQL[group]))
    def run(spark, sf):
        out = fe.behavioral_features(inputs(spark, sf), [group])
        return rounded(out.drop(*FEATURES))


def _register_trajectory(op: str, group: str) -> None:
    @query(f"{op}_{group}", features_oracle(trajectory_sql(LATE_WEIGHT)[group]))
    def run(spark, sf):
        out = fe.trajectory_features(inputs(spark, sf), [group])
        return rounded(out.drop(*FEATURES))


for _i, _g in enumerate(("round1", "pay", "bill", "payment", "ratios", "trends"), start=1):
    _register_behaviour(f"fe{_i}", _g)
for _i, _g in enumerate(fe.TRAJECTORY_GROUPS, start=1):
    _register_trajectory(f"ft{_i}", _g)


def _merge(*groups: dict) -> dict:
    out: dict = {}
    for g in groups:
        for name, text in g.items():
            out.setdefault(name, text)
    return out


@query("fe7_named_set_a3", features_oracle(_merge(*[BEHAVIOUR_SQL[g] for g in ("round1", "bill", "payment")]), raw=True))
def fe7_named_set_a3(spark, sf):
    return rounded(fe.behavioral_features(inputs(spark, sf), fe.ABLATIONS["A3"]))


@query("fe7_all_groups", features_oracle(_merge(*BEHAVIOUR_SQL.values()), raw=True))
def fe7_all_groups(spark, sf):
    return rounded(fe.engineer_features(inputs(spark, sf)))


_ALL_TEMPORAL = trajectory_sql(_rises(P))


@query(
    "ft5_temporal_set_t4",
    features_oracle(_merge(*[BEHAVIOUR_SQL[g] for g in ("round1", "bill", "payment")], *_ALL_TEMPORAL.values()), raw=True),
)
def ft5_temporal_set_t4(spark, sf):
    return rounded(fe.feature_set(inputs(spark, sf), fe.ABLATIONS["A3"], fe.TEMPORAL_SETS["T4_ALL"]))


@query(
    "ft5_temporal_set_t1",
    features_oracle(_merge(*[BEHAVIOUR_SQL[g] for g in ("round1", "bill", "payment")], _ALL_TEMPORAL["pay_trajectory"]), raw=True),
)
def ft5_temporal_set_t1(spark, sf):
    return rounded(fe.feature_set(inputs(spark, sf), fe.ABLATIONS["A3"], fe.TEMPORAL_SETS["T1_PAY"]))
