"""Row-wise feature groups. Projection only: no operator here shuffles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from riskweft.functions import rowmath as m
from riskweft.operators.projection import require_contract
from riskweft.sources.contract import BILL, DELAY, PAYMENT, ROW_ID

# Group names and the named group combinations.
BEHAVIOUR_GROUPS = ("round1", "pay", "bill", "payment", "ratios", "trends")
TRAJECTORY_GROUPS = ("pay_trajectory", "bill_payment_trajectory", "shortfall_coverage", "utilization_interactions")
EXPERIMENTS = {
    "exp_r2_0": ("round1",),
    "exp_r2_1": ("round1", "pay"),
    "exp_r2_2": ("round1", "bill", "payment"),
    "exp_r2_3": ("round1", "ratios"),
    "exp_r2_4": ("round1", "trends"),
    "exp_r2_5": BEHAVIOUR_GROUPS,
}
FOCUSED_EXPERIMENTS = {
    "baseline": ("round1",),
    "bill_payment": ("round1", "bill", "payment"),
    "all_engineered": BEHAVIOUR_GROUPS,
}
ABLATIONS = {
    "A0": ("round1",),
    "A1": ("round1", "bill"),
    "A2": ("round1", "payment"),
    "A3": ("round1", "bill", "payment"),
}
TEMPORAL_SETS = {
    "T0_A3": (),
    "T1_PAY": ("pay_trajectory",),
    "T2_BILL_PAYMENT": ("bill_payment_trajectory",),
    "T3_SHORTFALL": ("shortfall_coverage", "utilization_interactions"),
    "T4_ALL": TRAJECTORY_GROUPS,
}


def _cells(prefix: str) -> list[str]:
    return [f"_{prefix}{i}" for i in range(6)]


def _abs(cell: str) -> str:
    return f"abs({cell})"


def _each(cells: Sequence[str], test: str) -> list[str]:
    return [f"{c} {test}" for c in cells]


def _carried(df: DataFrame, carry: Sequence[str] | None) -> list[str]:
    kept = [c for c in ((ROW_ID,) if carry is None else carry) if c in df.columns]
    require_contract([c for c in df.columns if c not in kept])
    return kept


def _with_cells(df: DataFrame, fill: bool) -> DataFrame:
    """Add numeric working columns _p (delay), _b (bill), _a (payment) and _l (limit)."""
    types = {f.name: f.dataType for f in df.schema.fields}

    def cell(name: str) -> str:
        value = m.number(name, types[name])
        return f"coalesce({value}, 0D)" if fill else value

    blocks = (("p", DELAY), ("b", BILL), ("a", PAYMENT))
    work = [f"{cell(name)} as _{tag}{i}" for tag, block in blocks for i, name in enumerate(block)]
    return df.selectExpr("*", *work, f"abs({cell('X1')}) as _l")


def _with_ratios(df: DataFrame) -> DataFrame:
    """Add _u (bill over limit) and _c (payment over bill) for every month."""
    p, b, a = _cells("p"), _cells("b"), _cells("a")
    return df.selectExpr(
        "*", *[f"{m.safe_ratio(b[i], '_l')} as _u{i}" for i in range(6)], *[f"{m.safe_ratio(a[i], _abs(b[i]))} as _c{i}" for i in range(6)]
    )


def _with_row_stats(df: DataFrame) -> DataFrame:
    """Shared intermediates, each computed once: row means, deviations, late and severe flags."""
    p = _cells("p")
    df = df.selectExpr(
        "*", f"cast({m.count_true(_each(p, '> 0'))} as double) as _late", f"cast({m.any_true(_each(p, '>= 3'))} as double) as _severe",
        *[f"{m.row_mean(_cells(t))} as _mean_{t}" for t in "pbau"],
    )
    return df.selectExpr("*", *[f"{m.row_std(_cells(t), f'_mean_{t}')} as _std_{t}" for t in "pbau"])


def _behaviour_columns(group: str) -> dict[str, str]:
    p, b, a, u, c = (_cells(t) for t in "pbauc")
    if group == "round1":
        return {
            "count_pay_delay_gt0": "_late",
            "max_pay_delay": m.largest(p),
            "recent_pay_delay": p[0],
            "mean_pay_delay": "_mean_p",
            "pay_delay_trend": m.slope(p),
            "avg_bill_amt": "_mean_b",
            "max_bill_amt": m.largest(b),
            "min_bill_amt": m.smallest(b),
            "bill_std": "_std_b",
            "bill_growth": f"{b[0]} - {b[5]}",
            "avg_pay_amt": "_mean_a",
            "max_pay_amt": m.largest(a),
            "pay_std": "_std_a",
            "pay_to_bill_ratio": m.safe_ratio("_mean_a", "abs(_mean_b)"),
            "utilization_proxy": m.safe_ratio("_mean_b", "_l"),
        }
    if group == "pay":
        return {
            "pay_delay_count": "_late",
            "pay_delay_max": m.largest(p),
            "pay_delay_mean": "_mean_p",
            "pay_delay_std": "_std_p",
            "pay_recent_delay": p[0],
            "pay_recent_3m_mean": m.row_mean(p[:3]),
            "pay_old_3m_mean": m.row_mean(p[3:]),
            "pay_delay_trend_v2": m.slope(p),
            "pay_consecutive_delay": m.longest_run(_each(p, "> 0")),
            "pay_any_severe_delay": "_severe",
        }
    if group == "bill":
        return {
            "bill_mean": "_mean_b",
            "bill_median": m.row_median(b),
            "bill_max": m.largest(b),
            "bill_min": m.smallest(b),
            "bill_std_v2": "_std_b",
            "bill_range": f"{m.largest(b)} - {m.smallest(b)}",
            "bill_recent": b[0],
            "bill_recent_3m_mean": m.row_mean(b[:3]),
            "bill_previous_3m_mean": m.row_mean(b[3:]),
            "bill_trend": m.slope(b),
            "bill_change_recent": f"{b[0]} - {b[1]}",
            "bill_growth_ratio": m.safe_ratio(f"{b[0]} - {b[5]}", _abs(b[5])),
            "bill_cv": m.safe_ratio("_std_b", "abs(_mean_b)"),
        }
    if group == "payment":
        return {
            "payment_mean": "_mean_a",
            "payment_median": m.row_median(a),
            "payment_max": m.largest(a),
            "payment_min": m.smallest(a),
            "payment_std_v2": "_std_a",
            "payment_total": m.row_sum(a),
            "payment_recent": a[0],
            "payment_recent_3m_mean": m.row_mean(a[:3]),
            "payment_trend": m.slope(a),
            "payment_change_recent": f"{a[0]} - {a[1]}",
            "payment_cv": m.safe_ratio("_std_a", "abs(_mean_a)"),
        }
    if group == "ratios":
        monthly = {}
        for i in range(6):
            monthly[f"payment_to_bill_ratio_m{i + 1}"] = c[i]
            monthly[f"utilization_m{i + 1}"] = u[i]
        return {
            **monthly,
            "payment_to_bill_ratio_mean": m.row_mean(c),
            "payment_to_bill_ratio_min": m.smallest(c),
            "payment_to_bill_ratio_recent": c[0],
            "utilization_mean": "_mean_u",
            "utilization_max": m.largest(u),
            "utilization_recent": u[0],
            "utilization_trend": m.slope(u),
            "utilization_cv": m.safe_ratio("_std_u", "abs(_mean_u)"),
        }
    if group == "trends":
        return {
            "bill_slope": m.slope(b),
            "payment_slope": m.slope(a),
            "utilization_slope": m.slope(u),
            "delay_slope": m.slope(p),
            "payment_consistency": f"1D - greatest({m.safe_ratio('_std_a', 'abs(_mean_a)')}, 0D)",
            "bill_volatility": "_std_b",
            "payment_volatility": "_std_a",
            "delay_utilization_interaction": f"{p[0]} * {u[0]}",
            "delay_payment_ratio_interaction": f"{p[0]} * {c[0]}",
            "delay_count_utilization_interaction": "_late * _mean_u",
            "severe_delay_low_payment_interaction": f"_severe * (1D - least({c[0]}, 1D))",
        }
    raise ValueError(f"unknown feature group {group!r}")


def behaviour_names(groups: Sequence[str] = BEHAVIOUR_GROUPS) -> list[str]:
    return [name for g in BEHAVIOUR_GROUPS if g in groups for name in _behaviour_columns(g)]


def trajectory_names(groups: Sequence[str] = TRAJECTORY_GROUPS) -> list[str]:
    return [name for g in TRAJECTORY_GROUPS if g in groups for name in _trajectory_columns(g, groups)]


def _chosen(known: Sequence[str], groups: Sequence[str] | None) -> tuple[str, ...]:
    unknown = [g for g in groups or () if g not in known]
    if unknown:
        raise ValueError(f"unknown feature groups: {unknown}")
    return tuple(known) if groups is None else tuple(g for g in known if g in groups)


def _finished(work: DataFrame, source: DataFrame, kept: Sequence[str], built: dict[str, str]) -> DataFrame:
    """Kept columns, cleaned raw columns, cleaned new columns; the working columns end here."""
    raw = [c for c in source.columns if c not in kept]
    types = {f.name: f.dataType for f in source.schema.fields}
    types.update({n: T.LongType() if n in TRAJECTORY_COUNTS else T.DoubleType() for n in built})
    features = work.selectExpr(*kept, *raw, *[f"cast({text} as {types[n].simpleString()}) as {n}" for n, text in built.items()])
    return features.selectExpr(*kept, *[f"{m.finite_or_zero(c, types[c])} as {c}" for c in [*raw, *built]])


def behavioral_features(df: DataFrame, groups: Sequence[str] | None = None, carry: Sequence[str] | None = None) -> DataFrame:
    """Raw columns plus the enabled behaviour groups; every null, NaN and infinity ends as 0.

    The label is refused unless it is named in carry; carried columns pass
    through untouched and are never an input.
    """
    kept = _carried(df, carry)
    built = {n: c for g in _chosen(BEHAVIOUR_GROUPS, groups) for n, c in _behaviour_columns(g).items()}
    return _finished(_with_row_stats(_with_ratios(_with_cells(df, fill=False))), df, kept, built)


def engineer_features(df: DataFrame, carry: Sequence[str] | None = None) -> DataFrame:
    return behavioral_features(df, None, carry)


def _trajectory_columns(group: str, enabled: Sequence[str]) -> dict[str, str]:
    p, b, a, u, c = (_cells(t) for t in "pbauc")
    dp, db, da, du, dc = (m.steps(v) for v in (p, b, a, u, c))

    def rises(d: Sequence[str]) -> str:
        return m.count_true(_each(d, "> 0"))

    def falls(d: Sequence[str]) -> str:
        return m.count_true(_each(d, "< 0"))

    def turns(d: Sequence[str]) -> str:
        signs = [f"sign({x})" for x in d]
        return m.count_true([f"{x} <> {y}" for x, y in zip(signs, signs[1:])])

    if group == "pay_trajectory":
        return {
            "delay_worsening_count": rises(dp),
            "delay_improving_count": falls(dp),
            "delay_stable_count": m.count_true(_each(dp, "= 0")),
            "delay_transition_count": turns(dp),
            "delay_recent_vs_old": m.recent_minus_old(p),
            "delay_acceleration": m.mean_second_difference(p),
            "delay_recovery_count": falls(dp),
            "months_since_last_delay": m.first_position(_each(p, "<= 0")),
            "months_since_last_severe_delay": m.first_position(_each(p, "< 3")),
            "longest_delay_streak": m.longest_run(_each(p, "> 0")),
            "longest_no_delay_streak": m.longest_run(_each(p, "<= 0")),
            "recent_weighted_delay": m.recency_weighted(p),
            "delay_direction": f"sign({p[0]} - {p[5]})",
            "delay_slope": m.slope(p),
            "delay_curvature": m.mean_second_difference(p),
            "delay_recent_acceleration": f"({dp[0]} + {dp[1]}) / 2D - ({dp[3]} + {dp[4]}) / 2D",
        }
    if group == "bill_payment_trajectory":
        out: dict[str, str] = {}
        for name, v, d in (("bill", b, db), ("payment", a, da)):
            out.update({f"{name}_delta_{i + 1}": d[i] for i in range(5)})
            out.update({
                f"{name}_pct_change": m.safe_ratio(f"{v[0]} - {v[5]}", _abs(v[5])),
                f"{name}_slope_temporal": m.slope(v),
                f"{name}_acceleration": m.mean_second_difference(v),
                f"{name}_recent_vs_old": m.recent_minus_old(v),
                f"{name}_recency_weighted_mean": m.recency_weighted(v),
                f"{name}_increase_count": rises(d),
                f"{name}_decrease_count": falls(d),
            })
        # The first month has no predecessor and always counts as a change of direction.
        out["bill_direction_changes"] = f"1 + {turns(db)}"
        out["bill_monotonic_increase_count"] = rises(db)
        out["bill_monotonic_decrease_count"] = falls(db)
        out["payment_recovery_count"] = rises(da)
        return out
    if group == "shortfall_coverage":
        s = [f"({x} - {y})" for x, y in zip(b, a)]
        return {
            "shortfall_mean": m.row_mean(s),
            "shortfall_recent": s[0],
            "shortfall_max": m.largest(s),
            "shortfall_slope": m.slope(s),
            "shortfall_acceleration": m.mean_second_difference(s),
            "shortfall_positive_count": m.count_true(_each(s, "> 0")),
            "shortfall_streak": m.longest_run(_each(s, "> 0")),
            "recent_shortfall_ratio": m.safe_ratio(s[0], _abs(b[0])),
            "coverage_mean": m.row_mean(c),
            "coverage_recent": c[0],
            "coverage_min": m.smallest(c),
            "coverage_slope": m.slope(c),
            "coverage_acceleration": m.mean_second_difference(c),
            "low_coverage_count": m.count_true(_each(c, "< 0.5D")),
            "low_coverage_streak": m.longest_run(_each(c, "< 0.5D")),
            "coverage_recovery_count": rises(dc),
        }
    if group == "utilization_interactions":
        # Uses the worsening count only when that group is built too, else the number of late months.
        weight = rises(dp) if "pay_trajectory" in enabled else m.count_true(_each(p, "> 0"))
        return {
            "utilization_recent_temporal": u[0],
            "utilization_mean_temporal": m.row_mean(u),
            "utilization_slope_temporal": m.slope(u),
            "utilization_acceleration": m.mean_second_difference(u),
            "high_utilization_count": m.count_true(_each(u, "> 0.75D")),
            "utilization_increase_streak": m.longest_run(_each(du, "> 0")),
            "delay_worsening_utilization_increase": f"{weight} * {rises(du)}",
            "delay_worsening_low_coverage": f"{weight} * (1D - least({u[0]}, 1D))",
            "recent_delay_shortfall": f"{p[0]} * ({b[0]} - {a[0]})",
            "delay_recovery_payment_recovery": f"{falls(dp)} * {rises(da)}",
        }
    raise ValueError(f"unknown trajectory group {group!r}")


# Integer-valued trajectory columns; the rest are doubles.
TRAJECTORY_COUNTS = {
    "delay_worsening_count", "delay_improving_count", "delay_stable_count", "delay_transition_count",
    "delay_recovery_count", "months_since_last_delay", "months_since_last_severe_delay",
    "bill_increase_count", "bill_decrease_count", "bill_direction_changes", "bill_monotonic_increase_count",
    "bill_monotonic_decrease_count", "payment_increase_count", "payment_decrease_count", "payment_recovery_count",
    "shortfall_positive_count", "low_coverage_count", "coverage_recovery_count", "high_utilization_count",
    "delay_worsening_utilization_increase", "delay_recovery_payment_recovery",
}


def trajectory_features(df: DataFrame, groups: Sequence[str] | None = None, carry: Sequence[str] | None = None) -> DataFrame:
    """Raw columns plus the enabled trajectory groups. Null cells count as 0 before any formula."""
    kept = _carried(df, carry)
    wanted = _chosen(TRAJECTORY_GROUPS, groups)
    built = {n: c for g in wanted for n, c in _trajectory_columns(g, wanted).items()}
    return _finished(_with_ratios(_with_cells(df, fill=True)), df, kept, built)


def feature_set(df: DataFrame, behaviour: Sequence[str] = ABLATIONS["A3"], trajectory: Sequence[str] = (), carry: Sequence[str] | None = None) -> DataFrame:
    """Behaviour groups, then those trajectory columns that do not exist yet, in one projection chain."""
    kept = _carried(df, carry)
    raw = [c for c in df.columns if c not in kept]
    if not trajectory:
        return behavioral_features(df, behaviour, kept)
    # Both builders read the untouched inputs, which ride along under _in_ names, and
    # everything stays one projection chain over the same rows: no join of feature tables.
    inputs = [f"_in_{c}" for c in raw]
    base = behavioral_features(df.select("*", *[F.col(c).alias(f"_in_{c}") for c in raw]), behaviour, [*kept, *inputs])
    made = [c for c in base.columns if c not in kept and c not in inputs and c not in raw]
    step = base.select(
        *kept, *[F.col(c).alias(f"_f_{c}") for c in made], *[F.col(f"_in_{c}").alias(c) for c in raw]
    )
    merged = trajectory_features(step, trajectory, [*kept, *[f"_f_{c}" for c in made]])
    new = [c for c in merged.columns if c not in step.columns and c not in made]
    return merged.select(*kept, *raw, *[F.col(f"_f_{c}").alias(c) for c in made], *new)
