import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import FLAT, ROW0, ROW1, credit_frame
from riskweft.operators import features as fe
from riskweft.sources.contract import FEATURES


def rows(df):
    return [r.asDict() for r in df.orderBy("row_id").collect()]


def test_golden_values(spark):
    a, b = rows(fe.engineer_features(credit_frame(spark, [ROW0, ROW1])))
    assert a["count_pay_delay_gt0"] == 2 and a["recent_pay_delay"] == 2 and a["pay_to_bill_ratio"] > 0
    assert b["pay_to_bill_ratio"] == 0 and b["utilization_proxy"] == 0
    assert a["pay_consecutive_delay"] == 2 and a["pay_any_severe_delay"] == 0
    assert a["bill_median"] == 7500 and a["bill_growth_ratio"] == 1.0
    assert a["bill_trend"] == pytest.approx(-1000.0) and a["payment_total"] == 10750
    assert all(math.isfinite(v) for r in (a, b) for v in r.values())


def test_against_numpy(spark):
    rng = np.random.default_rng(7)
    data = rng.integers(-2, 9, size=(40, 23)).astype(float)
    data[:, 11:] *= 100.0
    out = rows(fe.engineer_features(credit_frame(spark, data.tolist())))
    for r, v in zip(out, data):
        p, b, a = v[5:11], v[11:17], v[17:23]
        assert r["bill_std"] == pytest.approx(b.std())
        assert r["payment_median"] == pytest.approx(np.median(a))
        assert r["pay_delay_trend"] == pytest.approx((p * (np.arange(6) - 2.5)).sum() / 17.5)
        run = best = 0
        for x in p > 0:
            run = run + 1 if x else 0
            best = max(best, run)
        assert r["pay_consecutive_delay"] == best


def test_nulls_are_skipped_then_zero(spark):
    row = list(ROW0)
    row[11] = None  # newest bill
    row[5] = None  # newest delay
    r = rows(fe.engineer_features(credit_frame(spark, [row])))[0]
    assert r["X12"] == 0 and r["bill_mean"] == 7000 and r["bill_median"] == 7000 and r["bill_max"] == 9000
    assert r["bill_trend"] == 0 and r["bill_change_recent"] == 0 and r["utilization_m1"] == 0
    assert r["pay_delay_mean"] == pytest.approx(0.2) and r["recent_pay_delay"] == 0 and r["delay_slope"] == 0


def test_trajectory_fills_nulls_first(spark):
    row = list(ROW0)
    row[5] = None
    r = rows(fe.trajectory_features(credit_frame(spark, [row])))[0]
    p = np.array([0, 1, 0, 0, 0, 0.0])
    assert r["delay_slope"] == pytest.approx((p * (np.arange(6) - 2.5)).sum() / 17.5)
    assert r["delay_worsening_count"] == 1 and r["delay_improving_count"] == 1 and r["delay_stable_count"] == 3


def test_trajectory_quirks(spark):
    r = rows(fe.trajectory_features(credit_frame(spark, [ROW0])))[0]
    assert r["bill_direction_changes"] == 1  # no real change, plus the first month
    assert r["months_since_last_delay"] == 2 and r["months_since_last_severe_delay"] == 0
    assert r["longest_delay_streak"] == 2 and r["longest_no_delay_streak"] == 4
    assert r["delay_curvature"] == r["delay_acceleration"]
    assert r["recent_delay_shortfall"] == 2 * 6000
    assert r["delay_worsening_low_coverage"] == 0  # no worsening step
    alone = rows(fe.trajectory_features(credit_frame(spark, [ROW0]), ["utilization_interactions"]))[0]
    assert alone["delay_worsening_low_coverage"] == pytest.approx(2 * 0.5)  # late months as weight, utilisation 0.5


def test_flat_and_zero_denominators(spark):
    zero = list(FLAT)
    zero[0] = zero[11] = zero[17] = 0
    out = rows(fe.trajectory_features(credit_frame(spark, [FLAT, zero])))
    assert len(out) == 2 and all(math.isfinite(v) for r in out for v in r.values())
    assert out[0]["bill_pct_change"] == 0 and out[0]["coverage_mean"] == pytest.approx(0.5)


def test_label_is_refused_unless_carried(spark):
    df = credit_frame(spark, [ROW0]).withColumn("Y", F.lit(1))
    with pytest.raises(ValueError, match="label"):
        fe.engineer_features(df)
    assert rows(fe.behavioral_features(df, ["round1"], ("row_id", "Y")))[0]["Y"] == 1
    with pytest.raises(ValueError, match="missing"):
        fe.engineer_features(df.drop("X5", "Y"))
    with pytest.raises(ValueError, match="unknown"):
        fe.behavioral_features(df.drop("Y"), ["nope"])


def test_named_sets(spark):
    df = credit_frame(spark, [ROW0])
    a3 = fe.behavioral_features(df, fe.ABLATIONS["A3"])
    assert len(a3.columns) == 1 + 62
    t1 = fe.feature_set(df, fe.ABLATIONS["A3"], fe.TEMPORAL_SETS["T1_PAY"])
    assert len(t1.columns) == 1 + 78
    groups = ("round1", "trends")
    both = fe.feature_set(df, groups, ("pay_trajectory",))
    assert both.columns.count("delay_slope") == 1
    assert len(fe.trajectory_features(df, ["bill_payment_trajectory"]).columns) == 1 + 23 + 28


def test_text_input_is_coerced(spark):
    df = credit_frame(spark, [ROW0])
    text = df.select("row_id", *[F.col(c).cast("string").alias(c) for c in FEATURES]).withColumn("X12", F.lit("n/a"))
    assert rows(fe.behavioral_features(text, ["bill"]))[0]["bill_mean"] == 7000
