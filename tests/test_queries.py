"""Registered queries against DuckDB on the smallest tables, and what their plans may not contain."""

import os

import pytest

import __spark_entry__ as entry_module
from verify import compare, oracle_connection

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
CHECKED = [
    "src2_binary_label", "src4_check_manifest", "eda2_summary", "eda8_rate_by_category", "eda9_rate_by_bin", "eda10_inconsistent_values", "prj6_numeric_coercion",
    "fe7_all_groups", "ft5_temporal_set_t4", "pp7_transform_all_splits", "spl1_stratified_split", "spl4_stratified_folds_k5", "smp1_undersample", "smp2_oversample",
    "met7_threshold_table", "met9_best_threshold", "met11_tradeoff_summary", "dia1_error_contrast", "dia3_score_correlation", "dia6_score_overlap",
    "rnk5_rerank_macro_f1", "mod12_segment_decisions", "mon2_psi", "mon3_ks_distance", "mon6_persistent_alerts", "mon7_stream_quality",
]


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", CHECKED)
def test_against_oracle(spark, con, name):
    ok, note = compare(spark, con, SF, name, entry_module.queries()[name], entry_module.oracle_sql()[name])
    assert ok, note


def test_registry():
    queries, oracle = entry_module.queries(), entry_module.oracle_sql()
    assert set(oracle) <= set(queries) and len(queries) >= 150


def test_entry(spark):
    assert entry_module.entry(spark).count() == 3


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString(), df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["fe7_all_groups", "spl1_stratified_split", "met1_confusion_counts", "eda5_duplicate_summary", "mon1_quality_by_day"])
def test_plans_stay_distributed(spark, name):
    _, physical = plan(entry_module.queries()[name](spark, SF))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert banned not in physical


def test_only_needed_columns_are_read(spark):
    _, physical = plan(entry_module.queries()["fe2_pay_features"](spark, SF))
    line = next(s for s in physical.splitlines() if "lineitem.parquet" in s)
    assert "ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>" in line


def test_features_do_not_shuffle(spark):
    from riskweft.operators.features import feature_set
    from riskweft.session import stage
    from riskweft.sources.panel import panel

    base = stage(panel(spark, SF).drop("Y"))
    _, physical = plan(feature_set(base, ("round1", "bill", "payment"), ("pay_trajectory",)))
    assert "Exchange" not in physical
