"""Registered queries on the smallest tables, beside DuckDB where SQL can say it."""

import os

import pytest

import __spark_entry__ as entry_module
import corpus_pipeline
from riskweft.llm.queries import ORACLE, QUERIES
from verify import compare, oracle_connection

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_oracle(spark, name):
    ok, note = compare(spark, oracle_connection(SF), SF, name, QUERIES[name], ORACLE[name])
    assert ok, note


def test_all_and_the_pipeline_are_registered():
    names = set(entry_module.queries())
    assert {n.split("_")[0] for n in names if n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5


def test_native_operators_run_no_python(spark):
    for name in ("op3_line_dedup", "op7_chat_formatting", "op10_mixing"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not [x for x in ("Python", "Pandas", "Arrow") if x in plan], name
