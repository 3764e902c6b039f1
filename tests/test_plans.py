"""Plan shapes that every batch query must keep."""

import pytest

import __spark_entry__ as entry_module
from tests.conftest import plan_of

OTHERS = entry_module._LLM.queries() if entry_module._LLM else {}
BATCH = sorted(n for n in entry_module.queries() if not n.startswith("live_") and n not in OTHERS)
PYTHON = ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas")


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python(name, spark, sf_dir):
    plan = plan_of(entry_module.queries()[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", *PYTHON):
        assert operator not in plan
    assert "SinglePartition" not in plan
