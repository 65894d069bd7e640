"""No registered query compares all pairs of rows or runs Python per row."""

import pytest

from tabloom.catalogue import registry

FOLDER = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_plan(spark, name):
    plan = registry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in FORBIDDEN if word in plan]


@pytest.mark.parametrize(
    "name, columns",
    [
        ("describe_numeric", ("l_returnflag", "l_shipdate")),
        ("table_shape", ("l_quantity",)),
        ("category_counts", ("o_totalprice", "o_custkey")),
        ("cap_runs", ("lang", "source")),
        ("html_words", ("url",)),
        ("roc_auc", ("o_custkey", "o_orderpriority")),
    ],
)
def test_scans_read_only_the_columns_used(spark, name, columns):
    plan = registry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    schemas = [line.split("ReadSchema:")[1] for line in plan.splitlines() if "ReadSchema:" in line]
    assert schemas and not [c for c in columns for s in schemas if c in s]
