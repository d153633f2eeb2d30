"""Plan shape of every registered query (sf0.001, executed, final AQE plan)."""

import re

import pytest

import __spark_entry__ as entry
from arealens.plans.registry import QUERIES

SMOKE = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")
# widest input tables and how many of their columns a query may read
TABLE_WIDTH = {"lineitem": 11, "orders": 6, "customer": 5}  # no query needs all their columns


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_plan_shape(spark, key):
    df = entry.queries()[key](spark, SMOKE)
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(qe, "formatted")
    for bad in FORBIDDEN:
        assert bad not in plan, f"{key}: {bad}"
    # column pruning: no scan of a wide fact table reads all of its columns
    for loc, schema in re.findall(r"Location: \w+ \[file:[^\]]*/(\w+)\.parquet\][^\n]*\n(?:[^\n]*\n)*?ReadSchema: struct<([^>]*)>", plan):
        if loc in TABLE_WIDTH:
            assert schema.count(":") < TABLE_WIDTH[loc], f"{key}: full scan of {loc}"
