"""Every registered query against its SQL counterpart."""

import pytest

import __spark_entry__ as entry
from scenarios.compare import difference
from scenarios.oracles import ORACLES
from scenarios.queries import QUERIES


def test_every_query_has_an_oracle():
    assert len(QUERIES) == 100
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


PAIRWISE_OR_PYTHON = [
    "CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas",
]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(name, spark, sf_dir, duck):
    frame = entry.queries()[name](spark, sf_dir)
    assert difference(frame, duck, entry.oracle_sql()[name]) == ""
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert [operator for operator in PAIRWISE_OR_PYTHON if operator in plan] == []


def test_entry_is_the_flagship(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 6
    assert [r.sales_amount for r in rows] == sorted((r.sales_amount for r in rows), reverse=True)
