"""Every query with an SQL counterpart gives the same schema and values in both engines."""

import pytest
from pyspark.sql.types import StringType

from checks.compare import compare
from checks.oracle import ORACLE_SQL
from checks.queries import QUERIES


def test_every_sql_text_has_a_query():
    assert set(ORACLE_SQL) <= set(QUERIES)


# a product of tables, or Python between the scan and the result
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas", "FlatMapGroups", "ArrowEvalPython")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(name, spark, db, folder):
    df = QUERIES[name](spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert [operator for operator in UNWANTED if operator in plan] == []
    assert compare(df, db, ORACLE_SQL[name]) == []


def test_fixture_has_the_declared_columns(readings):
    from skyledger.schema import readings_schema
    declared = readings_schema(record_id=StringType())
    assert [(f.name, f.dataType) for f in readings.schema] == [(f.name, f.dataType) for f in declared]


def test_entry_runs(spark):
    import __spark_entry__ as entry_module
    assert entry_module.entry(spark).count() > 0
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
