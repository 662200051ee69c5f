"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import pytest

from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def _names():
    from __spark_entry__ import oracle_sql
    return list(oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    from billing_guard.oracle import oracle_queries

    from __spark_entry__ import _training_data_queries, oracle_sql, queries
    assert set(queries()) - set(_training_data_queries()) == set(oracle_queries())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, SF)
    assert res["columns_match"], res
    assert res["rows_match"], res
    assert res["values_match"], res


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert len(df.columns) == 34
    assert df.count() > 0


_DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
               "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", _names())
def test_result_types_match_oracle(spark, con, name):
    from __spark_entry__ import oracle_sql, queries
    spark_types = {f.name: f.dataType.simpleString()
                   for f in queries()[name](spark, SF).schema.fields}
    cur = con.execute(f"SELECT * FROM ({oracle_sql()[name]}) LIMIT 0")
    duck_types = {d[0]: str(d[1]).upper() for d in cur.description}
    for col, t in spark_types.items():
        assert duck_types[col] == _DUCK_TYPES.get(t, t.upper()), (name, col, t, duck_types[col])
