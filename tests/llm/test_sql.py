"""Queries that SQL can express, against SQL."""

import pytest

from stratagrid.llm import queries

from ..conftest import rows_of, sql_rows


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_same_as_sql(spark, sf_dir, duck, name):
    df = queries.QUERIES[name](spark, sf_dir)
    cols, want = sql_rows(duck, queries.ORACLE_SQL[name])
    assert sorted(df.columns) == cols
    assert rows_of(df) == want
