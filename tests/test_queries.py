"""Every grid query against its SQL."""

import pytest

from stratagrid import queries

from .conftest import rows_of, sql_rows


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_as_sql(spark, sf_dir, duck, name):
    df = queries.QUERIES[name](spark, sf_dir)
    cols, want = sql_rows(duck, queries.SQL[name])
    assert sorted(df.columns) == cols
    assert rows_of(df) == want


def test_located_pixels_are_conserved(spark, sf_dir):
    out = queries.QUERIES["located_stats"](spark, sf_dir).groupBy("res").sum("pixel_count").collect()
    assert {r[1] for r in out} == {6000} and len(out) == 8


def test_entry(spark):
    import __spark_entry__

    assert set(queries.QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
