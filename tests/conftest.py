import os

import pytest
from pyspark.sql import SparkSession

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "6g").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.sql.warehouse.dir", "/tmp/stratagrid-warehouse").getOrCreate()
    )
    s.sparkContext.setLogLevel("OFF")
    return s


@pytest.fixture(scope="session")
def sf_dir():
    path = f"{DATA}/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("no test tables")
    return path


@pytest.fixture(scope="session")
def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in os.listdir(sf_dir):
        con.sql(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{t}'")
    return con


def rows_of(df):
    """Rows as tuples in order of column names, sorted."""
    cols = sorted(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda r: tuple((x is not None, str(x)) for x in r))


def sql_rows(con, sql):
    out = con.sql(sql)
    at = [out.columns.index(c) for c in sorted(out.columns)]
    return sorted(out.columns), sorted((tuple(r[i] for i in at) for r in out.fetchall()), key=lambda r: tuple((x is not None, str(x)) for x in r))
