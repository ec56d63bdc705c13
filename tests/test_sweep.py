from pyspark.sql import functions as F

from stratagrid.operators import stats
from stratagrid.queries import QUERIES
from stratagrid.streaming import sweep

from .conftest import rows_of

PX = "h3_cell long, elev double"


def test_running_stats_keep_rows_off_the_driver(spark, sf_dir):
    """A memory sink, which collects every batch, leaves a view with its rows on the driver."""
    before = {t.name for t in spark.catalog.listTables()}
    own = QUERIES["running_stats"](spark, sf_dir)
    assert {t.name for t in spark.catalog.listTables()} == before
    assert own.count() == QUERIES["partial_res9"](spark, sf_dir).count()


def test_kept_stats_go_on(spark, tmp_path):
    """Of a stream without files; of files that come in two runs, with nulls and NaN; settings are as they were."""
    source, at = f"{tmp_path}/in", f"file://{tmp_path}/at"
    (tmp_path / "in").mkdir()
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)

    def run():
        return sweep.kept_stats(spark.readStream.schema(PX).option("maxFilesPerTrigger", 1).parquet(source), at, "h3_cell")

    assert run().collect() == [] and run().columns == ["h3_cell", *stats.STATES]
    given = []
    for new in ([(1, 2.0), (1, 4.0), (None, 3.0), (2, None)], [(1, -1.5), (2, 7.0), (3, float("nan")), (None, 1.0)]):
        given += new
        spark.createDataFrame(new, PX).repartition(2).write.mode("append").parquet(source)
        own = run()
        want = stats.partial(spark.createDataFrame(given, PX), "h3_cell")
        assert str(rows_of(own)) == str(rows_of(want)) and own.select(F.sum("count")).first()[0] == sum(e is not None for _, e in given)
    assert spark.conf.get(key) == before
