"""The sorted table against a dictionary."""

import numpy as np
import pytest

from stratagrid.llm import common


@pytest.mark.parametrize("segment", [1, 7, 1 << 20])
def test_sorted_table(spark, monkeypatch, segment):
    monkeypatch.setattr(common, "SEGMENT", segment)
    rng = np.random.default_rng(segment)
    keys = np.unique(rng.integers(0, 1 << 64, 300, dtype=np.uint64))
    rows = [(int(k.astype(np.int64)), i, i % 5, b"x" * (i % 4) + str(i).encode()) for i, k in enumerate(keys)]
    rows += [(rows[10][0], 1000 + i, 7, f"same {i}".encode()) for i in range(9)]  # one hash, told apart by second
    df = spark.createDataFrame(rows, "h long, second long, v long, t binary").repartition(4)
    table = common.write_sorted_table(df, "test", ("second", "v"), ("t",))
    asked = [(h, s) for h, s, _, _ in rows] + [(rows[0][0], 99), (5, 5), (rows[10][0], 2000), (-1, 0)]
    asked += asked[:5]
    h = np.array([a for a, _ in asked], dtype=np.int64).view(np.uint64)
    hit, value = table.find(h, np.array([s for _, s in asked]))
    want = {(h, s): (v, t) for h, s, v, t in rows}
    for i, a in enumerate(asked):
        assert hit[i] == (a in want)
        assert not hit[i] or (value["v"][i], value["t"][i], value["second"][i]) == (*want[a], a[1])
    hit, _ = table.find(h)
    assert hit.tolist() == [a in {x for x, *_ in rows} for a, _ in asked]
    assert table.find(np.zeros(0, np.uint64))[0].tolist() == []


def test_an_empty_table(spark):
    table = common.write_sorted_table(spark.createDataFrame([], "h long, second long"), "test", ("second",))
    hit, value = table.find(np.array([1, 1 << 63], dtype=np.uint64), np.array([0, 0]))
    assert hit.tolist() == [False, False] and value["second"].tolist() == [0, 0]


def test_folds(spark):
    n = common.shuffle_partitions(spark)
    assert 1 << common.fold(spark) >= n > 1 << common.fold(spark) - 1
    assert 1 << common.fold(spark, 10_000 * n, 10) >= 1000 * n


def test_several_buckets_a_task(spark, monkeypatch):
    monkeypatch.setattr(common, "MOST_TASKS", 4)
    df = spark.createDataFrame([(int(h),) for h in np.random.default_rng(0).integers(-(1 << 63), 1 << 63, 500)], "h long")
    table = common.write_sorted_table(df, "test")
    hit, _ = table.find(np.array([r["h"] for r in df.collect()], dtype=np.int64).view(np.uint64))
    assert hit.all()


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Session:
        class sparkContext:  # noqa: N801
            master = "spark://host:7077"
            getConf = staticmethod(lambda: {})  # noqa: N815

        conf = {}

    with pytest.raises(RuntimeError, match=r"spark\.checkpoint\.dir"):
        common.shared_root(Session)
