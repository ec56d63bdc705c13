import numpy as np
import pytest

from stratagrid.llm import topk

VECTORS = "vec_id long, embedding array<float>, label int"


def by_hand(rows, k, asked):
    own = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            own.setdefault((i, tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)), None)
    out = []
    for q, a in own:
        if asked(q):
            found = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in own if i != q)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


def run(spark, rows, k=5, asked="vec_id % 3 = 0", **sizes):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)
    own = topk.integer_vectors(df, "vec_id", "embedding", 256)
    return sorted(tuple(r) for r in topk.top_k(own, own.filter(asked), k, **sizes).collect())


@pytest.mark.parametrize("sizes", [{}, {"shard_rows": 40, "block_rows": 7}])
def test_random(spark, sizes):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(30)]  # ties
    assert run(spark, rows, **sizes) == by_hand(rows, 5, lambda q: q % 3 == 0)


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, -0.001]), (3, None), (6, [1.0, None]), (9, [nan, 1.0]), (12, [inf, 1.0]), (None, [1.0, 1.0]), (1, [0.5]), (2, []), (4, [1.0, 2.0]), (4, [1.0, 2.0]), (-3, [-1.0, 0.25]), (5, [1e30, 0.0])]
    got = run(spark, rows)
    want = [(q, r, i, max(-(1 << 63), min((1 << 63) - 1, s))) for q, r, i, s in by_hand(rows, 5, lambda q: q % 3 == 0)]
    assert got == want


def test_fewer_than_k(spark):
    assert run(spark, [(0, [1.0])]) == []
    assert run(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 512 * 256)]
    assert run(spark, []) == []


def test_bounds_hold():
    rng = np.random.default_rng(1)
    v = np.floor(rng.normal(size=(3000, 16)) * 256)
    tree = topk.BallTree.build(v, np.arange(3000), leaf=50)
    q = np.floor(rng.normal(size=(20, 16)) * 256)
    bounds = tree.bounds(q)
    for node in range(len(tree.radius)):
        own = tree.vectors[tree.low[node] : tree.high[node]]
        assert ((q @ own.T).max(axis=1) <= bounds[:, node]).all()
    same = topk.BallTree.build(np.ones((1000, 4)), np.arange(1000)[::-1].copy(), leaf=10)
    assert [i for _, i in same.search(np.ones(4), 0, same.bounds(np.ones((1, 4)))[0], 3, -np.inf)] == [1, 2, 3]


def test_clashing_names(spark):
    rows = [(i, [float(i % 7), float(i % 5)]) for i in range(40)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).selectExpr("*", "1 AS v", "2 AS score", "3 AS shard", "4 AS query_id", "5 AS `rank`")
    own = topk.integer_vectors(df, "vec_id", "embedding", 256)
    assert sorted(tuple(r) for r in topk.top_k(own, own.filter("vec_id % 3 = 0"), 5).collect()) == by_hand(rows, 5, lambda q: q % 3 == 0)
