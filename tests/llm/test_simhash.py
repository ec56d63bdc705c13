import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from stratagrid.llm import simhash


def slow_fingerprint(text):
    w = (text or "").encode().translate(simhash.C.LOWER).split()
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(fps, radius):
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    a = np.array(fps, dtype=np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(a[:i] ^ a[i]) <= radius):
            parent[root(i)] = root(int(j))
    return [root(i) for i in range(len(fps))]


def same_partition(a, b):
    return len(set(a)) == len(set(b)) == len(set(zip(a, b, strict=True)))


def test_fingerprint():
    rng = random.Random(0)
    for n in (0, 1, 2, 3, 4, 50, 700):
        text = " ".join(rng.choice(["The", "a", "été", "x1", "\tÉ"]) for _ in range(n))
        assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_hash_is_sparks(spark):
    t = "some three words"
    assert spark.range(1).select(F.xxhash64(F.lit(t))).first()[0] & (1 << 64) - 1 == xxhash.xxh64_intdigest(t, 42)


def clusters(n, seed=0):
    rng, out = random.Random(seed), []
    while len(out) < n:
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 8])):
            out.append(x)
            for _ in range(rng.choice([0, 1, 2, 3, 4])):
                x ^= 1 << rng.randrange(64)
    return list(dict.fromkeys(out))


def test_forest_keeps_components():
    keys = clusters(800)
    edges = simhash.shard_forest(keys, 3)
    assert len(edges) < len(keys)
    at = {k: i for i, k in enumerate(keys)}
    parent = list(range(len(keys)))
    for a, b in edges:
        x, y = at[a], at[b]
        while parent[x] != x:
            x = parent[x]
        while parent[y] != y:
            y = parent[y]
        parent[x] = y
    roots = []
    for i in range(len(keys)):
        while parent[i] != i:
            i = parent[i]
        roots.append(i)
    assert same_partition(roots, groups(keys, 3))


def components_of(spark, keys):
    signed = [k - (1 << 64) if k >> 63 else k for k in keys]
    df = spark.createDataFrame([(k,) for k in signed], "fp long")
    root = {r["node"]: r["root"] for r in simhash.components(simhash.links(df)).collect()}
    return [root.get(k, k) for k in signed]


def test_links_and_components(spark, monkeypatch):
    keys = clusters(1500, 1)
    want = groups(keys, 3)
    assert same_partition(components_of(spark, keys), want)
    monkeypatch.setattr(simhash, "SHARD_ROWS", 2)  # every shard is dealt anew
    assert same_partition(components_of(spark, keys), want)


def test_a_long_chain(spark):
    x, keys = random.Random(2).getrandbits(64), []
    for i in range(300):
        keys.append(x)
        x ^= 0b111 << (i * 3 % 61)
    keys = list(dict.fromkeys(keys))
    assert same_partition(components_of(spark, keys), groups(keys, 3))


def test_odd_rows(odd_docs):
    got = simhash.near_duplicates(odd_docs).collect()
    rows = [(r["doc_id"], slow_fingerprint(r["text"])) for r in odd_docs.collect()]
    roots = groups([f for _, f in rows], 3)
    least = {}
    for (d, _), r in zip(rows, roots, strict=True):
        if d is not None:
            least[r] = min(d, least.get(r, d))
    want = sorted((d or 0, f - (1 << 64) if f >> 63 else f, least.get(r) or 0) for (d, f), r in zip(rows, roots, strict=True))
    assert sorted((r["doc_id"] or 0, r["fp"], r["component_id"] or 0) for r in got) == want


def test_whole_table(spark, big_dir):
    docs = spark.read.parquet(f"{big_dir}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in simhash.op7_simhash(spark, big_dir).collect()}
    fps = [slow_fingerprint(r["text"]) for r in docs]
    assert [got[r["doc_id"]]["fingerprint"] for r in docs] == [f"{f:016x}" for f in fps]
    assert same_partition([got[r["doc_id"]]["component_id"] for r in docs], groups(fps, 3))


def test_empty(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0


def test_clashing_names(spark):
    rows = [(k, "one two three four five" if k % 2 else f"words of number {k}") for k in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS fp", "2 AS root", "3 AS component_id", "4 AS mask", "5 AS least")
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(df).collect()}
    assert got == {k: 1 if k % 2 else k for k in range(8)}
