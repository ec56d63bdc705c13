import collections

import numpy as np

from stratagrid.llm import common, lines


def by_hand(rows, least=40, docs=5):
    """rows: (doc_id, text)."""
    key = lambda x: x.encode().strip(lines.SPACE).translate(common.LOWER)
    held = collections.defaultdict(set)
    for d, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x).decode()) >= least and d is not None:
                held[key(x)].add(d)
    gone = {k: max(ids) for k, ids in held.items() if len(ids) >= docs}
    out = []
    for d, t in rows:
        own = (t or "").split("\n")
        stay = [x for x in own if not (key(x) in gone and gone[key(x)] != d)]
        out.append((d, t if len(stay) == len(own) else "\n".join(stay), len(own), len(own) - len(stay)))
    return out


def order(rows):
    return sorted(rows, key=str)


def test_odd_rows(odd_docs):
    got = lines.drop_repeated_lines(odd_docs)
    assert got.columns == ["doc_id", "text", "score", "n_lines", "n_dropped"]
    want = by_hand([(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    assert order((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect()) == order(want)
    assert sum(w[3] for w in want) == 7  # six of seven documents, and the row without an id


def test_code_points_not_bytes(spark):
    rows = [(k, "é" * 39) for k in range(6)] + [(k + 10, "é" * 40) for k in range(6)] + [(k + 20, "É" * 40) for k in range(4)]
    got = lines.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert order((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect()) == order(by_hand(rows))


def test_empty(no_docs):
    assert lines.drop_repeated_lines(no_docs).count() == 0


def test_whole_table(spark, big_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{big_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = lines.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(7))
    assert order((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect()) == order(by_hand(rows))


def test_filters_have_no_false_negatives():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 1 << 63, 400_000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    bloom = lines.Bloom(10)
    for part in np.array_split(h, 13):
        bloom.add(part)
    assert bloom.has(h).all() and len(bloom.layers) > 5
    assert bloom.has(rng.integers(0, 1 << 63, 100_000, dtype=np.uint64) * np.uint64(2)).mean() < 0.1
    seen = lines.Sightings()
    seconds = [seen.see(np.concatenate([part, h[:10]]))[1] for part in np.array_split(h[10:], 5)]
    assert set(h[:10]) <= set(np.concatenate(seconds))


def test_no_second_sighting_is_held_back():
    rng = np.random.default_rng(2)
    for top in (0, 8):  # hashes of all ranges, and of one range
        h = np.unique(rng.integers(0, 1 << 64, 300_000, dtype=np.uint64) >> np.uint64(top))
        rng.shuffle(h)
        seen, got = lines.Sightings(), []
        for part in np.array_split(h, 20):
            got.append(seen.see(part)[1])
            got.append(seen.see(part)[1])
            assert not len(seen.see(part)[1])
        got = np.concatenate(got)
        assert set(h) == set(got) and len(got) == len(h)
        assert np.array_equal(np.sort(seen.twice.all()), np.sort(h))
        assert seen.see(h[:9], np.ones(9, bool))[1].size == 0
        # A mark from another task makes a suspect of a hash at its first sighting here.
        fresh = np.setdiff1d(rng.integers(0, 1 << 63, 50_000, dtype=np.uint64), h)
        assert set(seen.see(fresh, np.ones(len(fresh), bool))[1]) == set(fresh)


def test_clashing_names_and_small_segments(spark, monkeypatch):
    """Columns with names that the operator uses, and tables of many segments."""
    from stratagrid.llm import common

    monkeypatch.setattr(common, "SEGMENT", 3)
    rows = [(k, "\n".join(f"line number {j} is held by several of the documents" for j in range(k % 7 * 9))) for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS h", "'x' AS again", "2 AS bucket", "3 AS n", "4 AS keep", "5 AS sha")
    got = lines.drop_repeated_lines(df)
    assert got.columns == ["doc_id", "text", "h", "again", "bucket", "n", "keep", "sha", "n_lines", "n_dropped"]
    assert order((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect()) == order(by_hand(rows))
