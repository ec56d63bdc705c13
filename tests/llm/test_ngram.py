import collections
import math
import zlib

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratagrid.llm import ngram


def tokens(text):
    return [*(text or "").encode().translate(ngram.C.LOWER).split(), b"\n"]


class Slow:
    def __init__(self, texts):
        own = [tokens(t) for t in texts]
        self.uni = collections.Counter(w for t in own for w in t)
        self.bi = collections.Counter(p for t in own for p in zip([None, *t], t))
        self.cont = collections.Counter(b for _, b in self.bi)
        count = lambda c: [sum(v == k for v in c.values()) for k in (1, 2, 3, 4)]
        self.d2, self.d1 = ngram.discounts(count(self.bi)), ngram.discounts(count(self.cont))
        self.ctx = collections.defaultdict(lambda: [0, 0.0])
        for (a, _), c in self.bi.items():
            self.ctx[a][0] += c
            self.ctx[a][1] += self.d2[min(c, 3) - 1]
        self.spare = sum(self.d1[min(c, 3) - 1] for c in self.cont.values()) / max(1, len(self.bi))

    def lower(self, w):
        c = self.cont[w]
        return (c - (self.d1[min(c, 3) - 1] if c else 0)) / len(self.bi) + self.spare / (len(self.uni) + 1)

    def p(self, a, w):
        if a not in self.ctx:
            return self.lower(w)
        c, (n, s) = self.bi[a, w], self.ctx[a]
        return (c - (self.d2[min(c, 3) - 1] if c else 0)) / n + s / n * self.lower(w)

    def score(self, text):
        t = tokens(text)
        return sum(math.log10(self.p(a, w)) for a, w in zip([None, *t], t))


def same(spark, rows, train):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = ngram.train(df.filter(train))
    slow = Slow([r["text"] for r in df.filter(train).collect()])
    n, v = sum(slow.uni.values()), len(slow.uni)
    for r in ngram.score(df, model).join(df.withColumnRenamed("doc_id", "d"), F.col("doc_id").eqNullSafe(F.col("d"))).collect():
        t = tokens(r["text"])
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(t), sum(slow.uni[w] > 0 for w in t), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((slow.uni[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), rel=1e-9)
        assert r["score"] == pytest.approx(slow.score(r["text"]), rel=1e-9)
    return model, slow


def test_small(spark):
    rows = [(1, "a b a b c"), (2, "A  B\tc d"), (3, None), (4, ""), (None, "é a b"), (6, "unseen words only"), (7, "a b c d " * 5000)]
    model, slow = same(spark, rows, "doc_id IS NULL OR doc_id < 6")
    total = sum(slow.p(b"a", w) for w in slow.uni) + slow.p(b"a", b"never")
    assert total == pytest.approx(1.0)


def test_tables(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    same(spark, docs, "crc32(CAST(doc_id AS string)) % 5 <> 1")


def test_held_out_beats_unigrams(spark, sf_dir):
    rows = ngram.op4_lm_scoring(spark, sf_dir).collect()
    assert {r["doc_id"] for r in rows if r["held_out"]} == {r["doc_id"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1}
    assert sum(r["score"] for r in rows if r["held_out"]) > sum(r["base_score"] for r in rows if r["held_out"])


def test_empty(spark, no_docs):
    model = ngram.train(no_docs)
    row = ngram.score(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), model).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["score"]) == (3, 0, 0, 0.0)
    assert ngram.score(no_docs, model).count() == 0


@given(st.dictionaries(st.integers(0, (1 << 64) - 1), st.integers(1, 1 << 40), max_size=50))
def test_blocks(counts):
    keys = np.array(sorted(counts), dtype=np.uint64)
    values = np.array([counts[int(k)] for k in keys], dtype=np.int64)
    k, v = ngram._decode(ngram._encode(keys, values))
    assert (k == keys).all() and (v == values).all()


def test_discounts_by_hand():
    """Y = n1 / (n1 + 2 n2); D1 = 1 - 2 Y n2 / n1, D2 = 2 - 3 Y n3 / n2, D3 = 3 - 4 Y n4 / n3."""
    n1, n2, n3, n4 = 1000, 300, 120, 70
    y = 1000 / 1600
    assert ngram.discounts([n1, n2, n3, n4]) == pytest.approx((1 - 2 * y * 0.3, 2 - 3 * y * 0.4, 3 - 4 * y * 70 / 120))
    assert ngram.discounts([0, 0, 0, 0]) == (0.5, 1.5, pytest.approx(2.7))
    # counts of counts that rise, or end, would give a discount beyond its count, or below zero
    assert ngram.discounts([10, 0, 0, 0]) == (0.95, 1.5, pytest.approx(2.7))
    assert ngram.discounts([1000, 10, 900, 5])[1] == 0.1


def test_a_model_by_its_formula(spark):
    """Probabilities from the paper's formula, with discounts that are worked out here."""
    texts = ["a b a b a c", "a b d", "e f a b", "c a", "g h i j k", "a b"] * 2 + ["l m", "n o p", "a c"]
    model = ngram.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    own = [tokens(t) for t in texts]
    pairs = collections.Counter(p for t in own for p in zip([b"<s>", *t], t))
    follows = collections.Counter(w for _, w in pairs)

    def formula(counts):
        n = [sum(v == k for v in counts.values()) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1])
        return [min(max((k + 1) - (k + 2) * y * n[k + 1] / n[k], 0.05 * (k + 1)), 0.95 * (k + 1)) if n[k] else ((0.5, 1.5, 2.7)[k]) for k in range(3)]

    d2, d1 = formula(pairs), formula(follows)
    vocabulary = {w for t in own for w in t}

    def lower(w):
        c = follows[w]
        spare = sum(d1[min(v, 3) - 1] for v in follows.values()) / len(pairs)
        return max(c - (d1[min(c, 3) - 1] if c else 0), 0) / len(pairs) + spare / (len(vocabulary) + 1)

    def p(a, w):
        seen = {x: c for (y, x), c in pairs.items() if y == a}
        if not seen:
            return lower(w)
        c, n = seen.get(w, 0), sum(seen.values())
        return (c - (d2[min(c, 3) - 1] if c else 0)) / n + sum(d2[min(v, 3) - 1] for v in seen.values()) / n * lower(w)

    asked = ["a b a c d", "zz a", "", "l n c a b b"]
    got = ngram.score(spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string"), model).collect()
    for r in got:
        t = tokens(asked[r["doc_id"]])
        assert r["score"] == pytest.approx(sum(math.log10(p(a, w)) for a, w in zip([b"<s>", *t], t)), rel=1e-9)


def test_repeated_rows_and_clashing_names(spark):
    rows = [(1, "a b a"), (1, "a b a"), (1, "other words"), (None, "a b"), (None, "a b"), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS shard", "'x' AS block", "2 AS n_tokens", "3 AS score")
    model = ngram.train(df)
    slow = Slow([t for _, t in rows])
    got = ngram.score(df, model).collect()
    assert got[0].__fields__ == ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    assert sorted((r["doc_id"] or 0, r["n_tokens"], round(r["score"], 9)) for r in got) == sorted((d or 0, len(tokens(t)), round(slow.score(t), 9)) for d, t in rows)


def test_counts_beyond_32_bits(tmp_path):
    keys = np.array([3, 9], dtype=np.uint64)
    batch = ngram.pa.record_batch({"shard": ngram.pa.array([0], ngram.pa.int32()), "block": ngram.pa.array([ngram._encode(keys, np.array([1 << 33, 2]))], ngram.pa.binary())})
    folder = f"file://{tmp_path}"
    list(ngram._write_bigrams(folder, 4, 1)(iter([batch])))
    assert ngram.C.get_array(folder, "paircounts-0").tolist() == [1 << 33, 2]
