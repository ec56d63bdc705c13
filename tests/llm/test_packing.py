import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stratagrid.llm import packing


@pytest.fixture(scope="module")
def slow():
    t = Tokenizer.from_file(packing.public_vocabulary()[0])
    t.encode_special_tokens = True
    return t


@pytest.fixture(scope="module")
def tokens():
    return packing.Tokens(*packing.public_vocabulary())


def test_all_latin_characters_alike(slow, tokens):
    """Each character beside a letter, a digit, a sign and a space, in both orders."""
    for c in map(chr, range(256)):
        for text in (f"a{c}b", f"1{c}2", f"{c}", f" {c} {c}x", f"!{c}{c}?", f"\n{c}\n", f"x {c}'s", f"{c}  {c}", f"it{c}ll", f"Ab\t{c}\r\n"):
            assert tokens.ids(text).tolist() == slow.encode(text, add_special_tokens=False).ids, text.encode()


@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=200))
def test_any_text_alike(slow, tokens, text):
    assert tokens.ids(text).tolist() == slow.encode(text, add_special_tokens=False).ids


def check(rows, capacity):
    """rows: (sequence_id, offset, length). Gapless and within the capacity; gives the number of sequences."""
    by = {}
    for s, o, n in rows:
        by.setdefault(s, []).append((o, n))
    for places in by.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at <= capacity
    return len(by)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=300), st.integers(1, 80))
def test_plans(lengths, groups):
    h = {s: lengths.count(s) for s in set(lengths)}
    steps = packing.intervals(packing.plan(h, 64, groups))
    rows, ranks = [], {s: [] for s in h}
    for s, lo, hi, base, at in steps:
        rows += [(base + i, at, s) for i in range(hi - lo)]
        ranks[s] += range(lo, hi)
    assert all(sorted(r) == list(range(h[s])) for s, r in ranks.items())  # each piece has one place
    n = check(rows, 64)
    assert n <= 1.25 * -(-sum(lengths) // 64) + 2 or n <= len(lengths)


@pytest.mark.parametrize("n", [1000, 1_000_000])
def test_few_sequences(n):
    rng = random.Random(n)
    h = {}
    for _ in range(2000):
        s = min(1024, int(rng.expovariate(1 / 400)) + 1)
        h[s] = h.get(s, 0) + n // 1000
    runs = packing.plan(h, 1024)
    assert sum(r.count for r in runs) <= 1.01 * sum(s * k for s, k in h.items()) / 1024 + 1
    assert len(packing.intervals(runs)) < 20_000  # however many pieces


def test_odd_rows(odd_docs, slow):
    packed = packing.pack(odd_docs)
    got = packed.placed.collect()
    check([(r["sequence_id"], r["offset"], r["length"]) for r in got], 1024)
    by_doc = sorted((r["doc_id"] or 0, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got)
    want = []
    for r in odd_docs.collect():
        ids = [*slow.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        first = len(ids) if len(ids) <= 1024 else len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids), 1024), len(ids)]
        want += [(r["doc_id"] or 0, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert by_doc == sorted(want)
    total = {r["sequence_id"]: (r["n_tokens"], r["ids"]) for r in packed.sequences().collect()}
    assert all(len(ids) == 4 * n for n, ids in total.values()) and sum(n for n, _ in total.values()) == sum(w[3] for w in want)


def test_empty(no_docs):
    assert packing.pack(no_docs).placed.count() == 0


@pytest.fixture(scope="module")
def given_tokenizer():
    """As its file gives it."""
    return Tokenizer.from_file(packing.public_vocabulary()[0])


@pytest.mark.parametrize("text", ["a <|endoftext|> b", "<|endoftext|>", "é<|endoftext|><|endoftext|>x", "語 <|endoftext|> b", "<|endoftext|", "x<|endoftext|>\n\nit's"])
def test_names_of_tokens_in_texts(given_tokenizer, tokens, text):
    want = given_tokenizer.encode(text, add_special_tokens=False).ids
    assert tokens.ids(text).tolist() == want
    assert packing.Tokens(packing.public_vocabulary()[0]).ids(text).tolist() == want


def by_hand(tokenizer, rows, capacity=1024):
    """Sorted (doc_id, piece, start, length, crc32 of ids) of rows (doc_id, text)."""
    out = []
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        n = len(ids)
        first = n if n <= capacity else n % capacity or capacity
        cuts = [0, *range(first, n, capacity), n]
        out += [(doc_id or 0, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    return sorted(out)


def test_query(spark, sf_dir, given_tokenizer):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = packing.op3_best_fit_packing(spark, sf_dir)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    rows = got.collect()
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == by_hand(given_tokenizer, docs)
    used = check([(r["sequence_id"], r["offset"], r["length"]) for r in rows], 1024)
    assert used <= 1.02 * sum(r["length"] for r in rows) / 1024 + 1


def test_repeated_rows_and_clashing_names(spark, given_tokenizer):
    docs = [(1, "a <|endoftext|> b"), (1, "a <|endoftext|> b"), (None, None), (2, "word " * 3000), (2, "other")]
    df = spark.createDataFrame([(d, t, "x", 7, 8.0, "n") for d, t in docs], "doc_id long, text string, piece string, length long, part double, nth string")
    rows = packing.pack(df).placed.collect()
    assert sorted((r["doc_id"] or 0, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == by_hand(given_tokenizer, docs)
    check([(r["sequence_id"], r["offset"], r["length"]) for r in rows], 1024)


@pytest.mark.parametrize("groups", [32, 64, 512])
def test_few_groups_lose_little(groups):
    rng = random.Random(groups)
    h = {}
    for _ in range(200_000):
        s = min(1024, int(rng.expovariate(1 / 400)) + 1)
        h[s] = h.get(s, 0) + 1
    assert sum(r.count for r in packing.plan(h, 1024, groups)) <= 1.002 * sum(s * k for s, k in h.items()) / 1024 + 1
