import random
import re

from stratagrid.llm import decontamination as dc


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def by_hand(docs, items, size=10):
    wins = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - size + 1)):
            if w:
                wins.setdefault(tuple(w[k : k + size]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, named = words(t), set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if (own := wins.get(tuple(w[k : k + n]))) is not None:
                    hit |= set(range(k, k + n))
                    named |= own
        out.append((d, len(w), len(hit), sorted(str(x) for x in named if x is not None), bool(hit)))
    return sorted(out, key=str)


def run(spark, docs, items, **options):
    got = dc.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), **options)
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"], r["contaminated"]) for r in got.collect()), key=str)


def test_random(spark, monkeypatch):
    rng = random.Random(0)
    some = ["a", "B", "é", "É", "x1", "the", "Öl", "日本", "q"]
    items = [(i, " ".join(rng.choice(some) for _ in range(rng.choice([0, 1, 4, 9, 10, 11, 30])))) for i in range(25)] + [(None, "no id a b"), (3, None), (7, "a é q"), (8, "a é q")]
    docs = []
    for i in range(120):
        w = [rng.choice(some) for _ in range(rng.choice([0, 1, 9, 40, 300]))]
        if rng.random() < 0.5:
            k = rng.randrange(len(w) + 1)
            w[k:k] = (rng.choice(items)[1] or "").split()
        docs.append((i, rng.choice([" ", "\n", ", "]).join(w)))
    docs += [(None, "a é q"), (500, None), (500, "a é q"), (500, "a é q"), (501, "a é q " * 3000)]
    assert run(spark, docs, items) == by_hand(docs, items)
    monkeypatch.setattr(dc, "BLOCK", 2)  # several sets in the plan
    assert run(spark, docs, items, size=3) == by_hand(docs, items, 3)


def test_no_items_or_documents(spark):
    assert run(spark, [(1, "a b")], []) == [(1, 2, 0, [], False)]
    assert run(spark, [(1, "a b")], [(1, "")]) == [(1, 2, 0, [], False)]
    assert run(spark, [], [(1, "a b")]) == []


def test_odd_rows(spark, odd_docs):
    got = dc.contamination(odd_docs, spark.createDataFrame([(1, "same text here"), (2, "of them a line")], "item_id long, text string"))
    assert got.filter("contaminated").count() == 2 + 6


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "far one two three four five six seven near"), (2, "near far"), (3, "near x y far"), (4, "far")], "doc_id long, text string")
    items = dc.windows(spark.createDataFrame([(9, "near far")], "item_id long, text string"))
    counts = dc.term_counts(docs, ["near", "far"])
    asked = dc.rarest(counts, items)
    index = dc.build_index(docs, [r["term"] for r in asked.collect()], reach=9)
    found = lambda n: sorted(r["doc_id"] for r in dc.proximity_matches(index, asked, n).join(index.documents, "row").collect())
    assert (found(1), found(3), found(8)) == ([2], [2, 3], [1, 2, 3])


def test_plan_is_native(spark, sf_dir):
    plan = dc.op10_decontamination(spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))


def test_clashing_names(spark):
    """Id columns with names that the operator uses itself, and other columns beside them."""
    rows = [(i, "x", "one two three four five six seven eight nine ten eleven" if i % 2 else "one two") for i in range(6)]
    docs = spark.createDataFrame(rows, "row long, at string, text string").selectExpr("row", "at", "text", "1 AS w", "2 AS pos", "'t' AS term", "3 AS block", "4 AS own_0", "5 AS id_0")
    items = spark.createDataFrame([(1, "two three four five six seven eight nine ten eleven twelve")], "item_id long, text string")
    got = dc.contamination(docs, items, id_cols=("row", "at"))
    assert got.columns == ["row", "at", "n_words", "n_hit", "item_ids", "contaminated"]
    assert sorted((r["row"], r["at"], r["n_words"], r["n_hit"], r["contaminated"]) for r in got.collect()) == [(i, "x", 11, 10, True) if i % 2 else (i, "x", 2, 0, False) for i in range(6)]
    got = dc.contamination(docs, items, id_cols=("pos", "term"))
    assert sorted((r["pos"], r["term"], r["n_hit"]) for r in got.collect()) == [(2, "t", 0)] * 3 + [(2, "t", 10)] * 3


def test_several_passes(spark, monkeypatch):
    """Terms of several broadcasts; phrases and neighbourhoods."""
    rng = random.Random(5)
    items = [(i, " ".join(rng.choice("abcde") for _ in range(4))) for i in range(6)]
    docs = [(i, " ".join(rng.choice("abcdex") for _ in range(rng.choice([0, 3, 30, 200])))) for i in range(30)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    queries = dc.windows(spark.createDataFrame([(1, "a b e")], "item_id long, text string"))
    for block in (1, 2, 50):
        monkeypatch.setattr(dc, "BLOCK", block)
        assert run(spark, docs, items, size=4) == by_hand(docs, items, 4)
        counts = dc.term_counts(df, ["a", "b", "e", "none"])
        index = dc.build_index(df, ["a", "b", "e"], reach=9)
        assert {(r["term"], r["n"]) for r in counts.collect()} == {(c, sum(t.split().count(c) for _, t in docs)) for c in "abe"}
        asked = dc.rarest(counts, queries).collect()[0]["term"]
        for within in (2, 4):
            got = {(r["doc_id"], r["pos"]) for r in dc.proximity_matches(index, dc.rarest(counts, queries), within).join(index.documents, "row").collect()}
            want = {(d, k) for d, t in docs for k, w in enumerate(t.split()) if w == asked and {"a", "b", "e"} <= set(t.split()[max(0, k - within) : k + within + 1])}
            assert got == want


def test_benchmark_terms_are_not_in_the_plan(spark):
    """The plan doesn't grow with the benchmark."""
    docs = spark.createDataFrame([(1, "w1 w2 w3")], "doc_id long, text string")
    items = spark.createDataFrame([(i, f"only{i} in{i} the{i} benchmark{i}") for i in range(50)], "item_id long, text string")
    plan = dc.contamination(docs, items)._jdf.queryExecution().toString()
    assert "only7" not in plan and "benchmark" not in plan
