import random
import re
import zlib

import numpy as np
import pytest

from stratagrid.llm import toxicity


def corpus(n, seed=0):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    rows = []
    for i in range(n):
        bad = rng.random() < 0.15
        text = [rng.choice(words) for _ in range(rng.randint(20, 80))] + (["zzqualmfoo", "zzqualmbar", "wretchzz"] * 2 if bad else [])
        rng.shuffle(text)
        rows.append((i, " ".join(text), bad))
    return rows


def test_learns_from_some_of_the_positives(spark):
    rows = corpus(1500)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(bad)) for i, _, bad in rows if i % 3], "doc_id long, toxic int")
    model = toxicity.train_on_labels(docs, labels)
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    wrong = [i for i, _, bad in rows if got[i]["predicted"] != bad]
    assert len(wrong) < 0.02 * len(rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())


def test_order_and_partitions_make_no_difference(spark):
    rows = corpus(300, 1)
    labels = spark.createDataFrame([(i, int(bad)) for i, _, bad in rows], "doc_id long, toxic int")
    fit = lambda order, n: toxicity.train_on_labels(spark.createDataFrame([r[:2] for r in order], "doc_id long, text string").repartition(n), labels)
    a, b = fit(rows, 3), fit(rows[::-1], 5)
    assert (a.chosen == b.chosen).all() and np.allclose(a.weights, b.weights) and a.grams == b.grams


def test_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1), (None, 1), (4, None), (10, 1), (10, 0), (11, 0), (12, 1), (999, 1)], "doc_id long, toxic int")
    got = toxicity.score(odd_docs, toxicity.train_on_labels(odd_docs, labels))
    assert got.count() == odd_docs.count() and got.columns == ["doc_id", "text", "n_lines", "score", "predicted"]
    assert all(0 <= r["score"] <= 1 for r in got.collect())


def test_empty(spark, no_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train_on_labels(no_docs, none)
    assert toxicity.score(no_docs, model).count() == 0
    one = spark.createDataFrame([(1, "text")], "doc_id long, text string")
    assert toxicity.score(one, toxicity.train_on_labels(one, none)).first()["predicted"] == 0


def test_held_out_accuracy(spark, big_dir):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{big_dir}/labels.parquet").collect()}
    rows = [(r["score"], labels[r["doc_id"]]) for r in toxicity.op1_toxicity(spark, big_dir).collect() if r["held_out"] and r["doc_id"] in labels]
    pos, neg = [s for s, t in rows if t], [s for s, t in rows if not t]
    assert np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg]) > 0.85


def test_risk_is_corrected():
    """Positives hidden among the unlabelled keep their side."""
    rng = np.random.default_rng(0)
    positive = np.hstack([np.ones((100, 1)), rng.random((100, 5)) < 0.5]).astype(np.float32)
    mixed = np.hstack([(np.arange(1000) < 200)[:, None], rng.random((1000, 5)) < 0.5]).astype(np.float32)
    w, b = toxicity.nnpu(positive, mixed, 0.2, np.array([1.0, 0, 0, 0, 0, 0]), 0)
    assert ((mixed @ w + b > 0) == (mixed[:, 0] > 0)).mean() > 0.99


def risk_of(positive, unlabelled, prior, w, b):
    """The estimator as it is written: losses by label, means, and the part that mustn't be negative."""
    loss = lambda x, label: 1 / (1 + np.exp(label * (x @ w + b)))
    rest = loss(unlabelled, -1).mean() - prior * loss(positive, -1).mean()
    return prior * loss(positive, 1).mean(), rest


def slopes(f, w, b, step=1e-6):
    """The gradient of f by differences, the bias last."""
    at = np.append(w, b)
    out = []
    for i in range(len(at)):
        up, down = at.copy(), at.copy()
        up[i] += step
        down[i] -= step
        out.append((f(up[:-1], up[-1]) - f(down[:-1], down[-1])) / (2 * step))
    return np.array(out)


@pytest.mark.parametrize(("prior", "bias"), [(0.1, 0.3), (0.2, -2.0), (0.9, 1.0), (0.95, -1.0)])
def test_risk_and_gradient_by_differences(prior, bias):
    rng = np.random.default_rng(3)
    positive, unlabelled, w = rng.random((40, 6)) < 0.6, rng.random((200, 6)) < 0.3, rng.normal(size=6)
    means, grads = [], []
    for x in (positive, unlabelled):
        s = 1 / (1 + np.exp(-(x @ w + bias)))
        means.append(s.mean())
        grads.append(np.append(x.T @ (s * (1 - s)) / len(x), (s * (1 - s)).mean()))
    risk, grad = toxicity.corrected(prior, *means, *grads)
    first, rest = risk_of(positive, unlabelled, prior, w, bias)
    assert np.isclose(risk, first + max(0, rest))
    if rest >= 0:
        want = slopes(lambda w, b: sum(risk_of(positive, unlabelled, prior, w, b)), w, bias)
    else:
        want = -slopes(lambda w, b: risk_of(positive, unlabelled, prior, w, b)[1], w, bias)
    assert np.allclose(grad, want, atol=1e-6)


def test_both_signs_of_the_second_part_are_tested():
    rng = np.random.default_rng(3)
    positive, unlabelled, w = rng.random((40, 6)) < 0.6, rng.random((200, 6)) < 0.3, rng.normal(size=6)
    signs = [risk_of(positive, unlabelled, prior, w, b)[1] >= 0 for prior, b in ((0.1, 0.3), (0.2, -2.0), (0.9, 1.0), (0.95, -1.0))]
    assert True in signs and False in signs


def test_whole_gradients(spark):
    """A round over grouped rows of places is a step over dense rows; positives are unlabelled texts too."""
    rng = np.random.default_rng(5)
    x, y = rng.random((300, 7)) < 0.4, rng.random(300) < 0.3
    x[:40] = False
    w, b = rng.normal(size=(2, 7)), rng.normal(size=2)
    model = toxicity.Classifier(np.arange(7), {}, w, b, 0.25)
    texts = spark.createDataFrame([(i, np.flatnonzero(r).tolist()) for i, r in enumerate(x)], "doc_id long, places array<int>").repartition(5)
    positives = spark.createDataFrame([(int(i),) for i in np.flatnonzero(y)], "doc_id long")
    got = toxicity.refine(model, texts, positives, rounds=3, rate=0.05)
    for j in range(2):
        wj, bj, adam = w[j].copy(), b[j], toxicity._Adam(8, 0.05)
        for _ in range(3):
            means, grads = [], []
            for rows in (x[y], x):
                s = 1 / (1 + np.exp(-(rows @ wj + bj)))
                means.append(s.mean())
                grads.append(np.append(rows.T @ (s * (1 - s)) / len(rows), (s * (1 - s)).mean()))
            grad = toxicity.corrected(0.25, *means, *grads)[1]
            grad[:-1] += toxicity.DECAY * wj
            step = adam.step(grad)
            wj, bj = wj - step[:-1], bj - step[-1]
        assert np.allclose(got.weights[j], wj) and np.isclose(got.bias[j], bj)


def slow_score(model, text):
    """By every substring, without caches or an automaton."""
    counts = {}
    for word in re.findall(r"[^\W\d_]+", (text or "").lower()):
        w = f"^{word}$"
        for g in {w} | {w[i : i + n] for n in (4, 5, 6) for i in range(len(w) - n + 1)}:
            if g in model.grams:
                counts.setdefault(model.grams[g], []).append(word)
    held = {(f << 2) | level for f, words in counts.items() for level, least in enumerate((1, 2, 3, 5)) if len(words) >= least}
    x = np.array([f in held for f in model.chosen.tolist()], dtype=float)
    return float(np.mean([1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30))) for w, b in zip(model.weights, model.bias)]))


def test_query_against_brute_force(spark, big_dir):
    docs, labels = (spark.read.parquet(f"{big_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train_on_labels(docs, labels)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = toxicity.op1_toxicity(spark, big_dir).collect()
    assert len(got) == len(texts) and len(model.chosen) > 100
    for r in got:
        assert np.isclose(r["score"], slow_score(model, texts[r["doc_id"]]), atol=1e-6)
        assert r["predicted"] == (r["score"] >= 0.5) and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)


def test_one_rule_for_words_of_any_length(spark):
    rows = corpus(400, 2)
    filler = "q" * 200
    docs = [(i, t.replace("zzqualmfoo", filler + "zzqualmfoo" + filler)) for i, t, _ in rows]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    model = toxicity.train_on_labels(df, spark.createDataFrame([(i, int(bad)) for i, _, bad in rows], "doc_id long, toxic int"))
    assert any("zzqu" in g for g in model.grams)
    for r in toxicity.score(df, model).collect():
        assert np.isclose(r["score"], slow_score(model, r["text"]))
    assert np.isclose(toxicity.score(spark.createDataFrame([("x" * 300 + "zzqualmfoo",)], "text string"), model).first()["score"], slow_score(model, "x" * 300 + "zzqualmfoo"))


def test_repeated_ids_are_one_of_the_sample(spark):
    rows = corpus(300, 3)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows for _ in range(1 + 40 * (i == 7))], "doc_id long, text string")
    labels = spark.createDataFrame([(i, bad) for i, _, bad in rows], "doc_id long, positive boolean")
    once = toxicity.fit_sample(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), labels, 0.15)
    many = toxicity.fit_sample(docs, labels, 0.15)
    assert (once.chosen == many.chosen).all() and np.allclose(once.weights, many.weights)
