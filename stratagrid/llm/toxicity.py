"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; all training texts, those among them, are the unlabelled ones, whatever is known
of them, so the share of toxic texts among the unlabelled is the class prior. Linear classifiers are trained with numpy on
the class-prior-corrected risk

    R = prior * E_P[l(g)] + max(0, E_U[l(-g)] - prior * E_P[l(-g)])

with the sigmoid loss; where the second part turns negative, its gradient is reversed, which keeps the classifier from
explaining away unlabelled positives (non-negative PU learning). Features are words and their character n-grams at
several levels of their count in a text.

1. Features are chosen, and first weights are fitted in small steps, on a bounded sample of labelled texts: at most
   ``max_positive`` toxic ones against at most ``max_labelled`` of all labelled ones, their labels hidden, the first by a
   hash of their ids.
2. Every training text is reduced to the chosen features that it has. Texts with the same ones are one row with a count.
3. The weights are trained on by whole gradients of the risk over all training texts and all confirmed positives, summed
   by Spark's tasks.

Scoring needs the chosen features alone and reads every text whole, without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, replace
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

#: Lengths of the character n-grams, word ends included.
GRAMS = (4, 5, 6)
#: How often a text must have a feature for each of its levels.
LEVELS = (1, 2, 3, 5)
#: Tasks that share the sample, whose size is bounded.
SAMPLE_TASKS = 32
#: Weight decay.
DECAY = 1e-4
_WORD = re.compile(r"[^\W\d_]+")


#: Longer words are few, and are not remembered.
REMEMBERED = 64
#: Tasks that give a gradient, which is some kilobytes, to the driver.
GRADIENTS = 1024


def _grams(word: str) -> set[str]:
    """A word and its n-grams; ``^`` and ``$`` mark its ends."""
    w = f"^{word}$"
    return {w} | {w[i : i + n] for n in GRAMS for i in range(len(w) - n + 1)}


class _Features(dict):
    """word -> hashes of its features, in order; bounded like a cache."""

    def __missing__(self, word: str) -> np.ndarray:
        if len(self) > 40_000:
            self.clear()
        f = np.unique(np.array([crc32(g.encode()) for g in _grams(word)], dtype=np.int64))
        if len(word) <= REMEMBERED:
            self[word] = f
        return f


class _Found(dict):
    """word -> those of the given features that it has, found by an automaton of their texts; bounded like a cache."""

    def __init__(self, grams: dict[str, int]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for g, f in grams.items():
            self.automaton.add_word(g, f)
        if grams:
            self.automaton.make_automaton()
        else:
            self.automaton = None

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > 150_000:
            self.clear()
        f = tuple({f for _, f in self.automaton.iter(f"^{word}$")}) if self.automaton else ()
        if len(word) <= REMEMBERED:
            self[word] = f
        return f


def _words(text: str | None) -> Counter:
    return Counter(_WORD.findall((text or "").lower()))


def _levels(counts: np.ndarray, features: np.ndarray) -> np.ndarray:
    """A feature at each level that its count in a text reaches, as one number."""
    return np.concatenate([(features[counts >= least] << 2) | level for level, least in enumerate(LEVELS)])


def _sample_features(batches):
    """(positive, drawn, features at their levels) of the sampled texts."""
    cache = _Features()
    for batch in batches:
        feats = []
        for text in batch.column(1).to_pylist():
            words = _words(text)
            if words:
                own = [cache[w] for w in words]
                all_, at = np.unique(np.concatenate(own), return_inverse=True)
                counts = np.bincount(at, weights=np.repeat(list(words.values()), [len(f) for f in own]))
                feats.append(_levels(counts, all_))
            else:
                feats.append(np.zeros(0, np.int64))
        ends = np.r_[0, np.cumsum([len(f) for f in feats])].astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(feats) if feats else np.zeros(0, np.int64)))
        yield pa.record_batch({"positive": batch.column(0), "drawn": batch.column(2), "features": lists, "text": batch.column(1)})


def _grams_of(features: np.ndarray):
    """The texts of features, as far as the sampled texts have them."""

    def run(batches):
        own, seen = set(features.tolist()), set()
        for batch in batches:
            out = []
            for text in batch.column(0).to_pylist():
                for word in _words(text).keys() - seen:
                    seen.add(word)
                    out += [(f, g) for g in _grams(word) if (f := crc32(g.encode())) in own]
            if out:
                f, g = zip(*set(out), strict=True)
                yield pa.record_batch({"f": pa.array(f, pa.int64()), "gram": pa.array(g)})

    return run


def _chosen_features(chosen: np.ndarray):
    def run(batches):
        for batch in batches:
            lists = [np.intersect1d(np.array(f, dtype=np.int64), chosen).tolist() for f in batch.column(2).to_numpy(zero_copy_only=False)]
            yield pa.record_batch({"positive": batch.column(0), "drawn": batch.column(1), "features": pa.array(lists, pa.list_(pa.int64()))})

    return run


@dataclass
class Classifier:
    """Chosen features at their levels, the texts of the features, and for each of several classifiers their weights and
    a bias; the mean is the score. A text's features are given as their places among the chosen ones."""

    chosen: np.ndarray
    grams: dict[str, int]
    weights: np.ndarray
    bias: np.ndarray
    prior: float

    def margins(self, places: np.ndarray, of: np.ndarray, texts: int) -> np.ndarray:
        """By classifier and text; places: of the features of all texts, of: the text of each."""
        if not len(self.chosen):
            return np.repeat(self.bias[:, None], texts, axis=1)
        return np.stack([np.bincount(of, weights=w[places], minlength=texts) + b for w, b in zip(self.weights, self.bias, strict=True)])

    def scores(self, places: np.ndarray, of: np.ndarray, texts: int) -> np.ndarray:
        return _sigmoid(self.margins(places, of, texts)).mean(axis=0)


def _sigmoid(g: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(g, -30, 30)))


def corrected(prior: float, p: float, u: float, dp: np.ndarray, du: np.ndarray) -> tuple[float, np.ndarray]:
    """The risk and the gradient to follow, from the means of sigmoid(g) over positives (p) and unlabelled texts (u), which
    are losses for the label -1, and the gradients of these means. The loss for the label 1 is one minus that for -1."""
    rest = u - prior * p
    toward = du - prior * dp
    return prior * (1 - p) + max(0.0, rest), toward - prior * dp if rest >= 0 else -toward


class _Adam:
    def __init__(self, n: int, rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(n), np.zeros(n), 0, rate

    def step(self, grad: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m, self.v = 0.9 * self.m + 0.1 * grad, 0.999 * self.v + 0.001 * grad**2
        return self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-8)


def nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, scale: np.ndarray, seed: int, updates: int = 600, batch: int = 512, rate: float = 0.02, decay: float = DECAY) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear classifier on 0/1 rows, by Adam on the non-negative PU risk. Whole passes over the
    unlabelled rows make up ``updates`` steps or more, so that small samples are fitted as far as large ones."""
    rng, n = np.random.default_rng(seed), positive.shape[1]
    w, b = scale.astype(np.float32), np.float32(-np.median(unlabelled @ scale.astype(np.float32)) - 1.0)
    adam, steps = _Adam(n + 1, rate), max(1, -(-len(unlabelled) // batch))
    for _ in range(-(-updates // steps)):
        for part in np.array_split(rng.permutation(len(unlabelled)), steps):
            pick = rng.integers(0, len(positive), size=min(len(positive), max(32, batch // 4)))
            means, grads = [], []
            for x in (positive[pick], unlabelled[part]):
                s = _sigmoid(x @ w + b)
                slope = s * (1 - s)
                means.append(float(s.mean()))
                grads.append(np.append(x.T @ (slope / len(x)), slope.mean()))
            _, grad = corrected(prior, *means, *grads)
            grad[:-1] += decay * w
            step = adam.step(grad)
            w, b = (w - step[:-1]).astype(np.float32), np.float32(b - step[-1])
    return w, float(b)


def fit_sample(docs: DataFrame, labelled: DataFrame, prior: float | None, id_col: str = "doc_id", text_col: str = "text", max_positive: int = 2500, max_labelled: int = 6000, features: int = 1200, members: int = 3) -> Classifier:
    """Chooses features and fits first classifiers on a bounded sample of the texts of ``labelled``: distinct ids, and
    whether each is positive. Positives are also among the unlabelled texts of the sample at their own share.

    prior: share of toxic texts among all. An id of several rows gives the smallest of its texts. Without positives, or
    without texts, the classifier has no features and gives the prior to every text."""
    spark = docs.sparkSession
    C.short_batches(spark)
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    order = F.xxhash64(F.col("id").cast("string"), F.lit(7))
    # Ids are chosen first, by a limit that each task applies to its own rows; texts are read for these alone.
    known = labelled.select(F.col(id_col).alias("id"), "positive").filter(F.col("id").isNotNull()).join(given.select("id").distinct(), "id")
    first = lambda df, n, name: df.orderBy(order, "id").limit(n).select("id", F.lit(True).alias(name))
    toxic_ids, drawn_ids = first(known.filter("positive"), max_positive, "positive"), first(known, max_labelled, "drawn")
    ids = toxic_ids.join(drawn_ids, "id", "full").na.fill(False)  # at most max_positive + max_labelled rows
    # One text an id. The sample is dealt anew, since a few of the input's files may hold most of it.
    texts = given.join(F.broadcast(ids), "id").groupBy("id", "positive", "drawn").agg(F.min("text").alias("text"))
    sample = texts.select("positive", "text", "drawn").repartition(SAMPLE_TASKS).mapInArrow(_sample_features, "positive boolean, drawn boolean, features array<long>, text string")
    sample = C.materialize(sample, "toxicity-sample")
    n_p, n_u = (sample.agg(F.count(F.when(F.col(c), 1)).alias("n")).first()["n"] for c in ("positive", "drawn"))
    if not n_p or not n_u:
        only = float(prior or 0.0)
        g = np.log(max(only, 1e-6) / max(1 - only, 1e-6))
        return Classifier(np.zeros(0, np.int64), {}, np.zeros((1, 0)), np.array([min(g, -1e-6) if only < 0.5 else g]), only)
    one = lambda c: F.sum(F.col(c).cast("long"))
    counts = sample.select("positive", "drawn", F.explode("features").alias("f")).groupBy("f").agg(one("positive").alias("p"), one("drawn").alias("u"))
    p, q = (F.col("p") + 0.5) / (n_p + 1), (F.col("u") + 0.5) / (n_u + 1)
    both = (F.col("p") + F.col("u") + 1) / (n_p + n_u + 2)
    z = (p - q) / F.sqrt(both * (1 - both) * (1 / n_p + 1 / n_u))
    best = counts.filter(F.col("p") >= max(2, n_p // 400)).select("f", F.log(p / q).alias("ratio"), z.alias("z")).filter("z > 3").orderBy(F.desc("z"), "f").limit(features).collect()
    prior = float(prior if prior is not None else n_p / (n_p + n_u))
    chosen, scale = np.array([r["f"] for r in best], dtype=np.int64), np.array([r["ratio"] for r in best])
    if not len(chosen):
        return Classifier(chosen, {}, np.zeros((1, 0)), np.array([np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))]), prior)
    scale, chosen = scale[np.argsort(chosen)], np.sort(chosen)
    held = sample.mapInArrow(_chosen_features(chosen), "positive boolean, drawn boolean, features array<long>").collect()
    held.sort(key=lambda r: (r["positive"], r["drawn"], r["features"]))  # the same order however tasks ran
    x = np.zeros((len(held), len(chosen)), dtype=np.float32)
    for i, r in enumerate(held):
        x[i, np.searchsorted(chosen, r["features"])] = 1.0
    positive, unlabelled = x[[r["positive"] for r in held]], x[[r["drawn"] for r in held]]
    # n-grams of one marker come and go together; each gets its share of the evidence.
    scale = scale / max(1.0, float((positive @ scale).mean() / 6.0))
    fits = [nnpu(positive, unlabelled, prior, scale, seed) for seed in range(members)]
    named = sample.select("text").mapInArrow(_grams_of(np.unique(chosen >> 2)), "f long, gram string").distinct().collect()
    return Classifier(chosen, {r["gram"]: r["f"] for r in named}, np.stack([w for w, _ in fits]).astype(np.float64), np.array([b for _, b in fits]), prior)


def _places(model: Classifier, cache: _Found, text: str | None) -> np.ndarray:
    """Places among the chosen ones of the features of a text at their levels, in order."""
    counts: dict[int, int] = {}
    for word, n in _words(text).items():
        for f in cache[word]:
            counts[f] = counts.get(f, 0) + n
    if not counts:
        return np.zeros(0, np.int64)
    held = _levels(np.fromiter(counts.values(), np.int64, len(counts)), np.fromiter(counts, np.int64, len(counts)))
    at = np.minimum(np.searchsorted(model.chosen, held), len(model.chosen) - 1)
    return np.sort(at[model.chosen[at] == held])


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.r_[0, np.cumsum([len(x) for x in parts])].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *parts]).astype(np.int32)))


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All values, and the row of each."""
    return column.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(column)), np.diff(column.offsets.to_numpy()))


def features_of(docs: DataFrame, model: Classifier, text_col: str = "text", name: str = "places") -> DataFrame:
    """docs with, instead of the text, the places of its features among the chosen ones."""
    C.short_batches(docs.sparkSession)
    rest = [c for c in docs.columns if c not in (text_col, name)]
    given = docs.select(*rest, F.col(text_col).cast("string").alias(text_col))
    schema = T.StructType([*given.schema.fields[:-1], T.StructField(name, T.ArrayType(T.IntegerType()))])

    def run(batches):
        cache = _Found(model.grams)
        for batch in batches:
            places = [_places(model, cache, t) for t in batch.column(len(rest)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(rest))), _lists(places)], names=schema.names)

    return given.mapInArrow(run, schema)


def _gradients(model: Classifier):
    """Rows (places, positives, texts): for each classifier the sums of sigmoid(g) and of its gradient, bias last, over the
    positives and over all texts."""

    def run(batches):
        n, k = len(model.chosen), len(model.bias)
        total = np.zeros((k, 2, n + 2))
        for batch in batches:
            at, of = _flat(batch.column(0))
            counts = [batch.column(i).to_numpy().astype(np.float64) for i in (1, 2)]
            s = _sigmoid(model.margins(at, of, batch.num_rows))
            for j in range(k):
                for i, c in enumerate(counts):
                    slope = s[j] * (1 - s[j]) * c
                    total[j, i, :n] += np.bincount(at, weights=slope[of], minlength=n)
                    total[j, i, n] += slope.sum()
                    total[j, i, n + 1] += (s[j] * c).sum()
        yield pa.record_batch({"sums": pa.array([total.astype("<f8").tobytes()], pa.binary())})

    return run


def refine(model: Classifier, texts: DataFrame, positives: DataFrame, id_col: str = "doc_id", rounds: int = 8, rate: float = 0.03) -> Classifier:
    """Trains on with whole gradients of the risk over all texts (id, places) and the positives among them (distinct ids).
    Rows that repeat an id are texts of their own, and rows without one are unlabelled."""
    if not len(model.chosen) or not rounds:
        return model
    marked = positives.select(F.col(id_col).alias("__id"), F.lit(1).alias("positive"))
    rows = texts.join(marked, F.col(id_col) == F.col("__id"), "left")
    grouped = rows.groupBy("places").agg(F.sum(F.coalesce("positive", F.lit(0))).cast("long").alias("positives"), F.count(F.lit(1)).alias("texts"))
    # Texts alike are one row.
    patterns = C.materialize(grouped, "toxicity-patterns", rows=texts.count())
    n = patterns.agg(F.sum("positives").alias("p"), F.sum("texts").alias("u")).first()
    if not n["p"]:
        return model
    k, width = len(model.bias), len(model.chosen) + 2
    adams = [_Adam(width - 1, rate) for _ in range(k)]
    for _ in range(rounds):
        parts = patterns.coalesce(GRADIENTS).mapInArrow(_gradients(model), "sums binary").collect()
        sums = np.sum(sorted((np.frombuffer(bytes(r["sums"]), dtype="<f8") for r in parts), key=lambda x: x.tobytes()), axis=0).reshape(k, 2, width)
        weights, bias = model.weights.copy(), model.bias.copy()
        for j, adam in enumerate(adams):
            p, u = sums[j, 0] / n["p"], sums[j, 1] / n["u"]
            _, grad = corrected(model.prior, p[-1], u[-1], p[:-1], u[:-1])
            grad[:-1] += DECAY * weights[j]
            step = adam.step(grad)
            weights[j] -= step[:-1]
            bias[j] -= step[-1]
        model = replace(model, weights=weights, bias=bias)
    C.remove(patterns.stored_at)
    return model


_SCORED = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]


def _scored(batch: pa.RecordBatch, keep: range, s: np.ndarray, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=names)


def score(docs: DataFrame, model: Classifier, text_col: str = "text") -> DataFrame:
    """All columns of docs, score (0 to 1, higher: likelier toxic) and predicted (1 if score >= 0.5, else 0). Null and
    empty texts have no features and get the score of the bias. Input columns with the names of the new ones are replaced."""
    C.short_batches(docs.sparkSession)
    rest = [c for c in docs.columns if c not in ("score", "predicted")]
    given = docs.select(*[F.col(c).cast("string").alias(c) if c == text_col else F.col(c) for c in rest])
    schema, text_at = T.StructType([*given.schema.fields, *_SCORED]), rest.index(text_col)

    def run(batches):
        cache = _Found(model.grams)
        for batch in batches:
            at, of = _flat(_lists([_places(model, cache, t) for t in batch.column(text_at).to_pylist()]))
            yield _scored(batch, range(len(rest)), model.scores(at, of, batch.num_rows), schema.names)

    return given.mapInArrow(run, schema)


def score_features(texts: DataFrame, model: Classifier, name: str = "places") -> DataFrame:
    """As score, of a table of features_of; the features go."""
    rest = [c for c in texts.columns if c not in ("score", "predicted", name)]
    given = texts.select(*rest, name)
    schema = T.StructType([*given.schema.fields[:-1], *_SCORED])

    def run(batches):
        for batch in batches:
            yield _scored(batch, range(len(rest)), model.scores(*_flat(batch.column(len(rest))), batch.num_rows), schema.names)

    return given.mapInArrow(run, schema)


def _own() -> Column:
    """Whether a row isn't held out."""
    return C.text_remainder(F.col("doc_id")) != 0


def _learnable(labels: DataFrame) -> DataFrame:
    """(doc_id, positive) of labelled ids whose crc32 remainder isn't 0."""
    learn = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & _own())
    return learn.groupBy("doc_id").agg((F.max("toxic") == 1).alias("positive"))


def train_on_labels(docs: DataFrame, labels: DataFrame) -> Classifier:
    """The production setting: positives are labelled toxic = 1, and the prior is the toxic share, among labelled ids
    whose crc32 remainder isn't 0. An id labelled more than once counts once, toxic if any label says so; rows without
    an id or a label are left out. Texts of held-out ids take no part in training."""
    return _train(docs.filter(_own()), labels)[0]


def _train(docs: DataFrame, labels: DataFrame, carry: tuple[str, ...] = ()) -> tuple[Classifier, DataFrame]:
    """The classifier, and the features of all docs (doc_id, carry and places)."""
    learn = _learnable(labels)
    share = learn.agg(F.avg(F.col("positive").cast("double")).alias("p")).first()["p"]
    first = fit_sample(docs.filter(_own()), learn, share)
    texts = C.materialize(features_of(docs.select("doc_id", "text", *carry), first), "toxicity-features")
    return refine(first, texts.filter(_own()), learn.filter("positive")), texts


def train_and_score(docs: DataFrame, labels: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, carry, score, predicted) of all docs by train_on_labels' classifier; texts are read for features once."""
    model, texts = _train(docs, labels, carry)
    return score_features(texts, model)


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    """Scores every document for toxicity."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scored = train_and_score(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.select("doc_id", (C.text_remainder(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted")
