"""An interpolated modified Kneser-Ney bigram model: counted in Spark, stored as sorted hash arrays, mapped by workers.

Words are known by 64-bit hashes. The sorted array of a corpus' word hashes, split by their leading bits, is the
vocabulary, and a word's id is its place in it. A bigram is one 64-bit number made of two ids, multiplied by an odd
constant: a bijection that deals bigrams evenly over shards by leading bits, whatever their words, so a very common word
or pair is no hot shard. Tasks count in numpy and send each shard one sorted, delta-coded, compressed block, so a
bigram costs a few bytes of shuffle, and a pair that fills a third of a corpus costs one entry a block.

All sizes grow with the corpus and none is collected: the driver keeps totals, and workers map the arrays and look up
sorted queries.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

ODD = np.uint64(0x9E3779B97F4A7C15)
BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
END = b"\n"
#: Ids have 32 bits; the start of a text is the largest, and serves as a context only.
START, UNKNOWN = np.int64((1 << 32) - 1), np.int64((1 << 32) - 2)
#: Bytes of text of one shard of words or bigrams, about.
SHARD_BYTES = 64 << 20
#: Words whose hashes a worker remembers at most.
REMEMBERED = 1 << 20


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(C.LOWER).split()


class WordHashes(dict):
    """word -> hash; forgets everything when it holds REMEMBERED words."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh3_64_intdigest

        if len(self) >= REMEMBERED:
            self.clear()
        h = self[word] = xxh3_64_intdigest(word)
        return h


def _encode(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted distinct keys and their counts, packed."""
    gaps = np.diff(keys, prepend=np.uint64(0))
    small = np.minimum(counts, 255).astype(np.uint8)
    over = counts[counts >= 255].astype("<i8")
    planes = np.ascontiguousarray(gaps.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    used = max((8 - i for i in range(8) if planes[7 - i].any()), default=0)
    body = planes[:used].tobytes() + small.tobytes() + over.tobytes()
    return np.array([len(keys), used, len(over)], dtype="<i8").tobytes() + zlib.compress(body, 1)


def _decode(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, used, over = np.frombuffer(block[:24], dtype="<i8")
    body = zlib.decompress(block[24:])
    planes = np.zeros((8, n), dtype=np.uint8)
    planes[:used] = np.frombuffer(body, dtype=np.uint8, count=used * n).reshape(used, n)
    keys = np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)
    counts = np.frombuffer(body, dtype=np.uint8, count=n, offset=used * n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(body, dtype="<i8", count=over, offset=(used + 1) * n)
    return keys, counts


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of counts by key, keys in order."""
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys, counts = np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _by_shard(keys: np.ndarray, counts: np.ndarray, bits: int):
    """Blocks of sorted keys by leading bits."""
    where = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    cuts = np.searchsorted(where, np.arange((1 << bits) + 1))
    rows = [(b, _encode(keys[lo:hi], counts[lo:hi])) for b, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if hi > lo]
    return pa.record_batch({"shard": pa.array([b for b, _ in rows], pa.int32()), "block": pa.array([x for _, x in rows], pa.binary())}) if rows else None


class Counter:
    """Counts keys in numpy, and gives them out by shard whenever it holds too many."""

    def __init__(self, bits: int, most: int = 1 << 21):
        self.bits, self.most, self.parts, self.held = bits, most, [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray | None = None):
        if counts is None:
            keys, counts = np.unique(keys, return_counts=True)
        self.parts.append((keys, counts))
        self.held += len(keys)
        if self.held > self.most:
            self.parts = [_merge(self.parts)]
            self.held = len(self.parts[0][0])
            if self.held > self.most // 2:
                yield from self.flush()

    def flush(self):
        if (out := _by_shard(*_merge(self.parts), self.bits)) is not None:
            yield out
        self.parts, self.held = [], 0


def _blocks(batches):
    """(shard, keys, counts) of the sorted rows (shard, block) of one task, a shard at a time."""
    last, parts = None, []
    for batch in batches:
        for shard, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if shard != last:
                if last is not None:
                    yield (last, *_merge(parts))
                last, parts = shard, []
            parts.append(_decode(block))
            if len(parts) > 32:
                parts = [_merge(parts)]
    if last is not None:
        yield (last, *_merge(parts))


# ---- counting ----------------------------------------------------------------------------------------------------


def _count_words(bits: int):
    def run(batches):
        counter, hashes = Counter(bits), WordHashes()
        for batch in batches:
            words = [w for t in batch.column(0).to_pylist() for w in (*words_of(t), END)]
            yield from counter.add(np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words)))
        yield from counter.flush()

    return run


def _write_words(folder: str):
    def run(batches):
        for shard, keys, counts in _blocks(batches):
            C.put_array(folder, f"words-{shard}", keys)
            C.put_array(folder, f"counts-{shard}", counts)
            yield pa.record_batch({"shard": pa.array([shard], pa.int32()), "n": pa.array([len(keys)], pa.int64()), "tokens": pa.array([int(counts.sum())], pa.int64())})

    return run


@dataclass
class Vocabulary:
    """Word hashes in order, by leading bits; starts[b] is the id of the first word of bucket b."""

    folder: str
    bits: int
    starts: np.ndarray
    tokens: int

    @property
    def size(self) -> int:
        return int(self.starts[-1])

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids (UNKNOWN where there is none) and counts (0) of sorted distinct hashes."""
        ids, counts = np.full(len(hashes), UNKNOWN, dtype=np.int64), np.zeros(len(hashes), dtype=np.int64)
        where = (hashes >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(hashes), np.int64)
        cuts = np.searchsorted(where, np.arange((1 << self.bits) + 1))
        for b in np.flatnonzero(cuts[1:] > cuts[:-1]):
            if self.starts[b + 1] == self.starts[b]:
                continue
            lo, hi = cuts[b], cuts[b + 1]
            keys = C.get_array(self.folder, f"words-{b}")
            at = np.minimum(np.searchsorted(keys, hashes[lo:hi]), len(keys) - 1)
            hit = keys[at] == hashes[lo:hi]
            ids[lo:hi][hit] = self.starts[b] + at[hit]
            counts[lo:hi][hit] = C.get_array(self.folder, f"counts-{b}")[at[hit]]
        return ids, counts

    def ids(self, words: list[bytes], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
        """Ids and counts of words."""
        h = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
        unique, back = np.unique(h, return_inverse=True)
        ids, counts = self.look_up(unique)
        return ids[back], counts[back]


def _tokens(texts: list[str | None]) -> tuple[list[bytes], np.ndarray]:
    """All tokens of the texts, each text's followed by END, and how many of each text."""
    words, lengths = [], []
    for t in texts:
        w = words_of(t)
        words += w
        words.append(END)
        lengths.append(len(w) + 1)
    return words, np.array(lengths, dtype=np.int64)


def _bigrams(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Mixed keys of (previous, this) for each token; the first token of a text follows START."""
    before = np.r_[START, ids[:-1]] if len(ids) else ids
    before[np.cumsum(lengths)[:-1]] = START
    before[:1] = START
    return ((before.astype(np.uint64) << np.uint64(32)) | ids.astype(np.uint64)) * ODD


def _count_bigrams(vocabulary: Vocabulary, bits: int):
    def run(batches):
        counter, hashes = Counter(bits), WordHashes()
        for batch in batches:
            words, lengths = _tokens(batch.column(0).to_pylist())
            yield from counter.add(_bigrams(vocabulary.ids(words, hashes)[0], lengths))
        yield from counter.flush()

    return run


#: Of a context: the sum of its counts, and how many of its bigrams have count 1, 2, and 3 or more.
STATS = ("total", "n1", "n2", "n3")


def _tally(keys: np.ndarray, counts: np.ndarray):
    """By key, the statistics of the counts that stand beside it."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    sums = [np.add.reduceat(x.astype(np.int64), first) if len(first) else np.zeros(0, np.int64) for x in (counts, counts == 1, counts == 2, counts >= 3)]
    return keys[first], sums


def _write_bigrams(folder: str, id_bits: int, slices: int):
    """Writes each shard of bigrams and gives its shares of the statistics of contexts and continuations, by slices of
    ids: what = 0: a context's STATS; what = 1: how many contexts a word follows; what = 2: counts of counts."""

    def run(batches):
        width = max(1, -(-(1 << id_bits) // slices))
        for shard, keys, counts in _blocks(batches):
            C.put_array(folder, f"pairs-{shard}", keys)
            C.put_array(folder, f"paircounts-{shard}", counts.astype(np.uint32 if counts.max(initial=0) < 1 << 32 else np.int64))
            plain = keys * BACK
            context, sums = _tally((plain >> np.uint64(32)).astype(np.int64), counts)
            word, follows = np.unique((plain & np.uint64((1 << 32) - 1)).astype(np.int64), return_counts=True)
            rows = []
            for what, ids, columns in ((0, context, sums), (1, word, [follows.astype(np.int64)])):
                place = np.where(ids == START, 0, np.minimum(ids // width, slices - 1))
                for s in np.unique(place):
                    m = place == s
                    rows.append((int(s), what, zlib.compress(np.stack([ids[m], *(c[m] for c in columns)]).astype("<i8").tobytes(), 1)))
            have = np.bincount(np.minimum(counts, 5), minlength=6)[1:5]
            rows.append((-1, 2, have.astype("<i8").tobytes()))
            a, b, c = zip(*rows, strict=True)
            yield pa.record_batch({"slice": pa.array(a, pa.int32()), "what": pa.array(b, pa.int32()), "block": pa.array(c, pa.binary())})

    return run


def _slice_sums(blocks: list[bytes], low: int, high: int, columns: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums by id in [low, high), and of START."""
    out, start = np.zeros((columns, max(0, high - low)), dtype=np.int64), np.zeros(columns, dtype=np.int64)
    for block in blocks:
        x = np.frombuffer(zlib.decompress(block), dtype="<i8").reshape(columns + 1, -1)
        inner = (x[0] >= low) & (x[0] < high)
        for k in range(columns):
            np.add.at(out[k], x[0][inner] - low, x[k + 1][inner])
            start[k] += x[k + 1][x[0] == START].sum()
    return out, start


def _write_slices(folder: str, size: int, width: int):
    """Rows of one slice of ids after another: sums the shares and writes the arrays of the slice; gives counts of
    continuation counts."""

    def written(s: int, blocks: dict[int, list[bytes]]):
        low, high = s * width, min(size, (s + 1) * width)
        stats, start = _slice_sums(blocks[0], low, high, len(STATS))
        follows, _ = _slice_sums(blocks[1], low, high, 1)
        C.put_array(folder, f"contexts-{s}", np.ascontiguousarray(stats.T))
        C.put_array(folder, f"follows-{s}", follows[0])
        if s == 0:
            C.put_array(folder, "start", start)
        have = np.bincount(np.minimum(follows[0], 5), minlength=6)
        return pa.record_batch({"have": pa.array([[*have[1:5].tolist(), int(follows[0].sum()), int((follows[0] >= 3).sum())]], pa.list_(pa.int64()))})

    def run(batches):
        last, blocks = None, {0: [], 1: []}
        for batch in batches:
            for s, what, block in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if s != last:
                    if last is not None:
                        yield written(last, blocks)
                    last, blocks = s, {0: [], 1: []}
                blocks[what].append(block)
        if last is not None:
            yield written(last, blocks)

    return run


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts 1, 2, 3 and more, from how many n-grams have count 1, 2, 3 and 4. A
    count of counts of zero makes the formula undefined; such a discount falls back to 0.5, 0.75 or 0.9 of its range. A
    discount is held within 0.05 and 0.95 of its count, since small corpora, whose counts of counts don't fall steadily,
    give some at or beyond the ends, where a word would get no probability or none would be spared."""
    n1, n2, n3, n4 = n
    y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.5
    out = []
    for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), start=1):
        d = k - (k + 1) * y * b / a if a else (0.5, 0.75, 0.9)[k - 1] * k
        out.append(min(max(d, 0.05 * k), 0.95 * k))
    return tuple(out)


@dataclass
class Model:
    vocabulary: Vocabulary
    folder: str
    bits: int
    slices: int
    width: int
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    #: Distinct bigrams, and how many words follow 1, 2, 3 or more contexts.
    pairs: int
    words: tuple[int, int, int]

    def _by_slice(self, name: str, ids: np.ndarray, columns: int) -> np.ndarray:
        """Rows of a sliced array for sorted distinct ids below the vocabulary's size; zeros for others."""
        out = np.zeros((len(ids), columns), dtype=np.int64)
        if not self.pairs:
            return out
        inside = ids < self.vocabulary.size
        where = np.where(inside, ids // self.width, -1)
        for s in np.unique(where[inside]):
            m = where == s
            out[m] = C.get_array(self.folder, f"{name}-{s}")[ids[m] - s * self.width].reshape(-1, columns)
        return out

    def _pair_counts(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), dtype=np.int64)
        if not self.pairs:
            return out
        where = (keys >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(keys), np.int64)
        cuts = np.searchsorted(where, np.arange((1 << self.bits) + 1))
        for b in np.flatnonzero(cuts[1:] > cuts[:-1]):
            lo, hi = cuts[b], cuts[b + 1]
            held = C.get_array(self.folder, f"pairs-{b}")
            if len(held):
                at = np.minimum(np.searchsorted(held, keys[lo:hi]), len(held) - 1)
                out[lo:hi] = np.where(held[at] == keys[lo:hi], C.get_array(self.folder, f"paircounts-{b}")[at], 0)
        return out

    def word_probability(self, ids: np.ndarray) -> np.ndarray:
        """Discounted share of contexts that a word follows, mixed with the uniform distribution over the words and one
        unknown word."""
        uniform = 1.0 / (self.vocabulary.size + 1)
        if not self.pairs:
            return np.full(len(ids), uniform)
        follows = self._by_slice("follows", ids, 1)[:, 0]
        d = np.array([0.0, *self.word_discounts])[np.minimum(follows, 3)]
        spare = float(np.dot(self.word_discounts, self.words)) / self.pairs
        return (follows - d) / self.pairs + spare * uniform

    def log10(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """log10 probability of each token given the one before it."""
        keys, back = np.unique(_bigrams(ids, lengths), return_inverse=True)
        plain = keys * BACK
        context, at = np.unique((plain >> np.uint64(32)).astype(np.int64), return_inverse=True)
        stats = self._by_slice("contexts", context, len(STATS))
        if self.pairs and len(context) and context[-1] == START:
            stats[-1] = C.get_array(self.folder, "start")
        word, of = np.unique((plain & np.uint64((1 << 32) - 1)).astype(np.int64), return_inverse=True)
        lower = self.word_probability(word)[of]
        total = stats[:, 0].astype(np.float64)
        spare = stats[:, 1:] @ np.array(self.pair_discounts)
        count = self._pair_counts(keys)
        d = np.array([0.0, *self.pair_discounts])[np.minimum(count, 3)]
        seen = total[at] > 0
        safe = np.where(seen, total[at], 1.0)
        p = np.where(seen, (count - d) / safe + spare[at] / safe * lower, lower)
        return np.log10(p)[back]


def train(texts: DataFrame, text_col: str = "text") -> Model:
    """Counts the texts of a DataFrame and writes the model into the shared folder. Null texts count as empty: each text
    is its words and one end. An empty table gives a model that knows no word and takes all words as equally likely."""
    spark = texts.sparkSession
    C.short_batches(spark)
    given = texts.select(F.col(text_col).cast("string").alias("text"))
    # A shard's words and bigrams are merged in one worker, so there are as many shards as the texts need.
    folder, bits = C.new_folder(spark, "ngram"), C.fold(spark, C.text_bytes(given), SHARD_BYTES)
    counted = C.dealt(given.mapInArrow(_count_words(bits), "shard int, block binary"), bits, "shard")
    sizes, tokens = np.zeros(1 << bits, dtype=np.int64), 0
    for r in counted.mapInArrow(_write_words(folder), "shard int, n long, tokens long").collect():
        sizes[r["shard"]] = r["n"]
        tokens += r["tokens"]
    vocabulary = Vocabulary(folder, bits, np.r_[0, np.cumsum(sizes)], tokens)
    if vocabulary.size >= UNKNOWN:
        raise ValueError("more distinct words than ids")
    for b in np.flatnonzero(sizes == 0):
        C.put_array(folder, f"words-{b}", np.zeros(0, np.uint64))
        C.put_array(folder, f"counts-{b}", np.zeros(0, np.int64))
    if not tokens:
        return Model(vocabulary, folder, 0, 1, 1, (0.5, 0.5, 0.5), (0.5, 0.5, 0.5), 0, (0, 0, 0))
    slices = 1 << bits
    id_bits = max(1, vocabulary.size.bit_length())
    width = max(1, -(-(1 << id_bits) // slices))
    pairs = C.dealt(given.mapInArrow(_count_bigrams(vocabulary, bits), "shard int, block binary"), bits, "shard")
    shares = C.materialize(pairs.mapInArrow(_write_bigrams(folder, id_bits, slices), "slice int, what int, block binary"), "ngram-shares")
    # Counts of counts: a row of four numbers a shard.
    have = np.sum([np.frombuffer(bytes(r["block"]), dtype="<i8") for r in shares.filter("what = 2").collect()], axis=0).tolist()
    written = {b for b in range(1 << bits)}
    sums = C.dealt(shares.filter("what < 2"), bits, "slice").mapInArrow(_write_slices(folder, vocabulary.size, width), "have array<long>").collect()
    totals = np.sum([r["have"] for r in sums], axis=0)
    C.remove(shares.stored_at)
    for b in written:
        _ensure(folder, f"pairs-{b}", np.uint64)
        _ensure(folder, f"paircounts-{b}", np.uint32)
    n1, n2, n3, n4, all_pairs, n3_more = (int(x) for x in totals)
    return Model(vocabulary, folder, bits, slices, width, discounts(have), discounts([n1, n2, n3, n4]), all_pairs, (n1, n2, n3_more))


def _ensure(folder: str, name: str, kind) -> None:
    import pyarrow.fs as pafs

    fs, base = pafs.FileSystem.from_uri(folder)
    if fs.get_file_info(f"{base}/{name}.npy").type == pafs.FileType.NotFound:
        C.put_array(folder, name, np.zeros(0, kind))


def _score(model: Model):
    def run(batches):
        hashes, size, total = WordHashes(), model.vocabulary.size, model.vocabulary.tokens
        for batch in batches:
            words, lengths = _tokens(batch.column(1).to_pylist())
            ids, counts = model.vocabulary.ids(words, hashes)
            first = np.r_[0, np.cumsum(lengths)[:-1]]
            sums = lambda x: np.add.reduceat(x, first) if len(first) else x[:0]  # noqa: E731, B023
            base = np.log10((counts + 0.5) / (total + 0.5 * (size + 1)))
            yield pa.record_batch({
                "doc_id": batch.column(0), "n_tokens": pa.array(lengths), "n_known": pa.array(sums((counts > 0).astype(np.int64))),
                "train_tokens": pa.array(np.full(len(lengths), total, dtype=np.int64)), "base_score": pa.array(sums(base)), "score": pa.array(sums(model.log10(ids, lengths))),
            })

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, n_known, train_tokens, base_score (unigram, additive) and score (the model's), both log10
    probabilities of the whole text and its end. Null texts are empty. Rows that repeat or lack an id are scored alike."""
    C.short_batches(docs.sparkSession)
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(_score(model), "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def perplexity(scored: DataFrame) -> DataFrame:
    """Adds a text's perplexity under the model."""
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def op4_lm_scoring(spark, sf_dir: str) -> DataFrame:
    """Scores all documents by a model of those whose crc32 remainder isn't 1."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs.filter(C.text_remainder(F.col("doc_id")) != 1))
    scored = perplexity(score(docs, model))
    return scored.select("doc_id", (C.text_remainder(F.col("doc_id")) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")
