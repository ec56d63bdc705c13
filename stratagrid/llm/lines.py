"""Line deduplication: Bloom filters find the line keys seen twice; only those lines are shuffled.

1. Each task reads its documents and keeps a Bloom filter of the keys seen and the exact set of those seen twice. A key
   leaves the task at its first and at its second sighting only, as 8 bytes of hash.
2. The hashes meet by hash range, each range again with a filter and a set of its own. A second sighting makes a suspect.
   The filter has no false negatives and never holds a suspect back, so every repeated key is a suspect; a false positive
   only adds one.
3. Suspected lines, and no others, are shuffled with their SHA-256 for the exact count of documents and the largest id.
4. Keys in enough documents are written as sorted hash arrays that the last pass maps into memory.

Filters and sets are per task and per hash range and grow by layers, so their size follows a task's share, not the corpus.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

SPACE = b" \t\n\x0b\x0c\r"
#: Distinct keys of one hash range at most, as far as the bytes of the texts tell.
RANGE_KEYS = 1 << 23


class Bloom:
    """A Bloom filter over well-mixed 64-bit hashes that adds a layer of twice the size when one is full."""

    PROBES = 6

    def __init__(self, log2_bits: int = 20):
        self.layers: list[tuple[int, np.ndarray]] = []
        self.log2_bits, self.room = log2_bits - 1, 0

    def _positions(self, h: np.ndarray, log2: int) -> list[np.ndarray]:
        step = (h * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        # Not from 0: the leading bits of the hashes of a range are equal.
        return [(h + np.uint64(i) * step) >> np.uint64(64 - log2) for i in range(1, self.PROBES + 1)]

    def has(self, h: np.ndarray) -> np.ndarray:
        out = np.zeros(len(h), dtype=bool)
        for log2, words in self.layers:
            hit = np.ones(len(h), dtype=bool)
            for p in self._positions(h, log2):
                hit &= (words[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1) > 0
            out |= hit
        return out

    def add(self, h: np.ndarray) -> None:
        while len(h):
            if self.room <= 0:
                self.log2_bits += 1
                self.layers.append((self.log2_bits, np.zeros(1 << (self.log2_bits - 6), dtype=np.uint64)))
                self.room = (1 << self.log2_bits) // 10
            log2, words = self.layers[-1]
            now, h = h[: self.room], h[self.room :]
            self.room -= len(now)
            for p in self._positions(now, log2):
                np.bitwise_or.at(words, p >> np.uint64(6), np.uint64(1) << (p & np.uint64(63)))


class HashSet:
    """An exact set of 64-bit hashes, as sorted arrays of which each is over twice as long as the next."""

    def __init__(self):
        self.layers: list[np.ndarray] = []

    def has(self, h: np.ndarray) -> np.ndarray:
        out = np.zeros(len(h), dtype=bool)
        for held in self.layers:
            out |= held[np.minimum(np.searchsorted(held, h), len(held) - 1)] == h
        return out

    def add(self, h: np.ndarray) -> None:
        """Adds distinct hashes that it doesn't hold yet."""
        if len(h):
            self.layers.append(np.sort(h))
        while len(self.layers) > 1 and len(self.layers[-2]) <= 2 * len(self.layers[-1]):
            self.layers[-2:] = [np.sort(np.concatenate(self.layers[-2:]))]

    def all(self) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.uint64), *self.layers])


class Sightings:
    """What to pass on of a stream of hashes: each at its first sighting and again at its second one. A false positive of
    the filter takes a first sighting for a second one; nothing takes a second one for a later one."""

    def __init__(self):
        self.once, self.twice = Bloom(), HashSet()

    def see(self, h: np.ndarray, again: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The hashes that are new, and those seen a second time now (again: flags of hashes seen twice elsewhere)."""
        unique, first, counts = np.unique(h, return_index=True, return_counts=True)
        repeated = counts > 1
        if again is not None:
            flagged = np.zeros(len(unique), dtype=bool)
            np.logical_or.at(flagged, np.searchsorted(unique, h), again)
            repeated |= flagged
        known = self.once.has(unique)
        new = unique[~known]
        second = unique[known | repeated]
        second = second[~self.twice.has(second)]
        self.once.add(new)
        self.twice.add(second)
        return new, second


def line_key(line: bytes) -> bytes:
    return line.strip(SPACE).translate(C.LOWER)


def long_enough(key: bytes, least: int) -> bool:
    """At least so many code points: bytes that don't continue a character."""
    return len(key) >= least and (key.isascii() or len(key.decode("utf-8", "replace")) >= least)


def _keys(text: str | None, least: int) -> set[bytes]:
    """SHA-256 of the distinct keys of a text."""
    out = set()
    for line in (text or "").encode().split(b"\n"):
        if len(line) >= least and long_enough(key := line_key(line), least):
            out.add(hashlib.sha256(key).digest())
    return out


def _hash_of(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(d[:8] for d in digests), dtype="<u8").astype(np.uint64)


def _second_of(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(d[8:16] for d in digests), dtype="<i8").astype(np.int64)


def _sight_lines(least: int):
    def run(batches):
        seen = Sightings()
        for batch in batches:
            digests = [d for text in batch.column(0).to_pylist() for d in _keys(text, least)]
            new, second = seen.see(_hash_of(digests))
            h = np.concatenate([new, second])
            if len(h):
                yield pa.record_batch({"h": pa.array(h.view(np.int64)), "again": pa.array(np.r_[np.zeros(len(new), bool), np.ones(len(second), bool)])})

    return run


def _gather_suspects(table: C.SortedTable):
    """Rows (bucket, h, again) of a task, a bucket after another; a bucket's filter and set are held while it is read."""

    def run(batches):
        bucket, seen = None, None

        def written():
            table.write_bucket(bucket, np.sort(seen.twice.all()))
            return pa.record_batch({"bucket": pa.array([bucket], pa.int32())})

        for batch in batches:
            of, h, again = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64), batch.column(2).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]).tolist() if len(of) else []
            for lo, hi in zip(cuts, [*cuts[1:], len(of)], strict=True):
                if of[lo] != bucket:
                    if bucket is not None:
                        yield written()
                    bucket, seen = int(of[lo]), Sightings()
                seen.see(h[lo:hi], again[lo:hi])
        if bucket is not None:
            yield written()

    return run


def _suspected(table: C.SortedTable, least: int):
    def run(batches):
        for batch in batches:
            ids, digests = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = _keys(text, least)
                digests += own
                ids += [doc_id] * len(own)
            hit = np.flatnonzero(table.find(_hash_of(digests))[0])
            if len(hit):
                yield pa.record_batch({"sha": pa.array([digests[i] for i in hit], pa.binary()), "doc_id": pa.array([ids[i] for i in hit], pa.int64())})

    return run


def _drop(table: C.SortedTable, least: int, at: tuple[int, int], names: list[str]):
    id_at, text_at = at

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(id_at).to_pylist(), batch.column(text_at).to_pylist()
            split, digests, place = [], [], []
            for i, text in enumerate(texts):
                lines = (text or "").encode().split(b"\n")
                split.append(lines)
                for j, line in enumerate(lines):
                    if len(line) >= least and long_enough(key := line_key(line), least):
                        digests.append(hashlib.sha256(key).digest())
                        place.append((i, j))
            hit, value = table.find(_hash_of(digests), _second_of(digests))
            gone: dict[int, set[int]] = {}
            for k in np.flatnonzero(hit):
                i, j = place[k]
                if ids[i] is None or ids[i] != int(value["keep"][k]):
                    gone.setdefault(i, set()).add(j)
            out = [b"\n".join(x for j, x in enumerate(lines) if j not in gone[i]).decode() if i in gone else texts[i] for i, lines in enumerate(split)]
            columns = [pa.array(out, pa.string()) if k == text_at else batch.column(k) for k in range(batch.num_columns)]
            columns += [pa.array([len(x) for x in split], pa.int64()), pa.array([len(gone.get(i, ())) for i in range(len(split))], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    r"""Every row of docs, text without its repeated lines, and columns n_lines (before) and n_dropped.

    A line's key is the line without ASCII white space at its ends and with A-Z lower-cased. Keys of at least
    ``min_chars`` code points that ``min_docs`` distinct ids hold lose all their lines but those of the largest id.

    Null and empty texts have one empty line and stay as they are. Rows without an id don't count as documents, and
    lose the lines of every such key. Rows that share an id count as one document, and all of them keep what the
    largest id keeps. An empty table gives an empty result. Other columns are carried along; ones named n_lines or
    n_dropped are replaced.
    """
    spark = docs.sparkSession
    C.short_batches(spark)
    text, doc = F.col(text_col).cast("string"), F.col(id_col).cast("long")
    # A key has min_chars bytes or more, which bounds the keys of a hash range.
    bits = C.fold(spark, C.text_bytes(docs, text_col) // max(1, min_chars), RANGE_KEYS)
    suspects = C.SortedTable(C.new_folder(spark, "line-suspects"), bits)
    sighted = docs.select(text).mapInArrow(_sight_lines(min_chars), "h long, again boolean")
    dealt = C.dealt(sighted.select(C.top_bits(F.col("h"), bits).alias("bucket"), "h", "again"), bits)
    done = {r["bucket"] for r in dealt.mapInArrow(_gather_suspects(suspects), "bucket int").collect()}
    for b in set(range(1 << bits)) - done:
        suspects.write_index(b, [])

    held = docs.select(doc.alias("doc_id"), text.alias("text")).mapInArrow(_suspected(suspects, min_chars), "sha binary, doc_id long")
    repeated = held.groupBy("sha").agg(F.count_distinct("doc_id").alias("n"), F.max("doc_id").alias("keep")).filter(F.col("n") >= min_docs)
    confirmed = C.write_sorted_table(repeated.mapInArrow(_split_digest, "h long, second long, keep long"), "line-keys", ("second", "keep"))

    rest = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    given = docs.select(*[text.alias(c) if c == text_col else F.col(c) for c in rest])
    schema = T.StructType([*given.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    return given.mapInArrow(_drop(confirmed, min_chars, (rest.index(id_col), rest.index(text_col)), schema.names), schema)


def _split_digest(batches):
    for batch in batches:
        digests = batch.column(0).to_pylist()
        yield pa.record_batch({"h": pa.array(_hash_of(digests).view(np.int64)), "second": pa.array(_second_of(digests)), "keep": batch.column(2)})


def op6_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Line deduplication of all documents: per document the lines before and dropped, and the digest of what stays."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    kept = drop_repeated_lines(docs)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH lines AS (
  SELECT doc_id, u.line, u.i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents) d,
         LATERAL (SELECT unnest(l) AS line, generate_subscripts(l, 1) AS i) u),
keyed AS (
  SELECT doc_id, line, i, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
held AS (SELECT k, count(DISTINCT doc_id) AS n, max(doc_id) AS keep FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT a.doc_id, a.line, a.i, h.k IS NOT NULL AND a.doc_id <> h.keep AS gone FROM keyed a LEFT JOIN held h ON a.k = h.k)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(CASE WHEN gone THEN NULL ELSE line END, chr(10) ORDER BY i), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
