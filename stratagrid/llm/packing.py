"""Best-fit packing of token sequences by linear grouping.

Lengths are whole numbers up to the capacity, so the corpus enters the plan as a histogram of at most ``capacity``
counts, whatever its size. On the driver, over that histogram:

1. pieces longer than a fraction of the capacity are put in order and cut into groups of equal cardinality, and each
   length is rounded up to the longest of its group;
2. configurations of these few sizes are optimised: the largest size left, and the fullest complement for it that a
   subset-sum over the other sizes finds, used as often as the groups allow;
3. the actual lengths take the places of the rounded ones; lengths within a group being sorted, this splits a
   configuration into a few runs of bins that are filled alike;
4. short pieces go, longest first, to the run with the smallest gap that takes them.

Few groups lose space by rounding; the short pieces fill what is lost, if enough pieces count as short. How many do that
depends on the lengths, so the plan is made for several edges between short and large, and the best of them is taken.

The plan says for each length which ranks go to which bins and at which offset. It has some thousands of intervals, a
number that depends on the capacity and not on the corpus, and is joined to the ranked pieces as a broadcast.
"""

from __future__ import annotations

import base64
import json
import re
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common as C

# ---- tokens ------------------------------------------------------------------------------------------------------


class Tokens:
    """Token ids by the vocabulary of ``json_path``, without the special tokens that it would add around a text; names
    of its tokens that stand in a text are those tokens. Where a text has Latin-1 characters and no such name, the same
    vocabulary as a rank file (``ranks_path``) gives the same ids several times faster; tests compare both."""

    def __init__(self, json_path: str, ranks_path: str | None = None, pattern: str | None = None):
        self.json_path, self.slow, self.fast, self.named = json_path, None, None, None
        if ranks_path:
            import tiktoken

            with open(json_path, "rb") as file:
                named = [t["content"] for t in json.load(file)["added_tokens"]]
            self.named = re.compile("|".join(map(re.escape, named))) if named else None
            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.fast is not None and not (self.named and self.named.search(text)):
            try:
                text.encode("latin-1")
                return np.array(self.fast.encode_ordinary(text), dtype="<u4")
            except UnicodeEncodeError:
                pass
        if self.slow is None:  # only few texts need it, and it is large
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(self.json_path)
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype="<u4")


_tokens: dict[tuple, Tokens] = {}


def public_vocabulary() -> tuple[str, str, str]:
    """Places of the 50k byte-level vocabulary in both formats, and the pattern of the rank format."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def _cut(capacity: int, end_id: int, vocabulary: tuple[str, ...]):
    def run(batches):
        from pyspark import TaskContext

        tokens = _tokens.get(vocabulary) or _tokens.setdefault(vocabulary, Tokens(*vocabulary))
        part, seen = TaskContext.get().partitionId(), defaultdict(int)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.append(tokens.ids(text or ""), np.uint32(end_id)).astype("<u4")
                n = len(ids)
                first = n if n <= capacity else (n % capacity or capacity)
                starts = [0, *range(first, n, capacity)]
                for piece, (a, b) in enumerate(zip(starts, [*starts[1:], n], strict=True)):
                    rows.append((doc_id, piece, a, b - a, seen[b - a], ids[a:b].tobytes()))
                    seen[b - a] += 1
            if rows:
                ids, piece, start, length, nth, data = zip(*rows, strict=True)
                yield pa.record_batch({"doc_id": pa.array(ids, pa.int64()), "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()), "part": pa.array([part] * len(rows), pa.int32()), "nth": pa.array(nth, pa.int64()), "ids": pa.array(data, pa.binary())})

    return run


# ---- the plan ----------------------------------------------------------------------------------------------------

#: Groups of large lengths, so the number of sizes that configurations are made of.
GROUPS = 64
#: Shares of the capacity up to which pieces are small.
SMALL = (1 / 16, 1 / 4, 1 / 2)


@dataclass
class Run:
    """Bins filled alike: of each (length, first rank) in places, bin i holds the piece of rank first + i."""

    count: int
    gap: int
    places: list[tuple[int, int]] = field(default_factory=list)

    def split(self, k: int) -> tuple[Run, Run]:
        return Run(k, self.gap, list(self.places)), Run(self.count - k, self.gap, [(s, r + k) for s, r in self.places])


def _groups(lengths: list[int], counts: dict[int, int], groups: int) -> list[list[tuple[int, int]]]:
    """Lengths, longest first, dealt into groups of equal cardinality: each a list of (length, how many)."""
    total = sum(counts[s] for s in lengths)
    per, out, room = max(1, -(-total // groups)), [], 0
    for s in lengths:
        left = counts[s]
        while left:
            if room == 0:
                out.append([])
                room = per
            k = min(left, room)
            out[-1].append((s, k))
            left, room = left - k, room - k
    return out


def _complement(space: int, sizes: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Uses of (index, times) whose sizes fill most of space. sizes: (size, how many are left), largest first."""
    came = np.full(space + 1, -1, dtype=np.int32)
    reach = np.zeros(space + 1, dtype=bool)
    reach[0] = True
    for index, (size, left) in enumerate(sizes):
        if size > space:
            continue
        for _ in range(min(left, space // size)):
            more = np.zeros_like(reach)
            more[size:] = reach[:-size]
            more &= ~reach
            if not more.any():
                break
            came[more] = index
            reach |= more
        if reach[space]:
            break
    at, uses = int(np.flatnonzero(reach)[-1]), defaultdict(int)
    while at:
        uses[int(came[at])] += 1
        at -= sizes[came[at]][0]
    return list(uses.items())


def plan(histogram: dict[int, int], capacity: int, groups: int = GROUPS, small: float | tuple[float, ...] = SMALL) -> list[Run]:
    """Runs of bins that hold ``histogram[length]`` pieces of each length; of several edges between large and small
    pieces, those of the one that needs the fewest bins."""
    if isinstance(small, tuple):
        return min((plan(histogram, capacity, groups, s) for s in small), key=lambda runs: sum(r.count for r in runs))
    runs, ranks = [], defaultdict(int)
    if full := histogram.get(capacity, 0):
        runs.append(Run(full, 0, [(capacity, 0)]))
    edge = int(capacity * small)
    large = sorted((s for s, n in histogram.items() if n and edge < s < capacity), reverse=True)
    grouped = _groups(large, histogram, groups)
    left: list[list[tuple[int, int]]] = [list(g) for g in grouped]
    size, many = [g[0][0] for g in grouped], [sum(k for _, k in g) for g in grouped]

    def take(g: int, n: int) -> list[tuple[int, int, int]]:
        """The n longest pieces that are left of group g, as (length, first rank, how many)."""
        many[g] -= n
        out = []
        while n:
            s, k = left[g][0]
            now = min(k, n)
            out.append((s, ranks[s], now))
            ranks[s] += now
            n -= now
            left[g][0] = (s, k - now)
            if k == now:
                left[g].pop(0)
        return out

    for g in range(len(grouped)):
        while many[g]:
            alive = [h for h in range(g, len(grouped)) if many[h]]
            uses = defaultdict(int, {g: 1})
            for i, times in _complement(capacity - size[g], [(size[h], many[h] - (h == g)) for h in alive]):
                uses[alive[i]] += times
            n = min(many[h] // t for h, t in uses.items())
            slots = [take(h, n) for h, t in uses.items() for _ in range(t)]
            while n:  # as long as no slot changes its length, bins are alike
                k = min(slot[0][2] for slot in slots)
                runs.append(Run(k, capacity - sum(slot[0][0] for slot in slots), [(slot[0][0], slot[0][1]) for slot in slots]))
                n -= k
                for slot in slots:
                    s, r, m = slot.pop(0)
                    if m > k:
                        slot.insert(0, (s, r + k, m - k))
    by_gap: dict[int, list[Run]] = defaultdict(list)
    for run in runs:
        by_gap[run.gap].append(run)
    for s in sorted((s for s, n in histogram.items() if n and s <= min(edge, capacity - 1)), reverse=True):
        n, rank = histogram[s], 0
        while n:
            gap = next((g for g in range(s, capacity + 1) if by_gap.get(g)), None)
            if gap is None:
                each = min(capacity // s, n)
                run = Run(n // each, capacity, [])
                k = run.count
                run.places = [(s, rank + j * k) for j in range(each)]
                run.gap -= s * each
                by_gap[run.gap].append(run)
                rank, n = rank + k * each, n - k * each
                continue
            run = by_gap[gap].pop()
            if run.count > n:
                run, rest = run.split(n)
                by_gap[gap].append(rest)
            run.places.append((s, rank))
            run.gap -= s
            by_gap[run.gap].append(run)
            rank, n = rank + run.count, n - run.count
    return [r for g in sorted(by_gap) for r in by_gap[g]]


def intervals(runs: list[Run]) -> list[tuple[int, int, int, int, int]]:
    """(length, from rank, to rank, sequence of the first, offset) of all places."""
    out, base = [], 0
    for run in runs:
        at = 0
        for length, rank in run.places:
            out.append((length, rank, rank + run.count, base, at))
            at += length
        base += run.count
    return out


# ---- the operator ------------------------------------------------------------------------------------------------


@dataclass
class Packed:
    """pieces: each piece with its token ids (little-endian unsigned 32-bit); placed: where each goes, without ids."""

    pieces: DataFrame
    placed: DataFrame

    def sequences(self) -> DataFrame:
        """The packed sequences: sequence_id, n_tokens and ids, the bytes of its pieces in order."""
        key = ["part", "length", "nth"]
        parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
        return self.placed.join(self.pieces.select(*key, "ids"), key).groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("parts")).select(
            "sequence_id", "n_tokens", F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"))


def pack(docs: DataFrame, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", vocabulary: tuple[str, ...] | None = None, groups: int = GROUPS, small: float | tuple[float, ...] = SMALL) -> Packed:
    """Cuts each document's tokens and end id into pieces of at most ``capacity`` and packs them into sequences.

    Only documents longer than the capacity are cut; their first piece takes the remainder. Null and empty texts are a
    piece with the end id alone. Rows that repeat an id, or lack one, are packed like any other row. Very long texts are
    tokenized whole. An empty table gives no pieces. Other columns of docs are ignored.
    """
    spark = docs.sparkSession
    C.short_batches(spark)
    cut = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        _cut(capacity, end_id, vocabulary or public_vocabulary()), "doc_id long, piece int, start long, length long, part int, nth long, ids binary")
    pieces = C.materialize(cut.withColumn("ids_crc32", F.crc32("ids")), "pieces", compression="zstd")
    # The rank of a piece among those of its length: those of earlier tasks, and its number within the task.
    per_task = C.materialize(pieces.groupBy("length", "part").count(), "lengths", rows=pieces.count())
    histogram = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    before = per_task.select("length", "part", (F.sum("count").over(Window.partitionBy("length").orderBy("part")) - F.col("count")).alias("before"))
    steps = intervals(plan(histogram, capacity, groups, small)) or [(0, 0, 0, 0, 0)]
    table = spark.createDataFrame(steps, "length long, lo long, hi long, base long, offset long")
    ranked = pieces.drop("ids").join(before, ["length", "part"]).withColumn("rank", F.col("before") + F.col("nth")).alias("p")
    here = (F.col("p.length") == F.col("t.length")) & (F.col("p.rank") >= F.col("t.lo")) & (F.col("p.rank") < F.col("t.hi"))
    placed = ranked.join(F.broadcast(table.alias("t")), here).select(
        "doc_id", "piece", "start", "p.length", "ids_crc32", (F.col("t.base") + F.col("p.rank") - F.col("t.lo")).alias("sequence_id"), "t.offset", "part", "nth")
    return Packed(pieces, placed)


def op3_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences of at most 1024 tokens; one row per piece."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack(docs).placed.drop("part", "nth")
