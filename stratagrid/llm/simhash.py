"""SimHash near-duplicates: fingerprints, shards of BK-trees, components.

Fingerprints that differ in at most ``radius`` of 64 bits agree in at least ``blocks - radius`` of ``blocks`` blocks of
bits, so each distinct fingerprint goes to one shard for each choice of so many blocks and every link lies in some
shard. A shard's fingerprints make a BK-tree, whose children are keyed by their Hamming distance to the parent; a
search follows only the edges within the radius of the query's distance. Shards that hold very many fingerprints are
dealt anew by a part of the remaining bits, by the same argument, again and again until none outgrows a task.

Linked fingerprints join a forest while a shard is searched, and a shard returns the edges of its forest, fewer than it
has fingerprints, never all pairs. A tree travels to its shard's queries by shuffle instead of a broadcast, since the
fingerprints of a corpus have no proven bound.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

BITS = 64
#: A shard with more fingerprints than this is dealt anew.
SHARD_ROWS = 2048
#: So few bits that a shard's fingerprints may differ in are not split further; it holds this many at most.
MOST_SHARD_ROWS = 2048


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """A bit is 1 if set in over half of the XXH64 of the text's word shingles; 0 if it has no words."""
    from xxhash import xxh64_intdigest

    parts = (text or "").encode().translate(C.LOWER).split()
    if not parts:
        return 0
    words = min(words, len(parts))
    ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 1)
    starts, stops = np.r_[0, ends[: len(parts) - words]], ends[words - 1 :] - 1
    view, votes = memoryview(b" ".join(parts)), np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(starts), 1 << 14):  # not all hashes of a very long text at once
        some = slice(at, at + (1 << 14))
        h = np.array([xxh64_intdigest(view[a:b], seed) for a, b in zip(starts[some].tolist(), stops[some].tolist(), strict=True)], dtype="<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits((votes * 2 > len(starts)).astype(np.uint8), bitorder="little").view("<u8")[0])


def _fingerprints(text_at: int, names: list[str], words: int):
    def run(batches):
        for batch in batches:
            fp = np.array([fingerprint(t, words) for t in batch.column(text_at).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(batch.num_columns)), pa.array(fp.view(np.int64))], names=names)

    return run


def with_fingerprint(docs: DataFrame, text_col: str = "text", words: int = 3, name: str = "fp") -> DataFrame:
    """All columns of docs and the fingerprint of the text as a long."""
    C.short_batches(docs.sparkSession)
    rest = [c for c in docs.columns if c != name]
    given = docs.select(*[F.col(c).cast("string").alias(c) if c == text_col else F.col(c) for c in rest])
    schema = T.StructType([*given.schema.fields, T.StructField(name, T.LongType())])
    return given.mapInArrow(_fingerprints(rest.index(text_col), schema.names, words), schema)


# ---- BK-trees ----------------------------------------------------------------------------------------------------


class BKTree:
    """Nodes are distinct 64-bit fingerprints; children[node] maps a distance to the child at that distance."""

    def __init__(self):
        self.keys: list[int] = []
        self.children: list[dict[int, int]] = []

    def search_and_insert(self, key: int, radius: int) -> list[int]:
        """Nodes within the radius of key, which becomes the last node."""
        new, found = len(self.keys), []
        if new:
            stack, at = [0], 0
            while stack:
                node = stack.pop()
                d = (self.keys[node] ^ key).bit_count()
                if d <= radius:
                    found.append(node)
                children = self.children[node]
                if len(children) <= 2 * radius + 1:
                    stack += [c for e, c in children.items() if d - radius <= e <= d + radius]
                else:
                    stack += [children[e] for e in range(d - radius, d + radius + 1) if e in children]
            while True:
                d = (self.keys[at] ^ key).bit_count()
                nxt = self.children[at].get(d)
                if nxt is None:
                    self.children[at][d] = new
                    break
                at = nxt
        self.keys.append(key)
        self.children.append({})
        return found


def shard_forest(keys: list[int], radius: int) -> list[tuple[int, int]]:
    """Edges of a forest that connects what links within the radius connect."""
    if len(keys) == 2:
        return [(keys[0], keys[1])] if (keys[0] ^ keys[1]).bit_count() <= radius else []
    tree, parent, edges = BKTree(), list(range(len(keys))), []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, key in enumerate(keys):
        for j in tree.search_and_insert(key, radius):
            a, b = root(i), root(j)
            if a != b:
                parent[a] = b
                edges.append((keys[i], keys[j]))
    return edges


def _forest(radius: int):
    """Rows (mask, shard, fp) sorted by shard; a shard is held only while it is read."""

    def run(batches):
        last, keys = None, []

        def out(edges):
            a = np.array(edges, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            return pa.record_batch({"a": pa.array(a[:, 0]), "b": pa.array(a[:, 1])})

        for batch in batches:
            shard = np.stack([batch.column(i).to_numpy() for i in range(2)])
            fp = batch.column(2).to_numpy().view(np.uint64)
            cuts = np.flatnonzero(np.r_[True, (shard[:, 1:] != shard[:, :-1]).any(axis=0)]) if len(fp) else []
            edges = []
            for lo, hi in zip(cuts, [*cuts[1:], len(fp)], strict=True):
                if last != (this := tuple(shard[:, lo])):
                    if len(keys) > 1:
                        edges += shard_forest(keys, radius)
                    last, keys = this, []
                keys += fp[lo:hi].tolist()
            if edges:
                yield out(edges)
        if len(keys) > 1 and (edges := shard_forest(keys, radius)):
            yield out(edges)

    return run


def _block_masks(bits: list[int], blocks: int, keep: int) -> list[int]:
    """Masks of every choice of ``keep`` of ``blocks`` nearly equal parts of the given bits."""
    parts = np.array_split(np.array(bits), blocks)
    out = []
    for choice in combinations(range(blocks), keep):
        m = sum(1 << int(b) for k in choice for b in parts[k])
        out.append(m - (1 << 64) if m >= 1 << 63 else m)
    return out


def _finer(mask: int, radius: int) -> list[int]:
    """A shard's fingerprints agree under the mask, so those of a link, which differ in radius bits at most, agree in one
    of radius + 1 parts of the other bits as well. None where the other bits are few, which bounds a shard by itself."""
    free = [b for b in range(BITS) if not (mask >> b) & 1]
    return [mask | m for m in _block_masks(free, radius + 1, 1)] if 1 << len(free) > MOST_SHARD_ROWS else []


def links(fingerprints: DataFrame, radius: int = 3, blocks: int | None = None) -> DataFrame:
    """Edges (a, b), written to the shared folder, that connect the distinct values of column fp exactly as all links
    within the radius would."""
    spark, n = fingerprints.sparkSession, fingerprints.count()
    blocks = blocks or radius + 2
    masks = _block_masks(list(range(BITS)), blocks, blocks - radius)
    edges_at_most = n * len(masks)
    dealt = fingerprints.select("fp", F.explode(F.array(*[F.lit(m).cast("long") for m in masks])).alias("mask"))
    shards = None
    while True:
        rows = dealt.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("shard"), "fp")
        sizes = C.materialize(rows.groupBy("mask", "shard").count().filter(F.col("count") > 1), "shard-sizes", rows=edges_at_most // 2)
        # Shards of one are dropped here; the sizes are one row a shard, so this join is by unique keys.
        held = rows.join(sizes, ["mask", "shard"])
        # At most as many masks as there are choices of blocks and parts.
        large = [r["mask"] for r in sizes.filter(F.col("count") > SHARD_ROWS).select("mask").distinct().collect() if _finer(r["mask"], radius)]
        fits = (F.col("count") <= SHARD_ROWS) | (~F.col("mask").isin(large) if large else F.lit(True))
        usual = held.filter(fits).select("mask", "shard", "fp")
        shards = usual if shards is None else shards.unionByName(usual)
        if not large:
            break
        finer = spark.createDataFrame([(m, f) for m in large for f in _finer(m, radius)], "mask long, finer long")
        again = held.filter(~fits).join(F.broadcast(finer), "mask").select("fp", F.col("finer").alias("mask"))
        dealt = C.materialize(again.distinct(), "large-shards")
    sorted_ = shards.repartition(max(1, C.shuffle_partitions(spark)), "mask", "shard").sortWithinPartitions("mask", "shard", "fp")
    return C.materialize(sorted_.mapInArrow(_forest(radius), "a long, b long").distinct(), "links", rows=edges_at_most)


# ---- components --------------------------------------------------------------------------------------------------


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of the edges (a, b): alternating large and small stars, each round written to the
    shared folder. A round's joins are replaced by grouping on the node with its minimum, so the hub of a star is
    pre-aggregated and its edges are then joined to one row."""
    facts = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    current = C.materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), name, rows=edges.count())
    known = facts(current)
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        small = large.join(down, "u").select(F.explode(pairs).alias("e")).select("e.*").filter("u <> v").distinct()
        after = C.materialize(small, name, rows=2 * known[0])
        C.remove(current.stored_at)
        current, before, known = after, known, facts(after)
        if known == before:
            break
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))


# ---- the operator ------------------------------------------------------------------------------------------------


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 3, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp, component_id, root) of every row: its fingerprint, the smallest id that links lead to, its own included,
    and a fingerprint that names the component, also where ids repeat or are missing. Columns named in carry (not one of
    these or text) come along.

    Null, empty and blank texts have fingerprint 0 and are linked like any other. Texts of fewer words than a shingle
    are one shingle. Equal fingerprints are one node, so copies are never paired. Rows without an id take part but give
    no smallest id; a component without any id has a null one. Rows that repeat an id stay rows. An empty table gives
    none. Texts are read whole.
    """
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *carry)
    prints = C.materialize(with_fingerprint(given, words=words).select("doc_id", "fp", *carry), "fingerprints")
    rows = prints.count()
    distinct = C.materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints", rows=rows)
    edges = links(distinct, radius)
    nodes = components(edges)
    rooted = distinct.join(nodes, distinct.fp == nodes.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    table = rooted.select("fp", "root").join(ids, "root").select("fp", "component_id", "root")
    return C.materialize(prints.join(table, "fp").select("doc_id", "fp", "component_id", "root", *carry), "near-duplicates", rows=rows)


def op7_simhash(spark, sf_dir: str) -> DataFrame:
    """SimHash near-duplicates of all documents: fingerprint and component of each."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
