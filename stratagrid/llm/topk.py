"""Exact inner-product search by ball trees, a tree per shard of vectors.

A node holds a centre, a radius and, for a query q, an upper bound on inner products: q.centre + |q| * radius. A search
takes a shard's nodes in the order of their bounds and ends when the next bound is below the query's k-th score so far.
That score is shared: it comes with a block of queries into each shard. Rounds search one shard, the next two, the next
four and so on; each starts from the k-th scores of all shards before it.

Trees and blocks of queries are written to the shared folder; a task reads one tree and one block at a time, so memory
is bounded by their sizes, and neither vectors nor queries are broadcast. The stated query set meets all vectors in
blocks: a row per shard and block, no pair of vectors is ever emitted but a query's best in a shard.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common as C

LEAF = 256
#: Sums of products below this are exact in doubles.
EXACT = float(1 << 53)
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


@dataclass
class BallTree:
    """vectors and ids in the order of the leaves; node i covers rows [low[i], high[i]) and has children left[i],
    right[i] (-1: a leaf)."""

    vectors: np.ndarray
    ids: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    low: np.ndarray
    high: np.ndarray
    left: np.ndarray
    right: np.ndarray

    @classmethod
    def build(cls, vectors: np.ndarray, ids: np.ndarray, leaf: int = LEAF) -> BallTree:
        order = np.argsort(ids, kind="stable")
        nodes: list[list] = []
        stack = [(0, len(ids), None)]
        while stack:
            lo, hi, parent = stack.pop()
            own = vectors[order[lo:hi]]
            centre = own.mean(axis=0)
            far = np.sqrt(((own - centre) ** 2).sum(axis=1))
            me = len(nodes)
            nodes.append([centre, float(far.max()), lo, hi, -1, -1])
            if parent is not None:
                nodes[parent[0]][4 + parent[1]] = me
            if hi - lo > leaf and far.max() > 0:
                a = own[int(far.argmax())]
                b = own[int(((own - a) ** 2).sum(axis=1).argmax())]
                side = own @ (b - a)
                split = np.argsort(side, kind="stable")
                order[lo:hi] = order[lo:hi][split]
                mid = lo + (hi - lo) // 2
                stack += [(lo, mid, (me, 0)), (mid, hi, (me, 1))]
        c, r, lo, hi, le, ri = zip(*nodes, strict=True)
        return cls(vectors[order], ids[order], np.array(c), np.array(r), *(np.array(x, dtype=np.int64) for x in (lo, hi, le, ri)))

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Upper bounds by query and node, widened by what rounding can lose."""
        norms = np.sqrt((queries**2).sum(axis=1))
        sure = queries @ self.centre.T + norms[:, None] * self.radius
        slack = 1e-9 * (norms[:, None] * (np.sqrt((self.centre**2).sum(axis=1)) + self.radius)) + 1e-6
        return sure + slack

    def search(self, query: np.ndarray, own_id: int, bounds: np.ndarray, k: int, floor: float) -> list[tuple[int, int]]:
        """The k best (score, id) but the query's own, ties to smaller ids, among scores of at least floor."""
        best: list[tuple[int, int]] = []  # a heap of (score, -id), its worst first
        todo = [(-bounds[0], 0)]
        while todo:
            bound, node = heapq.heappop(todo)
            if -bound < floor:
                break
            if self.left[node] >= 0:
                for child in (self.left[node], self.right[node]):
                    if bounds[child] >= floor:
                        heapq.heappush(todo, (-bounds[child], int(child)))
                continue
            lo, hi = int(self.low[node]), int(self.high[node])
            scores, ids = inner(self.vectors[lo:hi], query), self.ids[lo:hi]
            take = np.flatnonzero((scores >= floor) & (ids != own_id))
            if len(take) > k:
                take = take[np.lexsort((ids[take], -scores[take]))[:k]]
            for s, i in zip(scores[take].tolist(), ids[take].tolist(), strict=True):
                if len(best) < k:
                    heapq.heappush(best, (s, -i))
                elif (s, -i) > best[0]:
                    heapq.heapreplace(best, (s, -i))
            if len(best) == k:
                floor = max(floor, best[0][0])
        return [(s, -i) for s, i in sorted(best, reverse=True)]


def inner(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in doubles where they are exact, else in Python's integers, held within 64 bits."""
    if len(vectors) == 0 or np.abs(vectors).max(initial=0) * np.abs(query).max(initial=0) * max(1, len(query)) < EXACT:
        return (vectors @ query).astype(np.int64)
    q = [int(x) for x in query]
    return np.array([min(_HIGH, max(_LOW, sum(int(a) * b for a, b in zip(v, q, strict=True)))) for v in vectors], dtype=np.int64)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of at most dims numbers; shorter ones end in zeros."""
    out = np.zeros((len(column), dims))
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out[np.repeat(np.arange(len(column)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _gather(batches):
    """All rows (shard, vec_id, vector) of a task, by shard."""
    held = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
    if held:
        rows = pa.concat_tables(held).combine_chunks()
        shard = rows[0].to_numpy()
        for s in np.unique(shard):
            yield int(s), rows.filter(pa.array(shard == s))


def _write_trees(folder: str, dims: int):
    def run(batches):
        for shard, rows in _gather(batches):
            tree = BallTree.build(_matrix(rows[2].combine_chunks(), dims), rows[1].to_numpy())
            for name, array in vars(tree).items():
                C.put_array(folder, f"{name}-{shard}", array)
            yield pa.record_batch({"part": pa.array([shard], pa.int32())})

    return run


def _write_queries(folder: str, dims: int):
    def run(batches):
        for block, rows in _gather(batches):
            order = np.argsort(rows[1].to_numpy(), kind="stable")
            C.put_array(folder, f"queries-{block}", _matrix(rows[2].combine_chunks(), dims)[order])
            C.put_array(folder, f"query_ids-{block}", rows[1].to_numpy()[order])
            yield pa.record_batch({"part": pa.array([block], pa.int32())})

    return run


def _write_floors(folder: str, turn: int):
    """Rows (block, query_id, kth) of one block after another: the scores from which a block's queries start in a round."""

    def run(batches):
        for block, rows in _gather(batches):
            ids = np.asarray(C.get_array(folder, f"query_ids-{block}"))
            floors = dict(zip(rows[1].to_pylist(), rows[2].to_pylist(), strict=True))
            C.put_array(folder, f"floors-{turn}-{block}", np.array([floors.get(q, -np.inf) for q in ids.tolist()], dtype=np.float64))
            yield pa.record_batch({"part": pa.array([block], pa.int32())})

    return run


def _search(folder: str, k: int, turn: int, shards: list[int], blocks: list[int]):
    """Rows (number of a pair of shard and block): searches the block's queries in the shard's tree, from the scores of the
    rounds before."""

    def run(batches):
        for batch in batches:
            for pair in batch.column(0).to_pylist():
                shard, block = shards[pair // len(blocks)], blocks[pair % len(blocks)]
                tree = BallTree(**{f: np.asarray(C.get_array(folder, f"{f}-{shard}")) for f in BallTree.__dataclass_fields__})
                queries, ids = np.asarray(C.get_array(folder, f"queries-{block}")), np.asarray(C.get_array(folder, f"query_ids-{block}"))
                floors = np.asarray(C.get_array(folder, f"floors-{turn}-{block}")) if turn else np.full(len(ids), -np.inf)
                bounds, rows = tree.bounds(queries), []
                for q in range(len(ids)):
                    rows += [(int(ids[q]), i, s) for s, i in tree.search(queries[q], int(ids[q]), bounds[q], k, floors[q])]
                if rows:
                    q, i, s = zip(*rows, strict=True)
                    yield pa.record_batch({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(i, pa.int64()), "score": pa.array(s, pa.int64())})

    return run


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, v) with v = floor(scale * x) in doubles. Left out: rows without an id, null vectors, and vectors with a
    component that is null or not finite. Repeated rows are one."""
    v = F.col(vector_col).cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    # floor() gives a whole number type, which large components would leave; x - x mod 1 stays a double
    whole = lambda x: (F.lit(float(scale)) * x) - F.pmod(F.lit(float(scale)) * x, F.lit(1.0))
    return df.filter(F.col(id_col).isNotNull() & v.isNotNull() & good).select(F.col(id_col).cast("long").alias("vec_id"), F.transform(v, whole).alias("v")).distinct()


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, shard_rows: int = 16_384, block_rows: int = 1_024) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best vectors (vec_id, v: doubles that are whole numbers), but those
    of its own id; all of them if fewer. Ties go to the smaller id. Shorter vectors count as ending in zeros. Without
    vectors or queries there are no rows. Scores beyond 64 bits are held at the ends of their range."""
    spark = vectors.sparkSession
    folder = C.new_folder(spark, "ball-trees")
    sizes = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dims")).first()
    asked = queries.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dims")).first()
    empty = "query_id long, rank int, vec_id long, score long"
    if not sizes["n"] or not asked["n"]:
        return spark.createDataFrame([], empty)
    dims = max(sizes["dims"], asked["dims"], 1)
    shards, blocks = -(-sizes["n"] // shard_rows), -(-asked["n"] // block_rows)
    deal = lambda df, n, name: df.select(F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(n)).cast("int").alias(name), "vec_id", "v").repartitionById(n, name)
    have = sorted(r["part"] for r in deal(vectors, shards, "shard").mapInArrow(_write_trees(folder, dims), "part int").collect())
    ask = sorted(r["part"] for r in deal(queries, blocks, "block").mapInArrow(_write_queries(folder, dims), "part int").collect())
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def round_of(own: list[int], turn: int) -> DataFrame:
        n = len(own) * len(ask)
        pairs = spark.range(0, n, 1, min(n, 100_000))  # a task a pair, as long as tasks are few enough
        found = pairs.mapInArrow(_search(folder, k, turn, own, ask), "query_id long, vec_id long, score long")
        return C.materialize(found, "top-k", rows=k * asked["n"] * len(own))

    best = round_of(have[:1], 0)
    done, turn = 1, 0
    while done < len(have):
        turn += 1
        # A score that k others reach is a floor for all other shards; of what was found, no query keeps more than k rows.
        kth = best.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").cast("double").alias("kth")).filter(F.col("n") >= k)
        rows = kth.select(F.pmod(F.xxhash64("query_id", F.lit(3)), F.lit(blocks)).cast("int").alias("block"), "query_id", "kth").repartitionById(blocks, "block")
        written = {r["part"] for r in rows.mapInArrow(_write_floors(folder, turn), "part int").collect()}
        for block in set(ask) - written:
            C.put_array(folder, f"floors-{turn}-{block}", np.full(len(C.get_array(folder, f"query_ids-{block}")), -np.inf))
        more = best.unionByName(round_of(have[done : done + (1 << turn)], turn))
        done += 1 << turn
        ranked = more.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        best = C.materialize(ranked.drop("rank"), "top-k-so-far", rows=k * asked["n"])
    return best.withColumn("rank", F.row_number().over(order)).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def op8_top_k(spark, sf_dir: str) -> DataFrame:
    """The five best of all embeddings for every vector whose id 50 divides."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    vectors = C.materialize(integer_vectors(rows, "vec_id", "embedding", 256), "vectors")
    return top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0), k=5)


OP8_SQL = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
