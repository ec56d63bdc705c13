"""Chat formatting with collapse of cumulative snapshots.

Logs often hold a conversation several times, each time some turns longer. Every turn gets a rolling hash of the turns
up to it; a conversation is known by its last one. One whose hash is also an inner hash of a longer conversation is a
snapshot, and an anti-join removes it. Of equal conversations the smallest id stays. Only conversations that stay are
put together and rendered.

Rolling hashes are two 64-bit sums over turns of hashes of (place, role, text), so a prefix' hash is a running sum: a
window within a conversation's block of turns and one over the sums of its blocks, and a conversation of very many
turns is no single task's. Hashes are pre-aggregated to one row each before they meet, so a first turn or a whole
conversation that a third of the logs share is one row as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common as C

#: Turns of a block.
BLOCK = 1024


def numbered(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv_id, place, role, text): turns in order, without repeated rows; places count from 0."""
    given = turns.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.coalesce(F.col(turn_col).cast("long"), F.lit(-1)).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).distinct()
    block = given.withColumn("block", F.floor(F.col("turn") / BLOCK))
    sizes = block.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("size"))
    before = F.sum("size").over(Window.partitionBy("conv_id").orderBy("block")) - F.col("size")
    place = F.row_number().over(Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")) - 1
    inner = block.withColumn("inner", place)
    return inner.join(sizes.select("conv_id", "block", before.alias("before")), ["conv_id", "block"]).select("conv_id", (F.col("before") + F.col("inner")).alias("place"), "role", "text")


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv_id, place, a, b): the hash of the turns up to and including place."""
    # sums wrap around 64 bits on purpose: decimals would grow, and xor would lose a pair of equal terms
    mixed = lambda seed: F.xxhash64(F.lit(seed), "place", "role", "text")
    own = turns.select("conv_id", "place", F.floor(F.col("place") / BLOCK).alias("block"), mixed(1).alias("a"), mixed(2).alias("b"))
    half = lambda c: [F.shiftrightunsigned(F.col(c), 32).alias(f"{c}h"), F.col(c).bitwiseAND(0xFFFFFFFF).alias(f"{c}l")]
    parts = ("ah", "al", "bh", "bl")
    split = own.select("conv_id", "place", "block", *half("a"), *half("b"))
    within = Window.partitionBy("conv_id", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    running = split.select("conv_id", "place", "block", *[F.sum(p).over(within).alias(p) for p in parts])
    blocks = split.groupBy("conv_id", "block").agg(*[F.sum(p).alias(p) for p in parts])
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("conv_id", "block", *[F.coalesce(F.sum(p).over(earlier), F.lit(0)).alias(f"{p}0") for p in parts])
    total = lambda p: F.col(p) + F.col(f"{p}0")
    return running.join(offsets, ["conv_id", "block"]).select("conv_id", "place", F.xxhash64(F.lit(1), total("ah"), total("al")).alias("a"), F.xxhash64(F.lit(2), total("bh"), total("bl")).alias("b"))


def maximal(hashes: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies) of the conversations that are no other's prefix, the smallest id of equal ones."""
    last = hashes.groupBy("conv_id").agg(F.max(F.struct("place", "a", "b")).alias("last"))
    whole = last.select("conv_id", F.col("last.a").alias("a"), F.col("last.b").alias("b"), (F.col("last.place") + 1).alias("n_turns"))
    ends = whole.select("conv_id", (F.col("n_turns") - 1).alias("end"))
    inner = hashes.join(ends, "conv_id").filter(F.col("place") < F.col("end")).groupBy("a", "b").agg(F.lit(1).alias("inner"))
    kept = whole.groupBy("a", "b", "n_turns").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies"))
    return kept.join(inner, ["a", "b"], "left_anti").select("conv_id", "n_turns", "n_copies")


def collapse(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(kept, turns of kept): conversations that are neither copies nor snapshots, and their numbered turns.

    Rows without a conversation id belong to none and are left out. Null roles and texts are empty; null turns count as
    turn -1; equal turn numbers are ordered by role and text; repeated rows count once. Other columns are ignored. An
    empty table gives none."""
    own = C.materialize(numbered(turns, conv_col, turn_col, role_col, text_col), "turns")
    hashes = C.materialize(prefix_hashes(own), "prefix-hashes")
    kept = C.materialize(maximal(hashes), "conversations")
    return kept, own.join(kept.select("conv_id"), "conv_id", "left_semi")


def render(turns: DataFrame, begin: str = "<|{role}|>\n", end: str = "\n<|end|>\n") -> DataFrame:
    """(conv_id, chat): turns put together in order. ``<|`` within a role or text becomes ``< |``, so that no text can
    end its turn or begin another's."""
    safe = lambda c: F.replace(F.col(c), F.lit("<|"), F.lit("< |"))
    left, right = begin.split("{role}")
    one = F.concat(F.lit(left), safe("role"), F.lit(right), safe("text"), F.lit(end))
    together = turns.select("conv_id", F.struct("place", one.alias("turn")).alias("t")).groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    return together.select("conv_id", F.concat_ws("", F.col("t.turn")).alias("chat"))


def op2_chat_format(spark, sf_dir: str) -> DataFrame:
    """All conversations, snapshots and copies collapsed, rendered."""
    kept, turns = collapse(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text"))
    return kept.join(render(turns), "conv_id").select("conv_id", "n_turns", "n_copies", "chat")


OP2_SQL = """
WITH t AS (SELECT DISTINCT conv_id, coalesce(turn, -1) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list(role || chr(1) || text ORDER BY turn, role, text) AS l,
      string_agg('<|' || replace(role, '<|', '< |') || '|>' || chr(10) || replace(text, '<|', '< |') || chr(10) || '<|end|>' || chr(10), '' ORDER BY turn, role, text) AS chat FROM t GROUP BY conv_id),
u AS (SELECT l, min(conv_id) AS conv_id, count(*) AS n_copies, min(chat) AS chat FROM c GROUP BY l),
p AS (SELECT DISTINCT l[1:i] AS l FROM (SELECT l, unnest(range(1, len(l))) AS i FROM u))
SELECT u.conv_id, CAST(len(u.l) AS BIGINT) AS n_turns, u.n_copies, u.chat FROM u LEFT JOIN p ON u.l = p.l WHERE p.l IS NULL
"""
