"""Pipeline stages over a table of documents: each gives the columns of the documents that it keeps."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C
from . import decontamination, lines, packing, simhash, toxicity

#: All columns of an input row but its text ride along under this name, so that none can clash with an operator's and
#: a text goes to Python once.
ROW = "__row"


def _packed_rows(docs: DataFrame) -> DataFrame:
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    return docs.select(rest.alias(ROW), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _unpacked(docs: DataFrame, **own: Column) -> list[Column]:
    """The columns of docs from a packed row; own: columns that were made anew."""
    own = {"text": F.col("text").cast(docs.schema["text"].dataType)} | own
    return [own[c].alias(c) if c in own else F.col(f"{ROW}.`{c}`").alias(c) for c in docs.columns]


def _text_keys() -> tuple[Column, Column]:
    """Two hashes that stand for a text; a null text has those of no other."""
    text = F.col("text").cast("string")
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def _absent(gone: DataFrame, name: str, names: tuple[str, ...], own: tuple[Column, ...]) -> Column:
    """Whether a row isn't among those to go. They are told by 128 bits of hash of some columns (names in gone, own in the
    row), which workers look up in mapped arrays: rows and their texts stay where they are read, however many go."""
    keys = lambda columns: [F.xxhash64(F.lit(seed), *columns) for seed in (2, 3)]
    key, second = keys([F.col(n) for n in names])
    table = C.write_sorted_table(gone.select(key.alias("h"), second.alias("second")).distinct(), name, ("second",))

    @F.arrow_udf(T.BooleanType())
    def absent(key: pa.Array, second: pa.Array) -> pa.Array:
        return pa.array(~table.find(key.to_numpy().view(np.uint64), second.to_numpy())[0])

    return absent(*keys(own))


def reject_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents that the classifier doesn't call toxic. It is trained on these documents and the labels. A score depends on
    the text alone, so texts that go are known by their hashes, and each text is read for features once."""
    h, g = _text_keys()
    scored = toxicity.train_and_score(docs.select("doc_id", "text", h.alias("h"), g.alias("g")), labels, ("h", "g"))
    return docs.filter(_absent(scored.filter("predicted = 1"), "toxic-texts", ("h", "g"), (h, g)))


def remove_repeated_lines(docs: DataFrame) -> DataFrame:
    """All documents, with their texts (and n_chars, where it is a column) after line deduplication."""
    kept = lines.drop_repeated_lines(_packed_rows(docs))
    own = {}
    if "n_chars" in docs.columns:
        own["n_chars"] = F.when(F.col("n_dropped") > 0, F.char_length("text")).otherwise(F.col(f"{ROW}.n_chars")).cast(docs.schema["n_chars"].dataType)
    return kept.select(*_unpacked(docs, **own))


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """The document with the smallest id of each group of near duplicates (of a group's rows that share it, one). Groups of
    rows without any id keep one of them."""
    h, g = _text_keys()
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), h.alias("h"), g.alias("g"))
    found = simhash.near_duplicates(keyed, carry=("h", "g"))
    rows = found.count()
    keep = found.filter(F.col("doc_id") == F.col("component_id")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    unnamed = found.filter(F.col("component_id").isNull()).agg(F.count(F.lit(1)).alias("n")).first()["n"]
    gone = found.filter(~F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)) & F.col("component_id").isNotNull())
    doc_id = F.col("doc_id").cast("long")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    staying = docs.filter(_absent(gone, "near-duplicates-to-drop", ("doc_id", "h", "g"), (doc_id, h, g)))
    left = staying.select(row.alias(ROW), doc_id.alias("doc_id"), h.alias("h"), g.alias("g"))
    repeated = C.materialize(keep.filter("n > 1").select("doc_id"), "repeated-ids", rows=rows)
    if repeated.isEmpty() and not unnamed:
        return left.select(f"{ROW}.*")
    left = C.materialize(left, "near-duplicate-rows")
    single = left.join(repeated, "doc_id", "left_anti").filter(F.col("doc_id").isNotNull())
    # An id can stand in several groups, and each of them keeps a row.
    roots = found.join(repeated, "doc_id", "left_semi").unionByName(found.filter(F.col("component_id").isNull())).select("h", "g", "root").distinct()
    thinned = left.join(repeated, "doc_id", "left_semi").unionByName(left.filter(F.col("doc_id").isNull()))
    several = thinned.join(roots, ["h", "g"]).groupBy("doc_id", "root").agg(F.min(ROW).alias(ROW))
    return single.select(f"{ROW}.*").unionByName(several.select(f"{ROW}.*"))


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents in which no window of a benchmark item occurs. Whether one does depends on the text alone, so texts
    that have one are known by two hashes."""
    h, g = _text_keys()
    hashed = docs.select(F.col("text").cast("string").alias("text"), h.alias("h"), g.alias("g"))
    found = decontamination.contamination(hashed, benchmark, id_cols=("h", "g"))
    bad = C.materialize(found.filter("contaminated").select(F.col("h").alias("__h"), F.col("g").alias("__g")).distinct(), "contaminated", rows=docs.count())
    same = (h == F.col("__h")) & (g == F.col("__g"))
    return docs.join(bad, same, "left_anti")


def packed(docs: DataFrame) -> DataFrame:
    """Where each piece of each document goes."""
    return packing.pack(docs).placed.drop("part", "nth")
