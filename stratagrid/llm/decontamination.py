"""Benchmark decontamination by a distributed positional inverted index; DataFrame and SQL functions only.

1. The terms of the benchmark are counted over the whole corpus.
2. Every window of consecutive item words has a rarest and a next rarest term. The postings of these are stored: document,
   position and term, and for rarest terms the words around, as far as a window can reach. The last word of a document also
   carries its columns and its number of words.
3. The postings of a window's rarest term, shifted by its offset, are the places where it could start; the postings of its
   next rarest term, shifted by its own, are intersected with them.
4. The lists of its other, common terms are met in place, in the stored surroundings of the places that are left. These
   lists would be half of all words; so they are neither stored nor moved, and the result is exact.

Terms are joined to words where texts are split, as broadcasts of at most ``BLOCK`` terms; a larger benchmark takes several
passes. A very common word is no hot key: words that aren't wanted go where they are read, and a term's postings are dealt
by document and position.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

#: Terms of one broadcast.
BLOCK = 1 << 20
#: What stands between words.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text with A-Z lower-cased; none of a null text. Splitting between words takes a tenth of the time
    that extracting them does; it leaves an empty text before and after."""
    return F.coalesce(F.array_remove(F.split(C.ascii_lower(text), BETWEEN), ""), F.array().cast("array<string>"))


def windows(items: DataFrame, size: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct windows (window: array of words, items: ids as text) of ``size`` consecutive words; of an item of fewer
    words, but not none, all of them."""
    own = items.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col).cast("string")).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    return own.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, size))).alias("window")).groupBy("window").agg(F.collect_set("item").alias("items"))


def _table(docs: DataFrame, terms: DataFrame | list[str], at_most: int | None, *more: str) -> DataFrame:
    """Distinct terms (term and more), stored. at_most: how many there are, where that is known."""
    rows = terms if isinstance(terms, DataFrame) else docs.sparkSession.createDataFrame([(t,) for t in terms], "term string")
    return C.materialize(rows.select("term", *more).distinct(), "terms", rows=at_most)


def _blocks(terms: DataFrame) -> list[DataFrame]:
    """The terms in parts of about BLOCK, dealt by their hashes."""
    n = max(1, -(-terms.count() // BLOCK))
    return [terms.filter(F.pmod(F.xxhash64(F.lit(11), "term"), F.lit(n)) == i) for i in range(n)]


def term_counts(docs: DataFrame, terms: DataFrame | list[str], text_col: str = "text", at_most: int | None = None) -> DataFrame:
    """(term, n): how often each of the terms stands in the corpus; terms that don't are left out."""
    each = docs.select(F.explode(words(F.col(text_col).cast("string"))).alias("term"))
    parts = [each.join(F.broadcast(b), "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("n")) for b in _blocks(_table(docs, terms, at_most))]
    return reduce(DataFrame.unionByName, parts)


@dataclass
class Index:
    """documents: a row per document: row, the given columns, n_words. postings: row, term, pos, and of terms whose
    surroundings are kept first (the position where these begin) and near (the words there)."""

    documents: DataFrame
    postings: DataFrame
    reach: int


def build_index(docs: DataFrame, terms: DataFrame | list[str], reach: int = 9, id_cols: tuple[str, ...] = ("doc_id",), text_col: str = "text", at_most: int | None = None) -> Index:
    """Positional postings of the terms, with the words up to ``reach`` places away, written to the shared folder. A table of
    terms tells by a column around which terms keep their surroundings; those of a list all do."""
    terms = terms.select("term", "around") if isinstance(terms, DataFrame) else docs.sparkSession.createDataFrame([(t, True) for t in terms], "term string, around boolean")
    parts = _blocks(_table(docs, terms, at_most, "around"))
    names = [f"id_{i}" for i in range(len(id_cols))]
    ids = [F.col(f"`{c}`").alias(n) for n, c in zip(names, id_cols, strict=True)]
    own = docs.select(F.monotonically_increasing_id().alias("row"), *ids, words(F.col(text_col).cast("string")).alias("w"))
    if len(parts) > 1:  # numbered once for all passes
        own = C.materialize(own, "words")
    each = own.select("row", *names, "w", F.posexplode_outer("w").alias("pos", "term"))
    first, last = F.greatest(F.col("pos") - reach, F.lit(0)), F.col("pos").isNull() | (F.col("pos") == F.size("w") - 1)
    stored = []
    for k, part in enumerate(parts):
        # The words of a text stay where they are split: a row is made for a word that is found, not for every word.
        found = each.join(F.broadcast(part), "term", "left").filter(F.col("around").isNotNull() | (last if k == 0 else F.lit(False)))
        near = F.when(F.col("around"), F.slice("w", first + 1, F.col("pos") + reach - first + 1))
        columns = [F.when(last, F.col(n)).alias(n) if k == 0 else F.lit(None).cast(each.schema[n].dataType).alias(n) for n in names]
        n_words = F.when(last, F.size("w").cast("long")) if k == 0 else F.lit(None).cast("long")
        stored.append(C.materialize(found.select("row", F.when(F.col("around").isNotNull(), F.col("term")).alias("term"), "pos", first.alias("first"), near.alias("near"), *columns, n_words.alias("n_words")), "postings"))
    documents = stored[0].filter("n_words IS NOT NULL").select("row", *[F.col(n).alias(c) for n, c in zip(names, id_cols, strict=True)], "n_words")
    postings = reduce(DataFrame.unionByName, [p.filter("term IS NOT NULL").select("row", "term", "pos", "first", "near") for p in stored])
    return Index(documents, postings, reach)


def rarest(counts: DataFrame, queries: DataFrame) -> DataFrame:
    """Adds to queries (window) the rarest of its terms and its first offset, and the next rarest at another offset (other
    and beside; null of a single word). Queries with a term that the corpus lacks are left out, since they have no match."""
    exploded = queries.select("window", F.posexplode("window").alias("offset", "term"))
    ranked = exploded.join(counts, "term", "left").groupBy("window").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term", "offset"))).alias("rank"))
    first, other = F.get("rank", F.lit(0)), F.get("rank", F.lit(1))
    found = ranked.filter(first["n"] > 0).select("window", first["term"].alias("term"), first["offset"].alias("offset"), other["term"].alias("other"), other["offset"].alias("beside"))
    return queries.join(found, "window").select(*queries.columns, "term", "offset", "other", "beside")


def phrase_matches(index: Index, queries: DataFrame) -> DataFrame:
    """(row, start, size, items) wherever a query's words stand consecutively. Queries have window, items, term, offset, other
    and beside; the index has postings of term, with surroundings, and of other."""
    queries = C.materialize(queries.withColumn("query", F.monotonically_increasing_id()), "queries", rows=queries.count())
    light = index.postings.select("row", "term", "pos")
    firsts = light.join(queries.select("query", "term", "offset", "other", "beside"), "term").filter(F.col("pos") >= F.col("offset")).select("row", "query", "pos", "offset", "other", "beside")
    wanted = firsts.filter("other IS NOT NULL").select("row", "query", F.col("pos").alias("at"), (F.col("pos") - F.col("offset") + F.col("beside")).alias("pos"), F.col("other").alias("term"))
    met = wanted.join(light, ["row", "pos", "term"], "left_semi").select("row", "query", F.col("at").alias("pos"))
    met = met.unionByName(firsts.filter("other IS NULL").select("row", "query", "pos"))
    placed = met.join(index.postings.filter("near IS NOT NULL").select("row", "pos", "first", "near"), ["row", "pos"]).join(queries.select("query", "window", "offset", "items"), "query")
    same = F.expr("slice(near, greatest(pos - offset - first, 0) + 1, size(window)) = window")
    return placed.filter(same).select("row", (F.col("pos") - F.col("offset")).alias("start"), F.size("window").alias("size"), "items")


def proximity_matches(index: Index, queries: DataFrame, within: int) -> DataFrame:
    """(row, pos, items) wherever all words of a query, in any order, stand at most ``within`` places from its rarest."""
    if within > index.reach:
        raise ValueError(f"the index reaches {index.reach} words")
    near = F.expr(f"slice(near, greatest(pos - {within} - first, 0) + 1, pos - greatest(pos - {within}, first) + {within} + 1)")
    return index.postings.filter("near IS NOT NULL").join(queries, "term").filter(F.size(F.array_except("window", near)) == 0).select("row", "pos", "items")


def contamination(docs: DataFrame, items: DataFrame, size: int = 10, id_cols: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """A row per document: the id columns, n_words, n_hit (words inside any occurrence of an item's window), item_ids
    (as text, in order) of the items with occurring windows, contaminated (n_hit > 0).

    Null and empty texts have no words and no hits. Items without words have no window; items without an id make hits
    but aren't named. Rows that repeat an id are rows of their own. Empty tables give no rows, or no hits. Very long
    texts are read whole. Other columns of either table are ignored; id columns may have any names but those of the
    result's other columns.
    """
    own = [f"own_{i}" for i in range(len(id_cols))]
    given = docs.select(*[F.col(f"`{c}`").alias(o) for c, o in zip(id_cols, own, strict=True)], F.col(f"`{text_col}`").cast("string").alias("text"))
    # The benchmark's words bound its windows and its terms.
    most = items.agg(F.coalesce(F.sum(F.size(words(F.col("text").cast("string"))).cast("long")), F.lit(0)).alias("n")).first()["n"]
    queries = C.materialize(windows(items, size), "windows", rows=most)
    counts = C.materialize(term_counts(given, queries.select(F.explode("window").alias("term")), at_most=most), "term-counts", rows=most)
    anchored = C.materialize(rarest(counts, queries), "anchored-windows", rows=most)
    anchors = anchored.select("term", F.lit(True).alias("around")).unionByName(anchored.filter("other IS NOT NULL").select(F.col("other").alias("term"), F.lit(False).alias("around")))
    index = build_index(given, anchors.groupBy("term").agg(F.max("around").alias("around")), max(size - 1, 0), tuple(own), at_most=most)
    found = phrase_matches(index, anchored).groupBy("row", "start", "size").agg(F.flatten(F.collect_set("items")).alias("items"))
    hits = found.groupBy("row").agg(
        F.size(F.array_distinct(F.flatten(F.collect_set(F.expr("sequence(start, start + size - 1)"))))).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("item_ids"),
    )
    none = F.array().cast("array<string>")
    return index.documents.join(hits, "row", "left").select(
        *[F.col(o).alias(c) for c, o in zip(id_cols, own, strict=True)], "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("item_ids", none).alias("item_ids"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def op10_decontamination(spark, sf_dir: str) -> DataFrame:
    """Exact matches of benchmark windows in all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.encode(F.array_join("item_ids", ","), "UTF-8"), 256).alias("items_sha256"), "contaminated")


OP10_SQL = r"""
WITH dw AS (SELECT doc_id, row_number() OVER () AS r, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+'), []) AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS k
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM iw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
places AS (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS k FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM dw) CROSS JOIN sizes WHERE i + n - 1 <= len(w)),
hit AS (SELECT DISTINCT a.r, a.i, a.n, win.item_id FROM places a JOIN win ON a.k = win.k AND a.n = win.n),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS s FROM (SELECT DISTINCT r, item_id FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN pos USING (r) LEFT JOIN its USING (r)
"""
