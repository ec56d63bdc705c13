import corpus_pipeline
from pyspark.sql import functions as F

from stratagrid.llm import common, stages

from .test_decontamination import by_hand as leaks
from .test_lines import by_hand as line_dedup
from .test_packing import check
from .test_simhash import groups, slow_fingerprint

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_against_brute_force(spark, big_dir):
    docs = spark.read.parquet(f"{big_dir}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{big_dir}/benchmark.parquet").select("item_id", "text").collect()]
    texts = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}
    seen = [texts(docs)]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = common.materialize(stage(spark, docs, big_dir), name)
        assert out.columns == docs.columns
        docs = out
        seen.append(texts(docs))
    start, clean, lines, single, free = seen
    assert all(start[k] == t for k, t in clean.items()) and 0.8 * len(start) < len(clean) < len(start)
    assert lines == {d: t for d, t, _, _ in line_dedup(list(clean.items()))}
    ids = sorted(lines)
    roots = groups([slow_fingerprint(lines[k]) for k in ids], 3)
    least = {}
    for k, r in zip(ids, roots, strict=True):
        least.setdefault(r, k)
    assert set(single) == set(least.values())
    assert set(free) == {r[0] for r in leaks(list(single.items()), items) if not r[4]}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, big_dir).collect()
    check([(r["sequence_id"], r["offset"], r["length"]) for r in packed], 1024)
    assert {r["doc_id"] for r in packed} == set(free)
    assert docs.filter(F.col("n_chars") != F.length("text")).count() == spark.read.parquet(f"{big_dir}/documents.parquet").join(docs.select("doc_id"), "doc_id").filter(F.col("n_chars") != F.length("text")).count()


def odd(spark):
    line = "a line that is long enough to count, and is repeated here"
    rows = [(1, "", "x", "s", 0, "k"), (2, None, None, None, None, "k"), (None, "text without id", "x", "s", 1, "a"), (None, "text without id", "x", "s", 1, "b"), (3, "one two three four", "x", "s", 1, "c"), (3, "one two three four", "x", "s", 1, "c"), (3, "one two three four", "y", "s", 1, "d"), (4, "w " * 100_000, "x", "s", 1, "e")]
    rows += [(10 + k, f"{line}\nown {k} words here for number {k}", "x", "s", 1, "f") for k in range(6)] + [(20, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda", "x", "s", 1, "g")]
    return spark.createDataFrame(rows, DOCS + ", fp string").withColumn("score", F.lit(1.0)).withColumn("n_lines", F.lit("x")).withColumn("row", F.lit(2)).withColumn("h", F.lit(3))


def test_odd_rows_pass_each_stage(spark):
    docs = odd(spark)
    labels = spark.createDataFrame([(1, 1), (3, 0), (10, 0)], "doc_id long, toxic int")
    bench = spark.createDataFrame([(1, "beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, None)], "item_id long, text string")
    same = stages.remove_repeated_lines(docs)
    assert same.columns == docs.columns and same.count() == docs.count()
    assert same.filter("doc_id = 12").first()["text"] == "own 2 words here for number 2" and same.filter("doc_id = 12").first()["n_chars"] == 29
    single = stages.one_of_each_group(docs)
    assert single.columns == docs.columns
    kept = [r["doc_id"] for r in single.collect()]
    assert kept.count(3) == 1 and kept.count(None) == 1 and kept.count(1) == 1 and 2 not in kept  # 1 and 2 have no words
    free = stages.without_benchmark(docs, bench)
    assert free.columns == docs.columns and free.count() == docs.count() - 1
    assert stages.reject_toxic(docs, labels).columns == docs.columns
    assert stages.packed(docs).select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_each_group_of_a_repeated_id_keeps_a_row(spark):
    base = [f"w{i}" for i in range(600)]
    near = next(t for k in range(600) if 0 < (slow_fingerprint(t := " ".join([*base[:k], "other", *base[k + 1 :]])) ^ slow_fingerprint(" ".join(base))).bit_count() <= 3)
    a, b, c = " ".join(base), " ".join(f"x{i}" for i in range(600)), " ".join(f"y{i}" for i in range(600))
    rows = [(5, a), (5, near), (5, b), (6, b), (7, a), (7, c), (8, c), (9, "alone")] + [(None, t) for t in ("no id " + c[::-1], "no id " + b[::-1], b)]
    docs = spark.createDataFrame([(d, t, "x", "s", 1) for d, t in rows], DOCS)
    kept = [(r["doc_id"], r["text"]) for r in stages.one_of_each_group(docs).collect()]
    assert sorted(kept, key=str) == sorted([(5, min(a, near)), (5, b), (7, c), (9, "alone"), *rows[8:10]], key=str)
    nameless = spark.createDataFrame([(None, t, "x", "s", 1) for t in (a, near, c)], DOCS)
    assert sorted(r["text"] for r in stages.one_of_each_group(nameless).collect()) == sorted([min(a, near), c])


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    for out in (stages.reject_toxic(none, labels), stages.remove_repeated_lines(none), stages.one_of_each_group(none), stages.without_benchmark(none, bench)):
        assert out.count() == 0 and out.columns == none.columns
    assert stages.packed(none).count() == 0
