import gzip
import hashlib
import io

import pyarrow.fs as pafs
import pytest

from stratagrid.llm import common, warc

PAGES = "page_id long, url string, html string"


def by_hand(rows, least=1000):
    best = {}
    for p, _, h in rows:
        b = (h or "").encode()
        if len(b) >= least and p is not None:
            best[b] = max(p, best.get(b, p))
    out = []
    for p, u, h in rows:
        b = (h or "").encode()
        keep = best.get(b)
        again = len(b) >= least and keep is not None and (p is None or p < keep) and sum((x or "").encode() == b for _, _, x in rows) > 1
        out.append((p, u or "", "revisit" if again else "response", len(b), hashlib.sha1(b).hexdigest(), keep if again else None))
    return sorted(out, key=str)


ROWS = [(1, "http://a", "x" * 2000), (2, "http://b", "x" * 2000), (3, None, "é" * 500), (4, "http://c\r\nX: y%", "é" * 500), (5, "u", None), (6, "u", ""), (7, "u", "small"), (8, "u", "small"), (None, "n", "x" * 2000), (None, "n", "only here " * 200)]
ROWS += [(9, "v", "x" * 2000), (9, "w", "x" * 2000)]  # the largest id twice
ROWS += [(20, f"t{k}", f"<p>{k}\r\n\r\n</p>" * 200) for k in range(5)] + [(30 + k, "c", "copy " * 400) for k in range(40)]


def read(spark, rows, **options):
    folder = common.new_folder(spark, "warc-test")
    manifest = warc.write_archive(spark.createDataFrame(rows, PAGES).repartition(5), folder, **options)
    return folder, manifest, warc.read_archive(spark, manifest)


def test_round_trip(spark):
    _, _, got = read(spark, ROWS)
    records = got.collect()
    assert sorted(((r["page_id"], r["url"], r["record_type"], r["payload_bytes"], r["payload_digest"], r["refers_to"]) for r in records), key=str) == by_hand(ROWS)
    assert all(hashlib.sha1(r["payload"]).hexdigest() == r["payload_digest"] for r in records if r["record_type"] == "response")


def files_of(folder):
    fs, base = pafs.FileSystem.from_uri(folder)
    return {f.base_name: fs.open_input_stream(f.path, compression=None).read() for f in fs.get_file_info(pafs.FileSelector(base)) if "shard-" in f.base_name}


def test_shards_and_files_are_deterministic(spark):
    rows = [(k % 50, f"u{k}", f"{k} " * (100 + k * 7 % 300)) for k in range(400)] + [(25, f"h{k}", f"hot {k} " * 300) for k in range(200)]
    options = {"shard_bytes": 40_000, "roll_bytes": 4_000, "sample": 100}
    (f1, _, a), (f2, _, _) = read(spark, rows, **options), read(spark, rows[::-1], **options)
    one, two = files_of(f1), files_of(f2)
    assert one == two and len(one) > 8 and len({n[:12] for n in one}) > 4
    assert sorted(((r["page_id"], r["url"], r["record_type"], r["payload_bytes"], r["payload_digest"], r["refers_to"]) for r in a.collect()), key=str) == by_hand(rows)
    whole = gzip.GzipFile(fileobj=io.BytesIO(next(iter(one.values())))).read()  # members read as one gzip file
    assert whole.count(b"WARC/1.1\r\n") >= 1


def test_only_the_manifests_files_are_read(spark):
    folder, manifest, got = read(spark, ROWS)
    n = got.count()
    fs, base = pafs.FileSystem.from_uri(folder)
    with fs.open_output_stream(f"{base}/shard-000009-0000.warc.gz", compression=None) as out:
        out.write(b"left by a lost task")
    assert warc.read_archive(spark, manifest).count() == n
    name = next(iter(n for n in files_of(folder) if n != "shard-000009-0000.warc.gz"))
    data = fs.open_input_stream(f"{base}/{name}", compression=None).read()
    with fs.open_output_stream(f"{base}/{name}", compression=None) as out:
        out.write(data[:-9])
    with pytest.raises(Exception, match="manifest"):
        warc.read_archive(spark, manifest).collect()


def test_empty(spark):
    assert read(spark, [])[2].count() == 0


def test_revisits_name_their_record(spark):
    folder, _, _ = read(spark, ROWS)
    records = [warc.parse(m) for data in files_of(folder).values() for m in warc.members(data)]
    ids = {h["WARC-Record-ID"]: h for h, _ in records if h["WARC-Type"] == "response"}
    revisits = [h for h, _ in records if h["WARC-Type"] == "revisit"]
    assert len(revisits) > 40
    for h in revisits:
        held = ids[h["WARC-Refers-To"]]
        assert held["WARC-Payload-Digest"] == h["WARC-Payload-Digest"] and held["X-Page-ID"] == h["X-Refers-To-Page-ID"]
        assert (held["WARC-Target-URI"], held["WARC-Date"]) == (h["WARC-Refers-To-Target-URI"], h["WARC-Refers-To-Date"])
    assert {h["WARC-Refers-To-Target-URI"] for h in revisits if h["X-Refers-To-Page-ID"] == "9"} == {"w"}


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()]
    got = warc.op5_warc(spark, sf_dir).collect()
    assert sorted(((r["page_id"], r["url"], r["record_type"], r["payload_bytes"], r["payload_digest"], r["refers_to"]) for r in got), key=str) == by_hand(rows)


def test_clashing_names(spark):
    df = spark.createDataFrame(ROWS, PAGES).selectExpr("*", "1 AS shard", "'k' AS keep", "2 AS size", "'d' AS digest", "3 AS n", "4 AS row")
    manifest = warc.write_archive(df, common.new_folder(spark, "warc-test"))
    got = warc.read_archive(spark, manifest).collect()
    assert sorted(((r["page_id"], r["url"], r["record_type"], r["payload_bytes"], r["payload_digest"], r["refers_to"]) for r in got), key=str) == by_hand(ROWS)
