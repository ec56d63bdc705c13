"""A deterministic sharded WARC writer and its reader.

Records are ranged into shards by page id. The bounds come from a sample of rows chosen by a hash of their content, so
the same pages give the same shards however they were partitioned; an id that several bounds fall on is dealt over as
many shards by a hash. A task sorts a shard's records and writes them as gzip members, rolling to the next file when
the compressed size is reached. Headers, record ids and digests are made anew from the row alone, with no clock.

A file is written under a temporary name and renamed when whole. The manifest's parts, written by the tasks, name the
files of the write with their digests, and a small file that names the parts is renamed into place last; readers open no
other file, so a lost or repeated task leaves no trace.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

#: Fixed: a record's date is part of its content here, not the time of writing.
DATE = "1970-01-01T00:00:00Z"
_SPACE = uuid.UUID("6f0e2a52-3b0f-5b53-9d6e-6b1a2c9c1e77")


def record_id(page_id: int | None, url: str, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id} {digest} {url}')}>"


def _clean(value: str) -> str:
    """A header value on one line."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def record(page_id: int | None, url: str, payload: bytes, refers_to: tuple[int, str] | None = None) -> bytes:
    """One WARC/1.1 record. A revisit holds the digest and length of its payload, not the payload; it names the record that
    does (refers_to: that one's page id and address)."""
    sha = hashlib.sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    is_revisit = refers_to is not None
    block = http if is_revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id, url, sha.hexdigest())}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_clean(url)}",
        "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(sha.digest()).decode()}",
        f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}",
        f"X-Payload-Length: {len(payload)}",
    ]
    head += [f"X-Page-ID: {page_id}"] if page_id is not None else []
    if is_revisit:
        holder, where = refers_to
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(holder, where, sha.hexdigest())}", f"WARC-Refers-To-Target-URI: {_clean(where)}", f"WARC-Refers-To-Date: {DATE}", f"X-Refers-To-Page-ID: {holder}"]
    return ("\r\n".join([*head, f"Content-Length: {len(block)}"]) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


class _Files:
    """The files of one shard: shard-NNNNNN-NNNN.warc.gz."""

    def __init__(self, folder: str, shard: int, roll: int, level: int):
        self.fs, self.base = pafs.FileSystem.from_uri(folder)
        self.fs.create_dir(self.base, recursive=True)
        self.shard, self.roll, self.level, self.number, self.done, self.out = shard, roll, level, 0, [], None

    def add(self, data: bytes) -> None:
        if self.out is None:
            self.name = f"shard-{self.shard:06d}-{self.number:04d}.warc.gz"
            self.temporary = f"{self.base}/.{self.name}.{uuid.uuid4().hex}"
            self.out, self.size, self.records, self.sha = self.fs.open_output_stream(self.temporary, compression=None), 0, 0, hashlib.sha256()
        z = zlib.compressobj(self.level, zlib.DEFLATED, 31)
        member = z.compress(data) + z.flush()
        self.out.write(member)
        self.sha.update(member)
        self.size, self.records = self.size + len(member), self.records + 1
        if self.size >= self.roll:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None
            path = f"{self.base}/{self.name}"
            try:
                self.fs.move(self.temporary, path)
            except OSError:  # a store that doesn't replace: an earlier attempt wrote the same bytes
                self.fs.delete_file(self.temporary)
            self.done.append((self.name, self.shard, self.records, self.size, self.sha.hexdigest()))
            self.number += 1


def _two_longs(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The first and the next 8 bytes of digests, as a table's key and its check."""
    data = b"".join(d[:16] for d in digests)
    return np.frombuffer(data, dtype="<u8")[::2].astype(np.uint64), np.frombuffer(data, dtype="<i8")[1::2].astype(np.int64)


def _split_digest(batches):
    for batch in batches:
        h, second = _two_longs([bytes.fromhex(d) for d in batch.column(0).to_pylist()])
        yield pa.record_batch({"h": pa.array(h.view(np.int64)), "second": pa.array(second), "keep": batch.column(1), "url": batch.column(2)})


def _write(folder: str, roll: int, level: int, copies: C.SortedTable, least: int):
    """Rows (shard, page_id, url, html), sorted, to files; copies: from a payload's digest to the id that holds it."""

    def run(batches):
        files, done = None, []
        for batch in batches:
            shards, ids, urls, htmls = (batch.column(i).to_pylist() for i in range(4))
            payloads = [h.encode() for h in htmls]
            h, second = _two_longs([hashlib.sha1(p).digest() for p in payloads])
            hit, value = copies.find(h, second)
            for i, (shard, page_id, url, payload) in enumerate(zip(shards, ids, urls, payloads, strict=True)):
                if files is None or files.shard != shard:
                    if files is not None:
                        files.close()
                        done += files.done
                    files = _Files(folder, shard, roll, level)
                holder = int(value["keep"][i])
                revisit = bool(hit[i]) and len(payload) >= least and (page_id is None or page_id < holder)
                files.add(record(page_id, url, payload, (holder, value["url"][i].decode()) if revisit else None))
        if files is not None:
            files.close()
            done += files.done
        if done:
            name, shard, records, size, sha = zip(*done, strict=True)
            yield pa.record_batch({"name": pa.array(name), "shard": pa.array(shard, pa.int32()), "records": pa.array(records, pa.int64()), "bytes": pa.array(size, pa.int64()), "sha256": pa.array(sha)})

    return run


def _bounds(pages: DataFrame, shards: int, rows: int, sample: int) -> np.ndarray:
    """shards - 1 ids between equal shares of a sample of rows, which are chosen by their content: about ``sample`` of
    them, or 20 a shard if that is more, so 2 million at the most shards that there can be, come to the driver. A row that
    is repeated often is one row of the sample with its count."""
    if shards < 2:
        return np.zeros(0, np.int64)
    one_in = max(1, rows // max(sample, 20 * shards))
    chosen = pages.filter((F.pmod(F.xxhash64("page_id", "url"), F.lit(one_in)) == 0) & F.col("page_id").isNotNull())
    counted = chosen.groupBy("page_id").agg(F.count(F.lit(1)).alias("n")).orderBy("page_id").toPandas()
    if not len(counted):
        return np.zeros(0, np.int64)
    upto = np.cumsum(counted["n"].to_numpy())
    wanted = np.arange(1, shards) * int(upto[-1]) // shards
    return counted["page_id"].to_numpy(dtype=np.int64)[np.searchsorted(upto, wanted, side="right")]


def _shard_of(bounds: np.ndarray):
    """The shard of an id: bounds at or below it, and of an id that several bounds fall on one of their shards by a
    hash. Rows without an id go before all others, to shard 0."""

    @F.pandas_udf("int")
    def shard(page_id: pd.Series, spread: pd.Series) -> pd.Series:
        ids = page_id.fillna(np.iinfo(np.int64).min).to_numpy(dtype=np.int64)
        last, first = np.searchsorted(bounds, ids, side="right"), np.searchsorted(bounds, ids, side="left")
        same = np.maximum(last - first, 1)
        return pd.Series((last - spread.to_numpy(dtype=np.int64) % same).astype(np.int32))

    return shard(F.col("page_id"), F.xxhash64("url", "html", "page_id").bitwiseAND(F.lit((1 << 62) - 1).cast("long")))


def write_archive(pages: DataFrame, folder: str, min_dedupe_bytes: int = 1000, shard_bytes: int = 24 << 20, roll_bytes: int = 8 << 20, level: int = 6, sample: int = 20_000, max_shards: int = 100_000) -> str:
    """Writes a record for every row (page_id, url, html) below ``folder``; gives the URI of the manifest.

    Of records with equal payloads of at least ``min_dedupe_bytes`` bytes, those with the largest page id hold the
    payload (response) and others refer to it (revisit), by page id and by record id: of several such records, that with
    the largest address. A null html is an empty payload, a null url an empty address.
    Rows without a page id rank below all others; among equal payloads without any id, all are responses. Rows that
    repeat the largest id are responses each. An empty table gives a manifest without files. Other columns are ignored.
    """
    spark = pages.sparkSession
    C.short_batches(spark)
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    given = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), html.alias("html"))
    size = F.octet_length("html").cast("long")
    # The copies of a payload are pre-aggregated to one row with the largest id; single payloads need none. Writers map
    # the table and look payloads up by digest, so that no text is shuffled for it.
    light = given.filter(size >= min_dedupe_bytes).select(F.sha1(F.encode("html", "UTF-8")).alias("digest"), F.struct("page_id", "url").alias("row"))
    keep = light.groupBy("digest").agg(F.max("row").alias("keep"), F.count(F.lit(1)).alias("n")).filter("n > 1 AND keep.page_id IS NOT NULL")
    split = keep.select("digest", "keep.page_id", F.encode("keep.url", "UTF-8").alias("url")).mapInArrow(_split_digest, "h long, second long, keep long, url binary")
    copies = C.write_sorted_table(split, "warc-copies", ("second", "keep"), ("url",))
    total = given.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    # Beyond max_shards, shards get larger; a task streams its shard, so that costs time and no memory.
    shards = min(max_shards, max(1, -(-total["bytes"] // shard_bytes)))
    shard = _shard_of(_bounds(given.select("page_id", "url"), shards, total["rows"], sample))
    dealt = given.select(shard.alias("shard"), "page_id", "url", "html").repartitionById(shards, "shard")
    ordered = dealt.sortWithinPartitions("shard", "page_id", "url", "html")
    files = ordered.mapInArrow(_write(folder, roll_bytes, level, copies, min_dedupe_bytes), "name string, shard int, records long, bytes long, sha256 string")
    return _commit(folder, files)


def _commit(folder: str, files: DataFrame) -> str:
    """Writes the archive's files and, as the rows come, the parts of the manifest; then the manifest itself, which names the
    folder of its parts and is renamed into place last. The driver holds totals only."""
    spark = files.sparkSession
    parts = f"manifest-{uuid.uuid4().hex}"
    files.write.json(f"{folder}/{parts}")
    listed = spark.read.schema(MANIFEST).json(f"{folder}/{parts}")
    if listed.groupBy("name").count().filter("count > 1").limit(1).count():
        raise RuntimeError("two tasks wrote the same file")
    total = listed.agg(F.count(F.lit(1)).alias("files"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("records", "bytes")]).first()
    fs, base = pafs.FileSystem.from_uri(folder)
    temporary = f"{base}/.manifest.{uuid.uuid4().hex}"
    with fs.open_output_stream(temporary) as out:
        out.write(json.dumps({"parts": parts, **total.asDict()}, sort_keys=True).encode())
    fs.move(temporary, f"{base}/manifest.json")
    return f"{folder}/manifest.json"


# ---- reading -----------------------------------------------------------------------------------------------------


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record."""
    head, _, rest = member.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    return headers, rest[: int(headers["Content-Length"])]


def members(data: bytes):
    """The gzip members of a file, each decompressed."""
    data = memoryview(data)
    while len(data):
        z = zlib.decompressobj(31)
        out = z.decompress(data)
        if not z.eof:
            raise ValueError("a gzip member is cut off")
        yield out
        data = data[len(data) - len(z.unused_data) :] if z.unused_data else data[:0]


#: A row of the manifest: a file of the archive.
MANIFEST = "name string, shard int, records long, bytes long, sha256 string"
FIELDS = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary, file string"


def _read(folder: str, with_payload: bool):
    def run(batches):
        fs, base = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, sha in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with fs.open_input_stream(f"{base}/{name}", compression=None) as source:
                    data = source.read()
                if hashlib.sha256(data).hexdigest() != sha:
                    raise ValueError(f"{name} isn't what its manifest says")
                rows = []
                for member in members(data):
                    h, block = parse(member)
                    revisit = h["WARC-Type"] == "revisit"
                    payload = None if revisit else block.partition(b"\r\n\r\n")[2]
                    digest = base64.b32decode(h["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    length = int(h["X-Payload-Length"])
                    if payload is not None and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != length):
                        raise ValueError(f"a payload in {name} isn't what its record says")
                    url = h["WARC-Target-URI"].replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
                    rows.append((int(h["X-Page-ID"]) if "X-Page-ID" in h else None, url, h["WARC-Type"], length, digest, int(h["X-Refers-To-Page-ID"]) if revisit else None, payload if with_payload else None, name))
                    if len(rows) >= C.ARROW_ROWS:
                        yield _rows(rows)
                        rows = []
                if rows:
                    yield _rows(rows)

    return run


def _rows(rows):
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.string())
    names = [f.split()[0] for f in FIELDS.split(", ")]
    return pa.record_batch({n: pa.array(c, k) for n, c, k in zip(names, zip(*rows, strict=True), kinds, strict=True)})


def read_archive(spark: SparkSession, manifest: str, with_payload: bool = True) -> DataFrame:
    """A row per record of the files that the manifest names: page_id, url (empty where it was null), record_type,
    payload_bytes, payload_digest (hex SHA-1 of the full payload), refers_to, payload (null for revisits), file.
    A file that differs from its manifest, or a payload from its record, raises an error."""
    C.short_batches(spark)
    folder = manifest.rsplit("/", 1)[0]
    fs, path = pafs.FileSystem.from_uri(manifest)
    with fs.open_input_stream(path) as source:
        index = json.loads(source.read())
    listed = spark.read.schema(MANIFEST).json(f"{folder}/{index['parts']}").select("name", "sha256")
    # A task a file, as long as they are few; a worker holds a file at a time.
    tasks = max(1, min(index["files"], 16 * C.shuffle_partitions(spark)))
    return listed.repartition(tasks, "name").mapInArrow(_read(folder, with_payload), FIELDS)


def op5_warc(spark, sf_dir: str) -> DataFrame:
    """Writes all pages as a WARC archive and reads it back."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    records = read_archive(spark, write_archive(pages, C.new_folder(spark, "warc")), with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


#: Rows that repeat a page_id with one payload of the largest id are responses each, as in write_archive.
OP5_SQL = """
WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
c AS (SELECT html, max(page_id) AS keep FROM p WHERE strlen(html) >= 1000 GROUP BY html),
r AS (SELECT p.*, strlen(p.html) AS n, keep, keep IS NOT NULL AND (page_id IS NULL OR page_id < keep) AS again FROM p LEFT JOIN c USING (html))
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN keep END AS refers_to, url FROM r
"""

