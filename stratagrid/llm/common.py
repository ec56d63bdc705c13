"""Plumbing that the corpus operators share: the shared folder, written tables, memory-mapped arrays, text keys.

Every intermediate that must outlive a lost executor is written below the folder named by ``spark.checkpoint.dir`` (a
folder that driver and executors share); one is made only where that setting is absent, as in tests.
"""

from __future__ import annotations

import atexit
import contextlib
import os
import re
import tempfile
import uuid

import numpy as np
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch between the JVM and a Python worker; texts can be long, so batches are short.
ARROW_ROWS = 512
#: Tasks of a shuffle at most.
MOST_TASKS = 1 << 15
#: Keys of one array of a sorted table.
SEGMENT = 1 << 20
#: Narrow rows that one file of a stored table holds at least, if it has so many.
ROWS_A_FILE = 1 << 18
#: Lower-cases A-Z in UTF-8 bytes and leaves every other byte alone.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: The same, and every ASCII byte but letters and digits becomes a space.
WORDS = bytes(32 if c < 128 and not chr(c).isalnum() else LOWER[c] for c in range(256))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_root(spark: SparkSession) -> str:
    """URI of the folder that driver and executors share."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = getattr(shared_root, "own", None)
        if base is None:
            base = shared_root.own = "file://" + tempfile.mkdtemp(prefix="stratagrid-shared-")
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(base)
    if base.startswith("file:"):
        base = "file://" + "/" + base[5:].lstrip("/")
    elif "://" not in base:
        base = "file://" + os.path.abspath(base)
    return base.rstrip("/")


_made: set[str] = set()


def new_folder(spark: SparkSession, name: str) -> str:
    """URI of a folder of its own below the shared one. It goes when the driver's Python ends, if not before."""
    if not _made:
        atexit.register(lambda: [remove(uri) for uri in list(_made)])
    uri = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    _made.add(uri)
    return uri


def remove(uri: str) -> None:
    """Deletes a folder of ours when its content is no longer needed."""
    _made.discard(uri)
    fs, path = pafs.FileSystem.from_uri(uri)
    with contextlib.suppress(OSError):
        fs.delete_dir(path)


def materialize(df: DataFrame, name: str, rows: int | None = None, **options: str) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it back: cuts lineage, and a lost executor loses nothing.
    rows: how many narrow rows df has at most, where that is known; few rows go to few files."""
    path = new_folder(df.sparkSession, name)
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROWS_A_FILE)))
    df.write.options(**options).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def short_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches of this session, since one row can hold a very long text."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(spark: SparkSession, amount: int = 0, each: int = 1) -> int:
    """Bits b such that 2**b buckets are as many as the session's shuffle partitions, or more if they would hold more than
    ``each`` of an ``amount`` otherwise."""
    return max(1, (max(shuffle_partitions(spark), -(-amount // each)) - 1).bit_length())


def dealt(df: DataFrame, bits: int, bucket: str = "bucket", *order: str) -> DataFrame:
    """Rows by their bucket, a number of so many bits. Beyond MOST_TASKS a task has several buckets, one after another."""
    beyond = max(0, bits - (MOST_TASKS.bit_length() - 1))
    parts = df.repartitionById(1 << (bits - beyond), F.shiftright(bucket, beyond))
    return parts.sortWithinPartitions(bucket, *order) if order or beyond else parts


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """Bytes of all texts, which bound what is counted of them."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text_col).cast("string")).cast("long")), F.lit(0)).alias("n")).first()["n"]


def top_bits(h: Column, bits: int) -> Column:
    """The bucket of a 64-bit hash, its leading bits, as a partition id."""
    return (F.shiftrightunsigned(h, 64 - bits) if bits else F.lit(0)).cast("int")


def text_remainder(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 5; a missing id counts as the empty text."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 5


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(text, _UPPER, _LOWER)


# ---- arrays in the shared folder, memory-mapped by workers -------------------------------------------------------


def put_array(folder: str, name: str, array: np.ndarray) -> None:
    """Writes one array under a temporary name and renames it, so that readers and repeated tasks see whole files only."""
    fs, base = pafs.FileSystem.from_uri(folder)
    fs.create_dir(base, recursive=True)
    temporary = f"{base}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(temporary) as out:
        np.lib.format.write_array(out, np.ascontiguousarray(array), allow_pickle=False)
    try:
        fs.move(temporary, f"{base}/{name}.npy")
    except OSError:  # a store that doesn't replace: another attempt of the same task was first
        fs.delete_file(temporary)


_open: dict[tuple[str, str], np.ndarray] = {}


def get_array(folder: str, name: str) -> np.ndarray:
    """The array, mapped into memory; of a remote store an unnamed local copy is mapped, which goes with the process."""
    if (folder, name) not in _open:
        if len(_open) > 4096:
            _open.clear()
        fs, base = pafs.FileSystem.from_uri(folder)
        path = f"{base}/{name}.npy"
        if isinstance(fs, pafs.LocalFileSystem):
            file = open(path, "rb")  # noqa: SIM115  the mapping needs it
        else:
            file = tempfile.TemporaryFile()  # noqa: SIM115
            with fs.open_input_stream(path) as src:
                while block := src.read(1 << 24):
                    file.write(block)
            file.flush()
            file.seek(0)
        np.lib.format.read_magic(file)
        shape, _, kind = np.lib.format.read_array_header_1_0(file)
        empty = 0 in shape  # can't be mapped
        _open[folder, name] = np.zeros(shape, kind) if empty else np.memmap(file, dtype=kind, mode="r", offset=file.tell(), shape=shape)
        file.close()
    return _open[folder, name]


class SortedTable:
    """A distributed map from unsigned 64-bit hashes to values: 2**bits buckets by leading bits, each in segments of
    sorted keys of bounded size, with parallel value arrays and an index of the segments' first keys. Workers map the
    files and look up sorted queries in bulk; nothing is broadcast, so the table may outgrow any one machine's memory.

    Values are numbers; of ``texts``, bytes are kept one after another, and their ends as numbers. A value ``second``
    tells keys of equal hash apart."""

    def __init__(self, folder: str, bits: int, values: tuple[str, ...] = (), texts: tuple[str, ...] = ()):
        self.folder, self.bits, self.values, self.texts = folder, bits, values, texts

    def bucket_of(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(keys), np.int64)

    def write_segment(self, bucket: int, segment: int, keys: np.ndarray, **values) -> None:
        put_array(self.folder, f"keys-{bucket}-{segment}", keys)
        for name in self.values:
            put_array(self.folder, f"{name}-{bucket}-{segment}", values[name])
        for name in self.texts:
            put_array(self.folder, f"{name}-{bucket}-{segment}", np.frombuffer(b"".join(values[name]), np.uint8))
            put_array(self.folder, f"{name}_ends-{bucket}-{segment}", np.cumsum([len(x) for x in values[name]], dtype=np.int64))

    def write_index(self, bucket: int, firsts: list[int]) -> None:
        put_array(self.folder, f"index-{bucket}", np.array(firsts, dtype=np.uint64))

    def write_bucket(self, bucket: int, keys: np.ndarray, **values) -> None:
        """A bucket's keys in order, in segments that don't part equal keys."""
        firsts, lo = [], 0
        while lo < len(keys):
            hi = len(keys) if len(keys) - lo <= SEGMENT else int(np.searchsorted(keys, keys[lo + SEGMENT], side="left"))
            hi = hi if hi > lo else int(np.searchsorted(keys, keys[lo], side="right"))
            self.write_segment(bucket, len(firsts), keys[lo:hi], **{k: v[lo:hi] for k, v in values.items()})
            firsts.append(int(keys[lo]))
            lo = hi
        self.write_index(bucket, firsts)

    def _parts(self, unique: np.ndarray):
        """(from, to, bucket, segment) of runs of sorted queries that one segment can hold."""
        buckets = self.bucket_of(unique)
        cuts = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]]) if len(unique) else []
        for lo, hi in zip(cuts, np.r_[cuts[1:], len(unique)] if len(unique) else [], strict=True):
            firsts = get_array(self.folder, f"index-{int(buckets[lo])}")
            of = np.searchsorted(firsts, unique[lo:hi], side="right") - 1
            for s in np.unique(of[of >= 0]):
                own = np.flatnonzero(of == s)
                yield lo + own[0], lo + own[-1] + 1, int(buckets[lo]), int(s)

    def find(self, queries: np.ndarray, second: np.ndarray | None = None) -> tuple[np.ndarray, dict]:
        """For each query whether it is a key, and its values (0, or no bytes, where it isn't). second: what tells queries of
        equal hash apart; it must be a value of the table."""
        queries = np.asarray(queries, dtype=np.uint64)
        if second is not None:  # distinct pairs; hashes are nearly always distinct as well
            order = np.lexsort((second, queries))
            q, s2 = queries[order], second[order]
            first = np.r_[True, (q[1:] != q[:-1]) | (s2[1:] != s2[:-1])] if len(q) else np.zeros(0, bool)
            unique, wanted, back = q[first], s2[first], np.empty(len(q), np.int64)
            back[order] = np.cumsum(first) - 1
        else:
            unique, back = np.unique(queries, return_inverse=True)
        found = np.zeros(len(unique), dtype=bool)
        out = {name: np.zeros(len(unique), dtype=np.int64) for name in self.values} | {name: np.full(len(unique), b"", dtype=object) for name in self.texts}
        for lo, hi, b, s in self._parts(unique):
            keys = get_array(self.folder, f"keys-{b}-{s}")
            at = np.minimum(np.searchsorted(keys, unique[lo:hi]), len(keys) - 1)
            hit = keys[at] == unique[lo:hi]
            if second is not None:
                checks, mine = get_array(self.folder, f"second-{b}-{s}"), wanted[lo:hi]
                while (other := hit & (checks[at] != mine)).any():  # the next key of that hash, if there is one
                    at[other] += 1
                    inside = at < len(keys)
                    at = np.minimum(at, len(keys) - 1)
                    hit &= inside & (keys[at] == unique[lo:hi])
            found[lo:hi] = hit
            for name in self.values:
                v = get_array(self.folder, f"{name}-{b}-{s}")
                if out[name].dtype != v.dtype:
                    out[name] = out[name].astype(v.dtype)
                out[name][lo:hi] = np.where(hit, v[at], 0)
            for name in self.texts:
                data, ends = get_array(self.folder, f"{name}-{b}-{s}"), get_array(self.folder, f"{name}_ends-{b}-{s}")
                for i in np.flatnonzero(hit).tolist():
                    out[name][lo + i] = data[(ends[at[i] - 1] if at[i] else 0) : ends[at[i]]].tobytes()
        return found[back], {name: v[back] for name, v in out.items()}


class BucketWriter:
    """mapInArrow function: rows (bucket, h and the values) sorted by bucket and h become the files of a SortedTable. A
    worker holds a segment at a time."""

    def __init__(self, table: SortedTable):
        self.table = table

    def __call__(self, batches):
        import pyarrow as pa

        table, names = self.table, [*self.table.values, *self.table.texts]
        bucket, firsts, total, held, kept = None, [], 0, [], 0

        def flush(last: bool):
            """Writes what is held, but for the last key's rows if the bucket goes on."""
            nonlocal firsts, held, kept
            rows = pa.concat_tables(held).combine_chunks()
            keys = rows["h"].to_numpy().view(np.uint64)
            n = len(keys) if last else int(np.searchsorted(keys, keys[-1], side="left"))
            if n:
                columns = {v: rows[v].to_pylist()[:n] if v in table.texts else rows[v].to_numpy()[:n] for v in names}
                table.write_segment(bucket, len(firsts), keys[:n], **columns)
                firsts.append(int(keys[0]))
            held, kept = ([rows.slice(n)], len(keys) - n) if n < len(keys) else ([], 0)

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            of = rows["bucket"].to_numpy()
            cuts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(of)], strict=True):
                if bucket is not None and of[lo] != bucket:
                    flush(True)
                    table.write_index(bucket, firsts)
                    yield pa.record_batch({"bucket": pa.array([bucket], pa.int32()), "n": pa.array([total], pa.int64())})
                    firsts, total = [], 0
                bucket = int(of[lo])
                held.append(rows.slice(lo, hi - lo))
                kept, total = kept + hi - lo, total + hi - lo
                if kept >= SEGMENT:
                    flush(False)
        if bucket is not None:
            if held:
                flush(True)
            table.write_index(bucket, firsts)
            yield pa.record_batch({"bucket": pa.array([bucket], pa.int32()), "n": pa.array([total], pa.int64())})


def write_sorted_table(rows: DataFrame, name: str, values: tuple[str, ...] = (), texts: tuple[str, ...] = ()) -> SortedTable:
    """Writes rows (h long, the values and the texts) as a SortedTable; Spark sorts them. Buckets without rows get an empty
    index."""
    spark = rows.sparkSession
    bits = fold(spark)
    table = SortedTable(new_folder(spark, name), bits, values, texts)
    of = dealt(rows.select(top_bits(F.col("h"), bits).alias("bucket"), "h", *values, *texts), bits, "bucket", "h")
    done = {r["bucket"] for r in of.mapInArrow(BucketWriter(table), "bucket int, n long").collect()}
    for b in set(range(1 << bits)) - done:
        table.write_index(b, [])
    return table
