"""Helpers that the text operators share: work tables, Arrow slices, words, row numbering."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes of text that a Python worker handles at once.
SLICE_BYTES = 8 << 20
#: Bytes of a record batch that the JVM hands to a Python worker.
BATCH_BYTES = 4 << 20
#: Rows of one id or key column that a broadcast may hold (about 64 MB).
BROADCAST_ROWS = 2_000_000


def work_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; a temporary one only where that is unset and the master is
    this machine."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="pingloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def small_batches(docs: DataFrame) -> DataFrame:
    """docs; texts go to Python workers in batches of BATCH_BYTES at most from here on in this session.  By rows alone a batch of long texts takes
    tens of MB in the JVM's buffers and in each worker, and neither gives them back."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return docs


def new_path(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/pingloom/{uuid.uuid4().hex}/{name}"


def save(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if its counted rows stay under the limit; else as it is, for a shuffle join."""
    return F.broadcast(df) if rows <= limit else df


def without_ids(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of docs whose key is not among ids (null counts as a key)."""
    ids = save(ids.select(F.col(ids.columns[0]).alias("__gone")).distinct(), "gone")
    ids = sized(ids, ids.count())
    return docs.join(ids, docs[key].eqNullSafe(ids["__gone"]), "left_anti")


def tidied(step):
    """A function over record batches that, when it ends, gives the worker's free memory back to the system: workers serve
    one task after another, and what one step freed would else count beside what the next one needs."""

    def run(batches):
        try:
            yield from step(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)

    return run


def strings(column) -> pa.StringArray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.type != pa.string():
        column = column.cast(pa.string())
    return pc.fill_null(column, "") if column.null_count else column


def slices(batches, limit: int = SLICE_BYTES, column: str = "text"):
    """(record batch, its texts with null as empty) in runs of rows of at most `limit` bytes, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        text = strings(batch.column(column))
        ends = np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64))
        at, done = 0, 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(at, to - at), text.slice(at, to - at)
            at, done = to, int(ends[to - 1])


def text_bytes(text: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and the n + 1 borders between them."""
    if not len(text):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    borders = np.frombuffer(text.buffers()[1], np.int32, len(text) + 1, text.offset * 4).astype(np.int64)
    data = text.buffers()[2]
    data = np.frombuffer(data, np.uint8)[borders[0] : borders[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return data, borders - borders[0]


def words(text: pa.StringArray) -> tuple[np.ndarray, np.ndarray, pa.StringArray]:
    """Words are runs of other bytes than \\x20 and \\x09-\\x0D.  Returns each word's row, its place in the list of distinct words, and that list."""
    split = pc.ascii_split_whitespace(text)
    flat = split.flatten()
    row = np.repeat(np.arange(len(text)), np.diff(split.offsets.to_numpy()))
    full = pc.greater(pc.binary_length(flat), 0)
    if not pc.all(full).as_py():
        row, flat = row[full.to_numpy(zero_copy_only=False)], flat.filter(full)
    coded = flat.dictionary_encode()
    return row, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (public splitmix64 constants)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def hashes(values: pa.StringArray, seed: int = 0) -> np.ndarray:
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(x, seed) for x in values.cast(pa.binary()).to_pylist()), U, len(values))


def window_hashes(row: np.ndarray, word_hash: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of `width` words in one row, and the place of its first word."""
    n = len(row) - width + 1
    if n <= 0:
        return np.zeros(0, U), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        h = word_hash[:n].copy()
        for k in range(1, width):
            h = h * U(0x9E3779B97F4A7C15) + word_hash[k : k + n]
    at = np.nonzero(row[:n] == row[width - 1 :])[0]
    return mix(h[at]), at


def running_start(df: DataFrame, by: list, amount: str, name: str = "start") -> DataFrame:
    """Adds the sum of `amount` over all rows before this one in the order of `by`.

    Rows are range-partitioned and written once with their partition's number; only one total a
    partition goes through a single task.  Ties in `by` get some order, each row once.
    """
    spark = df.sparkSession
    ordered = save(df.repartitionByRange(*by).withColumn("__part", F.spark_partition_id()), "ordered")
    totals = ordered.groupBy("__part").agg(F.sum(amount).alias("__sum"), F.min(F.struct(*by)).alias("__first"))
    before = Window.orderBy("__first", "__part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("__part", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"))
    within = Window.partitionBy("__part").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    return (
        ordered.withColumn("__in", F.coalesce(F.sum(amount).over(within), F.lit(0)))
        .join(F.broadcast(totals), "__part")
        .withColumn(name, (F.col("__before") + F.col("__in")).cast("long"))
        .drop("__part", "__before", "__in")
    )


_CLASS = np.ones(256, np.int8)
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[[b for b in range(33, 127) if not chr(b).isalnum() and b != 95]] = 2


def word_runs(text: pa.StringArray) -> tuple[np.ndarray, np.ndarray, pa.BinaryArray]:
    """Like words(), but runs of ASCII punctuation are words of their own."""
    data, borders = text_bytes(text)
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), pa.array([], pa.binary())
    kind = _CLASS[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = kind[1:] != kind[:-1]
    cut[borders] = True
    starts = np.nonzero(cut)[0]
    coded = pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
    row = np.repeat(np.arange(len(text)), np.diff(np.searchsorted(starts, borders)))
    some = kind[starts[:-1]] > 0
    return row[some], coded.indices.to_numpy(zero_copy_only=False)[some].astype(np.int64), coded.dictionary
