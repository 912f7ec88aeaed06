"""Packing of documents into sequences: first-fit decreasing with a tournament tree of free room.

A document's ids (with its end id) are cut into pieces of the capacity and a rest.  Pieces are dealt to random groups by
a hash of their task and place in it, so repeated rows don't meet in one group.  In each group the pieces go, longest first, into the first sequence with room; a
tournament tree over the sequences' room finds it in log time.  Groups are independent, so that only piece lengths
are shuffled, and a group has GROUP pieces or so whatever the size of the table and of its documents.

Nulls and empty texts: a null or empty text is its end id alone.  A very long text is one row of a task (about 40 times its bytes).  Repeated rows are documents of their own.  A null doc_id
is dealt like any other.  Empty table: no pieces.  Extra columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, small_batches, tidied
from .tokens import Encoder, tokenizer_json

CAPACITY = 1024
GROUP = 8192
SLICE = 2 << 20
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class Rooms:
    """A tournament tree: each node has the most room below it; first(n) is the first bin with room for n."""

    def __init__(self, bins: int, capacity: int):
        self.size = 1 << max(0, bins - 1).bit_length()
        self.tree = [capacity] * (2 * self.size)

    def first(self, n: int) -> int:
        tree, k = self.tree, 1
        while k < self.size:
            k *= 2
            if tree[k] < n:
                k += 1
        return k - self.size

    def take(self, bin: int, n: int) -> int:
        """Uses n of the bin's room; what had been used before."""
        tree, k = self.tree, bin + self.size
        tree[k] -= n
        left = tree[k]
        k //= 2
        while k:
            most = max(tree[2 * k], tree[2 * k + 1])
            if tree[k] == most:
                break
            tree[k] = most
            k //= 2
        return left


def first_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Each length's bin and its offset there.  Lengths must be 1 to capacity.  Ties go in the given order."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    full = int((lengths == capacity).sum())
    bins[order[:full]] = np.arange(full)
    rest = order[full:]
    rooms = Rooms(len(rest), capacity)
    for k, n in zip(rest.tolist(), lengths[rest].tolist(), strict=True):
        at = rooms.first(n)
        left = rooms.take(at, n)
        bins[k], offsets[k] = full + at, capacity - left - n
    return bins, offsets


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY, text: str = "text", key: str = "doc_id") -> DataFrame:
    """A row for each piece of each document, with the checksum of its ids and a number of its own (nth)."""
    json = docs.sparkSession.sparkContext.broadcast(tokenizer_json(tokenizer))

    def cut(batches):
        encoder, done = Encoder(json.value), TaskContext.get().partitionId() << 36
        for batch, texts in slices(batches, SLICE):
            ids, borders = encoder.encode(texts, end_id)
            size = np.diff(borders)
            n = (size + capacity - 1) // capacity
            row = np.repeat(np.arange(len(size)), n)
            start = (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)) * capacity
            length = np.minimum(capacity, size[row] - start)
            data, at = memoryview(ids.astype("<u4")).cast("B"), (borders[row] + start) * 4
            crc = [zlib.crc32(data[a:b]) for a, b in zip(at.tolist(), (at + length * 4).tolist(), strict=True)]
            yield pa.record_batch([batch.column(key).cast(pa.int64()).take(pa.array(row)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(size[row]), pa.array(np.arange(done, done + len(row)))], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "nth"])
            done += len(row)

    return small_batches(docs).select(F.col(key), F.col(text).alias("text")).mapInArrow(tidied(cut), PIECES + ", nth long")


def pack(cut: DataFrame, groups: int, capacity: int = CAPACITY, seed: int = 9) -> DataFrame:
    """Adds sequence_id (the group's number in the upper half) and offset to rows with a length."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "start", "ids_crc32"], kind="stable")
        bins, offsets = first_fit_decreasing(pdf["length"].to_numpy(), capacity)
        return pdf.assign(sequence_id=(pdf["group"].to_numpy(np.int64) << 32) + bins, offset=offsets).drop(columns=["group", "nth"])

    dealt = cut.withColumn("group", F.pmod(F.xxhash64("nth", F.lit(seed)), F.lit(groups)).cast("long"))
    return dealt.groupBy("group").applyInPandas(one, f"{PIECES}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    rows, size = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    groups = max(1, -(-(rows + size // (2 * capacity)) // group))  # a token has two bytes or more
    return pack(pieces(docs, tokenizer, end_id, capacity), groups, capacity)


def pack_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
