"""Token counts by a map-side two-tier look-up.

The first tier is a compact hash table of the corpus's frequent pre-tokens and how many tokens each has; it is broadcast.  What it
lacks goes to the second tier: each Python worker encodes it once and remembers the count as long as its cache has room.  A text's count is
the sum over its pre-tokens, so no pre-token is ever shuffled and no ids are built.

Frequent pre-tokens are found over all texts: each task keeps a summary of at most TABLE weighted entries, from which
it takes the same weight off all entries when it is full (Misra and Gries), and summaries are merged FAN at a time in the same
way until one is left.  It holds every pre-token of at most LONGEST bytes that makes up more than one in TABLE of all of them.
Only the speed depends on the table, never a count.

Texts are cut where the tokenizer's pattern surely cuts (see tokens.Encoder), so that a few units are two or more
pre-tokens; a tokenizer whose pattern can't be seen from bytes, or a sentencepiece model, takes a text as one unit.

Nulls and empty texts: a null text counts as empty: no bytes, no tokens.  A very long text is one row of a task (about 20 times its bytes).  Repeated rows and null doc_ids
give a row each.  Special strings inside a text are handled as the library does by default.  Empty table: no rows.  Columns other than the
key and the text are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import hashes, save, slices, text_bytes
from .tokens import Encoder, tokenizer_json

#: Entries of the broadcast table (about 40 bytes each) and of each task's summary.
TABLE = 1 << 16
#: Summaries merged at once.
FAN = 16
#: Longer units aren't worth a place in a table.
LONGEST = 40
SLICE = 2 << 20
LIMIT = 1024
#: Counts that a worker remembers beyond the table, in a dict of about 120 bytes an entry.
REMEMBERED = 200_000


class LengthTable:
    """Open addressing over the hashes of some byte strings; get() gives each string's number, -1 for one that isn't there.

    Strings themselves are compared after their hashes, so an answer is never wrong.
    """

    def __init__(self, units: list[bytes], numbers: np.ndarray):
        self.numbers = np.asarray(numbers, np.int32)
        self.data, self.borders = text_bytes(pa.array(units, pa.binary())) if units else (np.zeros(0, np.uint8), np.zeros(1, np.int64))
        self.hash = hashes(pa.array(units, pa.binary()))
        bits = max(1, int(2 * len(units)).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.slots = np.full(1 << bits, -1, np.int32)
        left, at = np.arange(len(units)), (self.hash & self.mask).astype(np.int64)
        while len(left):
            free = self.slots[at] < 0
            self.slots[at[free]] = left[free]  # of several that want a slot, the last gets it
            lost = self.slots[at] != left
            left, at = left[lost], (at[lost] + 1) & int(self.mask)

    def get(self, units: pa.BinaryArray) -> np.ndarray:
        out = np.full(len(units), -1, np.int64)
        if not len(units) or not len(self.hash):
            return out
        asked = hashes(units)
        found, left, at = np.full(len(units), -1, np.int64), np.arange(len(units)), (asked & self.mask).astype(np.int64)
        while len(left):
            here = self.slots[at]
            same = (here >= 0) & (self.hash[here] == asked[left])
            found[left[same]] = here[same]
            on = (here >= 0) & ~same
            left, at = left[on], (at[on] + 1) & int(self.mask)
        hit = np.nonzero(found >= 0)[0]
        data, borders = text_bytes(units)
        size, want = np.diff(borders)[hit], found[hit]
        hit, want, size = (x[size == np.diff(self.borders)[want]] for x in (hit, want, size))
        if len(hit):
            place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            differs = data[np.repeat(borders[hit], size) + place] != self.data[np.repeat(self.borders[want], size) + place]
            wrong = np.bincount(np.repeat(np.arange(len(hit)), size)[differs], minlength=len(hit)) > 0
            out[hit[~wrong]] = self.numbers[want[~wrong]]
        return out


class _Bytewise:
    """A tokenizers file: units by Encoder."""

    def __init__(self, json: str):
        self.encoder = Encoder(json)

    def units(self, text: pa.StringArray):
        return self.encoder._units(text)

    def counts(self, units: list[bytes]) -> list[int]:
        return [len(x) // 4 for x in self.encoder._fresh(units)] if units else []


class _Pieces:
    """A sentencepiece model: a text is one unit."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)

    def units(self, text: pa.StringArray):
        coded = text.cast(pa.binary()).dictionary_encode()
        return np.ones(len(text), np.int64), coded.indices.to_numpy(zero_copy_only=False), coded.dictionary

    def counts(self, units: list[bytes]) -> list[int]:
        return [len(x) for x in self.model.encode([u.decode() for u in units], num_threads=1)] if units else []


def _library(source):
    return _Bytewise(source) if isinstance(source, str) else _Pieces(source)


def _source(tokenizer: str) -> str | bytes:
    """The tokenizer's file, read by the driver: a fixed file of a few MB."""
    if tokenizer.endswith(".json"):
        return tokenizer_json(tokenizer)
    with open(tokenizer, "rb") as f:
        return f.read()


def trimmed(found: Counter, most: int) -> Counter:
    """At most `most` entries: all lose the weight of the first that has no room, and those without weight go."""
    if len(found) <= most:
        return found
    weights = np.fromiter(found.values(), np.int64, len(found))
    off = int(np.partition(weights, len(weights) - most - 1)[len(weights) - most - 1])
    return Counter({k: v - off for k, v in found.items() if v > off})


SUMMARY = "part int, units array<binary>, weights array<bigint>"


def _summary(part: int, found: Counter) -> pa.RecordBatch:
    columns = [pa.array([part], pa.int32()), pa.array([[*found]], pa.list_(pa.binary())), pa.array([[*found.values()]], pa.list_(pa.int64()))]
    return pa.record_batch(columns, names=["part", "units", "weights"])


def frequent_units(docs: DataFrame, tokenizer: str, table: int = TABLE, text: str = "text", fan: int = FAN) -> list[bytes]:
    """Frequent pre-tokens of all texts, at most `table`; only the last summary comes to the driver."""
    source = docs.sparkSession.sparkContext.broadcast(_source(tokenizer))

    def summarise(batches):
        library, found = _library(source.value), Counter()
        for _, texts in slices(batches, SLICE):
            _, index, units = library.units(texts)
            short = np.nonzero(pc.less_equal(pc.binary_length(units), LONGEST).to_numpy(zero_copy_only=False))[0]
            weights = np.bincount(index, minlength=len(units))[short]
            found.update(dict(zip(units.take(pa.array(short)).to_pylist(), weights.tolist(), strict=True)))
            if len(found) > 2 * table:
                found = trimmed(found, table)
        yield _summary(TaskContext.get().partitionId(), trimmed(found, table))

    def merge(key, rows):
        found: Counter = Counter()
        for units, weights in zip(rows["units"], rows["weights"], strict=True):
            found.update(dict(zip(units.values.to_pylist(), weights.values.to_pylist(), strict=True)))
            found = trimmed(found, table)
        return pa.Table.from_batches([_summary(key[0].as_py(), found)])

    rows = save(docs.select(F.col(text).alias("text")).mapInArrow(summarise, SUMMARY), "summaries")
    parts = rows.agg(F.max("part")).first()[0] or 0
    while parts > 0:
        rows = save(rows.groupBy(F.floor(F.col("part") / fan).cast("int").alias("to")).applyInArrow(merge, SUMMARY), "summaries")
        parts //= fan
    last = rows.first()
    return [bytes(u) for u in last.units] if last else []


def token_counts(docs: DataFrame, tokenizer: str, limit: int = LIMIT, table: int = TABLE, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of each row, without begin, end or added special tokens."""
    spark = docs.sparkSession
    units = frequent_units(docs, tokenizer, table, text)
    given = _source(tokenizer)
    source = spark.sparkContext.broadcast(given)
    first = spark.sparkContext.broadcast(LengthTable(units, np.array(_library(given).counts(units), np.int64)))

    def count(batches):
        library, known, table = _library(source.value), {}, first.value
        for batch, texts in slices(batches, SLICE):
            n, index, units = library.units(texts)
            size = table.get(units)
            missing = np.nonzero(size < 0)[0]
            names = units.take(pa.array(missing)).to_pylist()
            found = [known.get(u, -1) for u in names]
            new = [k for k, x in enumerate(found) if x < 0]
            for k, x in zip(new, library.counts([names[k] for k in new]), strict=True):
                found[k] = x
                if len(known) < REMEMBERED and len(names[k]) <= LONGEST:
                    known[names[k]] = x
            size[missing] = found
            upto = np.concatenate([[0], np.cumsum(size[index])])
            ends = np.concatenate([[0], np.cumsum(n)])
            total = np.diff(upto[ends])
            length = pc.binary_length(texts).cast(pa.int64())
            yield pa.record_batch([batch.column(0), length, pa.array(total, pa.int64()), pa.array(total > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def token_count_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))
