"""Benchmark decontamination by the q-gram lemma and banded alignment.

Texts and items are compared as bytes in ASCII lower case with each run of white space as one space.  An item is cut
into probes of at most PROBE bytes, one every STEP bytes.  So each verbatim excerpt of PROBE + STEP - 1 = 159 bytes or more
holds a whole probe and is found, wherever it is cut; items of up to PROBE bytes must occur whole, but for the edits.  A probe of m bytes occurs in a text if some stretch of the text
aligns with it at e = RATE * m edits or fewer.  By the q-gram lemma such a stretch shares m + 1 - Q * (e + 1)
q-grams with the probe, on neighbouring diagonals (place in the text less place in the probe).

1. Text places whose q-gram is one of a probe's are marked; stretches with fewer marks than any probe needs are left.
2. The others' marks are counted for each probe in diagonal bands of BAND that overlap by the edit budget.
3. Bands with enough marks are aligned within the band, and count if the edit budget holds.

Items are few against texts; they go to the tasks in blocks of at most BLOCK bytes, one pass over the texts for each block.

Nulls and empty texts or items: match nothing.  Items too short for any shared q-gram (under Q bytes) match nothing.
Repeated rows are each reported.  A null doc_id or item_id is reported as null.  Empty table: no rows.  Extra columns
are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, strings, text_bytes

Q = 10
PROBE = 150
STEP = 10
#: Bytes of text that are searched at once: a place in a found item has up to PROBE / STEP probes.
SEARCHED = 1 << 20
RATE = 0.07
BAND = 32
BLOCK = 8 << 20
U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[[9, 10, 11, 12, 13]] = 32
_MARK_BITS = 20


def plain(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes in the form that is compared, their borders, and each one's place in the text as it was."""
    low = _LOWER[data]
    keep = np.ones(len(low), bool)
    if len(low):
        keep[1:] = (low[1:] != 32) | (low[:-1] != 32)
        keep[borders[:-1][borders[:-1] < len(low)]] = True
    at = np.nonzero(keep)[0]
    return low[at], np.searchsorted(at, borders), at


def qgram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the Q bytes at each place (two overlapping 8-byte loads)."""
    n = len(data) - Q + 1
    if n <= 0:
        return np.zeros(0, U)
    raw = np.ascontiguousarray(data)
    first = np.ndarray((n,), "<u8", raw, 0, (1,))
    second = np.ndarray((n,), "<u8", raw, Q - 8, (1,))
    with np.errstate(over="ignore"):
        x = first * U(0x9E3779B97F4A7C15) ^ second * U(0xD6E8FEB86659FD93)
        return x ^ (x >> U(29))


class Probes:
    """All probes of a block of items, and a sorted list of their q-grams' places."""

    def __init__(self, items: list[tuple]):
        """items: (id, text)."""
        data, borders, _ = plain(*text_bytes(strings(pa.array([t or "" for _, t in items], pa.string()))))
        self.item, self.text, self.edits, self.least = [], [], [], []
        for k in range(len(items)):
            whole = data[borders[k] : borders[k + 1]]
            n = len(whole)
            starts = [0] if n <= PROBE else sorted({*range(0, n - PROBE, STEP), n - PROBE})
            for s in starts:
                part = whole[s : s + PROBE]
                edits = min(int(RATE * len(part)), len(part) // Q - 1)
                if edits >= 0:
                    self.item.append(k)
                    self.text.append(part)
                    self.edits.append(edits)
                    self.least.append(len(part) + 1 - Q * (edits + 1))
        self.ids = [i for i, _ in items]
        self.item, self.edits, self.least = (np.array(x, np.int64) for x in (self.item, self.edits, self.least))
        self.size = np.array([len(t) for t in self.text], np.int64)
        grams = [qgram_hashes(t) for t in self.text]
        self.gram = np.concatenate([*grams, np.zeros(0, U)])
        self.probe = np.repeat(np.arange(len(grams)), [len(g) for g in grams]).astype(np.int64)
        self.place = np.concatenate([np.arange(len(g)) for g in grams] + [np.zeros(0, np.int64)]).astype(np.int64)
        order = np.argsort(self.gram, kind="stable")
        self.gram, self.probe, self.place = self.gram[order], self.probe[order], self.place[order]
        self.mark = np.zeros(1 << _MARK_BITS, bool)
        self.mark[(self.gram >> U(64 - _MARK_BITS)).astype(np.int64)] = True

    def candidates(self, data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """row, probe and lowest diagonal (place in data less place in probe) of each band with enough q-grams."""
        none = (np.zeros(0, np.int64),) * 3
        if not len(self.size):
            return none
        h = qgram_hashes(data)
        at = np.nonzero(self.mark[(h >> U(64 - _MARK_BITS)).astype(np.int64)])[0]
        low = np.searchsorted(self.gram, h[at], side="left")
        hit = self.gram[np.minimum(low, len(self.gram) - 1)] == h[at]
        at, low = at[hit], low[hit]
        row = np.searchsorted(borders, at, side="right") - 1
        inside = at + Q <= borders[row + 1]
        at, low, row = at[inside], low[inside], row[inside]
        if not len(at):
            return none
        # stretches as long as the longest match with as many marks as the least probe needs
        reach = int((self.size + self.edits).max())
        upto = np.searchsorted(at, at + reach)
        dense = upto - np.arange(len(at)) >= int(self.least.min())
        cover = np.zeros(len(at) + 1, np.int64)
        np.add.at(cover, np.nonzero(dense)[0], 1)
        np.add.at(cover, upto[dense], -1)
        keep = np.cumsum(cover[:-1]) > 0
        at, low, row = at[keep], low[keep], row[keep]
        n = np.searchsorted(self.gram, self.gram[low], side="right") - low
        of = np.repeat(np.arange(len(at)), n)
        entry = low[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        probe, diagonal = self.probe[entry], at[of] - self.place[entry] + PROBE
        band, twice = diagonal // BAND, diagonal % BAND <= self.edits[probe]
        rows = np.concatenate([row[of], row[of][twice]])
        probes = np.concatenate([probe, probe[twice]])
        bands = np.concatenate([band, band[twice] - 1])
        order = np.lexsort((bands, probes, rows))
        rows, probes, bands = rows[order], probes[order], bands[order]
        if not len(rows):
            return none
        head = np.nonzero(np.concatenate([[True], (rows[1:] != rows[:-1]) | (probes[1:] != probes[:-1]) | (bands[1:] != bands[:-1])]))[0]
        enough = np.diff(np.append(head, len(rows))) >= self.least[probes[head]]
        head = head[enough]
        return rows[head], probes[head], bands[head] * BAND - PROBE

    def align(self, data: np.ndarray, borders: np.ndarray, row: np.ndarray, probe: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least edits of the probe against a stretch in the band, and where that stretch ends in data."""
        edits, end = np.zeros(len(row), np.int64), np.zeros(len(row), np.int64)
        for k in range(0, len(row), 2000):
            some = slice(k, k + 2000)
            edits[some], end[some] = self._align(data, borders, row[some], probe[some], low[some])
        return edits, end

    def _align(self, data, borders, row, probe, low):
        m, budget = self.size[probe], self.edits[probe]
        most = int(m.max())
        width = BAND + 3 * int(budget.max()) + 1
        pattern = np.zeros((len(row), most), np.int16)
        for k, p in enumerate(probe.tolist()):
            pattern[k, : m[k]] = self.text[p]
        begin = low - budget
        where = begin[:, None] + np.arange(most + width)
        inside = (where >= borders[row][:, None]) & (where < borders[row + 1][:, None])
        text = np.where(inside, data[np.clip(where, 0, len(data) - 1)], -1).astype(np.int16)
        step = np.arange(width)
        cost = np.zeros((len(row), width), np.int32)
        final, last = np.full(len(row), 1 << 20), np.zeros(len(row), np.int64)
        for i in range(most):
            new = cost + (pattern[:, i : i + 1] != text[:, i : i + width])
            new[:, :-1] = np.minimum(new[:, :-1], cost[:, 1:] + 1)
            cost = np.minimum.accumulate(new - step, axis=1) + step
            done = m == i + 1
            if done.any():
                final[done], last[done] = cost[done].min(axis=1), cost[done].argmin(axis=1) + i + 1
        return final, begin + last

    def matches(self, text: pa.StringArray) -> tuple[np.ndarray, ...]:
        """row, item's index, start and end in bytes of the text as it was, and edits, of each probe that occurs."""
        original, old = text_bytes(text)
        data, borders, at = plain(original, old)
        row, probe, low = self.candidates(data, borders)
        if not len(row):
            return (np.zeros(0, np.int64),) * 5
        edits, end = self.align(data, borders, row, probe, low)
        good = edits <= self.edits[probe]
        row, probe, edits, end = row[good], probe[good], edits[good], end[good]
        start = np.maximum(end - self.size[probe], borders[row])
        where = np.append(at, len(original))
        return row, self.item[probe], where[start] - old[row], where[np.minimum(end, borders[row + 1])] - old[row], edits


MATCHES = "doc_id long, item_id long, start long, end long, edits long, probes long"


def find_items(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, item_id, the stretch of bytes that all found probes cover, the least edits of a probe, and their number."""
    spark = docs.sparkSession
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    found: DataFrame | None = None
    for block in _blocks(items):
        shared = spark.sparkContext.broadcast(block)

        def search(batches, shared=shared):
            probes = Probes(shared.value)
            ids = pa.array(probes.ids, pa.int64())
            for batch, texts in slices(batches, SEARCHED):
                row, item, start, end, edits = probes.matches(texts)
                key = row * len(ids) + item
                order = np.argsort(key, kind="stable")
                if not len(order):
                    continue
                k = key[order]
                head = np.nonzero(np.concatenate([[True], k[1:] != k[:-1]]))[0]
                row, item = row[order][head], item[order][head]
                yield pa.record_batch([batch.column("doc_id").take(pa.array(row)), ids.take(pa.array(item)), pa.array(np.minimum.reduceat(start[order], head)), pa.array(np.maximum.reduceat(end[order], head)), pa.array(np.minimum.reduceat(edits[order], head)), pa.array(np.diff(np.append(head, len(order))))], names=[x.split()[0] for x in MATCHES.split(", ")])

        part = docs.mapInArrow(search, MATCHES)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else spark.createDataFrame([], MATCHES)


def _blocks(items: DataFrame):
    """Lists of (item_id, text), each of at most BLOCK bytes or one item; the driver holds one block at a time."""
    block, size = [], 0
    for r in items.select(F.col("item_id").cast("long"), "text").toLocalIterator():
        n = len((r["text"] or "").encode())
        if block and size + n > BLOCK:
            yield block
            block, size = [], 0
        block.append((r["item_id"], r["text"]))
        size += n
    if block:
        yield block


def decontam_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
