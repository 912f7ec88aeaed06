"""Near duplicates by ProbMinHash signatures, banding, verification and components.

A document is the multiset of its runs of five words (ASCII white space parts words, case is folded; a text of one to
four words is one run); a run's weight is how often it occurs.  ProbMinHash: each run is a Poisson process whose rate is
its weight; an arrival falls into a random register, which keeps the earliest; a run stops once its next arrival lies
behind all registers.  Two documents agree in a register with the probability Jaccard similarity of their weights.

1. Documents with equal multisets (two 64-bit sums) are copies: the least doc_id represents them.
2. Representatives meet where all ROWS registers of one of BANDS bands agree.  At similarity 0.8 a pair is missed with
   probability (1 - 0.8**ROWS)**BANDS, 3 in a million.
3. The member of a bucket that has the largest buckets is its pivot, near the middle of its group.  Each pair of a pivot
   and a member is compared once, whatever number of buckets it shares.  Links join classes.
4. Two other members A and B of a pivot P's buckets: let D(X) be the runs in which X and P differ.  If A isn't linked to P,
   A and B can only be linked if D(A) and D(B) share more than a share of D(A) that the sizes tell; so they share one of
   the first runs of each in a common order (prefix filtering; runs that P lacks come first, they are the rarer ones).
   Members of different classes meet by these runs.  Each carries a sketch, the parities of its runs in PARITIES hashed cells:
   cells of unlike parity are at most the runs that only one of two has, so the join drops pairs that can't be linked, and
   none that can.  Those left are compared.  No bucket, run or pair is capped, and no step lists all pairs of a group.
5. Each document gets the least doc_id of its class.

A pair is linked if the Jaccard similarity of its runs, or that of its weighted runs (sum of lesser by sum of greater counts),
is THRESHOLD or more.  Probability Jaccard is never less than the weighted one, so signatures find these pairs.

Nulls and empty texts: a text without words is a class of its own.  Repeated rows: copies of each other, each with its row.
A null doc_id is a class of its own and isn't compared.  Rows of one doc_id and unlike texts are one class.  A very long text
is one row of a task and needs about 60 times its bytes there.  Empty table: no rows.  Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import hashes, mix, save, sized, slices, small_batches, tidied, window_hashes, words

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 4
#: Bytes of text whose signatures are made at once.
SLICE = 2 << 20
REGISTERS = BANDS * ROWS
#: Cells of a sketch; its longs hold their parities, and the number of runs.
PARITIES = 1024
SKETCH = PARITIES // 64
U = np.uint64


def shingles(text: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """row, hash and count of the distinct word runs of each text, in order of row and hash."""
    row, index, distinct = words(pc.utf8_lower(text))
    if not len(row):
        return np.zeros(0, np.int64), np.zeros(0, U), np.zeros(0, np.int64)
    word = hashes(distinct)[index]
    h, at = window_hashes(row, word, WORDS)
    rows = row[at]
    counts = np.bincount(row, minlength=len(text))
    short = np.nonzero((counts > 0) & (counts < WORDS))[0]
    if len(short):
        begin = np.cumsum(counts) - counts
        more = np.zeros(len(short), U)
        with np.errstate(over="ignore"):
            for k in range(WORDS - 1):
                some = counts[short] > k
                more[some] = more[some] * U(0x9E3779B97F4A7C15) + word[begin[short][some] + k] + U(k + 1)
        h, rows = np.concatenate([h, mix(more)]), np.concatenate([rows, short])
    order = np.lexsort((h, rows))
    h, rows = h[order], rows[order]
    first = np.nonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])]))[0]
    return rows[first], h[first], np.diff(np.append(first, len(h)))


def prob_min_hash(row: np.ndarray, h: np.ndarray, weight: np.ndarray, n: int, registers: int = REGISTERS) -> np.ndarray:
    """The element that holds each register of each of n rows.  All rows must have an element.

    Arrival k of an element is the sum of its first k exponential gaps over its weight; gap and register come from
    the element's own random stream, so equal elements arrive alike wherever they are.
    """
    held = np.zeros((n, registers), U)
    time = np.full((n, registers), np.inf)
    row, state, rate, now = row.copy(), mix(h), 1.0 / weight, np.zeros(len(h))
    element, step = h, 0
    while len(row):
        step += 1
        with np.errstate(over="ignore"):
            draw = mix(state + U(step) * U(0x9E3779B97F4A7C15))
        now = now - np.log(((draw >> U(11)).astype(np.float64) + 0.5) / (1 << 53)) * rate
        slot = row * registers + (mix(draw) % U(registers)).astype(np.int64)
        order = np.lexsort((now, slot))
        s = slot[order]
        best = order[np.concatenate([[True], s[1:] != s[:-1]])]
        best = best[now[best] < time.ravel()[slot[best]]]
        time.ravel()[slot[best]] = now[best]
        held.ravel()[slot[best]] = element[best]
        live = now < time.max(axis=1)[row]
        row, state, rate, now, element = row[live], state[live], rate[live], now[live], element[live]
    return held


def estimate(a: np.ndarray, b: np.ndarray) -> float:
    """The probability Jaccard similarity that two signatures show."""
    return float((a == b).mean())


def expanded(row: np.ndarray, h: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """row and hash of each occurrence of the runs; the first keeps the run's own hash.  As sets these have the similarity
    that the weighted runs have."""
    of = np.repeat(np.arange(len(h)), count)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    with np.errstate(over="ignore"):
        return row[of], np.where(nth == 0, h[of], mix(h[of] + nth.astype(U) * U(0x9E3779B97F4A7C15)))


def sketches(row: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """The sketch of each of n rows."""
    out = np.zeros((n, SKETCH + 1), np.int64)
    if len(row):
        cell = (mix(h ^ U(0xD6E8FEB86659FD93)) >> U(32)) % U(PARITIES)
        place = row * (SKETCH + 1) + (cell >> U(6)).astype(np.int64)
        order = np.argsort(place, kind="stable")
        head = np.nonzero(np.concatenate([[True], place[order][1:] != place[order][:-1]]))[0]
        out.ravel()[place[order][head]] = np.bitwise_xor.reduceat((U(1) << (cell & U(63)))[order], head).view(np.int64)
        out[:, SKETCH] = np.bincount(row, minlength=n)
    return out


def slack(threshold: float) -> float:
    """At Jaccard similarity t, the runs in one of two sets only are at most this share of the sum of their sizes."""
    return (1 - threshold) / (1 + threshold)


def may_link(a: str, b: str, threshold: float = THRESHOLD) -> Column:
    """False if the sketches show that the similarity is under the threshold."""
    apart = F.lit(0)
    for k in range(SKETCH):
        apart = apart + F.bit_count(F.col(a)[k].bitwiseXOR(F.col(b)[k]))
    x, y = F.col(a)[SKETCH], F.col(b)[SKETCH]
    bound = (x + y) * F.lit(slack(threshold)) + 1e-6
    return (F.abs(x - y) <= bound) & (apart <= bound)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, the copies' key (two longs), the bands' keys, the sketch of the runs, and that of the weighted runs where some
    run repeats; the key is null for texts without words."""

    def sign(batches):
        for batch, text in slices(batches, SLICE):
            row, h, count = shingles(text)
            some, dense = np.unique(row, return_inverse=True)
            keys = np.zeros((2, len(text)), U)
            with np.errstate(over="ignore"):
                for k in range(2):
                    parts = mix(mix(h + U(k)) ^ (count.astype(U) * U(0xD6E8FEB86659FD93)))
                    upto = np.concatenate([np.zeros(1, U), np.cumsum(parts, dtype=U)])
                    borders = np.searchsorted(row, np.arange(len(text) + 1))
                    keys[k] = upto[borders[1:]] - upto[borders[:-1]]
                held = prob_min_hash(dense, h, count.astype(np.float64), len(some)).reshape(len(some), BANDS, ROWS)
                band = np.zeros((len(some), BANDS), U)
                for k in range(ROWS):
                    band = mix(band * U(0x9E3779B97F4A7C15) + held[:, :, k])
                band = mix(band + np.arange(BANDS, dtype=U))
            none = np.ones(len(text), bool)
            none[some] = False
            full = np.zeros((len(text), BANDS), np.int64)
            full[some] = band.view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(text) + 1, dtype=np.int32) * BANDS), pa.array(full.ravel()))
            again = np.zeros(len(text), bool)
            again[row[count > 1]] = True
            plain, weighted = sketches(row, h, len(text)), sketches(*expanded(row, h, count), len(text))
            plain = pa.ListArray.from_arrays(pa.array(np.arange(len(text) + 1, dtype=np.int32) * plain.shape[1]), pa.array(plain.ravel()))
            borders = np.concatenate([[0], np.cumsum(again)]).astype(np.int32) * weighted.shape[1]
            weighted = pa.ListArray.from_arrays(pa.array(borders), pa.array(weighted[again].ravel()), mask=pa.array(~again))
            yield pa.record_batch([batch.column("doc_id"), *(pa.array(k.view(np.int64), mask=none) for k in keys), lists, plain, weighted], names=["doc_id", "key1", "key2", "bands", "sketch", "weighted"])

    return small_batches(docs).mapInArrow(tidied(sign), "doc_id long, key1 long, key2 long, bands array<long>, sketch array<long>, weighted array<long>")


class Runs:
    """The runs of pairs of texts: each distinct text is cut up once."""

    def __init__(self, left: pa.StringArray, right: pa.StringArray):
        texts = pa.concat_arrays([left, right]).dictionary_encode()  # a pivot's text comes many times
        self.a, self.b = np.split(texts.indices.to_numpy(zero_copy_only=False), 2)
        n = len(texts.dictionary)
        row, h, count = shingles(texts.dictionary)
        self.repeats = np.zeros(n, bool)
        self.repeats[row[count > 1]] = True
        self.plain, self.weighted = self._cut(row, h, n), self._cut(*expanded(row, h, count), n)

    @staticmethod
    def _cut(row: np.ndarray, h: np.ndarray, n: int) -> list[np.ndarray]:
        order = np.lexsort((h, row))
        return np.split(h[order], np.searchsorted(row, np.arange(1, n)))

    def pair(self, k: int):
        """Sorted runs of both texts of pair k, and the same weighted (None where that is no different)."""
        x, y = self.a[k], self.b[k]
        yield self.plain[x], self.plain[y]
        yield (self.weighted[x], self.weighted[y]) if self.repeats[x] or self.repeats[y] else None


def linked(runs: Runs, k: int, share: float) -> bool:
    for sets in runs.pair(k):
        if sets is not None:
            both = len(np.intersect1d(*sets, assume_unique=True))
            if len(sets[0]) + len(sets[1]) - 2 * both <= share * (len(sets[0]) + len(sets[1])) + 1e-6:
                return True
    return False


def prefix(pivot: np.ndarray, runs: np.ndarray, share: float) -> tuple[bool, np.ndarray]:
    """Whether a member is too far from its pivot to be linked, and the runs by which it meets others (see the module's 4).

    Far: of |D| runs that differ, (|D| - share * sizes) / (1 + share) at least are common to both of a linked pair, so all
    but that many less one are enough to meet.  Else all of D are.
    """
    here, not_here = np.setdiff1d(runs, pivot, assume_unique=True), np.setdiff1d(pivot, runs, assume_unique=True)
    apart = len(here) + len(not_here)
    over = apart - share * (len(runs) + len(pivot))
    if over <= 1e-6:
        return False, np.concatenate([here, not_here])
    common = max(1, int(np.ceil(over / (1 + share) - 1e-6)))
    return True, np.concatenate([here, not_here])[: apart - common + 1]


def with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """pairs (a, b, ...) with the texts of both."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("left"))
    return pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("right")), "b").join(left, "a")


def compare_pivots(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """a (a pivot), b (a member), linked, whether either repeats a run, and for plain and weighted runs whether b is far and the
    runs by which it meets others."""
    share = slack(threshold)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                some = batch.slice(at, 200)
                runs = Runs(some.column("left").cast(pa.string()), some.column("right").cast(pa.string()))
                out, lists = [], []
                for k in range(some.num_rows):
                    plain, weighted = runs.pair(k)
                    far0, keys0 = prefix(*plain, share)
                    far1, keys1 = (far0, keys0) if weighted is None else prefix(*weighted, share)
                    out.append((not far0 or not far1, weighted is not None, far0, far1))
                    lists.append((keys0.view(np.int64), keys1.view(np.int64)))
                flags = [pa.array(x) for x in zip(*out, strict=True)]
                keys = [pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, x)]).astype(np.int32)), pa.array(np.concatenate(x))) for x in zip(*lists, strict=True)]
                yield pa.record_batch([some.column("a"), some.column("b"), *flags, *keys], names=["a", "b", "linked", "repeats", "far0", "far1", "keys0", "keys1"])

    return with_texts(pairs, texts).select("a", "b", "left", "right").mapInArrow(tidied(run), "a long, b long, linked boolean, repeats boolean, far0 boolean, far1 boolean, keys0 array<long>, keys1 array<long>")


def verify(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """la, lb, linked for each pair (a, b, la, lb)."""
    share = slack(threshold)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                some = batch.slice(at, 200)
                runs = Runs(some.column("left").cast(pa.string()), some.column("right").cast(pa.string()))
                found = [linked(runs, k, share) for k in range(some.num_rows)]
                yield pa.record_batch([some.column("la"), some.column("lb"), pa.array(found, pa.bool_())], names=["la", "lb", "linked"])

    return with_texts(pairs, texts).select("la", "lb", "left", "right").mapInArrow(tidied(run), "la long, lb long, linked boolean")


def components(edges: DataFrame) -> DataFrame:
    """id, new: the least id that each id in an edge (a, b) reaches.

    Each round an id takes the least label around it and then that label's own label; rounds end when no label moves.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = save(both, "edges")
    if both.isEmpty():
        return both.select(F.col("a").alias("id"), F.col("b").alias("new"))
    now = save(both.groupBy("a").agg(F.min("b").alias("near")).select(F.col("a").alias("id"), F.least("a", "near").alias("label")), "labels")
    while True:
        around = both.join(now.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = now.join(around.withColumnRenamed("a", "id"), "id").select("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = step.select(F.col("id").alias("label"), F.col("label").alias("further"))
        moved = save(step.join(jump, "label", "left").select("id", "old", F.least("label", F.coalesce("further", "label")).alias("label")), "labels")
        now = moved.select("id", "label")
        if moved.where("label <> old").isEmpty():
            return now.withColumnRenamed("label", "new")


def pivot_pairs(copies: DataFrame) -> DataFrame:
    """a (a pivot), b: the pivot of each bucket with each other member, each pair once.  copies: copy_id, bands."""
    members = copies.select(F.col("copy_id").alias("id"), F.explode("bands").alias("bucket"))
    sizes = save(members.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "sizes")
    score = F.sum("size").over(Window.partitionBy("id"))  # an id has BANDS buckets at most
    members = save(members.join(sizes, "bucket").select("bucket", "id", score.alias("score")), "members")
    pivots = save(members.groupBy("bucket").agg(F.max(F.struct("score", F.bitwise_not("id").alias("least"))).alias("best")).select("bucket", F.bitwise_not("best.least").alias("a")), "pivots")
    return members.join(pivots, "bucket").where("a <> id").select("a", F.col("id").alias("b")).distinct()


def meeting_pairs(compared: DataFrame, labels: DataFrame, copies: DataFrame, threshold: float) -> DataFrame:
    """a, b, la, lb: members of unlike classes that may be linked though one of them is far from their pivot."""
    kinds = F.array(F.struct(F.lit(0).alias("kind"), F.col("far0").alias("far"), F.col("keys0").alias("keys")), F.struct(F.lit(1).alias("kind"), F.col("far1").alias("far"), F.col("keys1").alias("keys")))
    # Where no member of a pivot has a repeated run, weighted runs are the plain ones.
    groups = compared.groupBy("a").agg(F.max(F.col("far0") | F.col("far1")).alias("any"), F.count("*").alias("n"), F.max("repeats").alias("both"))
    groups = save(groups.where("any and n > 1").select("a", "both"), "groups")
    runs = compared.join(sized(groups, groups.count()), "a").select(F.col("a").alias("pivot"), F.col("b").alias("id"), F.explode(F.slice(kinds, F.lit(1), F.when(F.col("both"), 2).otherwise(1))).alias("k"))
    runs = runs.select("pivot", "id", "k.kind", "k.far", F.explode("k.keys").alias("run"))
    shared = save(runs.groupBy("pivot", "kind", "run").agg(F.count("*").alias("n"), F.max("far").alias("any")).where("n > 1 and any").drop("n", "any"), "shared")
    met = save(runs.join(shared, ["pivot", "kind", "run"]), "met")
    known = copies.select(F.col("copy_id").alias("id"), "sketch", F.coalesce("weighted", "sketch").alias("weighted"))
    met = met.join(known, "id").join(labels.withColumnRenamed("new", "label"), "id", "left")
    met = save(met.select("pivot", "kind", "run", "id", "far", F.coalesce("label", "id").alias("label"), F.when(F.col("kind") == 0, F.col("sketch")).otherwise(F.col("weighted")).alias("sketch")), "met")
    other = met.select("pivot", "kind", "run", F.col("id").alias("b"), F.col("far").alias("far_b"), F.col("label").alias("lb"), F.col("sketch").alias("other"))
    return met.join(other, ["pivot", "kind", "run"]).where(F.expr("far and label <> lb and (not far_b or id < b)") & may_link("sketch", "other", threshold)).select(F.col("id").alias("a"), "b", F.col("label").alias("la"), "lb").distinct()


def near_duplicate_classes(docs: DataFrame, threshold: float = THRESHOLD, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, class_id (the least doc_id of the class) and copy_id (the least doc_id with the same words) for each row."""
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    signed = save(signatures(docs), "signatures")
    lone = F.col("key1").isNull() | F.col("doc_id").isNull()
    copies = save(signed.where(~lone).groupBy("key1", "key2").agg(F.min("doc_id").alias("copy_id"), *(F.first(c).alias(c) for c in ("bands", "sketch", "weighted"))), "copies")

    pairs = save(pivot_pairs(copies), "pairs")
    named = copies.select("key1", "key2", "copy_id", F.col("copy_id").alias("class_id"))
    if not pairs.isEmpty():
        ids = save(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ids")
        texts = save(docs.join(sized(ids, ids.count()), "doc_id", "left_semi"), "texts")
        compared = save(compare_pivots(pairs, texts, threshold), "compared")
        labels = components(compared.where("linked"))
        tested = save(verify(save(meeting_pairs(compared, labels, copies, threshold), "met"), texts, threshold), "tested")
        merged = components(tested.where("linked").select(F.col("la").alias("a"), F.col("lb").alias("b")))
        for found in (labels, merged):
            named = named.join(found.withColumnRenamed("id", "class_id"), "class_id", "left").select("key1", "key2", "copy_id", F.coalesce("new", "class_id").alias("class_id"))
    rows = signed.where(~lone).select("doc_id", "key1", "key2").join(named, ["key1", "key2"]).select("doc_id", "class_id", "copy_id")
    return rows.unionByName(signed.where(lone).select("doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("copy_id")))


def near_dup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
