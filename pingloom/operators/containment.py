"""Overtakes counted without making pairs: how many trips of a segment each trip lies strictly inside, by a merge tree over arrays."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import rollup
from .packs import Packs


def _greatest(block: np.ndarray, place: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From each row to the end of its block: the greatest place, its owner, and the greatest place of any other owner (-1: none)."""
    base = ((block[-1] - block) * (place.max(initial=0) + 1))[::-1]
    value, who = place[::-1] + base, owner[::-1]
    top = np.maximum.accumulate(value)
    record = np.concatenate([[True], value[1:] > top[:-1]])
    top_owner = who[np.maximum.accumulate(np.where(record, np.arange(len(value)), 0))]
    # Where the greatest changes hands, the one before it is the greatest of all others.
    before, before_owner = np.concatenate([[-1], top[:-1]]), np.concatenate([[-1], top_owner[:-1]])
    other = np.maximum.accumulate(np.where(record, np.where(before_owner != who, before, -1), np.where(who != top_owner, value, -1)))
    return (top - base)[::-1], top_owner[::-1], np.where(other >= base, other - base, -1)[::-1]


class MergeTree:
    """Intervals in the order of their starts; each level holds their ends sorted inside blocks of a power of two, with running sums of a weight and, where
    they have places in some order and owners, the greatest places."""

    def __init__(self, start: np.ndarray, end: np.ndarray, weight: np.ndarray, place: np.ndarray | None = None, owner: np.ndarray | None = None):
        order = np.argsort(start, kind="stable")
        self.start, end, weight = start[order], end[order], weight[order]
        if place is not None:
            place, owner = place[order], owner[order]
        self.n, self.levels = len(end), []
        self.ranks = np.unique(end)
        rank = np.searchsorted(self.ranks, end)
        self.wide = len(self.ranks) + 1
        block = np.arange(self.n)
        for level in range(max(1, self.n.bit_length())):
            key = (block >> level) * self.wide + rank
            by = np.argsort(key, kind="stable")
            greatest = None if place is None else _greatest((block >> level)[by], place[by], owner[by])
            self.levels.append((key[by], np.concatenate([[0], np.cumsum(weight[by])]), greatest))

    def around(self, start: np.ndarray, end: np.ndarray, owner: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each interval how many of the tree's begin earlier and end later, the sum of their weights, and the greatest place of those of another owner (-1: none)."""
        count, total, best = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64), np.full(len(start), -1, np.int64)
        upto = np.searchsorted(self.start, start, side="left")
        above = np.searchsorted(self.ranks, end, side="right")
        for level, (key, sums, greatest) in enumerate(self.levels):
            some = np.nonzero((upto >> level) & 1)[0]
            if not len(some):
                continue
            # The first `upto` intervals are whole blocks, one for each bit that is set.
            block = (upto[some] >> (level + 1)) << 1
            last = np.minimum((block + 1) << level, self.n)
            first = np.searchsorted(key, block * self.wide + above[some], side="left")
            count[some] += last - first
            total[some] += sums[last] - sums[first]
            if greatest is not None:
                some, first = some[first < last], first[first < last]
                top, top_owner, other = (g[first] for g in greatest)
                best[some] = np.maximum(best[some], np.where(top_owner != owner[some], top, other))
        return count, total, best


#: Columns that follow from others, as expressions of these, which it is given a way to get by name.
Made = Callable[[Callable[[str], Column]], dict[str, Column]]
#: Rows that a task counts at once (more only if one bucket of a segment has more).
CHUNK = 1 << 16


def _codes(*columns: np.ndarray) -> np.ndarray:
    """Numbers from 0 for the distinct rows of some columns."""
    out = np.zeros(len(columns[0]), np.int64)
    for c in columns:
        code = np.unique(c, return_inverse=True)[1].astype(np.int64)
        out = np.unique(out * (code.max(initial=0) + 1) + code, return_inverse=True)[1].astype(np.int64)
    return out


def counted(group: np.ndarray, plate: np.ndarray, start: np.ndarray, end: np.ndarray, weight: np.ndarray, ask: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the asking rows: how many rows of their group and of another plate lie around them, the sum of their weights, and the greatest of their places.

    Groups are moved apart in time, so one tree does for all of them; what a plate counts against itself is taken off by a second tree.
    """
    times = np.unique(np.concatenate([start, end]))
    a, b = np.searchsorted(times, start), np.searchsorted(times, end)
    owner = _codes(plate)
    apart = lambda code: (a + code * (len(times) + 1), b + code * (len(times) + 1))
    (s, e), (own_s, own_e) = apart(group), apart(_codes(group, owner))
    n, total, best = MergeTree(s, e, weight, place, owner).around(s[ask], e[ask], owner[ask])
    own_n, own_total, _ = MergeTree(own_s, own_e, weight).around(own_s[ask], own_e[ask])
    return n - own_n, total - own_total, best


def overtake_counts(trips: DataFrame, segment: list[str], bucket_s: int = 900, carry: tuple[str, ...] = (), latest: Column | None = None, order: str = "trip_id", parts: int | None = None, since: Column | None = None, made: Made | None = None, packs: Packs | None = None) -> DataFrame:
    """segment, order, plate, start_at, end_at, seconds, n, overtaken_s, last_overtaken (and carry) of the trips that overtake: how many trips of other
    vehicles on the segment start before and end after it, the sum of their seconds, and the vehicle of the one with the greatest `order`.

    A busy segment is dealt out by time: a trip counts in the bucket of its start, and is counted against in all that it touches,
    so a bucket holds the trips of some minutes whatever the length of a day.  Tasks take many buckets at once, and no pair is made.
    latest: where the segment's keys tell it, a time after which no trip of the segment starts; long trips need no bucket behind it.
    parts: how many tasks the buckets are dealt to, if not the session's number.
    since: where the segment's keys tell it, the time from which its buckets count; where that and latest are a bucket apart, no trip goes into two.
    made: those of the columns that follow from trips' own; only what trips has is shuffled.
    packs: how trips' columns are packed for the shuffle, if at all.
    """
    keys, packs = [*segment, "__t"], packs or Packs({})
    made, places = (made(F.col), made(packs.column)) if made else ({}, {})
    time = lambda c: F.unix_micros(c.cast("timestamp"))
    low = lambda c: F.floor((time(c) if since is None else time(c) - time(since)) / (bucket_s * 1_000_000))
    own = list(dict.fromkeys([*segment, order, "plate", "start_at", "end_at", "seconds"]))
    carry = [c for c in carry if c not in own]
    # A trip without a vehicle is none's overtake.
    rows = trips.withColumns(made).where(F.col("plate").isNotNull())
    fields = {c: rows.schema[c].dataType.simpleString() for c in [*own, *carry]}
    last = low(F.col("end_at")) if latest is None else F.least(low(F.col("end_at")), low(latest))
    rows = rows.withColumns({"__first": low(F.col("start_at")), "__last": last})
    spread = rows.withColumn("__t", F.explode(F.sequence("__first", F.greatest("__first", "__last"))))
    # A trip asks in its first bucket; in the others it is an interval and no more, so what it carries stays behind.
    asks = F.col("__t") == F.col("__first")
    slim = spread.select(*(trips.columns if made else [*own, *(F.when(asks, F.col(c)).alias(c) for c in carry)]), "__t")
    by = [*(places.get(c, packs.column(c)) for c in segment), "__t"]
    tight = packs.packed(slim)
    dealt = packs.restored(tight.repartition(*by) if parts is None else tight.repartition(parts, *by), slim.columns)
    # What follows from a trip's own columns is made behind the shuffle, which has to move and store every byte of a row.
    ready = dealt.withColumns(made).select(*fields, "__t", (F.col("__t") == low(F.col("start_at"))).alias("__ask"))
    ready = ready.withColumns({"__g": F.xxhash64(*keys), "__h": F.xxhash64(F.lit(1), *keys), "__p": F.xxhash64("plate"), "__a": time(F.col("start_at")), "__b": time(F.col("end_at")), "__w": F.col("seconds").cast("long")})

    def count(held):
        table = pa.Table.from_batches(held)
        start, end, weight, plate, g, h = (table[c].to_numpy() for c in ("__a", "__b", "__w", "__p", "__g", "__h"))
        ask = np.nonzero(table["__ask"].to_numpy())[0]
        if not len(ask):
            return
        by = pc.sort_indices(table, sort_keys=[(c, "ascending") for c in dict.fromkeys([order, "plate"])]).to_numpy().astype(np.int64)
        place = np.empty(len(by), np.int64)
        place[by] = np.arange(len(by))
        n, s, best = counted(_codes(g, h), plate, start, end, weight, ask, place)
        some = n > 0
        chosen = table.select(list(fields)).take(pa.array(ask[some]))
        last = table["plate"].take(pa.array(by[best[some]]))
        for column, values in (("n", pa.array(n[some])), ("overtaken_s", pa.array(s[some])), ("last_overtaken", last)):
            chosen = chosen.append_column(column, values)
        yield from chosen.to_batches()

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if rows + batch.num_rows > CHUNK:
                # What is held ends where a group does; the group that goes on stays for the next chunk.
                g = batch.column("__g").to_numpy()
                cut = int(np.argmax(g != held[-1].column("__g")[-1].as_py())) if held and (g != held[-1].column("__g")[-1].as_py()).any() else (0 if not held else len(g))
                if held and cut < len(g):
                    held.append(batch.slice(0, cut))
                    yield from count(held)
                    held, rows, batch = [], 0, batch.slice(cut)
            held.append(batch)
            rows += batch.num_rows
        if held:
            yield from count(held)

    schema = ", ".join(f"`{c}` {kind}" for c, kind in fields.items())
    return ready.sortWithinPartitions("__g").mapInArrow(run, f"{schema}, n long, overtaken_s long, last_overtaken {fields['plate']}")


def overtakes_by_day(trips: DataFrame, segment: list[str], dims: list[str], day: str = "service_date", bucket_s: int = 900, latest: Column | None = None, parts: int | None = None, since: Column | None = None, made: Made | None = None, packs: Packs | None = None) -> DataFrame:
    """For each day and dims (of the overtaking trip; `overtaker` is its plate): n, last_at, last_overtaken and both sides' mean seconds.

    The same as rolling up all pairs.
    """
    keys = list(dict.fromkeys([*segment, day]))
    carry = tuple(c for c in dims if c not in ("overtaker", *keys))
    counts = overtake_counts(trips, keys, bucket_s, carry, latest, parts=parts, since=since, made=made, packs=packs).withColumn("overtaker", F.col("plate"))
    daily = counts.groupBy(day, *dims).agg(
        F.sum("n").alias("n"),
        F.max(F.struct("end_at", "trip_id", "last_overtaken")).alias("l"),
        rollup.rounded(F.sum(F.col("n") * F.col("seconds")) / F.sum("n")).cast("long").alias("overtaker_mean_s"),
        rollup.rounded(F.sum("overtaken_s") / F.sum("n")).cast("long").alias("overtaken_mean_s"),
    )
    return daily.select(day, *dims, "n", F.col("l.end_at").alias("last_at"), F.col("l.last_overtaken").alias("last_overtaken"), "overtaker_mean_s", "overtaken_mean_s")
