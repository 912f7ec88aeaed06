"""Removal of repeated passages by longest-previous-factor arrays over suffix order.

A byte goes if a string of LENGTH bytes that covers it also starts earlier: in a document of smaller id (equal ids: in
an equal or smaller text), or in the same document further left.  Strings are those of the input; matches never cross
documents.

The corpus has no suffix array of its own; it is cut so that equal strings meet in one:
1. Winnowing: of the K-byte grams in a string of LENGTH bytes, the one with the least hash (ties: the last) is its
   anchor.  Which one that is depends on the string alone, so equal strings have equal anchors.  The strings that share
   an anchor's place form one segment of under 2 * LENGTH bytes.
2. Segments go by their anchor's hash; of segments whose anchors' and whole contents' 64-bit hashes agree all but the first are
   repeats whole, and each task drops them before the shuffle.  Anchors with one segment left are done.
   Anchors with many kinds of segments (a passage that many documents share ends each time in another neighbourhood) go
   string by string instead, each by two 64-bit hashes of its own, so that no group grows with the corpus.
3. For the other anchors, the first segments of each kind get their bytes, in document order, and a suffix array per
   batch.  Previous and next smaller places in suffix order give each suffix's longest match that starts earlier; where
   it reaches LENGTH, the string is a repeat.  This step compares bytes, not hashes.
4. Removed runs are joined for each document.

Nulls and empty texts: no bytes, nothing to remove.  A null doc_id counts as -2**63.  Rows equal in
doc_id and text are one document, given back as often as they come.  Very long texts are cut into overlapping windows of
SLICE bytes, which changes no string's anchor.  Empty table: no rows.  Extra columns come back as they are.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mix, save, slices, small_batches, text_bytes, tidied

LENGTH = 100
K = 32
U = np.uint64
_TABLES = mix(np.arange(1, 513, dtype=U)).reshape(2, 256)
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
#: Bytes of segments that one suffix array covers (more only if one anchor's segments need it).
ARRAY_BYTES = 2 << 20
#: Kinds of segments at one anchor, in one slice of text, from which its strings go one by one.
MANY = 32
#: The same over all slices: beyond it an anchor's segments aren't compared in one task, and their strings go one by one too.
MOST = 1024
#: Bytes of text whose strings are hashed at once (about 100 times as much memory).
SLICE = 1 << 20
#: What a row of the tables between the steps is.
COMPARE, REPEAT, MARK, STRING, SINGLE = range(5)
SEGMENT = "kind int, anchor long, content long, doc_id long, tie long, at int, strings int"
NAMES = [x.split()[0] for x in SEGMENT.split(", ")]


class Prefixes:
    """Polynomial hashes of all substrings of a run of bytes, modulo 2**64, from prefix sums."""

    def __init__(self, limit: int):
        self.limit = limit
        self.powers = [np.cumprod(np.full(limit + 1, b, U)) for b in _BASES]
        self.inverse = [np.cumprod(np.full(limit + 1, pow(b, -1, 1 << 64), U)) for b in _BASES]

    def grow(self, n: int) -> None:
        if n > self.limit:
            self.__init__(n)

    def sums(self, data: np.ndarray, which: int) -> np.ndarray:
        out = np.zeros(len(data) + 1, U)
        np.cumsum(_TABLES[which][data] * self.powers[which][: len(data)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, start: np.ndarray | slice, end: np.ndarray | slice, which: int) -> np.ndarray:
        return (sums[end] - sums[start]) * self.inverse[which][: len(sums)][start]


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of `width` values (two passes over blocks)."""
    n = len(x)
    pad = -n % width
    blocks = np.concatenate([x, np.full(pad, np.iinfo(U).max, U)]).reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def segments(data: np.ndarray, borders: np.ndarray, hashes: Prefixes, length: int = LENGTH, k: int = K):
    """row, first start, last start, anchor hash and content hash of each segment."""
    none = np.zeros(0, np.int64)
    n = len(data)
    if n < length:
        return none, none, none, none.astype(U), none.astype(U)
    hashes.grow(n)
    sums = hashes.sums(data, 0)
    gram = mix((sums[k:] - sums[:-k]) * hashes.inverse[0][: n - k + 1])
    low = U((1 << 28) - 1)
    if n > low:
        raise ValueError("give windows of a long text")
    least = _sliding_min((gram & ~low) | (low - np.arange(len(gram), dtype=U)), length - k + 1)
    anchor = (low - (least & low)).astype(np.int64)  # for each start of a string
    row = np.repeat(np.arange(len(borders) - 1), np.diff(borders))[: len(anchor)]
    inside = np.arange(len(anchor)) + length <= borders[1:][row]
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])])
    start = np.nonzero(inside & (new | ~np.concatenate([[False], inside[:-1]])))[0]
    last_of_run = inside & np.concatenate([new[1:] | ~inside[1:], [True]])
    end = np.nonzero(last_of_run)[0]
    second = hashes.sums(data, 1)
    content = mix(hashes.of(second, start, end + length, 1) ^ mix((anchor[start] - start).astype(U) << U(8) ^ (end - start).astype(U)))
    return row[start], start, end, gram[anchor[start]], content


def suffix_array(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of their first `depth` values (ties: by place), and a number for each that tells these values
    apart.  By doubling; data: values up to 1022."""
    n = len(data)

    def ranks(key: np.ndarray) -> np.ndarray:
        return np.unique(key, return_inverse=True)[1].astype(U) + U(1)

    def shifted(rank: np.ndarray, by: int) -> np.ndarray:
        return rank * U(n + 1) + np.concatenate([rank[by:], np.zeros(min(by, n), U)])[:n]

    key = data.astype(U) + U(1)
    packed = np.zeros(n, U)
    for j in range(min(6, n, depth)):
        packed[: n - j] |= key[j:] << U(10 * (5 - j))
    rank, known = ranks(packed), min(6, depth)
    while known * 2 <= depth:
        rank, known = ranks(shifted(rank, known)), known * 2
    if known < depth:
        rank = ranks(shifted(rank, depth - known))
    return np.argsort(rank, kind="stable"), rank


def _nearest_smaller(order: np.ndarray, lcp: np.ndarray, depth: int) -> np.ndarray:
    """The common prefix of each suffix with the nearest one before it in the order that starts earlier in the text.

    Each suffix holds a link to one before it and the least common prefix on the way; while the link's end starts
    later, it takes over that one's link.  A prefix under `depth` is of no use, and its suffix drops out.
    """
    link, least = np.arange(len(order)) - 1, lcp.copy()
    live = np.nonzero(least >= depth)[0]
    while len(live):
        live = live[order[link[live]] > order[live]]
        over = link[live]
        link[live], least[live] = link[over], np.minimum(least[live], least[over])
        gone = link[live] < 0
        least[live[gone]] = 0
        live = live[~gone & (least[live] >= depth)]
    return least


def longest_previous_factors(data: np.ndarray, depth: int) -> np.ndarray:
    """For each place the longest match that starts earlier, up to depth; a match under depth counts as none.

    In suffix order it is with the previous or the next smaller place: every other earlier start lies behind one of
    the two and shares no more than they do.
    """
    n = len(data)
    out = np.zeros(n, np.int64)
    if n:
        order, name = suffix_array(data, depth)
        lcp = np.zeros(n, np.int64)
        lcp[1:][name[order][1:] == name[order][:-1]] = depth
        before = _nearest_smaller(order, lcp, depth)
        after = _nearest_smaller(order[::-1], np.append(lcp[1:], 0)[::-1], depth)[::-1]
        out[order] = np.maximum(before, after)
    return out


def _rows(kind, anchor, content, doc, tie, at, strings) -> pa.RecordBatch:
    n = len(anchor)
    kind = np.full(n, kind, np.int32) if np.isscalar(kind) else kind.astype(np.int32)
    return pa.record_batch([pa.array(kind), pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64)), pa.array(doc), pa.array(tie), pa.array(at.astype(np.int32)), pa.array(strings.astype(np.int32))], names=NAMES)


def _windows(data: np.ndarray, borders: np.ndarray):
    """(first byte, bytes, borders) of all texts at once, or of windows of one long text that share LENGTH - 1 bytes."""
    if len(borders) != 2 or len(data) <= SLICE:
        yield 0, data, borders
        return
    for at in range(0, len(data) - LENGTH + 1, SLICE):
        some = data[at : at + SLICE + LENGTH - 1]
        yield at, some, np.array([0, len(some)])


def _single_strings(data, borders, hashes: Prefixes, row, start, end):
    """Hashes, row and place of each string of the given segments: they stand for anchor and content of its own."""
    n = end - start + 1
    of = np.repeat(np.arange(len(n)), n)
    at = start[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    one, two = np.zeros(len(at), U), np.zeros(len(at), U)
    for first in range(0, len(data), SLICE):
        here = np.nonzero((at >= first) & (at < first + SLICE))[0]
        if len(here):
            some = data[first : first + SLICE + LENGTH - 1]
            hashes.grow(len(some))
            one[here], two[here] = (hashes.of(hashes.sums(some, k), at[here] - first, at[here] - first + LENGTH, k) for k in (0, 1))
    return mix(one ^ U(1)), mix(two ^ U(2)), row[of], at - borders[:-1][row[of]]


def find_segments(docs: DataFrame) -> DataFrame:
    """The segments of all texts; those that come again in one slice are marked as repeats there."""

    def find(batches):
        hashes = Prefixes(1 << 16)
        for batch, text in slices(batches, SLICE):
            docs, ties = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "tie"))
            for first_byte, data, borders in _windows(*text_bytes(text)):
                yield from marked(data, borders, docs, ties, first_byte, hashes)

    def marked(data, borders, docs, ties, first_byte, hashes):
        row, start, end, anchor, content = segments(data, borders, hashes)
        if not len(row):
            return
        at = start - borders[:-1][row] + first_byte
        order = np.lexsort((at, ties[row], docs[row], content, anchor))
        a, c = anchor[order], content[order]
        new_anchor = np.concatenate([[True], a[1:] != a[:-1]])
        new = new_anchor | np.concatenate([[True], c[1:] != c[:-1]])
        kinds = np.bincount(np.cumsum(new_anchor) - 1, weights=new)
        many = (kinds >= MANY)[np.cumsum(new_anchor) - 1]
        if many.any():
            found = order[many & new]
            h1, h2, r, p = _single_strings(data, borders, hashes, row[found], start[found], end[found])
            marks = order[many & new_anchor]
            zero = np.zeros(len(marks), np.int64)
            yield _rows(MARK, anchor[marks], zero.view(U), zero, zero, zero, zero)
            yield _rows(STRING, h1, h2, docs[r], ties[r], p + first_byte, np.ones(len(r), np.int32))
        kind = np.where(new, COMPARE, REPEAT)
        first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        same = ~new & (docs[row[order]] == docs[row[order[first]]]) & (ties[row[order]] == ties[row[order[first]]]) & (at[order] == at[order[first]])
        keep = ~(many & new) & ~same  # the same document again: nothing new
        o = order[keep]
        # Repeats only pass through; they go by their own place, as a hot anchor has many.
        with np.errstate(over="ignore"):
            spread = mix(docs[row[o]].astype(U) * U(0x9E3779B97F4A7C15) + at[o].astype(U))
        yield _rows(kind[keep], np.where(kind[keep] == REPEAT, spread, anchor[o]), content[o], docs[row[o]], ties[row[o]], at[o], end[o] - start[o] + 1)

    return small_batches(docs).mapInArrow(tidied(find), SEGMENT)


def _table(batches) -> dict[str, np.ndarray] | None:
    parts = list(batches)
    if not sum(b.num_rows for b in parts):
        return None
    return {c: np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in parts]) for c in parts[0].schema.names}


def resolve(batches):
    """Rows of an anchor together -> repeats, segments to compare, and first strings of hot anchors."""
    t = _table(batches)
    if t is None:
        return
    yield _rows(REPEAT, *(t[c][t["kind"] == REPEAT] for c in NAMES[1:]))
    marked = np.unique(t["anchor"][t["kind"] == MARK])
    live = np.isin(t["kind"], [COMPARE, STRING])
    t = {c: v[live] for c, v in t.items()}
    if not len(t["anchor"]):
        return
    order = np.lexsort((t["at"], t["tie"], t["doc_id"], t["content"], t["anchor"]))
    t = {c: v[order] for c, v in t.items()}
    new_anchor = np.concatenate([[True], t["anchor"][1:] != t["anchor"][:-1]])
    new = new_anchor | np.concatenate([[True], t["content"][1:] != t["content"][:-1]])
    first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    same = ~new & np.all([t[c] == t[c][first] for c in ("doc_id", "tie", "at")], axis=0)
    group = np.cumsum(new_anchor) - 1
    kinds = np.bincount(group, weights=new)[group]
    hot = np.isin(t["anchor"], marked) | (kinds > MOST)
    kind = np.where(new, np.where(t["kind"] == STRING, STRING, np.where(hot, SINGLE, COMPARE)), REPEAT)
    done = same | (new & (kind == COMPARE) & (kinds == 1))
    yield _rows(kind[~done], *(t[c][~done] for c in NAMES[1:]))


def compare(batches):
    """Segments' bytes, an anchor's together -> the strings in them that start earlier elsewhere."""
    parts = list(batches)
    t = _table(b.select(NAMES) for b in parts)
    if t is None:
        return
    data = [x for b in parts for x in b.column("bytes").to_pylist()]
    order = np.argsort(t["anchor"], kind="stable")
    sizes = t["strings"][order].astype(np.int64) + LENGTH
    anchors = t["anchor"][order]
    heads = np.nonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]]))[0]
    upto = np.concatenate([[0], np.cumsum(sizes)])
    at = 0
    while at < len(heads):
        to = max(at + 1, int(np.searchsorted(upto[heads], upto[heads[at]] + ARRAY_BYTES, side="right")) - 1)
        here = order[heads[at] : heads[to] if to < len(heads) else len(order)]
        here = here[np.lexsort((t["at"][here], t["tie"][here], t["doc_id"][here]))]
        again = np.all([t[c][here][1:] == t[c][here][:-1] for c in ("doc_id", "tie", "at")], axis=0)  # a repeated row's
        here = here[np.concatenate([[True], ~again])]
        n = t["strings"][here].astype(np.int64)
        wide = n + LENGTH  # a separator ends each segment
        begin = np.cumsum(wide) - wide
        text = np.full(int(wide.sum()), 256, np.int64)
        flat = np.frombuffer(b"".join([data[k] for k in here.tolist()]), np.uint8)
        text[np.arange(len(flat)) + np.repeat(np.arange(len(here)), wide - 1)] = flat
        of = np.repeat(np.arange(len(here)), n)
        place = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        repeat = longest_previous_factors(text, LENGTH)[begin[of] + place] >= LENGTH
        of, place = of[repeat], place[repeat]
        head = np.concatenate([[True], (of[1:] != of[:-1]) | (place[1:] != place[:-1] + 1)]) if len(of) else np.zeros(0, bool)
        run = np.nonzero(head)[0]
        some = here[of[run]]
        yield _rows(REPEAT, t["anchor"][some], np.zeros(len(some), np.int64), t["doc_id"][some], t["tie"][some], t["at"][some] + place[run], np.diff(np.append(run, len(of))))
        at = to


def repeats(docs: DataFrame) -> DataFrame:
    """doc_id, tie, at, strings: runs of places at which repeated strings start.  docs: doc_id, tie, text, no nulls but in text."""
    found = save(find_segments(docs).repartition("anchor").mapInArrow(tidied(resolve), SEGMENT), "segments")
    runs = found.where(F.col("kind") == REPEAT)

    asked = found.where(F.col("kind").isin(COMPARE, SINGLE))
    if not asked.isEmpty():
        asked = asked.groupBy("doc_id", "tie").agg(F.collect_list(F.struct("kind", "anchor", "at", "strings")).alias("asked"))

        def fetch(batches):
            hashes = Prefixes(1 << 16)
            for batch, text in slices(batches, SLICE):
                data, borders = text_bytes(text)
                lists = batch.column("asked")
                row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
                flat = lists.flatten()
                kind, anchor, at, strings = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("kind", "anchor", "at", "strings"))
                docs, ties = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "tie"))
                start = borders[:-1][row] + at
                single = kind == SINGLE
                if single.any():
                    h1, h2, r, p = _single_strings(data, borders, hashes, row[single], start[single], start[single] + strings[single] - 1)
                    out = _rows(STRING, h1, h2, docs[r], ties[r], p, np.ones(len(r), np.int32))
                    yield out.append_column("bytes", pa.nulls(len(out), pa.binary()))
                o = np.nonzero(~single)[0]
                raw = data.tobytes()
                out = _rows(COMPARE, anchor[o], np.zeros(len(o), np.int64), docs[row[o]], ties[row[o]], at[o], strings[o])
                yield out.append_column("bytes", pa.array([raw[a:b] for a, b in zip(start[o].tolist(), (start[o] + strings[o] + LENGTH - 1).tolist(), strict=True)], pa.binary()))

        fetched = save(docs.join(asked, ["doc_id", "tie"]).mapInArrow(tidied(fetch), f"{SEGMENT}, bytes binary"), "bytes")
        compared = fetched.where(F.col("kind") == COMPARE).repartition("anchor").mapInArrow(tidied(compare), SEGMENT)
        strings = found.where(F.col("kind") == STRING).unionByName(fetched.where(F.col("kind") == STRING).drop("bytes"))
        strings = strings.repartition("anchor").mapInArrow(tidied(resolve), SEGMENT).where(F.col("kind") == REPEAT)
        runs = runs.unionByName(compared).unionByName(strings)
    elif not found.where(F.col("kind") == STRING).isEmpty():
        runs = runs.unionByName(found.where(F.col("kind") == STRING).repartition("anchor").mapInArrow(tidied(resolve), SEGMENT).where(F.col("kind") == REPEAT))
    return runs.select("doc_id", "tie", "at", "strings")


def _spans(batch, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """row, start and end of maximal removed runs, from the lists of runs of starts."""
    lists = batch.column("__runs")
    filled = lists.fill_null(pa.scalar([], lists.type)) if lists.null_count else lists
    row = np.repeat(np.arange(len(filled)), np.diff(filled.offsets.to_numpy()))
    flat = filled.flatten()
    start = borders[:-1][row] + flat.field("at").to_numpy(zero_copy_only=False)
    end = start + flat.field("strings").to_numpy(zero_copy_only=False) + LENGTH - 1
    order = np.argsort(start, kind="stable")
    row, start, end = row[order], start[order], np.maximum.accumulate(end[order])
    if not len(row):
        return row, start, end
    head = np.concatenate([[True], (start[1:] > end[:-1]) | (row[1:] != row[:-1])])
    first = np.nonzero(head)[0]
    return row[first], start[first], end[np.append(first[1:], len(row)) - 1]


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", as_text: bool = False) -> DataFrame:
    """The columns of docs but text, with __kept, __n_bytes, __n_removed and __n_spans.

    __kept holds the bytes that stay; as_text: as a string, without the rest of characters of which bytes were removed.
    """
    docs = docs.withColumns({"__doc": F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))), "__text": F.col(text), "__tie": F.xxhash64(F.col(text))})
    runs = repeats(docs.select(F.col("__doc").alias("doc_id"), F.col("__tie").alias("tie"), F.col("__text").alias("text")))
    runs = runs.groupBy(F.col("doc_id").alias("__doc"), F.col("tie").alias("__tie")).agg(F.collect_list(F.struct("at", "strings")).alias("__runs"))
    rest = [c for c in docs.columns if c != text and c not in ("__doc", "__text", "__tie", "__runs")]

    def apply(batches):
        for batch, text in slices(batches, column="__text"):
            data, borders = text_bytes(text)
            row, start, end = _spans(batch, borders)
            raw, kept, at = data.tobytes(), [], np.searchsorted(row, np.arange(len(text) + 1))
            for k, (a, b) in enumerate(zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True)):
                some = slice(at[k], at[k + 1])
                cuts = [a, *np.column_stack([start[some], end[some]]).ravel().tolist(), b]
                left = b"".join([raw[x:y] for x, y in zip(cuts[::2], cuts[1::2], strict=True)])
                kept.append(left.decode("utf-8", "ignore") if as_text else left)
            removed = np.bincount(row, weights=end - start, minlength=len(text)).astype(np.int64)
            yield pa.record_batch([*(batch.column(c) for c in rest), pa.array(kept, pa.string() if as_text else pa.binary()), pa.array(np.diff(borders)), pa.array(removed), pa.array(np.bincount(row, minlength=len(text)))], names=[*rest, "__kept", "__n_bytes", "__n_removed", "__n_spans"])

    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in rest), f"__kept {'string' if as_text else 'binary'}, __n_bytes long, __n_removed long, __n_spans long"])
    return docs.join(runs, ["__doc", "__tie"], "left").select(*rest, "__text", "__runs").mapInArrow(tidied(apply), schema)


def suffix_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    done = remove_repeats(docs)
    return done.select("doc_id", F.col("__n_bytes").alias("n_bytes"), F.col("__n_removed").alias("n_removed"), F.col("__n_spans").alias("n_spans"), F.sha2("__kept", 256).alias("kept_sha256"))
