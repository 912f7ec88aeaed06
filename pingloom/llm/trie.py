"""The prefix trie of conversations, from sorted turn sequences by range minima over their common prefixes.

Each turn is a 16-byte key (the start of a SHA-256 of its role and text), a conversation the sequence of its keys.  Sequences
are sorted over the whole cluster and cut into blocks of about BLOCK turns, whatever the number of conversations below one turn.
In a block, the length of the prefix that each row shares with the row before it goes into a sparse table of minima.  A candidate prefix (a row and a depth)
finds its first and its last row by two binary searches in that table, each on its own, so that all candidates of a
block go at once and none needs a stack.  All measures of a node are differences of running sums over its rows, or a minimum by a
second sparse table.

A node whose rows go on beyond its block gives a partial row with the digest of its prefix; partial rows are summed by that
digest (two for each block and depth at most).  A list of member ids that runs over blocks is hashed in the order of a sort, a
row at a time.

Nulls: turns are ordered with a null turn first, ties by role, then by the turn's key; a null role or text is empty; repeated rows are repeated turns.  Rows
with a null conv_id are no conversation.  Very long texts only pass through a hash; a conversation is one row of about 40 bytes a turn in a
task.  Empty table: no nodes.  Extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import save
from .sharding import CRC_SQL, crc_sql

#: Turns of a block, and of a task's share of the sorted rows.
BLOCK = 1 << 16
SHARE = 1 << 19
KEY = 16
BORROW = 9


def turn_key(role: Column, text: Column) -> Column:
    """The first 16 bytes (32 hex digits) of the hash of a role and a text; the role's length tells where it ends."""
    return F.substring(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * KEY)


def turn_lists(rows: DataFrame) -> DataFrame:
    """conv_id and turns (array<struct<turn, role, key, size>> in order) of rows by turn; size: UTF-8 bytes of the text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.struct("turn", role.alias("role"), turn_key(role, text).alias("key"), F.octet_length(text).cast("long").alias("size"))
    found = rows.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    return found.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt(lists: DataFrame, borrow: Column, every: int = 5, most: int = BORROW - 1) -> DataFrame:
    """Each conversation c with the first `borrow` turns of conversation c - c % every in place of its own; borrow is `most` at most."""
    base = lists.select(F.col("conv_id").alias("__base"), F.slice("turns", 1, most).alias("__first"))
    own = lists.withColumn("__h", borrow).withColumn("__from", F.col("conv_id") - F.col("conv_id") % every)
    joined = own.join(base, F.col("__from") == F.col("__base"), "left")
    first = F.slice(F.coalesce("__first", F.slice("turns", 1, 0)), F.lit(1), F.col("__h"))
    rest = F.slice("turns", F.col("__h") + 1, F.greatest(F.lit(0), F.size("turns") - F.col("__h")))
    return joined.select("conv_id", F.concat(first, rest).alias("turns"))


class Minima:
    """A sparse table: the least value of any run of an array, by two overlapping runs of a power of two."""

    def __init__(self, values: np.ndarray):
        self.n, self.levels = len(values), [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            half = 1 << (len(self.levels) - 1)
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def least(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of values[a..b], both ends in."""
        out = np.empty(len(a), self.levels[0].dtype)
        level = np.frexp((b - a + 1).astype(np.float64))[1] - 1
        for k in np.unique(level).tolist():
            at = level == k
            out[at] = np.minimum(self.levels[k][a[at]], self.levels[k][b[at] - (1 << k) + 1])
        return out

    def right(self, at: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The last row r with values[at + 1 .. r] all >= bound."""
        at = at.copy()
        for k in reversed(range(len(self.levels))):
            level = self.levels[k]
            on = at + 1 < len(level)
            on[on] = level[at[on] + 1] >= bound[on]
            at[on] += 1 << k
        return at

    def left(self, at: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The first row l with values[l + 1 .. at] all >= bound."""
        at = at.copy()
        for k in reversed(range(len(self.levels))):
            start = at - (1 << k) + 1
            on = start >= 1
            on[on] = self.levels[k][start[on]] >= bound[on]
            at[on] -= 1 << k
        return at


def common_prefixes(keys: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each row the number of first keys that it shares with the row before it; 0 for the first.  starts: n + 1 borders."""
    size = np.diff(starts)
    least = np.zeros(len(size), np.int64)
    least[1:] = np.minimum(size[1:], size[:-1])
    before = np.cumsum(least) - least
    row = np.repeat(np.arange(len(size)), least)
    place = np.arange(len(row)) - before[row]
    differs = (keys[starts[row] + place] != keys[starts[row - 1] + place]).any(axis=1)
    out = least.copy()
    at = np.nonzero(differs)[0][::-1]
    out[row[at]] = place[at]  # the first difference is written last
    return out


def shared(a: bytes, b: bytes) -> int:
    """Keys that two sequences have in common at their start."""
    n = min(len(a), len(b)) // KEY
    if not n:
        return 0
    differs = (np.frombuffer(a, np.uint8, n * KEY) != np.frombuffer(b, np.uint8, n * KEY)).reshape(n, KEY).any(axis=1)
    return int(differs.argmax()) if differs.any() else n


PIECE = "kind string, key binary, up binary, block long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_NAMES = [x.split()[0] for x in PIECE.split(", ")]
_ARROW = pa.schema([(n, {"string": pa.string(), "binary": pa.binary(), "long": pa.int64()}[k]) for n, k in (x.split() for x in PIECE.split(", "))])
NOTHING = hashlib.sha256(b"").hexdigest()


def _prefix_digests(sequence: bytes, depth: int) -> list[bytes]:
    """The digests of the prefixes of 0 to `depth` keys; the depth is part of each."""
    state, out = hashlib.blake2b(digest_size=KEY), []
    for d in range(depth + 1):
        if d:
            state.update(sequence[(d - 1) * KEY : d * KEY])
        last = state.copy()
        last.update(b"%d" % d)
        out.append(last.digest())
    return out


def block_nodes(convs: np.ndarray, sequences: list[bytes], sizes: list[np.ndarray], before: int, after: int, block: int) -> pa.Table:
    """The nodes of one block of sorted sequences.

    before, after: keys that the first row shares with the row before the block, and the last one with the row behind it; -1
    where there is none.  Nodes inside the block are whole (kind `node`, or `below` if their parent isn't); others are partial
    (`part`), and the members that end in them are listed (`end`).
    """
    n = len(convs)
    length = np.fromiter((len(s) // KEY for s in sequences), np.int64, n)
    starts = np.concatenate([[0], np.cumsum(length)])
    keys = np.frombuffer(b"".join(sequences), np.uint64).reshape(-1, 2)
    tokens = np.concatenate(sizes).astype(np.int64) if starts[-1] else np.zeros(0, np.int64)
    lcp = common_prefixes(keys, starts)
    follow = np.append(lcp[1:], after)
    minima, ids = Minima(lcp), Minima(convs)

    # Candidates: at the first row all depths, further down those that a row doesn't share with the row before it.
    low = lcp + 1
    low[0] = 0
    many = np.maximum(0, length - low + 1)
    offset = np.concatenate([[0], np.cumsum(many)])
    row = np.repeat(np.arange(n), many)
    depth = np.arange(len(row)) - offset[row] + low[row]
    left, right = minima.left(row, depth), minima.right(row, depth)
    count = right - left + 1
    crosses_left, crosses_right = (left == 0) & (depth <= before), (right == n - 1) & (depth <= after)
    crosses = crosses_left | crosses_right

    # A parent is the candidate one key shorter at the first row of its own extent.
    up = depth > 0
    top = np.where(up, minima.left(row, np.maximum(0, depth - 1)), 0)
    parent = np.where(up, offset[top] + np.maximum(0, depth - 1) - low[top], -1)
    least = ids.least(left, right)
    children = np.bincount(parent[up & ~crosses_left], minlength=len(row))
    leaf = np.concatenate([[0], np.cumsum(follow < length)])
    text = np.where(up, tokens[np.minimum(starts[row] + np.maximum(0, depth - 1), max(0, len(tokens) - 1))], 0) if len(tokens) else np.zeros(len(row), np.int64)
    weight = np.concatenate([[0], np.cumsum(count * text - np.where(crosses_left, 0, text))])
    saved = weight[offset[right + 1]] - weight[:-1]

    # Members of exactly this depth are the first rows of the extent, as far as they repeat each other.
    repeats = np.append((lcp[1:] == length[1:]) & (lcp[1:] == length[:-1]), False)
    last_equal = np.minimum.accumulate(np.where(repeats, n, np.arange(n))[::-1])[::-1]
    ends = np.where(length[left] == depth, last_equal[left] - left + 1, 0)
    digest = np.full(len(row), NOTHING, object)
    for k in np.nonzero((ends > 0) & ~crosses)[0].tolist():
        members = np.sort(convs[left[k] : left[k] + ends[k]])
        digest[k] = hashlib.sha256(",".join(map(str, members.tolist())).encode()).hexdigest()

    key = np.full(len(row), None, object)
    for side, at in ((crosses_left, 0), (crosses_right & ~crosses_left, n - 1)):
        here = np.nonzero(side)[0]
        names = _prefix_digests(sequences[at], int(depth[here].max())) if len(here) else []
        for k in here.tolist():
            key[k] = names[depth[k]]
    above = np.where(up, key[np.maximum(parent, 0)], None)
    known = np.array([x is None for x in above], bool)
    kind = np.where(crosses, "part", np.where(known, "node", "below"))
    parents = pa.array(least[np.maximum(parent, 0)], mask=~known | ~up)
    columns = [kind, key, above, np.full(len(row), block), least, depth, parents, count, children, leaf[right + 1] - leaf[left], saved, digest]
    table = pa.Table.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, _ARROW.types, strict=True)], schema=_ARROW)
    listed = [(key[k], convs[left[k] : left[k] + ends[k]], depth[k]) for k in np.nonzero((ends > 0) & crosses)[0].tolist()]
    if listed:
        size = [len(c) for _, c, _ in listed]
        columns = {"kind": pa.array(["end"] * sum(size)), "key": pa.array([k for (k, _, _), m in zip(listed, size, strict=True) for _ in range(m)], pa.binary()), "conv_id": pa.array(np.concatenate([c for _, c, _ in listed])), "depth": pa.array(np.repeat([d for *_, d in listed], size))}
        table = pa.concat_tables([table, pa.table([columns.get(f.name, pa.nulls(sum(size), f.type)) for f in _ARROW], schema=_ARROW)])
    return table


def _pieces(ordered: DataFrame, parts: int, block: int) -> DataFrame:
    """All blocks' rows of sorted sequences (part, seq, sizes, conv_id, before, after): a task reads whole parts in order."""

    def run(batches):
        held: list = []
        turns, number = 0, 0

        def done(after: int):
            nonlocal held, turns, number
            before = shared(last, held[0][1]) if last is not None else held[0][3]
            out = block_nodes(np.array([h[0] for h in held], np.int64), [h[1] for h in held], [h[2] for h in held], before, after, (held[0][5] << 24) + number)
            number, turns = number + 1, 0
            return out

        last = None
        for batch in batches:
            sizes = batch.column("sizes")
            offsets = sizes.offsets.to_numpy() - sizes.offsets[0].as_py()
            flat = sizes.flatten().to_numpy(zero_copy_only=False)
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "seq", "before", "after", "part")]
            for k, (conv, seq, before, after, part) in enumerate(zip(*columns, strict=True)):
                if held and held[-1][5] != part:
                    yield from done(held[-1][4]).to_batches()
                    held, last, number = [], None, 0
                elif held and turns >= block:
                    yield from done(shared(held[-1][1], seq)).to_batches()
                    held, last = [], held[-1][1]
                held.append((conv, seq, flat[offsets[k] : offsets[k + 1]], before, after, part))
                turns += len(seq) // KEY + 1
        if held:
            yield from done(held[-1][4]).to_batches()

    return ordered.repartition(parts, "part").sortWithinPartitions("part", "seq", "conv_id").mapInArrow(run, PIECE)


def _borders(ordered: DataFrame) -> DataFrame:
    """part, and the keys that its first row shares with the part before it, its last row with the next one (-1: none)."""
    ends = ordered.groupBy("part").agg(F.min(F.struct("seq", "conv_id"))["seq"].alias("first"), F.max(F.struct("seq", "conv_id"))["seq"].alias("last"))
    both = Window.orderBy("part")
    ends = save(ends.withColumns({"was": F.lag("last").over(both), "next": F.lead("first").over(both)}), "borders")

    def compare(batches):
        for b in batches:
            rows = zip(*(b.column(c).to_pylist() for c in ("part", "first", "last", "was", "next")), strict=True)
            found = [(p, -1 if was is None else shared(was, first), -1 if after is None else shared(last, after)) for p, first, last, was, after in rows]
            yield pa.record_batch([pa.array([f[k] for f in found], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64()))], names=["part", "before", "after"])

    return ends.mapInArrow(compare, "part long, before long, after long")


def _list_digests(ends: DataFrame) -> DataFrame:
    """key and the hash of its ids in order, comma-joined.  Rows of a key stream through one hash, so a list of any length takes no memory."""

    def digest(batches):
        now, state, out = None, None, []
        for batch in batches:
            for key, conv in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
                if key != now:
                    if state is not None:
                        out.append((now, state.hexdigest()))
                    now, state = key, hashlib.sha256()
                    state.update(b"%d" % conv)
                else:
                    state.update(b",%d" % conv)
            yield pa.record_batch([pa.array([k for k, _ in out], pa.binary()), pa.array([h for _, h in out], pa.string())], names=["key", "ends_sha256"])
            out = []
        if state is not None:
            yield pa.record_batch([pa.array([now], pa.binary()), pa.array([state.hexdigest()])], names=["key", "ends_sha256"])

    return ends.repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(digest, "key binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, block: int = BLOCK, share: int = SHARE) -> DataFrame:
    """The nodes of all prefixes of conversations (conv_id, turns), as the module says: conv_id (the least member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    seq = F.unhex(F.array_join(F.transform("turns", lambda t: t["key"]), ""))
    rows = save(conversations.select("conv_id", seq.alias("seq"), F.transform("turns", lambda t: t["size"]).alias("sizes")), "sequences")
    n, turns = rows.agg(F.count("*"), F.coalesce(F.sum(F.size("sizes")), F.lit(0))).first()
    parts = max(1, -(-(n + turns) // share))
    ordered = save(rows.repartitionByRange(parts, "seq", "conv_id").withColumn("part", F.spark_partition_id().cast("long")), "ordered")
    pieces = save(_pieces(ordered.join(F.broadcast(_borders(ordered)), "part"), parts, block), "pieces")  # borders: three numbers a part

    measures = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    part = pieces.where("kind = 'part'")
    lists = _list_digests(pieces.where("kind = 'end'").select("key", "conv_id"))
    wide = part.groupBy("key", "depth").agg(F.min("conv_id").alias("conv_id"), F.first("up").alias("up"), *(F.sum(m).alias(m) for m in measures))
    wide = save(wide.join(lists, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING))), "wide")
    name = wide.select(F.col("key").alias("up"), F.col("conv_id").alias("__parent"))
    # A block's own copy of each wide node's least member: no key of the join below has more rows than a block.
    local = part.select("block", F.col("key").alias("up")).distinct().join(name, "up")
    columns = ["conv_id", "depth", "parent_conv_id", *measures, "ends_sha256"]
    below = pieces.where("kind = 'below'").join(local, ["block", "up"]).withColumn("parent_conv_id", F.col("__parent"))
    top = wide.join(name, "up", "left").withColumn("parent_conv_id", F.col("__parent"))
    return pieces.where("kind = 'node'").select(*columns).unionByName(below.select(*columns)).unionByName(top.select(*columns))


def trie_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = turn_lists(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text"))
    lists = save(lists, "turns")  # read twice below
    return prefix_trie(rebuilt(lists, (F.crc32(F.col("conv_id").cast("string").cast("binary")) % BORROW).cast("int")))


TRIE_SQL = f"""WITH RECURSIVE {CRC_SQL},
turned AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT conv_id, hex(encode(conv_id::VARCHAR)) AS digits FROM turned GROUP BY 1),
taken AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {crc_sql("digits")} % 9 AS h FROM ids, crc),
built AS (SELECT k.conv_id, pos, role, text FROM taken k JOIN turned t ON t.conv_id = base AND pos < h UNION ALL SELECT k.conv_id, pos, role, text FROM taken k JOIN turned t ON t.conv_id = k.conv_id AND pos >= h),
seqs AS (SELECT k.conv_id, coalesce(list(sha256(length(role) || ':' || role || text) ORDER BY pos) FILTER (pos IS NOT NULL), []) AS s, coalesce(list(strlen(text) ORDER BY pos) FILTER (pos IS NOT NULL), []) AS sizes
  FROM taken k LEFT JOIN built b ON k.conv_id = b.conv_id GROUP BY 1),
reached AS (SELECT *, unnest(range(len(s) + 1)) AS depth FROM seqs),
members AS (SELECT conv_id, depth, array_to_string(s[1:depth], '') AS k, array_to_string(s[1:depth - 1], '') AS up, len(s) = depth AS done, coalesce(sizes[depth], 0) AS size FROM reached),
nodes AS (SELECT depth, k, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (done), '')) AS ends_sha256, (count(*) - 1) * any_value(size) AS saves
  FROM members GROUP BY depth, k),
below AS (SELECT up, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
sized AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN below ON below.up = k AND below.depth = nodes.depth),
summed AS (SELECT a.depth, a.k, count(*) FILTER (b.n_children = 0) AS n_leaves, sum(b.saves)::BIGINT AS saved_tokens FROM sized a JOIN sized b ON starts_with(b.k, a.k) GROUP BY ALL)
SELECT a.conv_id, a.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, a.n_convs, a.n_children, n_leaves, saved_tokens, a.ends_sha256
FROM sized a JOIN summed s ON a.k = s.k AND a.depth = s.depth LEFT JOIN nodes p ON a.up = p.k AND a.depth = p.depth + 1"""
