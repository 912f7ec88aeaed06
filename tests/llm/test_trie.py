import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pingloom.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, block string"


def _rebuilt(rows):
    """conv_id -> turns (role, text), by the contract, in plain Python."""
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    return out


def _brute(found):
    """All measures of all nodes from whole sequences."""
    members = defaultdict(list)
    for c, turns in found.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = set()
    for p, who in members.items():
        below = [q for q in members if q[: len(p)] == p]
        inner = {q[:-1] for q in members if q}
        ends = ",".join(map(str, sorted(c for c in who if tuple(found[c]) == p)))
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        out.add((min(who), len(p), min(members[p[:-1]]) if p else None, len(who), sum(len(q) == len(p) + 1 for q in below), sum(q not in inner for q in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def _run(spark, rows, **sizes):
    lists = trie.save(trie.turn_lists(spark.createDataFrame(rows, SCHEMA).repartition(3)), "turns")
    built = trie.rebuilt(lists, (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int"))
    got = trie.prefix_trie(built, **sizes).collect()
    assert len(got) == len(set(map(tuple, got)))
    return {(r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in got}


def _random(n, seed):
    """A third of the conversations begin alike, a third are copies of one, some are very short or long."""
    rng, rows = np.random.default_rng(seed), []
    for c in range(n):
        hot = rng.integers(3)
        size = 6 if hot == 1 else int(rng.choice([1, 2, 3, 5, 9, 30]))
        for t in range(size):
            text = f"same {t}" if hot == 1 or (hot == 2 and t < 3) else f"t{rng.integers(3)}é"
            rows.append((c * 1 + (c % 7 == 0) * 1000, t, "user" if t % 2 == 0 else "assistant", text, "clash", "clash"))
    return rows


@pytest.mark.parametrize("block, share", [(1 << 16, 1 << 19), (8, 64), (1, 40)])
def test_nodes_equal_brute_force_at_any_block_size(spark, block, share):
    rows = _random(60, 5)
    assert _run(spark, rows, block=block, share=share) == _brute(_rebuilt(rows))


def test_nulls_ties_repeats_and_empty_texts(spark):
    rows = [(0, None, None, None, None, None), (0, 0, "user", "", "x", "y"), (5, 1, "user", "b", None, None), (5, 1, "user", "a", None, None), (5, 1, "user", "a", None, None), (None, 0, "user", "lost", None, None)]
    rows += [(6, 3, "assistant", "ab" * 50000, None, None), (7, None, "", "", None, None), (11, 0, "user", None, None, None), (14, 0, "us", "er", None, None), (15, 0, "use", "r", None, None)]
    got = _run(spark, rows)
    want = _rebuilt(rows)
    assert {r[0] for r in got if r[1] == 0} == {0} and {r[3] for r in got if r[1] == 0} == {len(want)}
    # ties go by the turns' keys, which plain Python takes from the same hash
    key = lambda t: hashlib.sha256(f"{len(t[0])}:{t[0]}{t[1]}".encode()).hexdigest()
    h, own = zlib.crc32(b"5") % 9, sorted([("user", "b"), ("user", "a"), ("user", "a")], key=key)
    want[5] = own[:h] + own[h:]
    for c in want:
        if c - c % 5 == 5 and c != 5:
            want[c] = own[: zlib.crc32(str(c).encode()) % 9] + [x[2:4] for x in rows if x[0] == c][zlib.crc32(str(c).encode()) % 9 :]
    assert got == _brute({c: [tuple(y or "" for y in x) for x in v] for c, v in want.items()})


def test_turnless_conversations_are_in_the_root(spark):
    """All rebuilt conversations lose their turns: the root is then the one leaf."""
    ids = [c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1][:4]
    rows = [(c, 0, "user", "x", None, None) for c in ids]
    want = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert _run(spark, rows, block=1, share=2) == {(min(ids), 0, None, 4, 0, 1, 0, want)}


def test_empty_table(spark):
    assert _run(spark, []) == set()


def test_extents_by_range_minima():
    """From any row of an extent, both searches find its ends; against a scan."""
    rng = np.random.default_rng(2)
    values = rng.integers(0, 5, 300)
    m = trie.Minima(values)
    at, bound = rng.integers(0, 300, 500), rng.integers(0, 6, 500)
    left, right = m.left(at, bound), m.right(at, bound)
    for i, b, a, z in zip(at.tolist(), bound.tolist(), left.tolist(), right.tolist(), strict=True):
        x, y = i, i
        while x > 0 and values[x] >= b:
            x -= 1
        while y + 1 < 300 and values[y + 1] >= b:
            y += 1
        assert (a, z) == (x, y)
    a = rng.integers(0, 300, 400)
    b = np.minimum(299, a + rng.integers(0, 200, 400))
    assert m.least(a, b).tolist() == [values[i : j + 1].min() for i, j in zip(a, b, strict=True)]
