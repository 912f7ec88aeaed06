import re
import zlib
from collections import Counter

import numpy as np
import pytest

from pingloom.llm import spelling

SCHEMA = "doc_id long, text string, word string, n string, kind string"


def _near(a, b):
    """Whether exactly one character is inserted, deleted or replaced."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return any((a[k + i :], b[k + j :]) and a[k + i :] == b[k + j :] for i, j in ((1, 1), (1, 0), (0, 1)) if k + i <= len(a) and k + j <= len(b))


def _forms(vocab):
    out = {}
    for w, n in vocab.items():
        near = [(-vocab[o], o) for o in vocab if _near(w, o)]
        m, o = min(near, default=(0, None))
        out[w] = (o, -m) if near and -m >= 5 * n else (None, None), n, len(near)
    rows = set()
    for w, ((form, form_n), n, near) in out.items():
        root = w
        while out[root][0][0] is not None:
            root = out[root][0][0]
        rows.add((w, form, root, n, near, form_n))
    return rows


def _words(rows):
    found = Counter()
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            found[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


@pytest.mark.parametrize("block", [3, 40, 20_000])
def test_forms_equal_brute_force(spark, block):
    """Few letters, so that there are many near words, ties and chains; small blocks split every bucket."""
    rng = np.random.default_rng(12)
    words = {"".join(rng.choice(list("abß"), rng.integers(1, 8))) for _ in range(250)} | {"aaaaaa", "aaaaaab", "baaaaaa", "日本語", "日本", "a", ""}
    vocab = {w: int(5 ** rng.integers(0, 6)) + int(rng.integers(0, 2)) for w in sorted(words)}
    got = spelling.spelling_forms(spark.createDataFrame([*vocab.items()], "word string, n long"), block=block).collect()
    assert len(got) == len(vocab) and {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == _forms(vocab)


def test_documents_to_forms(spark, tmp_path):
    """Nulls, empty and long texts, repeated rows, other letters, columns of clashing names."""
    words = "gardens gardené GARDENS ÀÉÎõü× naïveté naivete colour-coloured colours".split()
    rng = np.random.default_rng(1)
    rows = [(k, " ".join(rng.choice(words, 300)), "x", "y", "z") for k in range(40)]
    rows += [(None, "gardens " * 7, None, None, None), (2, None, None, None, None), (3, "", None, None, None), (4, "gardenz " * 5, "", "", ""), (4, "gardenz " * 5, "", "", ""), (5, "garden1s coloured" * 9000, None, None, None)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    want = _forms(_words(rows))
    assert any(r[1] for r in want)
    got = spelling.spelling_query(spark, str(tmp_path)).collect()
    assert {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == want and len(got) == len(want)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert spelling.spelling_query(spark, str(tmp_path)).count() == 0


def test_one_half_that_all_words_share(spark):
    """A bucket of all words is dealt to many tasks and loses no pair."""
    rng = np.random.default_rng(3)
    words = sorted({"internat" + "".join(rng.choice(list("abcdefgh"), rng.integers(6, 8))) for _ in range(400)})
    vocab = {w: 5 + int(rng.integers(0, 200)) for w in words} | {words[0][:-1]: 9000}
    got = spelling.near_pairs(spark.createDataFrame([*vocab.items()], "word string, n long"), block=30).collect()
    assert sorted((r.word, r.other) for r in got) == sorted((a, b) for a in vocab for b in vocab if _near(a, b))


def test_intervals_grow_on_both_sides():
    """Whatever the order of the steps, an interval's places are the pattern's places."""
    rng = np.random.default_rng(4)
    text = rng.integers(1, 4, 400)
    index = spelling.BothWays(text, 4, 8)
    for _ in range(200):
        a = int(rng.integers(0, 393))
        pattern, lo, hi = text[a : a + 7].copy(), 3, 3
        pattern[rng.integers(0, 7)] = rng.integers(1, 4)
        state = tuple(np.array([x]) for x in (0, 0, index.n))
        while hi - lo < 7 and state[2][0]:
            right = hi < 7 and (lo == 0 or rng.integers(2))
            c, lo, hi = (pattern[hi], lo, hi + 1) if right else (pattern[lo - 1], lo - 1, hi)
            state = index.grow(state, np.array([c]), bool(right))
        want = [k for k in range(len(text) - (hi - lo) + 1) if (text[k : k + hi - lo] == pattern[lo:hi]).all()]
        assert sorted(index.order[state[0][0] : state[0][0] + state[2][0]].tolist()) == want
