import collections
import zlib

import numpy as np
import pyarrow as pa
import pytest

P = pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from pingloom.llm import neardup  # noqa: E402
from pingloom.llm.tokens import Encoder, tokenizer_json  # noqa: E402


def test_sketches_rule_out_no_similar_pair(spark):
    """Against plain sets of runs: every pair of similarity 0.8 or more passes, and most others of the family don't."""
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in range(220)]
    texts = []
    for k in range(80):
        words = list(base[: 220 - k % 7])
        for at in rng.choice(len(words), k % 12, replace=False):
            words[at] = f"x{k}_{at}"
        texts.append(" ".join(words))
    row, h, count = neardup.shingles(pa.array(texts))
    sketch = neardup.sketches(row, h, len(texts)).tolist()
    sets = [set(h[row == k].tolist()) for k in range(len(texts))]
    pairs = [(a, b) for a in range(len(texts)) for b in range(a + 1, len(texts))]
    df = spark.createDataFrame([(a, b, sketch[a], sketch[b]) for a, b in pairs], "a int, b int, x array<long>, y array<long>")
    passed = {(r.a, r.b) for r in df.where(neardup.may_link("x", "y")).collect()}
    similar = {(a, b) for a, b in pairs if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8}
    assert similar <= passed and len(passed) < len(similar) + (len(pairs) - len(similar)) / 2


def brute_classes(texts, threshold=0.8):
    """The least number of each text's class, from all pairs of texts by plain Counters."""
    def bag(text):
        words = text.lower().split()
        return collections.Counter(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))

    bags = [bag(t or "") if (t or "").split() else None for t in texts]
    label = list(range(len(texts)))

    def top(k):
        while label[k] != k:
            k = label[k]
        return k

    for a in range(len(texts)):
        for b in range(a):
            x, y = bags[a], bags[b]
            if x is None or y is None:
                continue
            plain = len(x.keys() & y.keys()) / len(x.keys() | y.keys())
            if max(plain, (x & y).total() / (x | y).total()) >= threshold:
                low, high = sorted((top(a), top(b)))
                label[high] = low
    return [top(k) for k in range(len(texts))]


def edited_family(rng, base, n, most, tag):
    """Copies of a list of words with 0 to `most` words replaced: near the base, beyond the threshold, and chains between."""
    out, last = [], list(base)
    for k in range(n):
        words = list(last if k % 5 == 4 else base)
        for at in rng.choice(len(words), rng.integers(0, most + 1), replace=False):
            words[at] = f"{tag}{k}_{at}"
        if k % 7 == 6:
            words += words[:12] * int(rng.integers(1, 4))  # repeated runs
        last = words
        out.append(" ".join(words))
    return out


def test_classes_are_those_of_all_pairs(spark):
    rng = np.random.default_rng(11)
    texts = [None, "", "one two", "one two", "  One   TWO ", "a b c d e f g " * 40, "a b c d e f g " * 41]
    texts += edited_family(rng, [f"w{k}" for k in range(200)], 150, 14, "x") + edited_family(rng, [f"v{k}" for k in range(60)], 80, 4, "y")
    texts += [" ".join(f"u{rng.integers(5000)}" for _ in range(80)) for _ in range(60)]
    df = spark.createDataFrame([(k, t, 1, 2) for k, t in enumerate(texts)], "doc_id long, text string, label int, runs int").repartition(3)
    got = {r.doc_id: r.class_id for r in neardup.near_duplicate_classes(df).collect()}
    want = brute_classes(texts)
    assert [got[k] for k in range(len(texts))] == want
    assert len(set(want)) > 70 and max(collections.Counter(want).values()) > 40


def test_prefixes_meet_wherever_a_pair_is_linked():
    """A pivot, a far member and any other member of similarity 0.8 or more have a run of their prefixes in common."""
    rng, met = np.random.default_rng(3), 0
    for _ in range(4000):
        n = int(rng.integers(4, 60))
        pivot = np.unique(rng.integers(0, 90, n))
        a = np.setdiff1d(np.union1d(pivot, rng.integers(0, 120, rng.integers(0, 12))), rng.choice(pivot, rng.integers(0, len(pivot) // 2 + 1)))
        b = np.setdiff1d(np.union1d(a, rng.integers(0, 120, rng.integers(0, 5))), rng.choice(a, min(len(a), rng.integers(0, 4))))
        if not len(a) or not len(b):
            continue
        share = neardup.slack(0.8)
        (far_a, keys_a), (far_b, keys_b) = neardup.prefix(pivot, a, share), neardup.prefix(pivot, b, share)
        if (far_a or far_b) and len(np.intersect1d(a, b)) >= 0.8 * len(np.union1d(a, b)):
            met += 1
            assert len(np.intersect1d(keys_a, keys_b))
    assert met > 300


def test_pipeline_stages(spark, tmp_path):
    """Each stage on its predecessor's rows; the last one's pieces hold exactly the ids of the texts that are left."""
    rng = np.random.default_rng(8)
    vocabulary = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(vocabulary, n))
    item, passage = prose(40), prose(60)
    texts = [prose(120) for _ in range(40)]
    texts += [texts[0], texts[1] + " tail", prose(90) + " " + item, prose(80) + " " + passage, prose(80) + " " + passage, "too short", None, "again and again and over " * 60]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        columns, docs = docs.columns, stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
            kept.append({r.doc_id: r.text for r in docs.collect()})
    quality, near, suffix, clean = kept
    assert set(quality) == set(range(45))
    assert set(near) == set(quality) - {40, 41}
    assert set(suffix) == set(near) and suffix[43] == texts[43] and passage not in suffix[44] and suffix[44].strip() in texts[44]
    assert set(clean) == set(suffix) - {42}
    encode, pieces = Encoder(tokenizer_json(P.path("byte_bpe_50k.json"))).tokenizer.encode, {}
    for r in docs.collect():
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == set(clean)
    for doc_id, rows in pieces.items():
        ids = [*encode(clean[doc_id], add_special_tokens=False).ids, 0]
        at = 0
        for r in sorted(rows, key=lambda r: r.start):
            assert r.start == at and r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
