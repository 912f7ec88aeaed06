import collections
import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

P = pytest.importorskip("public_tokenizers")

from tokenizers import Tokenizer  # noqa: E402

from pyspark.sql import functions as F  # noqa: E402

from pingloom.llm import chat, decontam, importance, licences, neardup, packing, quality, sharding, store, suffix  # noqa: E402
from pingloom.llm.tokens import Encoder, tokenizer_json  # noqa: E402

BPE = P.path("byte_bpe_50k.json")
LINE = "the quick brown fox jumps over the lazy dog and runs away from seven angry bears in the dark forest by the river today"
TEXTS = [None, "", "a", LINE, LINE, "x " + LINE + " y z", "  odd\t\twhite\n\n space here　 'll don't “hi” <|endoftext|>", "long " * 3000, LINE.upper(), "ab" * 400]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", "clash") for i, t in enumerate(TEXTS)] + [(None, LINE, None, None, "clash"), (3, LINE, "en", "s", "clash")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, shard string").repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, shard string")


def test_encoder_is_exact():
    e = Encoder(tokenizer_json(BPE))
    ids, b = e.encode(pa.array([t or "" for t in TEXTS]))
    for k, t in enumerate(TEXTS):
        assert ids[b[k] : b[k + 1]].tolist() == e.tokenizer.encode(t or "", add_special_tokens=False).ids


def test_added_tokens_have_their_own_ids(spark, tmp_path):
    """Against the tokenizer file as it is, not the Encoder's own tokenizer."""
    fresh = Tokenizer.from_file(BPE)
    rng, end = np.random.default_rng(4), "<|endoftext|>"
    bits = [end, end, " ", "  ", "\n", "\t ", "a", "Zé", "7", ".", "<|", "|>", "<|endoftext", "…", "'ll", "\u3000", "ß"]
    texts = ["a <|endoftext|> b", end, "<|endof", "text|>", *("".join(rng.choice(bits, 12)) for _ in range(3000))]
    want = [fresh.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[0] == [64, 220, 50256, 275]
    ids, b = Encoder(tokenizer_json(BPE)).encode(pa.array(texts))
    assert [ids[b[k] : b[k + 1]].tolist() for k in range(len(texts))] == want
    df = spark.createDataFrame(list(enumerate(texts[:50])), "doc_id long, text string")
    store.write_store(df, f"file://{tmp_path}/s", BPE)
    assert {r.doc_id: r.ids for r in store.read_documents(spark, f"file://{tmp_path}/s").collect()} == {k: [*want[k], 2] for k in range(50)}


def test_store_round_trip(spark, docs, empty, tmp_path):
    e = Encoder(tokenizer_json(BPE))
    store.write_store(docs, f"file://{tmp_path}/s", BPE)
    back = store.read_documents(spark, f"file://{tmp_path}/s").collect()
    sums = {r.start: r for r in store.document_checksums(spark, f"file://{tmp_path}/s").collect()}
    assert len(back) == 12
    at = 0
    for r in sorted(back, key=lambda r: r.start):
        text = TEXTS[r.doc_id] if r.doc_id is not None else LINE
        assert r.start == at and r.ids == [*e.tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        assert sums[at].ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and sums[at].n_tokens == len(r.ids)
        at += len(r.ids)
    store.write_store(empty, f"file://{tmp_path}/e", BPE)
    assert store.document_checksums(spark, f"file://{tmp_path}/e").count() == 0


def test_store_is_in_order_and_checked(spark, tmp_path):
    """Ascending doc_id over several files without adaptive execution, and each kind of damage is seen."""
    import pyarrow.parquet as pq

    rng = np.random.default_rng(6)
    rows = [(int(k), " ".join(f"w{x}" for x in rng.integers(0, 50, rng.integers(0, 700)))) for k in rng.permutation(500)]
    docs = spark.createDataFrame([*rows, rows[7], (None, "null id"), (None, "null id")], "doc_id long, text string").repartition(5)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        store.write_store(docs, f"file://{tmp_path}/s", BPE)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    files = sorted((tmp_path / "s/recipes").glob("part-*.parquet"))
    ids = [x for f in files for x in pq.read_table(f).column("doc_id").to_pylist()]
    assert len(files) > 2 and ids[:2] == [None, None] and ids[2:] == sorted([*range(500), rows[7][0]])
    at = 0
    for r in sorted(store.read_documents(spark, f"file://{tmp_path}/s").collect(), key=lambda r: r.start):
        assert r.start == at
        at += len(r.ids)
    chunks = pq.read_table(tmp_path / "s/data/kind=0")
    assert len(set(chunks.column("key").to_pylist())) == len(chunks)
    root = store.verify_manifest(spark, f"file://{tmp_path}/s")
    assert root == store.merkle_root([store.merkle_root([r for r in pq.read_table(f).column("root").to_pylist()]) for f in files if pq.read_table(f).num_rows])
    for f in files[1:2]:  # a recipe less
        pq.write_table(pq.read_table(f).slice(1), f)
        (tmp_path / f"s/recipes/.{f.name}.crc").unlink()
    with pytest.raises(ValueError):
        store.verify_manifest(spark, f"file://{tmp_path}/s")


def test_tree_is_the_merkle_root():
    for n in range(40):
        leaves, tree = [store.digest(bytes([k])) for k in range(n)], store.Tree()
        for leaf in leaves:
            tree.add(leaf)
        assert tree.root() == store.merkle_root(leaves)


def test_packing(docs, empty):
    rows = packing.pack_documents(docs, BPE).collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append(r)
    for rs in by.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    assert packing.pack_documents(empty, BPE).count() == 0
    bins, _ = packing.first_fit_decreasing(np.array([3, 7, 5, 5, 10]), 10)
    assert len(set(bins.tolist())) == 3


def removed(texts):
    seen, out = set(), []
    for t in texts:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 99):
            if b[i : i + 100] in seen:
                gone[i : i + 100] = True
            seen.add(b[i : i + 100])
        out.append(np.frombuffer(b, np.uint8)[~gone].tobytes())
    return out


def test_suffix_against_brute_force(spark, empty):
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdé"), 4)) for _ in range(40)]
    shared = " ".join(rng.choice(words, 60))
    texts = ["".join(f"{w} " for w in rng.choice(words, 50)) + shared + " ".join(rng.choice(words, 20)) for _ in range(90)] + [shared * 3, "ab" * 200, None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = {r.doc_id: bytes(r["__kept"]) for r in suffix.remove_repeats(df).collect()}
    assert [got[i] for i in range(len(texts))] == removed(texts)
    assert suffix.remove_repeats(empty).count() == 0


def test_suffix_of_long_null_and_repeated_rows(spark, monkeypatch):
    """Texts over many windows, a null doc_id, repeated rows, and columns named like the operator's own."""
    monkeypatch.setattr(suffix, "SLICE", 1500)
    monkeypatch.setattr(suffix, "MANY", 4)
    rng = np.random.default_rng(9)
    fresh = lambda n: "".join(rng.choice(list("abcdefgh é"), n))
    passages = [fresh(int(n)) for n in rng.integers(90, 400, 12)]
    long = [fresh(400).join(rng.choice(passages, 25)) + fresh(1000) for _ in range(4)]
    short = [fresh(60) + passages[k % 3] + fresh(50) for k in range(30)]
    texts = [passages[0], *long, *short, long[0][2000:6000], "z" * 5000, "", None]
    rows = [(None if k == 0 else k, t, f"r{k}", k, "x") for k, t in enumerate(texts)]
    rows += [rows[2], rows[7]]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string, at int, asked string").repartition(3)
    back = suffix.remove_repeats(df).collect()
    want = removed(texts)
    assert len(back) == len(rows)
    for r in back:
        k = r.at
        assert bytes(r["__kept"]) == want[k] and r.runs == f"r{k}" and r["__n_removed"] == len((texts[k] or "").encode()) - len(want[k])


def test_suffix_anchor_in_many_slices(spark, monkeypatch):
    """One passage with unlike surroundings, one text a slice: no slice sees two kinds, but no task gets all of them to compare."""
    monkeypatch.setattr(suffix, "SLICE", 400)
    monkeypatch.setattr(suffix, "MOST", 16)
    rng = np.random.default_rng(21)
    fresh = lambda n: "".join(rng.choice(list("abcdefgh é"), n))
    passage = fresh(260)
    texts = [fresh(90) + passage + fresh(90) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = suffix.find_segments(df.withColumn("tie", F.lit(0).cast("long"))).repartition("anchor").mapInArrow(suffix.resolve, suffix.SEGMENT)
    groups = {(r.kind, r.anchor): r["count"] for r in found.groupBy("kind", "anchor").count().collect()}
    assert max(n for (k, _), n in groups.items() if k == suffix.COMPARE) <= 16 and max(n for (k, _), n in groups.items() if k == suffix.SINGLE) > 100
    assert {r.doc_id: bytes(r["__kept"]) for r in suffix.remove_repeats(df).collect()} == dict(enumerate(removed(texts)))


def test_near_duplicates(spark, docs, empty):
    got = {(r.doc_id, r.class_id) for r in neardup.near_duplicate_classes(docs).collect()}
    assert {(3, 3), (4, 3), (8, 3), (0, 0), (None, None)} <= got
    assert neardup.near_duplicate_classes(empty).count() == 0
    # a chain: neighbours are alike, ends aren't
    words = [f"w{i}" for i in range(200)]
    chain = [" ".join(words[5 * k :] + [f"z{k}{j}" for j in range(5 * k)]) for k in range(5)]
    df = spark.createDataFrame(list(enumerate(chain)), "doc_id long, text string")
    assert {r.class_id for r in neardup.near_duplicate_classes(df).collect()} == {0}


def test_signature_estimates_probability_jaccard():
    x = {k: 1 + k % 3 for k in range(400)}
    y = {k: 1 + k % 4 for k in range(100, 500)}
    h = lambda d: np.array([k * 2654435761 + 1 for k in d], np.uint64)
    sig = lambda d: neardup.prob_min_hash(np.zeros(len(d), int), h(d), np.array(list(d.values()), float), 1, 4096)[0]
    exact = sum(1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in {*x, *y}) for d in x if d in y)
    assert abs(neardup.estimate(sig(x), sig(y)) - exact) < 0.03


def test_decontamination(spark, empty):
    item = "It was a bright cold day in April, and the clocks were striking thirteen while the wind blew dust in from the street outside."
    near = item.replace("bright", "brighht").replace("  ", " ").upper()
    df = spark.createDataFrame([(1, "before " + item + " after"), (2, "x\n" + near.replace(" ", "\n ", 3)), (3, LINE), (None, item), (5, None)], "doc_id long, text string")
    items = spark.createDataFrame([(7, item), (8, None), (9, "tiny")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontam.find_items(df, items).collect()} == {(1, 7), (2, 7), (None, 7)}
    assert decontam.find_items(empty, items).count() == 0


def test_decontamination_against_edit_distance(spark):
    """Items of one probe against the least edit distance to any stretch of the text, by plain dynamic programming."""
    rng = np.random.default_rng(21)
    letters = list("abcdefghijklmnop ")

    def plain(text):
        return re.sub(r"[ \t\n\v\f\r]+", " ", text).lower()

    def distance(item, text):
        last = [0] * (len(text) + 1)
        for i, a in enumerate(item, 1):
            row = [i]
            for j, b in enumerate(text, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (a != b)))
            last = row
        return min(last)

    items = ["".join(rng.choice(letters, int(n))).strip() for n in (40, 80, 149, 110)]
    texts = []
    for k in range(60):
        part = list(items[k % 4])
        for _ in range(rng.integers(0, 14)):
            at, how = rng.integers(len(part)), rng.integers(3)
            part[at : at + (how < 2)] = [] if how == 0 else [str(rng.choice(letters))]
        texts.append("".join(rng.choice(letters, 60)) + "".join(part) + "".join(rng.choice(letters, 60)))
    rows = [(k, t) for k, t in enumerate(texts)] + [(5, texts[5]), (None, items[0])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, item_id int, probe string")
    benchmark = spark.createDataFrame([(k, t) for k, t in enumerate(items)], "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id) for r in decontam.find_items(df, benchmark).collect()), key=str)
    want = sorted(((d, k) for d, t in rows for k, item in enumerate(items) if distance(plain(item), plain(t)) <= int(decontam.RATE * len(plain(item)))), key=str)
    assert set(got) == set(want) and len({d for d, _ in want}) > 20 and len(want) < len(texts)


def test_decontamination_finds_every_excerpt_of_159_bytes(spark):
    rng = np.random.default_rng(6)
    item, other = ("".join(rng.choice(list("abcdefghijklmnop"), 394)) for _ in range(2))
    excerpts = [item[k : k + 159] for k in range(0, 394 - 158)] + [item[30:189]]
    df = spark.createDataFrame([(k, other[:100] + x + other[100:200]) for k, x in enumerate(excerpts)], "doc_id long, text string")
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontam.find_items(df, items).collect()} == {(k, 7) for k in range(len(excerpts))}


def test_first_fit_decreasing_against_plain_scan():
    rng = np.random.default_rng(13)
    for most in (1024, 90, 3):
        lengths = rng.integers(1, most + 1, 700)
        room, want = [], {}
        for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
            at = next((b for b, r in enumerate(room) if r >= lengths[k]), len(room))
            if at == len(room):
                room.append(1024)
            want[k] = (at, 1024 - room[at])
            room[at] -= lengths[k]
        bins, offsets = packing.first_fit_decreasing(lengths, 1024)
        assert [(int(b), int(o)) for b, o in zip(bins, offsets, strict=True)] == [want[k] for k in range(len(lengths))]


def test_all_quality_counts_against_plain_python(spark):
    rng = np.random.default_rng(17)
    parts = ["a b c d e f", "a b c d e f", "x # y", "\n", "\n\n", "äö ü|ß", "  \t", "one two three four five six seven", "$%&<>*", "\r\n"]
    texts = [" ".join(rng.choice(parts, rng.integers(0, 25))) for _ in range(80)] + [None, "", " \n "]
    df = spark.createDataFrame([(k, t, "en", 1, "x") for k, t in enumerate(texts)], "doc_id long, text string, lang string, n_words int, kept string")
    for r in quality.quality(df).collect():
        text = texts[r.doc_id] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = collections.Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
        repeated = {k + j for k in range(len(words) - 4) if windows[tuple(words[k : k + 5])] > 1 for j in range(5)}
        lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
        want = (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeated))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(words) < 10 or 100 * len(repeated) > 20 * len(words)) and not (r.base_failed and r.kept)


def test_kneser_ney_against_plain_python():
    """Model's probabilities against the recursive definition with plain dictionaries."""
    rng = np.random.default_rng(19)
    words = ["".join(rng.choice(list("abcd"), rng.integers(1, 6))) for _ in range(300)]
    bits, order = quality.BITS, quality.ORDER
    seen = collections.Counter()
    for w in words:
        codes = [0] * (order - 1) + [ord(c) + 2 for c in w] + [1]
        seen.update(tuple(codes[k : k + order]) for k in range(len(codes) - order + 1))
    levels = {order: dict(seen)}
    for k in range(order - 1, 0, -1):
        levels[k] = dict(collections.Counter(g[1:] for g in levels[k + 1]))

    def p(gram):
        if not gram:
            return 1 / quality.SYMBOLS
        table = levels[len(gram)]
        below, c = p(gram[1:]), [sum(n == k for n in table.values()) for k in range(5)]
        y = c[1] / (c[1] + 2 * c[2]) if c[1] else 0
        d = [0, *(min(float(k), max(0.05, k - (k + 1) * y * c[k + 1] / c[k])) for k in (1, 2, 3))] if min(c[1:]) else [0, 0.5, 1.0, 1.5]
        same = {g: n for g, n in table.items() if g[:-1] == gram[:-1]}
        if not same:
            return below
        total = sum(same.values())
        n = same.get(gram, 0)
        return (n - d[min(n, 3)]) / total + sum(d[min(x, 3)] for x in same.values()) / total * below

    pack = lambda gram: sum(c << (bits * (order - 1 - k)) for k, c in enumerate(gram))
    keys = np.array(sorted(map(pack, seen)), np.uint64)
    by = {pack(g): n for g, n in seen.items()}
    model = quality.Model(keys, np.array([by[int(k)] for k in keys]))
    grams = list(seen)[:150] + [tuple(int(x) for x in rng.choice([0, 1, 99, 100, 101, 102, 150], 4)) for _ in range(100)]
    got = model.log_p(np.array([pack(g) for g in grams], np.uint64))
    assert np.abs(got - np.log([p(g) for g in grams])).max() < 1e-9


def test_quality_counts(spark, docs, empty):
    for r in quality.quality(docs).collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", (TEXTS[r.doc_id] if r.doc_id is not None else LINE) or "")
        assert (r.n_words, r.word_chars) == (len(words), sum(map(len, words)))
        assert not (r.base_failed and r.kept)
    assert quality.quality(empty).count() == 0


def test_model_sums_to_one():
    rng = np.random.default_rng(1)
    distinct = pa.array(["".join(rng.choice(list("abc"), 3)) for _ in range(60)]).unique()
    grams, _ = quality.word_ngrams(distinct)
    keys, n = np.unique(grams, return_counts=True)
    model = quality.Model(keys, n)
    context = keys[0] >> np.uint64(quality.BITS) << np.uint64(quality.BITS)
    assert abs(np.exp(model.log_p(context + np.arange(quality.SYMBOLS, dtype=np.uint64))).sum() - 1) < 1e-6


def test_bands_reject_symbols_that_all_documents_teach(spark):
    """Tables and sprinkled symbols, a tenth of the texts, are rejected though the model counts them; prose is kept."""
    rng = np.random.default_rng(23)
    vocabulary = ["".join(rng.choice(list("abcdefghij"), rng.integers(2, 8))) for _ in range(500)]
    prose = [" ".join(rng.choice(vocabulary, 80)) for _ in range(180)]
    poor = [" | ".join(rng.choice(vocabulary, 60)) for _ in range(10)] + [" ".join(w + str(rng.choice(["###", "$$$", "***"])) for w in rng.choice(vocabulary, 60)) for _ in range(10)]
    df = spark.createDataFrame([(k, t, "en") for k, t in enumerate(prose + poor)], "doc_id long, text string, lang string")
    assert {r.doc_id for r in quality.quality(df).collect() if r.kept} == set(range(180))


def test_passages_in_another_language_are_kept(spark):
    """A word's probability is half that of its language and half the mean of the main languages'."""
    rng = np.random.default_rng(29)
    first, second = (["".join(rng.choice(list(letters), rng.integers(2, 8))) for _ in range(300)] for letters in ("abcdefgh", "mnopqrst"))
    prose = lambda v, n: " ".join(rng.choice(v, n))
    rows = [(k, "en", prose(first, 80)) for k in range(60)] + [(60 + k, "fr", prose(second, 80)) for k in range(60)] + [(120, "en", prose(first, 40) + " " + prose(second, 40))]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    assert {r.doc_id for r in quality.quality(df).collect() if r.kept} == set(range(121))
    models = {}
    for name in ("en", "fr"):
        grams, _ = quality.word_ngrams(pa.array([w for _, lang, t in rows if lang == name for w in t.split()]))
        models[name] = quality.Model(*np.unique(grams, return_counts=True))
    counts = quality.save(quality.count_ngrams(df), "ngrams")
    assert sorted(quality.main_languages(counts)) == ["en", "fr"]
    mixed = rows[-1][2].split()
    cost = 0.0
    for w in mixed:
        p = {name: np.exp(m.log_p(quality.word_ngrams(pa.array([w]))[0]).sum()) for name, m in models.items()}
        cost -= np.log(p["en"] / 2 + (p["en"] + p["fr"]) / 4)
    got = quality.score(df, quality.train(counts), foreign=quality.main_languages(counts)).where("doc_id = 120").head().log_perplexity
    assert abs(got - cost / sum(map(len, mixed))) < 1e-9


def test_model_in_parts_counts_every_ngram(spark):
    """However small the parts are, scores are those of a model of all n-grams (and all documents teach)."""
    rng = np.random.default_rng(2)
    texts = [" ".join("".join(rng.choice(list("abcdefé"), rng.integers(1, 7))) for _ in range(60)) for _ in range(40)] + ["a|b || zz |q| " * 9, "", None]
    langs = ["en", "de", None]
    df = spark.createDataFrame([(i, langs[i % 3] if i < 40 else "en", t) for i, t in enumerate(texts)], "doc_id long, lang string, text string").repartition(3)
    counts = quality.save(quality.count_ngrams(df), "ngrams")
    assert counts.count() > 300
    models = {}
    for name in langs:
        grams, word = quality.word_ngrams(pa.array([w for i, t in enumerate(texts) if (langs[i % 3] if i < 40 else "en") == name for w in (t or "").split()]))
        models[name] = quality.Model(*np.unique(grams, return_counts=True))
    for rows in (4000, 10**6):
        parts = quality.train(counts, rows)
        assert (len(parts) > 1) == (rows == 4000)
        for r in quality.score(df, parts).collect():
            words = (texts[r.doc_id] or "").split()
            if words:
                p = models[r.lang].log_p(quality.word_ngrams(pa.array(words))[0])
                letters = sum(c not in "#*$%&|<>" for w in words for c in w)
                assert abs(r.log_perplexity + p.sum() / letters) < 1e-9
            else:
                assert r.log_perplexity is None


def test_sharding_law(docs, empty):
    rows = sharding.assign_shards(docs).collect()
    assert len(rows) == 12 and all(r.grown_shard in (r["shard"], 24) for r in rows)
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert sharding.assign_shards(empty).count() == 0


def test_changed_weights_move_rows_within_their_subtrees(spark):
    """Shard 5 (rack 4 to 7, region 0 to 11) gets three times its weight."""
    keys = spark.range(6000).withColumnRenamed("id", "k")
    grown = sharding.with_shard(sharding.with_shard(keys, "k", "old", 24), "k", "new", 24, None, {5: 3.0}).collect()
    moved = [(r.old, r.new) for r in grown if r.old != r.new]
    region, rack = lambda s: s // 12, lambda s: s // 4
    assert moved and all(region(b) == 0 for _, b in moved)  # other regions only lose, to this one
    assert all(rack(b) == 1 for a, b in moved if region(a) == 0) and all(b == 5 for a, b in moved if rack(a) == 1)
    share = sum(r.new == 5 for r in grown) / len(grown)
    assert abs(share - 3 / 26) < 0.02


def formatted_digests(df):
    return {r.conv_id: r for r in chat.read_back(chat.format_turns(chat.canonical_records(chat.as_records(df)))).collect()}


def test_chat_round_trip(spark):
    texts = ["</s>[INST] ok [/INST]", "<|im_end|> <\\|im_sep|>", "", None, 'plain \\ "text" \u0000 \U0001f600 \n']
    rows = [(c, i, "assistant" if i % 2 else "user", t) for c in (1, 2, 3, None) for i, t in enumerate(texts)]
    rows += [(9, 0, "user", "twin"), (9, 1, "assistant", "reply"), (5, 0, "b", "x"), (5, 0, "a", "z"), (5, 0, "a", "y"), (5, 0, "a", "y"), (6, None, None, None)]
    df = spark.createDataFrame([(*r, "extra", "clash") for r in rows], "conv_id long, turn long, role string, text string, record string, turns string")
    got = formatted_digests(df)
    assert set(got) == {1, 2, 3, None, 9, 5, 6}
    for conv in got:
        mine = sorted([(-1 if r[1] is None else r[1], r[2] or "", r[3] or "") for r in rows if r[0] == conv])
        said = "".join(f"{role}\n{text}\n" for _, role, text in mine)
        learnt = "".join(text for _, role, text in mine if role == "assistant")
        assert got[conv].turns_sha256 == hashlib.sha256(said.encode()).hexdigest() and got[conv].n_turns == len(mine)
        assert got[conv].loss_sha256 == hashlib.sha256(learnt.encode()).hexdigest() and got[conv].loss_chars == len(learnt)
    assert formatted_digests(df.limit(0)) == {}


def test_chat_layouts_by_fingerprint(spark):
    turns = lambda *x: [("user", x[0]), ("assistant", x[1])]
    records = {
        '{"messages": [{"role": "user", "content": "a"}, {"content": "b", "role": "assistant"}]}': ("messages", turns("a", "b")),
        '{"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}': ("conversations", turns("a", "b")),
        '{"chat": {"turns": [{"speaker": {"role": "user"}, "text": "a"}, {"speaker": {"role": "assistant"}, "text": "b"}]}}': ("chat", turns("a", "b")),
        '{"output": "b", "instruction": "a", "input": "more"}': ("instruction", turns("a\nmore", "b")),
        '{"instruction": "a", "output": 7}': ("instruction_only", turns("a", "7")),
        '{"prompt": "a", "completion": "b"}': ("prompt", turns("a", "b")),
        '{"question": "a", "answer": null}': ("question", turns("a", "")),
        '{"system": "s", "user": "a", "response": "b"}': ("system", [("system", "s"), *turns("a", "b")]),
        '{"prompt": {"deep": "a"}, "completion": "b"}': (None, None),
        '{"messages": [{"role": "user", "content": {"parts": "a"}}]}': (None, None),
        '{"prompt": "a"}': (None, None),
        "not json": (None, None),
        "": (None, None),
    }
    df = spark.createDataFrame([(r,) for r in [*records, None]], "record string")
    for r in chat.canonical_records(df).collect():
        layout, want = records.get(r.record, (None, None))
        assert (r.layout, r.turns if r.turns is None else [tuple(x) for x in r.turns]) == (layout, want)


def test_licences(spark, empty):
    rows = [(1, "a/b/LICENSE", "Released under the MIT License."), (2, "a/b/c/x.py", "no notice here at all"), (3, "d/y.py", None), (4, None, "words\nLicensed under the Apache License, Version 2.0.")]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string")
    got = {r.doc_id: (r.licence, r.source) for r in licences.inherit(licences.scan(df)).collect()}
    assert got == {1: ("MIT", "own"), 2: ("MIT", "inherited"), 3: (None, None), 4: ("Apache-2.0", "own")}
    assert licences.inherit(licences.scan(licences.document_paths(empty))).count() == 0
    assert {r.licence for r in licences.scan(df, {}, full={}).collect()} == {None}


def test_licence_files_and_wrapped_notices(spark):
    mit = "Copyright (c) 2020 Someone Here\n\n" + licences.FULL_TEMPLATES["MIT"]
    rows = [(1, "p/LICENSE", mit), (2, "p/src/deep/a.py", "code of no note"), (2, "p/src/deep/a.py", "code of no note"), (3, "q/NOTICE", "# This Source Code Form is subject to\n# the terms of the Mozilla Public\n# License, v. 2.0"), (4, "q/x", None), (None, "r/long.txt", "w x y z " * 20000 + "\nReleased under the MIT License.\n" + "w " * 9)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, path string, text string, licence string, lines int")
    got = licences.inherit(licences.scan(df)).collect()
    assert len(got) == 6
    assert {(r.doc_id, r.licence, r.source, r.licence_dir) for r in got} == {(1, "MIT", "own", None), (2, "MIT", "inherited", "p"), (3, "MPL-2.0", "own", None), (4, "MPL-2.0", "inherited", "q"), (None, "MIT", "own", None)}


def test_licence_scores_against_plain_cosine(spark):
    rng = np.random.default_rng(12)
    pool = sorted({w for t in licences.TEMPLATES.values() for w in licences.template_words(t)}) + [f"noise{k}" for k in range(6)]
    names = list(licences.TEMPLATES)
    texts = []
    for _ in range(60):
        words = licences.template_words(licences.TEMPLATES[names[rng.integers(len(names))]])
        for _ in range(rng.integers(0, 5)):
            words.insert(rng.integers(len(words)), pool[rng.integers(len(pool))])
        del words[rng.integers(len(words))]
        texts.append("first line of text\n" + " ".join(words).upper())
    docs = spark.createDataFrame([(k, f"d/{k}", t) for k, t in enumerate(texts)], "doc_id long, path string, text string")
    bags = [set(licences.template_words(t)) for t in texts]
    weigh = lambda w: np.log((1 + len(texts)) / (1 + (sum(w in b for b in bags) if w in vocabulary else 0))) + 1
    vocabulary = {w for t in (*licences.TEMPLATES.values(), *licences.FULL_TEMPLATES.values()) for w in licences.template_words(t)}

    def cosine(a, b):
        x, y = collections.Counter(a), collections.Counter(b)
        dot = sum(x[w] * y[w] * weigh(w) ** 2 for w in x if w in y)
        return dot / np.sqrt(sum((n * weigh(w)) ** 2 for w, n in x.items()) * sum((n * weigh(w)) ** 2 for w, n in y.items()))

    for r in licences.scan(docs, full={}).collect():
        vocabulary = {w for t in licences.TEMPLATES.values() for w in licences.template_words(t)}
        line = licences.template_words(texts[r.doc_id].split("\n")[1])
        score, name = max((cosine(line, licences.template_words(t)), [-ord(c) for c in n], n) for n, t in licences.TEMPLATES.items())[::2]
        assert (r.licence is None and score < licences.THRESHOLD + 1e-9) or (r.licence == name and abs(r.score - score) < 1e-9) or r.score >= score


def test_importance(spark, docs, empty):
    labels = spark.createDataFrame([(3, 1, 0), (7, 0, 0)], "doc_id long, quality int, toxic int")
    rows = importance.resample(docs, labels, share=0.5).collect()
    assert sum(r.kept for r in rows) >= 5 and not any(r.kept for r in rows if not r.n_grams)
    assert importance.resample(empty, labels).count() == 0


def test_gumbel_top_k_against_plain_python(spark):
    """The kept rows are those of the k greatest values, ties included, and one draw follows the importances."""
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(["good", "fine", "bad", "poor", "so"], rng.integers(1, 30))) for _ in range(300)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(7, texts[7]), (8, texts[8]), (None, texts[3]), (9999, ""), (9998, None)]
    df = spark.createDataFrame([(*r, 1.0, True) for r in rows], "doc_id long, text string, value double, kept boolean").repartition(3)
    labels = spark.createDataFrame([(k, int("bad" not in t), 0) for k, t in enumerate(texts)], "doc_id long, quality int, toxic int")
    for plain in (False, True):
        out = importance.resample(df, labels, share=0.3, temperature=1.0, plain=plain).collect()
        k = round(0.3 * len(rows))
        last = sorted((r.value for r in out if r.value is not None), reverse=True)[k - 1]
        assert len(out) == len(rows) and all(r.kept == (r.value is not None and r.value >= last) for r in out)
    # one of three, many seeds: chosen as often as its importance says
    logs = np.log(np.array([0.5, 0.3, 0.2]))
    wins = np.bincount([np.argmax(logs + importance.gumbel(np.array([11, 12, 13]), seed)) for seed in range(4000)], minlength=3) / 4000
    assert np.abs(wins - np.exp(logs)).max() < 0.03
