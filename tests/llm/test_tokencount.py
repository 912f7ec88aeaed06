from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

P = pytest.importorskip("public_tokenizers")

from tokenizers import Tokenizer  # noqa: E402

from pingloom.llm import tokencount  # noqa: E402

BPE = P.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, n_tokens long, over_limit string"
TEXTS = [None, "", "a", "two words", "two words", " odd\t\twhite\n\n space here　 'll don't “hi” <|endoftext|>x", "long " * 3000, "ab" * 700, "ß é ñ 7.5% …", "word " * 1023, "word " * 1024 + "end"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", 5, "clash") for i, t in enumerate(TEXTS)] + [(None, "null id", None, None, None), (3, "two words", None, 1, "again")]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def _want(rows, encode):
    return sorted(((r.doc_id, len((r.text or "").encode()), n := len(encode(r.text or "")), n > 1024) for r in rows), key=str)


@pytest.mark.parametrize("table", [1, 3, 1000])
def test_counts_are_the_librarys_whatever_the_table(spark, docs, table):
    """Nulls, empty and long texts, repeated rows, clashing columns, special strings; a table that holds next to nothing, or all."""
    library = Tokenizer.from_file(BPE)
    want = _want(docs.collect(), lambda t: library.encode(t, add_special_tokens=False).ids)
    assert sorted(map(tuple, tokencount.token_counts(docs, BPE, table=table).collect()), key=str) == want


def test_other_tokenizers(spark, docs):
    import sentencepiece

    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    got = tokencount.token_counts(docs, P.path("word_bpe_49k.json"), table=50)
    assert sorted(map(tuple, got.collect()), key=str) == _want(docs.collect(), lambda t: library.encode(t, add_special_tokens=False).ids)
    model = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    got = tokencount.token_counts(docs, P.path("piece_bpe_32k.model"), table=50)
    assert sorted(map(tuple, got.collect()), key=str) == _want(docs.collect(), model.encode)


def test_empty_table(spark):
    assert tokencount.token_counts(spark.createDataFrame([], SCHEMA), BPE).count() == 0


def test_random_texts(spark):
    """Against the library over texts put together from pieces on which its pattern is easily cut wrongly."""
    rng, library = np.random.default_rng(13), Tokenizer.from_file(BPE)
    bits = ["<|endoftext|>", " ", "  ", "\n", "\t ", "a", "Zé", "7", ".", "<|", "'ll", "　", "ß", "word", " word"]
    rows = [(k, "".join(rng.choice(bits, rng.integers(0, 40)))) for k in range(2000)]
    got = tokencount.token_counts(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), BPE, limit=20, table=40)
    assert {(r.doc_id, r.n_tokens, r.over_limit) for r in got.collect()} == {(k, n := len(library.encode(t, add_special_tokens=False).ids), n > 20) for k, t in rows}


def test_frequent_units_are_found(spark):
    """Any unit that makes up more than one in `table` of all is in the table, over many tasks and merges."""
    rng = np.random.default_rng(3)
    words = [f" w{int(x)}" for x in rng.zipf(1.5, 20000) % 5000]
    rows = [(k, "".join(words[k * 100 : k * 100 + 100])) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(40)
    library, counts = tokencount._library(tokencount._source(BPE)), Counter()
    for _, t in rows:
        _, index, units = library.units(pa.array([t]))
        counts.update(units.to_pylist()[k] for k in index.tolist())
    found = set(tokencount.frequent_units(docs, BPE, table=50, fan=4))
    assert len(found) <= 50 and {u for u, n in counts.items() if n * 50 > sum(counts.values())} <= found


def test_length_table_is_exact():
    rng = np.random.default_rng(1)
    units = sorted({bytes(rng.integers(0, 3, rng.integers(0, 9)).astype(np.uint8)) for _ in range(2000)})
    inside, outside = units[::2], units[1::2]
    table = tokencount.LengthTable(inside, np.arange(len(inside)))
    assert table.get(pa.array(inside, pa.binary())).tolist() == [*range(len(inside))]
    assert set(table.get(pa.array(outside, pa.binary())).tolist()) == {-1}
    assert set(tokencount.LengthTable([], np.zeros(0)).get(pa.array(inside, pa.binary())).tolist()) == {-1}
