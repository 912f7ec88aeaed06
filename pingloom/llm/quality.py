"""Quality rules: base counts of each text, and bands of n-gram perplexity for each language.

Model: an interpolated modified Kneser-Ney model of order 4 over the characters inside words (white space ends a word),
one for each language, counted and estimated by Spark over all documents, without cutoffs.  Distinct words are counted
and scored once a slice, each with the number of times it occurs.  Log probabilities and back-off weights are dealt by
hash into parts of about PART_ROWS rows.  Each part is broadcast for itself and looked up by itself, so neither the
driver nor a task holds more than one at a time, at any size.

Verdict: a word's probability is half that of its document's language and half the mean of the FOREIGN main languages'.
A document's log perplexity a letter is its whole negative log probability over its characters that are no symbols
(`#*$%&|<>`): symbols are paid for but don't count as content, for a model that has seen them foretells runs of them
well, and a mean over all characters would fall by them.  It is compared with its language's median; the document is
rejected beyond UPPER or LOWER times the median absolute deviation.  Languages with fewer than LEAST documents are held
against the band of all.

Nulls and empty texts: no words, so base_failed and not kept.  A null language is one of its own.  Repeated rows are
judged alike.  A very long text is a slice by itself and judged whole.  Empty table: no rows.  Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import mix, new_path, save, slices, small_batches, text_bytes, tidied, window_hashes, words

ORDER = 4
BITS = 15
#: Symbols: 0 before a word's first character, 1 after its last, and characters from 2 on; those beyond fold by a hash.
SYMBOLS = 1 << BITS
#: Rows (n-grams and contexts) of a part of the model.
PART_ROWS = 2_000_000
LOWER, UPPER, LEAST = 12.0, 12.0, 30
#: A word's probability is half that of its document's language and half the mean of this many languages' with most n-grams,
#: so that passages in another language don't count as poor.
FOREIGN = 16
#: Bytes of text that are counted or scored at once.
SLICE = 2 << 20
#: Log perplexities are put into bins of this width for the medians.
BIN = 0.001
U = np.uint64
_SYMBOL_BYTE = np.isin(np.arange(256), [ord(c) for c in "#*$%&|<>"])
_SPACE_BYTE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def _sum_rows(marks: np.ndarray, borders: np.ndarray) -> np.ndarray:
    upto = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
    return upto[borders[1:]] - upto[borders[:-1]]


def base_counts(text: pa.StringArray, row: np.ndarray, index: np.ndarray, distinct: int) -> dict[str, np.ndarray]:
    """The base counts of each text; row and index: of its words."""
    data, borders = text_bytes(text)
    n = len(text)
    space = _SPACE_BYTE[data]
    out = {"n_words": np.bincount(row, minlength=n), "word_chars": _sum_rows(((data & 0xC0) != 0x80) & ~space, borders), "n_symbols": _sum_rows(_SYMBOL_BYTE[data], borders)}
    lines = pc.split_pattern(text, "\n")
    flat = lines.flatten()
    line_row = np.repeat(np.arange(n), np.diff(lines.offsets.to_numpy()))
    inked = pc.greater(pc.binary_length(pc.ascii_trim_whitespace(flat)), 0)
    line_row, coded = line_row[inked.to_numpy(zero_copy_only=False)], flat.filter(inked).dictionary_encode()
    key = line_row.astype(np.int64) * max(1, len(coded.dictionary)) + coded.indices.to_numpy(zero_copy_only=False)
    first = np.unique(key, return_index=True)[1]
    again = np.ones(len(key), bool)
    again[first] = False
    out["n_dup_lines"] = np.bincount(line_row[again], minlength=n)
    # 5-word windows found twice or more in one text
    h, at = window_hashes(row, mix(np.arange(distinct, dtype=U) + U(1))[index] if distinct else np.zeros(0, U), 5)
    repeated = np.zeros(len(row) + 1, np.int64)
    if len(h):
        key = mix(h ^ mix(row[at].astype(U) + U(77)))
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice = at[order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]]
        np.add.at(repeated, twice, 1)
        np.add.at(repeated, twice + 5, -1)
    out["n_repeat_words"] = np.bincount(row[np.cumsum(repeated[:-1]) > 0], minlength=n)
    return out


def word_ngrams(distinct: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The packed n-grams of all words (one for each character and one for the end), and each one's word."""
    size = pc.utf8_length(distinct).to_numpy(zero_copy_only=False).astype(np.int64)
    points = np.frombuffer("".join(distinct.to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32).astype(U)
    wide = size + ORDER
    begin = np.cumsum(wide) - wide
    codes = np.zeros(int(wide.sum()), U)
    word = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(points)) - np.repeat(np.cumsum(size) - size, size)
    codes[begin[word] + ORDER - 1 + place] = np.where(points < SYMBOLS - 258, points + U(2), U(SYMBOLS - 256) + mix(points) % U(256))
    codes[begin + wide - 1] = 1
    packed = np.zeros(len(codes), U)
    for k in range(ORDER):
        packed[ORDER - 1 :] |= codes[ORDER - 1 - k : len(codes) - k] << U(BITS * k)
    keep = np.ones(len(codes), bool)
    for k in range(ORDER - 1):
        keep[begin + k] = False
    return packed[keep], np.repeat(np.arange(len(size)), size + 1)


def count_ngrams(docs: DataFrame) -> DataFrame:
    """lang, ngram, n over all documents; each task sums its own first."""

    def count(batches):
        total: dict = {}
        for batch, text in slices(batches, SLICE):
            row, index, distinct = words(text)
            if not len(row):
                continue
            ngrams, word = word_ngrams(distinct)
            coded = batch.column("lang").dictionary_encode(null_encoding="encode")
            lang = coded.indices.to_numpy(zero_copy_only=False)[row]
            for k, name in enumerate(coded.dictionary.to_pylist()):
                times = np.bincount(index[lang == k], minlength=len(distinct))[word]
                some = times > 0
                keys, back = np.unique(ngrams[some], return_inverse=True)
                total.setdefault(name, []).append((keys, np.bincount(back, weights=times[some]).astype(np.int64)))
                if len(total[name]) > 3:
                    total[name] = [_add_up(total[name])]
        for name, parts in total.items():
            keys, n = _add_up(parts)
            for k in range(0, len(keys), 100_000):
                here = keys[k : k + 100_000]
                yield pa.record_batch([pa.array([name] * len(here), pa.string()), pa.array(here.astype(np.int64)), pa.array(n[k : k + 100_000])], names=["lang", "ngram", "n"])

    return small_batches(docs).select("lang", "text").mapInArrow(tidied(count), "lang string, ngram long, n long").groupBy("lang", "ngram").agg(F.sum("n").alias("n"))


def _add_up(parts: list) -> tuple[np.ndarray, np.ndarray]:
    keys, back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(back, weights=np.concatenate([n for _, n in parts])).astype(np.int64)


def _discounts(n: np.ndarray) -> np.ndarray:
    """Of counts 0, 1, 2 and 3 or more (the modified Kneser-Ney estimate); plain values where counts of counts lack."""
    c = [int((n == k).sum()) for k in range(5)]
    if min(c[1:]) == 0:
        return np.array([0, 0.5, 1.0, 1.5])
    y = c[1] / (c[1] + 2 * c[2])
    return np.clip([0, 1 - 2 * y * c[2] / c[1], 2 - 3 * y * c[3] / c[2], 3 - 4 * y * c[4] / c[3]], [0, 0.05, 0.05, 0.05], [0, 1, 2, 3])


class Model:
    """One language's model in memory, to hold train() against.

    Sorted arrays of hashed n-grams: log probabilities of each order, and log back-off weights of contexts.
    """

    def __init__(self, ngrams: np.ndarray, counts: np.ndarray):
        """ngrams: distinct, sorted."""
        mask = lambda k: U((1 << (BITS * k)) - 1)
        levels = {ORDER: (ngrams, counts)}
        for k in range(ORDER - 1, 0, -1):
            levels[k] = np.unique(levels[k + 1][0] & mask(k), return_counts=True)
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.backs: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        lower_keys, lower = np.zeros(1, U), np.array([1 / SYMBOLS])
        for k in range(1, ORDER + 1):
            keys, n = levels[k]
            d = _discounts(n)
            cut = d[np.minimum(n, 3)]
            contexts, of = np.unique(keys >> U(BITS), return_inverse=True)
            total, free = np.bincount(of, weights=n), np.bincount(of, weights=cut)
            back = free / total
            below = lower[np.searchsorted(lower_keys, keys & mask(k - 1))] if k > 1 else np.full(len(keys), lower[0])
            p = (n - cut) / total[of] + back[of] * below
            lower_keys, lower = keys, p
            self.tables[k] = self._sorted(keys, np.log(p))
            self.backs[k] = self._sorted(contexts, np.log(np.maximum(back, 1e-9)))

    @staticmethod
    def _sorted(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = mix(keys + U(1))
        order = np.argsort(h)
        return h[order], values[order]

    @staticmethod
    def _look(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = mix(keys + U(1))
        if not len(table[0]):
            return np.zeros(len(keys), bool), np.zeros(len(keys))
        at = np.minimum(np.searchsorted(table[0], h), len(table[0]) - 1)
        return table[0][at] == h, table[1][at]

    def log_p(self, ngrams: np.ndarray) -> np.ndarray:
        out, todo, keys = np.zeros(len(ngrams)), np.arange(len(ngrams)), ngrams
        for k in range(ORDER, 0, -1):
            found, value = self._look(self.tables[k], keys)
            out[todo[found]] += value[found]
            todo, keys = todo[~found], keys[~found]
            if not len(todo):
                return out
            seen, back = self._look(self.backs[k], keys >> U(BITS))
            out[todo[seen]] += back[seen]
            keys = keys & U((1 << (BITS * (k - 1))) - 1)
        out[todo] += np.log(1 / SYMBOLS)
        return out


def _mask(k: int) -> int:
    return (1 << (BITS * k)) - 1


def _level_discounts(level: DataFrame) -> DataFrame:
    """d1, d2 and d3 of each language, as _discounts gives them."""
    c = level.groupBy("lang").agg(*(F.sum((F.col("n") == k).cast("double")).alias(f"c{k}") for k in range(1, 5)))
    y = F.col("c1") / (F.col("c1") + 2 * F.col("c2"))

    def d(k: int):
        value = k - (k + 1) * y * F.col(f"c{k + 1}") / F.col(f"c{k}")
        return F.when(F.least("c1", "c2", "c3", "c4") == 0, F.lit(k / 2)).otherwise(F.least(F.lit(float(k)), F.greatest(F.lit(0.05), value)))

    return c.select(F.col("lang").alias("__lang"), *(d(k).alias(f"d{k}") for k in (1, 2, 3)))


def train(counts: DataFrame, rows: int = PART_ROWS) -> list:
    """Broadcast parts of all languages' models, from saved counts of all n-grams.

    A part: {(lang, k): (sorted keys, values)}; values are the log probabilities of n-grams of order k, and for -k the log
    back-off weights of their contexts.
    """
    levels = {ORDER: counts.select("lang", F.col("ngram").alias("key"), "n")}
    for k in range(ORDER - 1, 0, -1):
        levels[k] = save(levels[k + 1].groupBy("lang", F.col("key").bitwiseAND(F.lit(_mask(k))).alias("key")).agg(F.count("*").alias("n")), "level")
    tables, total, lower = [], 0, None
    for k in range(1, ORDER + 1):
        d = save(_level_discounts(levels[k]), "discounts")
        level = levels[k].join(d, levels[k]["lang"].eqNullSafe(d["__lang"]))
        level = level.withColumns({"cut": F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3")), "context": F.shiftright("key", BITS)})
        by = Window.partitionBy("lang", "context")
        level = level.select("lang", "key", "context", "n", "cut", F.sum("n").over(by).alias("total"), (F.sum("cut").over(by) / F.sum("n").over(by)).alias("back"))
        if lower is None:
            level = level.withColumn("below", F.lit(1 / SYMBOLS))
        else:
            below = lower.select(F.col("lang").alias("__lang"), F.col("key").alias("__key"), F.col("p").alias("below"))
            level = level.join(below, level["lang"].eqNullSafe(below["__lang"]) & (level["key"].bitwiseAND(F.lit(_mask(k - 1))) == below["__key"]))
        lower = save(level.select("lang", "key", "context", "back", ((F.col("n") - F.col("cut")) / F.col("total") + F.col("back") * F.col("below")).alias("p")), "level")
        total += lower.count()
        tables.append(lower.select("lang", F.lit(k).alias("k"), "key", F.log("p").alias("value")))
        tables.append(lower.groupBy("lang", F.lit(-k).alias("k"), F.col("context").alias("key")).agg(F.log(F.greatest(F.max("back"), F.lit(1e-9))).alias("value")))
    every = tables[0]
    for table in tables[1:]:
        every = every.unionByName(table)
    parts = max(1, -(-2 * total // rows))  # at most as many contexts as n-grams
    path = new_path(counts.sparkSession, "model")
    every.withColumn("part", F.pmod(F.xxhash64("key", "k"), F.lit(parts)).cast("int")).write.partitionBy("part").parquet(path)
    model = counts.sparkSession.read.schema(f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in every.schema)}, part int").parquet(path)
    return [counts.sparkSession.sparkContext.broadcast(_part(model.where(F.col("part") == i).drop("part").toArrow())) for i in range(parts)]


def _part(table: pa.Table) -> dict:
    names = table.column("lang").combine_chunks().dictionary_encode(null_encoding="encode")
    lang, k = names.indices.to_numpy(zero_copy_only=False).astype(np.int64), table.column("k").to_numpy().astype(np.int64)
    key, value = table.column("key").to_numpy().astype(U), table.column("value").to_numpy()
    group = lang * (2 * ORDER + 1) + k + ORDER
    order = np.lexsort((key, group))
    group, key, value = group[order], key[order], value[order]
    at = np.nonzero(np.diff(group, prepend=-1))[0].tolist() + [len(group)]
    names = names.dictionary.to_pylist()
    return {(names[group[a] // (2 * ORDER + 1)], int(group[a] % (2 * ORDER + 1)) - ORDER): (key[a:b], value[a:b]) for a, b in zip(at, at[1:])}  # noqa: B905


def _opened(parts: list):
    """Each part's dict in turn; only a single one stays in memory."""
    for part in parts:
        yield part.value if len(parts) == 1 or part._path is None else part.load_from_path(part._path)


def _find(parts: list, wanted: list[tuple]) -> list[np.ndarray]:
    """wanted: (lang, k, keys); their values, NaN where the model has none."""
    out = [np.full(len(keys), np.nan) for _, _, keys in wanted]
    for part in _opened(parts):
        for (name, k, keys), values in zip(wanted, out, strict=True):
            known, value = part.get((name, k), (keys[:0], None))
            if len(known):
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                hit = known[at] == keys
                values[hit] = value[at[hit]]
    return out


def log_p(parts: list, ngrams: dict) -> dict:
    """The log probability of each n-gram; ngrams: arrays by language."""
    out = dict(zip(ngrams, _find(parts, [(name, ORDER, keys) for name, keys in ngrams.items()]), strict=True))
    unseen = {name: np.nonzero(np.isnan(p))[0] for name, p in out.items() if np.isnan(p).any()}
    if not unseen:
        return out
    kinds = [-ORDER, *(x for k in range(ORDER - 1, 0, -1) for x in (k, -k))]
    wanted = []
    for name, at in unseen.items():
        keys = ngrams[name][at]
        wanted += [(name, k, keys & U(_mask(k)) if k > 0 else (keys & U(_mask(-k))) >> U(BITS)) for k in kinds]
    found = iter(_find(parts, wanted))
    for name, at in unseen.items():
        value, done = np.zeros(len(at)), np.zeros(len(at), bool)
        for k, here in zip(kinds, found):  # noqa: B905 (found goes on with the next language)
            some = ~done & ~np.isnan(here)
            value[some] += here[some]
            if k > 0:
                done |= some
        out[name][at] = np.where(done, value, value + np.log(1 / SYMBOLS))
    return out


SCORES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, log_perplexity double"


def main_languages(counts: DataFrame, most: int = FOREIGN) -> list:
    """The languages with most n-grams."""
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    return [r["lang"] for r in totals.orderBy(F.desc("n"), "lang").limit(most).collect()]


def _costs(models: list, foreign: list | tuple, distinct: pa.StringArray, index: np.ndarray, lang: np.ndarray, names: list) -> np.ndarray:
    """The negative log probability of each word; index: its place in distinct, lang: its language's in names."""
    cost = np.zeros(len(index))
    if not len(index):
        return cost
    ngrams, word = word_ngrams(distinct)
    keys, back = np.unique(ngrams, return_inverse=True)
    found = log_p(models, dict.fromkeys([*names, *foreign], keys))
    of_word = {name: np.bincount(word, weights=p[back], minlength=len(distinct)) for name, p in found.items()}
    every = np.logaddexp.reduce([of_word[name] for name in foreign], axis=0) - np.log(len(foreign)) if foreign else None
    for k, name in enumerate(names):
        p = of_word[name] if every is None else np.logaddexp(of_word[name], every) - np.log(2)
        mine = lang == k
        cost[mine] = -p[index[mine]]
    return cost


def score(docs: DataFrame, models: list, key: str = "doc_id", foreign: list | tuple = ()) -> DataFrame:
    """The base counts and the negative log probability a letter (null: no words) of each document; foreign: see FOREIGN."""

    def run(batches):
        for batch, text in slices(batches, SLICE):
            row, index, distinct = words(text)
            base = base_counts(text, row, index, len(distinct))
            coded = batch.column("lang").dictionary_encode(null_encoding="encode")
            lang, names = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()
            total = np.bincount(row, weights=_costs(models, foreign, distinct, index, lang[row], names), minlength=len(text))
            letters = np.maximum(1, base["word_chars"] - base["n_symbols"])
            yield pa.record_batch([batch.column(key), batch.column("lang"), *(pa.array(base[c].astype(np.int64)) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), pa.array(total / letters, mask=base["n_words"] == 0)], names=[key, "lang", *(x.split()[0] for x in SCORES.split(", "))])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, "lang", "text").mapInArrow(tidied(run), f"{key} {kind}, lang string, {SCORES}")


def bands(scores: DataFrame, least: int = LEAST, lower: float = LOWER, upper: float = UPPER) -> DataFrame:
    """lang, low, high: from exact medians over bins of log perplexity.  A row with lang '*' (all) covers small languages."""
    binned = scores.where("log_perplexity is not null").select("lang", F.floor(F.col("log_perplexity") / BIN).alias("bin"))
    counted = binned.groupBy("lang", "bin").agg(F.count("*").alias("n"))
    counted = save(counted.select(F.lit(False).alias("all"), "lang", "bin", "n").unionByName(counted.groupBy("bin").agg(F.sum("n").alias("n")).select(F.lit(True).alias("all"), F.lit(None).cast("string").alias("lang"), "bin", "n")), "bins")

    def median(rows: DataFrame, value: str) -> DataFrame:
        by = Window.partitionBy("all", "lang")
        upto = F.sum("n").over(by.orderBy(value))
        ranked = rows.withColumn("upto", upto).withColumn("total", F.sum("n").over(by))
        return ranked.where("upto * 2 >= total").groupBy("all", "lang").agg(F.min(value).alias("mid"), F.max("total").alias("total"))

    mid = median(counted, "bin")
    apart = counted.alias("c").join(mid.alias("m"), F.expr("c.all = m.all and c.lang <=> m.lang")).select("c.all", "c.lang", F.abs(F.col("bin") - F.col("mid")).alias("away"), "n", F.col("mid").alias("center"))
    apart = apart.groupBy("all", "lang", "away", "center").agg(F.sum("n").alias("n"))
    spread = median(apart, "away").withColumnRenamed("mid", "mad").drop("total")
    mad = F.greatest(F.col("mad"), F.lit(10)) * BIN
    center = F.col("mid") * BIN
    both = mid.alias("m").join(spread.alias("s"), F.expr("m.all = s.all and m.lang <=> s.lang")).select("m.all", "m.lang", "total", (center - lower * mad).alias("low"), (center + upper * mad).alias("high"))
    return save(both.where(F.col("all") | (F.col("total") >= least)), "bands")


def judge(scores: DataFrame, limits: DataFrame) -> DataFrame:
    """Adds base_failed, low, high and kept."""
    own = limits.where(~F.col("all")).select(F.col("lang").alias("__lang"), F.col("low").alias("__low"), F.col("high").alias("__high"))
    every = limits.where("all").select(F.col("low").alias("__all_low"), F.col("high").alias("__all_high"))
    judged = scores.join(own, scores["lang"].eqNullSafe(own["__lang"]), "left").join(F.broadcast(every), F.lit(True), "left")  # every: one row
    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    within = F.col("log_perplexity").between(F.coalesce("__low", "__all_low"), F.coalesce("__high", "__all_high"))
    return judged.withColumns({"base_failed": base_failed, "perplexity": F.exp("log_perplexity"), "kept": ~base_failed & F.coalesce(within, F.lit(False))}).drop("__lang", "__low", "__high", "__all_low", "__all_high")


def quality(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts, trains, scores and judges all rows of docs (key, lang, text)."""
    docs = docs.select(key, F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counts = save(count_ngrams(docs), "ngrams")
    models = train(counts)
    scores = save(score(docs, models, key, main_languages(counts)), "scores")
    return judge(scores, bands(scores))


def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lang", "perplexity")
