"""Spelling variants: words that differ by one inserted, deleted or replaced character, found by bidirectional FM-index search schemes.

The vocabulary (words with their counts over all documents) is joined by newlines into one text, of which two FM-indexes are kept: of
the text and of its reverse.  A search holds the rank interval of its pattern in both, so a pattern grows by a character on either
side.  One error leaves one half of a word as it is, so there are two schemes:

* the first half exactly, from its middle leftwards up to the newline before it, then rightwards over the second half with one
  error, and the newline behind it;
* the second half exactly, rightwards up to the newline, then leftwards over the first half with one error.

The second scheme leaves out what the first finds.  All searches of a task go side by side, a character a step, on arrays.

Near words share a half, so a word is put into the indexes of the buckets of its possible halves (four), and is looked up in two.
A bucket with more words than BLOCK is dealt to several indexes, and one with more look-ups to several tasks of each, so that no task gets over
about BLOCK words and 2 * BLOCK look-ups, whatever the number of words with one half.

Nulls and empty texts: a null or empty text has no words; a null doc_id counts as an empty one.  A very long text's runs
are a list in one row before they become rows (about 60 bytes a run).  Repeated rows count each time.  Words that are near each other in two ways are one pair.  Empty table: no rows.
Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import save
from .sharding import CRC_SQL, crc_sql

#: Words of one index, and searches that go side by side.
BLOCK = 20_000
SIDE = 2_000
LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
_RUN = "[A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def noised_words(docs: DataFrame, every: int = 199) -> DataFrame:
    """A row (word) for each run of letters: lower-cased in A-Z, and without a character where the checksum of document and run says so."""
    found = F.explode(F.regexp_extract_all("text", F.lit(_RUN), F.lit(0))).alias("run")
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), found).withColumn("run", F.translate("run", _UPPER, _LOWER))
    h = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
    return runs.withColumn("h", h).select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word and n, its occurrences, of long and frequent enough words."""
    long = words.where(F.char_length("word") >= least_length)
    return long.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


class Rows:
    """A wavelet matrix of a sequence of small numbers: for an interval of it, how often a number occurs before either end and how many
    numbers in it are less, by one step a bit."""

    def __init__(self, values: np.ndarray, size: int):
        self.bits = max(1, int(size - 1).bit_length())
        self.ones, self.zeros = [], []
        self.first = np.concatenate([[0], np.cumsum(np.bincount(values, minlength=size))]).astype(np.int64)
        now = values
        for k in reversed(range(self.bits)):
            bit = (now >> k) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(int(len(bit) - bit.sum()))
            now = np.concatenate([now[bit == 0], now[bit == 1]])
        self.base = self._descend(np.zeros(size, np.int64), np.zeros(size, np.int64), np.arange(size))[0]

    def _descend(self, a: np.ndarray, b: np.ndarray, c: np.ndarray):
        a, b, less = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        for k, ones, zeros in zip(reversed(range(self.bits)), self.ones, self.zeros, strict=True):
            x, y, one = ones[a], ones[b], ((c >> k) & 1).astype(bool)
            less += np.where(one, (b - y) - (a - x), 0)
            a, b = np.where(one, zeros + x, a - x), np.where(one, zeros + y, b - y)
        return a, b, less

    def step(self, a: np.ndarray, b: np.ndarray, c: np.ndarray):
        """start and size of the interval of c before the interval's pattern, and how many of the interval's numbers are less than c."""
        x, y, less = self._descend(a, b, c)
        return self.first[c] + x - self.base[c], y - x, less

    def each(self, a: np.ndarray, b: np.ndarray):
        """row, number, start, size and less (as step() gives them) of all numbers that occur in each interval."""
        row, c, less = np.arange(len(a)), np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        for ones, zeros in zip(self.ones, self.zeros, strict=True):
            x, y = ones[a].astype(np.int64), ones[b].astype(np.int64)
            nothing = (b - y) - (a - x)
            some, one = np.nonzero(nothing)[0], np.nonzero(y - x)[0]
            row, c, less = np.concatenate([row[some], row[one]]), np.concatenate([c[some] * 2, c[one] * 2 + 1]), np.concatenate([less[some], (less + nothing)[one]])
            a, b = np.concatenate([(a - x)[some], zeros + x[one]]), np.concatenate([(b - y)[some], zeros + y[one]])
        return row, c, self.first[c] + a - self.base[c], b - a, less


def suffix_order(values: np.ndarray, size: int, depth: int) -> np.ndarray:
    """Starts of suffixes in the order of their first `depth` values at least, by doubling; values: 0 to size - 1."""
    bits, n = max(1, int(size).bit_length()), len(values)
    known = min(max(1, 62 // bits), depth)
    rank = np.zeros(n, np.int64)
    for k in range(min(known, n)):
        rank[: n - k] |= (values[k:].astype(np.int64) + 1) << (bits * (known - 1 - k))
    rank = np.unique(rank, return_inverse=True)[1]
    while known < min(depth, n):
        after = np.zeros(n, np.int64)
        after[: n - known] = rank[known:] + 1
        rank, known = np.unique(rank * (n + 1) + after, return_inverse=True)[1], known * 2
    return np.argsort(rank, kind="stable")


class BothWays:
    """FM-indexes of a text and of its reverse.  A state is (start here, start in the reverse, size)."""

    def __init__(self, text: np.ndarray, size: int, depth: int):
        # 0 ends either text and sorts before all; depth: the longest pattern.
        self.n = len(text) + 1
        self.order, self.sides = None, []
        for t in (text, text[::-1]):
            t = np.append(t, 0)
            order = suffix_order(t, size, depth + 1)
            self.sides.append(Rows(t[order - 1], size))
            self.order = order if self.order is None else self.order

    def grow(self, state, c: np.ndarray, rightwards: bool):
        """The states with a character more on one side; those that occur nowhere have no size."""
        a, b = (state[1], state[0]) if rightwards else (state[0], state[1])
        start, size, less = self.sides[rightwards].step(a, a + state[2], c)
        return (b + less, start, size) if rightwards else (start, b + less, size)

    def all(self, state, rightwards: bool):
        """row, character and state of every way to go on."""
        a, b = (state[1], state[0]) if rightwards else (state[0], state[1])
        row, c, start, size, less = self.sides[rightwards].each(a, a + state[2])
        other = b[row] + less
        return row, c, ((other, start, size) if rightwards else (start, other, size))


def _take(state, at):
    return tuple(x[at] for x in state)


def _join(states):
    return tuple(np.concatenate(x) for x in zip(*states, strict=True))


def search(index: BothWays, words: np.ndarray, lengths: np.ndarray, cut: np.ndarray, rightwards: bool) -> tuple[np.ndarray, np.ndarray]:
    """(query, place in the text of the newline before the match) of all words with one error on one side of the cut and none on the other.

    words: a row of character numbers for each query; rightwards: the part before the cut is exact and the errors lie behind it.
    """
    line, n = 1, len(lengths)
    whole = (np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, index.n, np.int64))
    # The exact half, from the cut outwards, and the newline at its end.
    query, state = np.arange(n), whole
    done_q, done_s = [], []
    exact = cut if rightwards else lengths - cut
    for k in range(int(exact.max(initial=0)) + 1):
        ended = exact[query] == k
        c = np.full(len(query), line)
        at = cut[query] - 1 - k if rightwards else cut[query] + k
        c[~ended] = words[query[~ended], at[~ended]]
        state = index.grow(state, c, not rightwards)
        alive = state[2] > 0
        done_q.append(query[ended & alive])
        done_s.append(_take(state, ended & alive))
        query, state = query[~ended & alive], _take(state, ~ended & alive)
        if not len(query):
            break
    query, state = np.concatenate(done_q), _join(done_s)

    # The other half: place counts the characters that are dealt with, from the cut outwards.
    rest = (lengths - cut if rightwards else cut)
    char = lambda q, k: words[q, cut[q] + k if rightwards else cut[q] - 1 - k]
    place, err = np.zeros(len(query), np.int64), np.zeros(len(query), bool)
    hits_q, hits_s = [], []
    while len(query):
        fresh = np.nonzero(~err)[0]
        over = fresh[place[fresh] < rest[query[fresh]]]  # a character is left out
        row, c, ways = index.all(_take(state, fresh), rightwards)
        row = fresh[row]
        letter = c > line
        inserted = letter
        same = place[row] < rest[query[row]]
        asked = np.zeros(len(row), np.int64)
        asked[same] = char(query[row[same]], place[row[same]])
        replaced = letter & same & (c != asked)
        right = letter & same & (c == asked)
        late = np.nonzero(err)[0]
        ended = place[late] == rest[query[late]]
        c_late = np.full(len(late), line)
        c_late[~ended] = char(query[late[~ended]], place[late[~ended]])
        moved = index.grow(_take(state, late), c_late, rightwards)
        alive = moved[2] > 0
        hits_q.append(query[late[ended & alive]])
        hits_s.append(_take(moved, ended & alive))
        on = ~ended & alive
        query, place, err, state = (
            np.concatenate([query[row[right]], query[row[replaced]], query[row[inserted]], query[over], query[late[on]]]),
            np.concatenate([place[row[right]] + 1, place[row[replaced]] + 1, place[row[inserted]], place[over] + 1, place[late[on]] + 1]),
            np.concatenate([np.zeros(right.sum(), bool), np.ones(replaced.sum() + inserted.sum() + len(over) + on.sum(), bool)]),
            _join([_take(ways, right), _take(ways, replaced), _take(ways, inserted), _take(state, over), _take(moved, on)]),
        )
    query, state = np.concatenate(hits_q) if hits_q else np.zeros(0, np.int64), _join(hits_s) if hits_s else whole
    if not len(query):
        return query, query
    # A whole delimited word: one place.  Several ways to the same word are one hit.
    found = np.unique(query * index.n + index.order[state[0]])
    return found // index.n, found % index.n


def near_in_block(words: list[str], queries: list[str], kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, word) numbers of pairs that differ by one error outside the half that the query's kind keeps (0: first half, 1: second)."""
    none = np.zeros(0, np.int64)
    if not words or not queries:
        return none, none
    text = "\n" + "\n".join(words) + "\n"
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    asked = [np.frombuffer(q.encode("utf-32-le"), np.uint32) for q in queries]
    letters = np.unique(codes[codes != 10])
    number = lambda x: np.where((at := np.searchsorted(letters, x)) < len(letters), np.where(letters[np.minimum(at, len(letters) - 1)] == x, at + 2, len(letters) + 2), len(letters) + 2)
    lengths = np.fromiter(map(len, asked), np.int64, len(asked))
    size = len(letters) + 3  # 0 ends the text, 1 is the newline, the last one stands for characters that no word has
    index = BothWays(np.where(codes == 10, 1, number(codes)), size, int(lengths.max()) + 3)
    table = np.full((len(asked), int(lengths.max())), size - 1, np.int64)
    table[np.arange(table.shape[1]) < lengths[:, None]] = number(np.concatenate(asked))
    starts = np.concatenate([[0], np.cumsum([len(w) + 1 for w in words])])
    heads, out = [q[: len(q) // 2] for q in queries], []
    for kind in (0, 1):
        here = np.nonzero(kinds == kind)[0]
        for k in range(0, len(here), SIDE):
            some = here[k : k + SIDE]
            q, place = search(index, table[some], lengths[some], lengths[some] // 2, kind == 0)
            q, w = some[q], np.searchsorted(starts, place)
            if kind:
                new = np.fromiter((not words[b].startswith(heads[a]) for a, b in zip(q.tolist(), w.tolist(), strict=True)), bool, len(q))
                q, w = q[new], w[new]
            out.append((q, w))
    return np.concatenate([q for q, _ in out]), np.concatenate([w for _, w in out])


PAIRS = "word string, n long, other string, other_n long"


def near_pairs(vocab: DataFrame, block: int = BLOCK) -> DataFrame:
    """word, n, other and other_n for each ordered pair of near words of a vocabulary (word, n; words are distinct)."""
    vocab = save(vocab.select("word", "n"), "vocabulary")
    total = vocab.count()
    buckets = max(1, -(-4 * total // block))
    size = F.char_length("word")
    bucket = lambda kind, half: F.pmod(F.xxhash64(F.lit(kind), half), F.lit(buckets)).cast("long")

    def keys(kind: int, lengths: list) -> list:
        half = (lambda k: F.substring(F.col("word"), F.lit(1), k)) if kind == 0 else (lambda k: F.substring(F.col("word"), size - k + 1, k))
        return [F.struct(F.lit(kind).alias("kind"), bucket(kind, half(k)).alias("bucket")) for k in lengths]

    half = lambda n: F.floor(n / 2).cast("int")
    # A query of length L keeps its first L // 2 or its last L - L // 2 characters; L is a word's length or one off.
    kept = F.array(*keys(0, [half(size - 1), half(size + 1)]), *keys(1, [half(size), half(size + 2)]))
    held = vocab.select("word", "n", F.explode(F.array_distinct(kept)).alias("k")).select("word", "n", "k.*")
    asked = vocab.select("word", "n", F.explode(F.array(*keys(0, [half(size)]), *keys(1, [half(size + 1)]))).alias("k")).select("word", "n", "k.*")
    both = save(held.withColumn("ask", F.lit(False)).unionByName(asked.withColumn("ask", F.lit(True))), "halves")
    sizes = both.groupBy("kind", "bucket").agg(F.greatest(F.lit(1), F.ceil(F.count_if(~F.col("ask")) / block)).cast("int").alias("blocks"), F.greatest(F.lit(1), F.ceil(F.count_if("ask") / (2 * block))).cast("int").alias("tasks"))
    dealt = both.join(sizes, ["kind", "bucket"])  # two numbers a bucket, and 4 / block buckets a word
    mine = lambda n: F.pmod(F.xxhash64("word"), n).cast("int")
    every = lambda n: F.sequence(F.lit(0), n - 1)
    # A word is in one block and all its tasks, a query in one task and all blocks.
    grid = dealt.withColumns({"blocks": F.when(F.col("ask"), every(F.col("blocks"))).otherwise(F.array(mine(F.col("blocks")))), "tasks": F.when(F.col("ask"), F.array(mine(F.col("tasks")))).otherwise(every(F.col("tasks")))})
    grid = grid.withColumn("block", F.explode("blocks")).withColumn("task", F.explode("tasks")).select("kind", "bucket", "block", "task", "word", "n", "ask")

    def one(rows):
        ask, word, n = rows["ask"].to_numpy().astype(bool), np.array(rows["word"].to_pylist(), object), rows["n"].to_numpy()
        words, queries = word[~ask], word[ask]
        q, w = near_in_block(words.tolist(), queries.tolist(), rows["kind"].to_numpy()[ask])
        return pa.table({"word": pa.array(queries[q], pa.string()), "n": pa.array(n[ask][q], pa.int64()), "other": pa.array(words[w], pa.string()), "other_n": pa.array(n[~ask][w], pa.int64())})

    return grid.groupBy("kind", "bucket", "block", "task").applyInArrow(one, PAIRS)


def roots(forms: DataFrame) -> DataFrame:
    """word and root: forms (word, form) followed to the last.  Each round doubles the way, so chains of n take log n rounds."""
    now = save(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        nxt = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        new = save(now.join(nxt, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        now = new.select("word", "root")
        if new.where("moved").isEmpty():
            return now


def spelling_forms(vocab: DataFrame, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """word, form, root, n, n_near and form_n of each word of a vocabulary (word, n).  A word's form is its most frequent near word (ties: the
    least in code-point order) if that is `ratio` times as frequent; root is where forms lead."""
    vocab = save(vocab.select("word", "n"), "vocabulary")
    pairs = near_pairs(vocab, block)
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("m"), F.col("other").alias("form"))).alias("b"))
    # Most words have no near word, so what they get is joined to the whole vocabulary.
    found = vocab.join(best, "word", "left").withColumn("form", F.when(-F.col("b.m") >= ratio * F.col("n"), F.col("b.form")))
    found = save(found.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form", F.when(F.col("form").isNotNull(), -F.col("b.m")).alias("form_n")), "forms")
    ends = roots(found.where("form is not null"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_forms(vocabulary(noised_words(spark.read.parquet(f"{sf_dir}/documents.parquet"))))


#: Near words share what is left when each loses the replaced character, or one of them the inserted one.
SPELLING_SQL = f"""WITH RECURSIVE {CRC_SQL},
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '{_RUN}')), '{_UPPER}', '{_LOWER}') AS run FROM documents),
told AS (SELECT run, coalesce(doc_id::VARCHAR, '') || ':' || run AS told, count(*) AS n FROM runs GROUP BY ALL),
summed AS (SELECT run, n, hex(encode(told)) AS digits FROM told),
hashed AS (SELECT run, n, {crc_sql("digits")} AS h FROM summed, crc),
noised AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, (h % length(run) + 2)::BIGINT) ELSE run END AS word, n FROM hashed),
vocab AS (SELECT word, sum(n)::BIGINT AS n FROM noised WHERE length(word) >= {LEAST_LENGTH} GROUP BY 1 HAVING sum(n) >= {LEAST_COUNT}),
holes AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM vocab)),
pairs AS (SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM holes a JOIN vocab b ON a.rest = b.word UNION SELECT b.word, b.n, a.word, a.n FROM holes a JOIN vocab b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, min((-other_n, other)) AS b FROM pairs GROUP BY 1),
forms AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b[1] >= {RATIO} * v.n THEN b[2] END AS form, CASE WHEN -b[1] >= {RATIO} * v.n THEN -b[1] END AS form_n FROM vocab v LEFT JOIN best USING (word)),
ways AS (SELECT word, form AS root, 1 AS k FROM forms WHERE form IS NOT NULL UNION ALL SELECT w.word, f.form, k + 1 FROM ways w JOIN forms f ON w.root = f.word WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(root, k) AS root FROM ways GROUP BY 1)
SELECT f.word, f.form, coalesce(e.root, f.word) AS root, f.n, f.n_near, f.form_n FROM forms f LEFT JOIN ends e USING (word)"""
