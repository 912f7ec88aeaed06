"""Importance resampling: hashed n-gram models of target and raw text, and Gumbel top-k.

A text is a bag of words and word pairs (runs of ASCII punctuation are words), hashed into BUCKETS.  Raw: all documents.
Target: labelled documents of good quality that aren't toxic; labels come from at most SAMPLE labelled rows, those with
the least hash of their doc_id.  A bucket's log weight is log((t + A) / (T * r / R + A)): what the target has of it
against what it would have if it were raw text, less the mean of that over the target, so that length alone neither
helps nor hurts.  A document's log importance is the sum over its n-grams over the root of their number (a sum of
independent terms spreads by that root) and a temperature; with a Gumbel variate from its doc_id added, the top k are a
sample without replacement by importance.  plain=True takes the sum as it is, the likelihood ratio of the two models, and
temperature 1 samples by it.  The query uses TEMPERATURE: figures for both are in the README.

k is a given share of all documents.  Where none is given, the sampled labels set a border of log importance with the
fewest errors, and k is the number of all documents from there on.  Rows that tie with the k-th stay.

Nulls and empty texts: a text without words has no importance and isn't kept.  A null doc_id gets the variate of id 0.
Repeated rows get the same value and stay or go together.  A very long text is one row of a task (about 40 times its bytes).  Without any target row nothing tells texts apart: weights
are 0.  Empty table: no rows.  Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import hashes, mix, save, slices, word_runs

BUCKETS = 1 << 16
SAMPLE = 20_000
A = 1.0
TEMPERATURE = 0.1
SEED = 10
#: Rows among which the k-th value is found by sorting; more are narrowed down by histograms.
SORTED_ROWS = 50_000
U = np.uint64


def ngram_buckets(text: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """row and bucket of each word and each pair of neighbouring words in one text."""
    row, index, distinct = word_runs(text)
    word = hashes(distinct)[index] if len(distinct) else np.zeros(0, U)
    with np.errstate(over="ignore"):
        pair = mix(word[:-1] * U(0x9E3779B97F4A7C15) + word[1:])
    same = row[1:] == row[:-1]
    return np.concatenate([row, row[1:][same]]), (np.concatenate([mix(word), pair[same]]) % U(BUCKETS)).astype(np.int64)


def labelled_sample(labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted doc_ids of the sampled labels, and whether each is of the target."""
    rows = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(F.when((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), 1).otherwise(0)).alias("good"))
    rows = rows.orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(sample).orderBy("doc_id").collect()
    return np.array([r["doc_id"] for r in rows], np.int64), np.array([r["good"] for r in rows], bool)


def border(values: np.ndarray, good: np.ndarray) -> float:
    """The value from which on rows count as good with the fewest errors (the least such value; no rows: any value does)."""
    if not len(values):
        return -np.inf
    order = np.argsort(values, kind="stable")
    v, g = values[order], good[order]
    errors = np.concatenate([[0], np.cumsum(g)]) + np.concatenate([np.cumsum(~g[::-1])[::-1], [0]])
    at = np.concatenate([[True], v[1:] != v[:-1], [True]])  # rows of equal value stay together
    best = int(np.argmin(np.where(at, errors, len(v) + 1)))
    return float(v[best]) if best < len(v) else np.inf


def fit(docs: DataFrame, target_ids: np.ndarray) -> np.ndarray:
    """The log weight of each bucket."""
    shared = docs.sparkSession.sparkContext.broadcast(target_ids)

    def count(batches):
        raw, target, ids = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64), shared.value
        for batch, text in slices(batches):
            row, bucket = ngram_buckets(text)
            raw += np.bincount(bucket, minlength=BUCKETS)
            mine = np.isin(batch.column("doc_id").fill_null(-(1 << 63)).to_numpy(), ids)
            target += np.bincount(bucket[mine[row]], minlength=BUCKETS)
        at = np.nonzero(raw)[0]
        yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(raw[at]), pa.array(target[at])], names=["bucket", "raw", "target"])

    rows = docs.mapInArrow(count, "bucket int, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    at = rows.column("bucket").to_numpy()
    raw[at], target[at] = rows.column("raw").to_numpy(), rows.column("target").to_numpy()
    weights = np.log((target + A) / (raw * (target.sum() / max(1.0, raw.sum())) + A))
    return weights - (weights * target).sum() / max(1.0, target.sum())


def gumbel(ids: np.ndarray, seed: int = SEED) -> np.ndarray:
    u = ((mix(mix(ids.view(U)) + U(seed)) >> U(11)).astype(np.float64) + 0.5) / (1 << 53)
    return -np.log(-np.log(u))


def weigh(docs: DataFrame, weights: np.ndarray, temperature: float = TEMPERATURE, plain: bool = False, seed: int = SEED) -> DataFrame:
    """doc_id, n_grams, log_importance and value (with the Gumbel variate; null without words)."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        for batch, text in slices(batches):
            row, bucket = ngram_buckets(text)
            n = np.bincount(row, minlength=len(text))
            total = np.bincount(row, weights=shared.value[bucket], minlength=len(text))
            total /= temperature if plain else np.sqrt(np.maximum(n, 1)) * temperature
            value = total + gumbel(batch.column("doc_id").fill_null(0).to_numpy(), seed)
            yield pa.record_batch([batch.column("doc_id"), pa.array(n), pa.array(total), pa.array(value, mask=n == 0)], names=["doc_id", "n_grams", "log_importance", "value"])

    return docs.mapInArrow(run, "doc_id long, n_grams long, log_importance double, value double")


def kth_largest(values: DataFrame, k: int) -> float | None:
    """The k-th largest of the column `value`; histograms narrow the range until few rows are left in it."""
    values = values.where("value is not null").select("value")
    n, low, high = values.agg(F.count("*"), F.min("value"), F.max("value")).first()
    if k <= 0 or n == 0:
        return None
    if k >= n:
        return low
    while n > SORTED_ROWS and low < high:
        width = (high - low) / 1024
        if low + width == low:
            break
        bins = dict(values.where(F.col("value").between(low, high)).groupBy(F.least(F.floor((F.col("value") - low) / width), F.lit(1023)).alias("bin")).agg(F.struct(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")).alias("x")).collect())
        for b in sorted(bins, reverse=True):
            if bins[b]["n"] >= k:
                n, low, high = bins[b]
                break
            k -= bins[b]["n"]
    if low == high:
        return low
    return values.where(F.col("value").between(low, high)).orderBy(F.desc("value")).limit(k).agg(F.min("value")).first()[0]


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None, key: str = "doc_id", text: str = "text", temperature: float = TEMPERATURE, plain: bool = False, seed: int = SEED) -> DataFrame:
    """doc_id, n_grams, log_importance, value and kept for each row."""
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    ids, good = labelled_sample(labels)
    scored = save(weigh(docs, fit(docs, ids[good]), temperature, plain, seed), "importance")
    if share is None:
        sample = docs.sparkSession.createDataFrame([(int(i), bool(g)) for i, g in zip(ids, good, strict=True)], "id long, good boolean")
        rows = scored.where("n_grams > 0").join(F.broadcast(sample), F.col("doc_id") == F.col("id")).groupBy("doc_id").agg(F.max("log_importance").alias("v"), F.max("good").alias("g")).collect()
        least = border(np.array([r["v"] for r in rows]), np.array([r["g"] for r in rows], bool))
        k = scored.where((F.col("n_grams") > 0) & (F.col("log_importance") >= least)).count()
    else:
        k = round(share * scored.count())
    last = kth_largest(scored, k)
    return scored.withColumn("kept", F.coalesce(F.col("value") >= F.lit(last), F.lit(False)) if last is not None else F.lit(False))


def importance_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
