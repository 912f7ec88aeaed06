"""A corpus from documents to packed sequences: quality rules, near-dedup, suffix dedup, decontamination, packing.

Each stage takes the rows that its predecessor kept.  All but the last return the columns of documents.  Rows that share
a doc_id stand or fall together in stages that reject; near-dedup keeps one of them.  A null doc_id is judged like
any other value by the quality rules and decontamination, and is never a near copy.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pingloom.llm import decontam, neardup, packing, quality, suffix
from pingloom.llm.common import save, without_ids


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return without_ids(docs, quality.quality(docs).where(~F.col("kept")).select("doc_id"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least doc_id of each class stays."""
    classes = save(neardup.near_duplicate_classes(docs), "classes")
    left = without_ids(docs, classes.where("doc_id <> class_id").select("doc_id"))
    again = classes.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if again.isEmpty():
        return left
    repeated = left.join(again, "doc_id", "left_semi")
    first = repeated.withColumn("__n", F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))).where("__n = 1").drop("__n")
    return without_ids(left, again).unionByName(first.select(*left.columns))


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of passages go; every document keeps the rest of its text."""
    done = suffix.remove_repeats(docs, as_text=True)
    return done.withColumns({"text": F.col("__kept"), "n_chars": F.char_length("__kept").cast("long")}).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    found = decontam.find_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return without_ids(docs, found.select("doc_id"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack_documents(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("suffix_dedup", suffix_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: No SQL: perplexities, signatures and tokenizers are beyond it; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), name)
    return docs
