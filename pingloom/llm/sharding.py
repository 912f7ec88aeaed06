"""Sharding by a weighted hash tree: region, then rack, then shard.

At each level a key draws -ln(u) / weight for each child, u from a hash of key and child, and goes to the least draw, so
a child is taken in proportion to its weight, and a change of weights moves keys only between children whose share it
changes.  A node's weight is its shards' sum.  A shard that is added to the tree becomes a region of its own: keys that
draw it move there, and no other key moves.  The place of a row depends on doc_id and the number of shards alone
(law: key), and the tree costs a few draws a row, not one for each shard.

slot numbers a shard's rows from 0 without gaps, in order of a hash of doc_id, doc_id and checksum; it is put together
from counts of PARTS parts of each shard, so that no task sorts a whole shard.

Nulls and empty texts: a null text has size 8 and checksum 0; a null doc_id is a key like any other.  Repeated rows go to
one shard and get slots of their own.  Empty table: no rows.  Extra columns stay out of the way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import save

SHARDS = 24
PER_RACK, PER_REGION = 4, 12
#: Hex digits of a key's hash that part a shard for numbering: 256 parts.
PART_DIGITS = 2


def tree(shards: int, grown_from: int | None = None, weights: dict[int, float] | None = None) -> list[list[list[tuple[int, float]]]]:
    """Regions of racks of (shard, weight).  Shards from grown_from on are regions of their own.  weights: of shards whose weight
    isn't 1; all must be positive."""
    base, of = min(shards, shards if grown_from is None else grown_from), lambda s: float((weights or {}).get(s, 1.0))
    regions = [[[(s, of(s)) for s in range(r, min(r + PER_RACK, g + PER_REGION, base))] for r in range(g, min(g + PER_REGION, base), PER_RACK)] for g in range(0, base, PER_REGION)]
    return regions + [[[(s, of(s))]] for s in range(base, shards)]


def weight(node) -> float:
    return node[1] if isinstance(node, tuple) else sum(map(weight, node))


def _least(key: Column, name: Column, weights: list[Column], n: int) -> Column:
    """Which of up to n children of the node `name` the key draws; a child that isn't there has a null weight."""
    draws = []
    for k in range(n):
        digits = F.conv(F.substring(F.md5(F.concat(key, name, F.lit(f"/{k}"))), 1, 13), 16, 10).cast("double")
        draws.append(F.struct((-F.log((digits + F.lit(0.5)) / F.lit(float(1 << 52))) / weights[k]).alias("draw"), F.lit(k).alias("k")))
    return F.array_min(F.filter(F.array(*draws), lambda x: x["draw"].isNotNull()))["k"]


def with_shard(rows: DataFrame, key: str, name: str, shards: int, grown_from: int | None = None, weights: dict[int, float] | None = None) -> DataFrame:
    """Adds the shard of each key: one level of the tree after the other, so that a row draws only on its own way down."""
    regions = tree(shards, grown_from, weights)
    racks, leaves = max(map(len, regions)), max(len(r) for g in regions for r in g)

    def table(values) -> Column:
        return F.array(*(F.lit(v) if v is not None else F.lit(None) for v in values))

    def at(values, index: Column, kind: str) -> Column:
        return F.get(table(values).cast(f"array<{kind}>"), index)

    text = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    rows = rows.withColumn("__g", _least(text, F.lit(""), [F.lit(weight(g)) for g in regions], len(regions)))
    rack_weights = [at([weight(g[k]) if k < len(g) else None for g in regions], F.col("__g"), "double") for k in range(racks)]
    rows = rows.withColumn("__r", _least(text, F.concat(F.lit("/"), F.col("__g")), rack_weights, racks))
    flat = [g[k] if k < len(g) else [] for g in regions for k in range(racks)]
    place = F.col("__g") * racks + F.col("__r")
    leaf_weights = [at([r[k][1] if k < len(r) else None for r in flat], place, "double") for k in range(leaves)]
    rows = rows.withColumn("__s", _least(text, F.concat(F.lit("/"), F.col("__g"), F.lit("/"), F.col("__r")), leaf_weights, leaves))
    shard = at([r[k][0] if k < len(r) else None for r in flat for k in range(leaves)], place * leaves + F.col("__s"), "int")
    return rows.withColumn(name, shard).drop("__g", "__r", "__s")


def assign_shards(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text", weights: dict[int, float] | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of each row."""
    raw = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    part = F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit("null"))), 1, PART_DIGITS)
    rows = docs.select(F.col(key).alias("doc_id"), (F.octet_length(raw) + F.lit(8)).cast("long").alias("size"), F.crc32(raw).cast("long").alias("text_crc32"), F.lit("key").alias("law"), part.alias("__part"))
    rows = save(with_shard(with_shard(rows, "doc_id", "shard", shards, None, weights), "doc_id", "grown_shard", shards + 1, shards, weights), "shards")
    parts = rows.groupBy("shard", "__part").agg(F.count("*").alias("n"))  # shards x 256 rows at most
    before = Window.partitionBy("shard").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("shard", "__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    within = Window.partitionBy("shard", "__part").orderBy("doc_id", "text_crc32")
    numbered = rows.withColumn("__in", F.row_number().over(within)).join(F.broadcast(parts), ["shard", "__part"])
    return numbered.select("doc_id", "size", "text_crc32", "law", "shard", (F.col("__before") + F.col("__in") - 1).cast("long").alias("slot"), "grown_shard")


def shard_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def _sql_shard(node: list, name: str, key: str) -> str:
    below = [str(c[0]) if isinstance(c, tuple) else _sql_shard(c, f"{name}/{k}", key) for k, c in enumerate(node)]
    if len(node) == 1:
        return below[0]
    draws = [f"-ln((('0x' || substr(md5({key} || '{name}/{k}'), 1, 13))::BIGINT + 0.5::DOUBLE) / {1 << 52}::DOUBLE) / {weight(c)}::DOUBLE" for k, c in enumerate(node)]
    return f"list_extract([{', '.join(below)}], list_position([{', '.join(draws)}], list_min([{', '.join(draws)}])))"


#: CRC-32 by its definition: the remainder's table, then a fold over the bytes' hexadecimal digits.
CRC_SQL = """
bits AS (SELECT i, i::BIGINT AS c, 0 AS k FROM range(256) t(i) UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS steps FROM bits WHERE k = 8)"""


def crc_sql(digits: str) -> str:
    """The CRC-32 of bytes given in hexadecimal, beside the table `crc`."""
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length({digits}) // 2), lambda i: ('0x' || substr({digits}, (2 * i + 1)::BIGINT, 2))::BIGINT)), lambda a, b: xor(a >> 8, list_extract(steps, (xor(a, b) & 255) + 1))), 4294967295::BIGINT)"


def shard_sql() -> str:
    k = "coalesce(doc_id::VARCHAR, 'null')"
    return f"""WITH RECURSIVE {CRC_SQL},
sized AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS n, hex(encode(coalesce(text, ''))) AS digits FROM documents),
summed AS (SELECT doc_id, n, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(n), lambda i: ('0x' || substr(digits, (2 * i + 1)::BIGINT, 2))::BIGINT)), lambda a, b: xor(a >> 8, list_extract(steps, (xor(a, b) & 255) + 1))), 4294967295::BIGINT) AS sum FROM sized, crc),
placed AS (SELECT doc_id, (n + 8)::BIGINT AS size, sum::BIGINT AS text_crc32, ({_sql_shard(tree(SHARDS), '', k)})::INTEGER AS shard, ({_sql_shard(tree(SHARDS + 1, SHARDS), '', k)})::INTEGER AS grown_shard FROM summed)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, (row_number() OVER (PARTITION BY shard ORDER BY substr(md5({k}), 1, {PART_DIGITS}), doc_id, text_crc32) - 1)::BIGINT AS slot, grown_shard FROM placed"""
