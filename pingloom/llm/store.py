"""Content-addressed store of token ids.

Layout of a store: `data/kind=0` holds each unique chunk once (key: its digest, body: ids, little-endian unsigned integers of 16
bits where the vocabulary allows it, else 32), `data/kind=1` the recipes as the writers made them.  `recipes` holds one
recipe a document in ascending doc_id order: file number (`part`), then order inside the file (`place`).  `manifest` has a row for each part: its documents, ids, the ids before it, the root
of a Merkle tree over its recipes' roots, and the root of all parts.

A rolling hash over the last ids decides where a document's id stream is cut, so equal passages give equal chunks
wherever they stand.  A chunk is stored once, under its digest.  A recipe lists its document's digests and lengths and
the root of a Merkle tree over them.  Reading checks each chunk against its digest, each recipe against its root, and the
recipes' roots against the manifest.

Nulls and empty texts: a null or empty text is its end id alone; a null doc_id sorts first.  Repeated rows: each is a
document with a recipe of its own, its chunks are shared.  A very long text is one row of a task: about 40 times its bytes there.
Empty table: an empty store.  Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mix, new_path, slices
from .tokens import Encoder, tokenizer_json

WINDOW = 8
#: A chunk ends where the window's hash has this many zero bits, so it holds 512 ids or so.
ZERO_BITS = 9
LONGEST = 4096
SLICE = 1 << 20

ROWS = "kind int, key binary, nth long, doc_id long, n long, body binary, lengths binary"
_ARROW = pa.schema([("kind", pa.int32()), ("key", pa.binary()), ("nth", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("body", pa.binary()), ("lengths", pa.binary())])
RECIPES = "part int, place long, doc_id long, root binary, n long, within long, digests binary, lengths binary, part_root binary"
MANIFEST = "part int, n_docs long, n_ids long, start long, root binary, store_root binary"


def digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def merkle_root(leaves: list[bytes]) -> bytes:
    """Pairs of nodes are hashed level by level; an odd last node moves up; no leaves: the digest of nothing."""
    if not leaves:
        return digest(b"")
    while len(leaves) > 1:
        leaves = [digest(b"".join(leaves[k : k + 2])) if k + 1 < len(leaves) else leaves[k] for k in range(0, len(leaves), 2)]
    return leaves[0]


class Tree:
    """merkle_root of leaves that come one by one: the roots of whole subtrees, at most one of each height."""

    def __init__(self):
        self.roots: list[tuple[int, bytes]] = []

    def add(self, leaf: bytes) -> None:
        node = (0, leaf)
        while self.roots and self.roots[-1][0] == node[0]:
            node = (node[0] + 1, digest(self.roots.pop()[1] + node[1]))
        self.roots.append(node)

    def root(self) -> bytes:
        if not self.roots:
            return digest(b"")
        node = self.roots[-1][1]
        for _, left in self.roots[-2::-1]:
            node = digest(left + node)
        return node


def cuts(ids: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Ends of chunks: after a window whose hash has ZERO_BITS zeros, at each document's end, and after LONGEST ids."""
    with np.errstate(over="ignore"):
        x = mix(np.arange(int(ids.max(initial=0)) + 1, dtype=np.uint64) + np.uint64(1)).astype(np.uint32)[ids]
        h = x.copy()
        for k in range(1, WINDOW):
            h[k:] += x[:-k] * np.uint32(pow(0x01000193, k, 1 << 32))
    marked = (h >> np.uint32(32 - ZERO_BITS)) == 0
    row_start = np.repeat(borders[:-1], np.diff(borders))
    at = np.nonzero(marked)[0]
    at = at[at - row_start[at] >= WINDOW - 1] + 1  # a window never reaches into the document before
    ends = np.union1d(at, borders[1:])
    gaps = np.diff(np.concatenate([[0], ends]))
    if len(gaps) and gaps.max() > LONGEST:
        more = [np.arange(e - g + LONGEST, e, LONGEST) for e, g in zip(ends[gaps > LONGEST], gaps[gaps > LONGEST], strict=True)]
        ends = np.union1d(ends, np.concatenate(more))
    return ends


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 2, text: str = "text", key: str = "doc_id") -> None:
    """Encode docs (key, text) with a tokenizer file and write the store."""
    json = docs.sparkSession.sparkContext.broadcast(tokenizer_json(tokenizer))

    def encode(batches):
        encoder, done = Encoder(json.value), TaskContext.get().partitionId() << 36
        for batch, texts in slices(batches, SLICE):
            ids, borders = encoder.encode(texts, end_id)
            ends = cuts(ids, borders)
            starts = np.concatenate([[0], ends[:-1]])
            data = memoryview(ids.astype("<u2" if encoder.tokenizer.get_vocab_size() < 1 << 16 else "<u4")).cast("B")
            width = len(data) // len(ids) if len(ids) else 1
            digests = [digest(data[a:b]) for a, b in zip((starts * width).tolist(), (ends * width).tolist(), strict=True)]
            fresh = list(dict(zip(reversed(digests), range(len(digests) - 1, -1, -1), strict=True)).values())  # the first place of each
            yield pa.record_batch([pa.array(np.zeros(len(fresh), np.int32)), pa.array([digests[k] for k in fresh], pa.binary()), pa.array(np.zeros(len(fresh), np.int64)), pa.nulls(len(fresh), pa.int64()), pa.array((ends - starts)[fresh]), pa.array([data[a * width : b * width].tobytes() for a, b in zip(starts[fresh].tolist(), ends[fresh].tolist(), strict=True)], pa.binary()), pa.nulls(len(fresh), pa.binary())], schema=_ARROW)
            first = np.searchsorted(ends, borders, side="right")
            first[0] = 0
            sizes = (ends - starts).astype("<u4")
            parts = [digests[a:b] for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
            yield pa.record_batch([pa.array(np.ones(len(parts), np.int32)), pa.array([merkle_root(p) for p in parts], pa.binary()), pa.array(np.arange(done, done + len(parts))), batch.column(key).cast(pa.int64()), pa.array(np.diff(borders)), pa.array([b"".join(p) for p in parts], pa.binary()), pa.array([sizes[a:b].tobytes() for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)], pa.binary())], schema=_ARROW)
            done += len(parts)

    spark = docs.sparkSession
    # Chunks go by their digest, and equal ones are dropped in each task first; recipes have a number (nth) of their own.
    rows = docs.select(F.col(key), F.col(text).alias("text")).mapInArrow(encode, ROWS)
    rows.groupBy("kind", "key", "nth").agg(*(F.first(c).alias(c) for c in ("doc_id", "n", "body", "lengths"))).write.partitionBy("kind").parquet(f"{path}/data")
    rows = spark.read.schema(ROWS).parquet(f"{path}/data")
    recipes = rows.where("kind = 1").select("doc_id", F.col("key").alias("root"), "n", F.col("body").alias("digests"), "lengths")
    by = [F.col("doc_id"), F.col("root")]
    recipes.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(_number, RECIPES).write.parquet(f"{path}/recipes")
    _write_manifest(spark, path)


def _number(batches):
    """Adds part, place, the ids of the part before each recipe, and in a part's last row its root."""
    part, place, within, tree, last = TaskContext.get().partitionId(), 0, 0, Tree(), None
    for batch in batches:
        if not batch.num_rows:
            continue
        if last is not None:
            yield last
        n = batch.column("n").to_numpy()
        for root in batch.column("root").to_pylist():
            tree.add(root)
        count = batch.num_rows
        last = pa.record_batch([pa.array(np.full(count, part, np.int32)), pa.array(np.arange(place, place + count)), batch.column("doc_id"), batch.column("root"), batch.column("n"), pa.array(within + np.cumsum(n) - n), batch.column("digests"), batch.column("lengths"), pa.nulls(count, pa.binary())], names=[x.split()[0] for x in RECIPES.split(", ")])
        place, within = place + count, within + int(n.sum())
    if last is not None:
        yield last.set_column(last.num_columns - 1, "part_root", pa.array([None] * (last.num_rows - 1) + [tree.root()], pa.binary()))


def _write_manifest(spark: SparkSession, path: str) -> None:
    """A row a part comes to the driver: as many as files."""
    ends = spark.read.schema(RECIPES).parquet(f"{path}/recipes").where("part_root is not null")
    parts = sorted((r["part"], r["place"] + 1, r["within"] + r["n"], bytes(r["part_root"])) for r in ends.select("part", "place", "within", "n", "part_root").collect())
    whole, start, rows = merkle_root([root for *_, root in parts]), 0, []
    for part, n_docs, n_ids, root in parts:
        rows.append((part, n_docs, n_ids, start, root, whole))
        start += n_ids
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.parquet(f"{path}/manifest")


def verify_manifest(spark: SparkSession, path: str) -> bytes:
    """The root of the store; fails if the recipes don't give the manifest's roots."""

    def roots(batches):
        part, tree, n = None, Tree(), 0
        for batch in batches:
            for p, root in zip(batch.column("part").to_pylist(), batch.column("root").to_pylist(), strict=True):
                if p != part and part is not None:
                    yield pa.record_batch([pa.array([part], pa.int32()), pa.array([n]), pa.array([tree.root()], pa.binary())], names=["part", "n_docs", "root"])
                    tree, n = Tree(), 0
                part, n = p, n + 1
                tree.add(root)
        if part is not None:
            yield pa.record_batch([pa.array([part], pa.int32()), pa.array([n]), pa.array([tree.root()], pa.binary())], names=["part", "n_docs", "root"])

    recipes = spark.read.schema(RECIPES).parquet(f"{path}/recipes").select("part", "place", "root")
    found = recipes.repartition("part").sortWithinPartitions("part", "place").mapInArrow(roots, "part int, n_docs long, root binary").collect()
    rows = spark.read.schema(MANIFEST).parquet(f"{path}/manifest").collect()
    if {(r["part"], r["n_docs"], bytes(r["root"])) for r in found} != {(r["part"], r["n_docs"], bytes(r["root"])) for r in rows}:
        raise ValueError("the recipes don't match the manifest")
    whole = merkle_root([bytes(r["root"]) for r in sorted(rows, key=lambda r: r["part"])])
    if any(bytes(r["store_root"]) != whole for r in rows):
        raise ValueError("the manifest is damaged")
    return whole


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """key, n and the body's ids as 32-bit little-endian bytes; fails if a body doesn't match its digest."""

    def check(batches):
        for batch in batches:
            out = []
            for d, n, body in zip(*(batch.column(c).to_pylist() for c in ("key", "n", "body")), strict=True):
                if digest(body) != d:
                    raise ValueError(f"chunk {d.hex()} is damaged")
                out.append(np.frombuffer(body, "<u2" if len(body) == 2 * n else "<u4").astype("<u4").tobytes())
            yield pa.record_batch([batch.column("key"), batch.column("n"), pa.array(out, pa.binary())], names=["key", "n", "ids"])

    rows = spark.read.schema(ROWS).parquet(f"{path}/data").where("kind = 0").select("key", "n", "body")
    return rows.mapInArrow(check, "key binary, n long, ids binary")


_UNFOLDED = "row long, part int, doc_id long, start long, n_tokens long, key binary, place int, after long"


def _recipe_rows(spark: SparkSession, path: str) -> DataFrame:
    """A row for each chunk of each recipe (row, part): the document, the chunk's key and place, and the number of the document's ids
    after it."""

    def unfold(batches):
        for batch in batches:
            at, keys, place, after = [], [], [], []
            for k, (root, digests, lengths, n) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("root", "digests", "lengths", "n")), strict=True)):
                leaves = [digests[j : j + 16] for j in range(0, len(digests), 16)]
                if merkle_root(leaves) != root:
                    raise ValueError(f"the recipe {root.hex()} is damaged")
                upto = np.cumsum(np.frombuffer(lengths, "<u4").astype(np.int64))
                at += [k] * max(1, len(leaves))
                keys += leaves or [None]
                place += range(max(1, len(leaves)))
                after += (n - upto).tolist() or [0]
            at = pa.array(at, pa.int64())
            yield pa.record_batch([*(batch.column(c).take(at) for c in ("place", "part", "doc_id", "start", "n")), pa.array(keys, pa.binary()), pa.array(place, pa.int32()), pa.array(after, pa.int64())], names=[x.split()[0] for x in _UNFOLDED.split(", ")])

    recipes = spark.read.schema(RECIPES).parquet(f"{path}/recipes")
    parts = spark.read.schema(MANIFEST).parquet(f"{path}/manifest").select("part", F.col("start").alias("before"))
    recipes = recipes.join(F.broadcast(parts), "part")  # a row a file
    return recipes.select("place", "part", "doc_id", (F.col("before") + F.col("within")).alias("start"), "root", "n", "digests", "lengths").mapInArrow(unfold, _UNFOLDED)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start and the array of ids, put together from the chunks that the recipe names."""
    verify_manifest(spark, path)
    rows = _recipe_rows(spark, path).join(read_chunks(spark, path).select("key", F.col("ids").alias("ids")), "key", "left")
    joined = rows.groupBy("part", "row", "doc_id", "start", "n_tokens").agg(F.sort_array(F.collect_list(F.struct("place", "ids"))).alias("parts"))

    def decode(batches):
        for batch in batches:
            ids = [np.frombuffer(b"".join(p["ids"] or b"" for p in parts), "<u4").astype(np.int64) for parts in batch.column("parts").to_pylist()]
            if [len(x) for x in ids] != batch.column("n_tokens").to_pylist():
                raise ValueError("a chunk is missing")
            yield pa.record_batch([batch.column("doc_id"), batch.column("start"), pa.array(ids, pa.list_(pa.int64()))], names=["doc_id", "start", "ids"])

    return joined.mapInArrow(decode, "doc_id long, start long, ids array<long>")


def _shift_tables(bits: int = 48) -> np.ndarray:
    """tables[k][byte][value]: what 2**k zero bytes make of a CRC-32 register, by linearity, for each of its four bytes."""
    one = np.array([1 << k for k in range(32)], np.uint32)

    def table(columns: np.ndarray) -> np.ndarray:
        out = np.zeros((4, 256), np.uint32)
        for k in range(32):
            value = np.arange(256)
            out[k // 8] ^= np.where(value >> (k % 8) & 1, columns[k], np.uint32(0)).astype(np.uint32)
        return out

    def apply(t: np.ndarray, x: np.ndarray) -> np.ndarray:
        return t[0][x & 255] ^ t[1][x >> 8 & 255] ^ t[2][x >> 16 & 255] ^ t[3][x >> 24]

    step = one.copy()
    for _ in range(8):  # one zero byte: eight times one bit of the reflected polynomial
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1).astype(np.uint32)
    tables = [table(step)]
    for _ in range(bits - 1):
        step = apply(tables[-1], apply(tables[-1], one))
        tables.append(table(step))
    return np.array(tables)


def crc_before(crc: np.ndarray, n_bytes: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """What CRC-32 values give to the CRC-32 of a longer run of bytes in which n_bytes follow; xor joins the parts."""
    crc, n_bytes, k = crc.astype(np.uint32), n_bytes.copy(), 0
    while n_bytes.any():
        t, odd = tables[k], (n_bytes & 1).astype(bool)
        x = crc[odd]
        crc[odd] = t[0][x & 255] ^ t[1][x >> np.uint32(8) & 255] ^ t[2][x >> np.uint32(16) & 255] ^ t[3][x >> np.uint32(24)]
        n_bytes >>= 1
        k += 1
    return crc


def document_checksums(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32, from the files.

    Each stored chunk is read, checked and summed once.  The sum of a document is put together from the sums of its
    chunks (CRC-32 is linear), so that no ids are shuffled.
    """

    def sums(batches):
        for batch in batches:
            yield pa.record_batch([batch.column("key"), batch.column("n"), pa.array([zlib.crc32(x) for x in batch.column("ids").to_pylist()], pa.int64())], names=["key", "n", "crc"])

    def shift(batches):
        tables = _shift_tables()
        for batch in batches:
            crc = batch.column("crc").to_numpy(zero_copy_only=False).astype(np.uint32)
            moved = crc_before(crc, batch.column("after").to_numpy(zero_copy_only=False) * 4, tables)
            yield pa.record_batch([*(batch.column(c) for c in ("part", "row", "doc_id", "start", "n_tokens", "n")), pa.array(moved.astype(np.int64))], names=["part", "row", "doc_id", "start", "n_tokens", "n", "crc"])

    verify_manifest(spark, path)
    chunks = read_chunks(spark, path).mapInArrow(sums, "key binary, n long, crc long")
    rows = _recipe_rows(spark, path).join(chunks, "key", "left")
    moved = rows.select("part", "row", "doc_id", "start", "n_tokens", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("crc", F.lit(0)).alias("crc"), "after").mapInArrow(shift, "part int, row long, doc_id long, start long, n_tokens long, n long, crc long")
    whole = moved.groupBy("part", "row", "doc_id", "start", "n_tokens").agg(F.sum("n").alias("found"), F.bit_xor("crc").alias("ids_crc32"))
    return whole.select("doc_id", "start", F.when(F.col("found") == F.col("n_tokens"), F.col("n_tokens")).otherwise(F.raise_error(F.lit("a chunk is missing"))).alias("n_tokens"), "ids_crc32")


def tokenize_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query: documents into a new store in the shared folder, and back."""
    import public_tokenizers

    path = new_path(spark, "store")
    write_store(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return document_checksums(spark, path)
