"""Upkeep of stored tables: which files are whole, manifest windows, rewrites with a swap, collection of old files, spools.

Files are listed, moved and deleted through Hadoop's file system, so any store that Spark reads will do.  Only file names and
sizes come to the driver.
"""

from __future__ import annotations

import json
import os
import posixpath
import time
import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Store:
    """A folder of any file system that Spark knows."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.home = self._path(self.root).toUri().getPath()
        self.fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, path: str):
        return self._path(path if "/" in path and (path.startswith("/") or ":" in path) else f"{self.root}/{path}")

    def files(self, folder: str = "") -> list[tuple[float, str, int]]:
        """(modified, path, bytes) of all files below, in order."""
        at = self._at(folder) if folder else self._path(self.root)
        if not self.fs.exists(at):
            return []
        out, found = [], self.fs.listFiles(at, True)
        while found.hasNext():
            f = found.next()
            out.append((f.getModificationTime() / 1000, f.getPath().toString(), f.getLen()))
        return sorted(out)

    def exists(self, path: str) -> bool:
        return self.fs.exists(self._at(path))

    def move(self, a: str, b: str) -> None:
        self.fs.mkdirs(self._at(b).getParent())
        if not self.fs.rename(self._at(a), self._at(b)):
            raise OSError(f"can't move {a} to {b}")

    def delete(self, path: str) -> bool:
        return self.fs.delete(self._at(path), True)

    def read(self, path: str, start: int, length: int) -> bytes:
        stream = self.fs.open(self._at(path))
        try:
            stream.seek(start)
            return bytes(stream.readNBytes(length))
        finally:
            stream.close()

    def create(self, path: str):
        """A stream that others see grow, flush by flush."""
        local = getattr(self.fs, "getRawFileSystem", None) if self.fs.getScheme() == "file" else None  # without checksum files beside it
        return (local() if local else self.fs).create(self._at(path))

    def write(self, path: str, data: bytes) -> None:
        """Readers see the old content or the new one, and a crash leaves one of them: written beside, then put over it in one step."""
        aside = f"{path}.{uuid.uuid4().hex}.tmp"
        stream = self.create(aside)
        try:
            stream.write(data)
            stream.hsync()
        finally:
            stream.close()
        self._put_over(aside, path)

    def _put_over(self, a: str, b: str) -> None:
        a, b = self._at(a), self._at(b)
        if self.fs.getScheme() == "file":
            os.replace(a.toUri().getPath() if a.isAbsolute() else str(a), b.toUri().getPath())
            return
        jvm = self.spark._jvm
        over = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
        options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
        options[0] = over
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(b.toUri(), self.spark._jsc.hadoopConfiguration()).rename(a, b, options)


def whole_parquet(store: Store, min_age_s: float = 0, now: float | None = None) -> list[tuple[float, str, int]]:
    """Parquet files that are ready: not hidden or temporary, old enough, with the format's mark at both ends."""
    now = time.time() if now is None else now
    out = []
    for modified, path, size in store.files():
        below = path.split(store.home, 1)[-1]
        hidden = any(part[:1] in ("_", ".") for part in below.split("/"))
        if hidden or not path.endswith(".parquet") or size < 8 or now - modified < min_age_s:
            continue
        if store.read(path, 0, 4) == b"PAR1" == store.read(path, size - 4, 4):
            out.append((modified, path, size))
    return out


def manifest_window(store: Store, manifest: str, offset: int, most: int = 10_000, step: int = 1 << 20) -> tuple[list[dict], int]:
    """The manifest's JSON lines from a byte offset on, `most` at most, and the offset behind them.  A last line without an
    end is still being written and waits."""
    size = next((n for _, p, n in store.files(manifest)), 0)
    rows, at, left = [], offset, b""
    while at + len(left) < size and len(rows) < most:
        left += store.read(manifest, at + len(left), min(step, size - at - len(left)))
        *lines, rest = left.split(b"\n")
        for line in lines:
            if len(rows) == most:
                return rows, at
            at += len(line) + 1
            if line.strip():
                rows.append(json.loads(line))
        left = rest
    return rows, at


def recover_swap(store: Store, folder: str) -> bool:
    """After a crash between the two moves of a swap the backup goes back; left-overs of a finished one go."""
    backup = f"{folder}.backup"
    if not store.exists(backup):
        return False
    if store.exists(folder):
        store.delete(backup)
    else:
        store.move(backup, folder)
    return True


def swap(store: Store, fresh: str, folder: str) -> None:
    """Puts a freshly written folder in the place of another; recover_swap mends a crash at any point."""
    recover_swap(store, folder)
    if store.exists(folder):
        store.move(folder, f"{folder}.backup")
    store.move(fresh, folder)
    store.delete(f"{folder}.backup")


def rewrite_small(store: Store, folder: str, files: int = 1, small: int = 32 << 20, keys: list[str] | None = None) -> bool:
    """Rewrites a folder of over `files` small files as that many; with keys, one row of each stays.  False: nothing to do."""
    recover_swap(store, folder)
    found = [x for x in store.files(folder) if x[1].endswith(".parquet")]
    if sum(size < small for *_, size in found) <= files:
        return False
    rows = store.spark.read.parquet(f"{store.root}/{folder}")
    rows = rows.dropDuplicates(keys) if keys else rows
    fresh = f"{folder}.fresh-{uuid.uuid4().hex}"
    rows.repartition(files).write.option("compression", "zstd").parquet(f"{store.root}/{fresh}")
    swap(store, fresh, folder)
    return True


def dedup_history(rows: DataFrame, keys: list[str], path: str, day: str, first: list[str], since: str | None = None, until: str | None = None) -> DataFrame:
    """Writes one row for each key and day (the least of the other columns) into path, replacing the days that occur, and returns rows
    before and after for each day.  A day's rows are spread over several files.  The report counts the day column of the
    source and of what was written; the keys aren't grouped again."""
    inside = (F.lit(True) if since is None else F.col(day) >= since) & (F.lit(True) if until is None else F.col(day) < until)
    rows = rows.where(inside)
    kept = rows.groupBy(day, *keys).agg(*(F.min(c).alias(c) for c in first))
    spread = kept.repartition(day, F.pmod(F.xxhash64(*keys), F.lit(8)))
    writer = spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
    writer.partitionBy(day).parquet(path)
    before = rows.groupBy(F.col(day).cast("string").alias("__day"), F.col(day)).agg(F.count("*").alias("before"))
    after = rows.sparkSession.read.parquet(path).groupBy(F.col(day).cast("string").alias("__day")).agg(F.count("*").alias("after"))
    return before.join(after, "__day").select(day, "before", "after")


def _place(path: str) -> str:
    """The path of a file without scheme and host, with . and .. resolved."""
    return posixpath.normpath(urlparse(path).path)


def collectable(files: list[tuple[float, str, int]], done: set[str], root: str, now: float, min_age_s: float = 86_400, most: int | None = None) -> list[str]:
    """Files that may go: handled (below the compaction's offset, or of committed batches), old enough, and below root itself."""
    inside = _place(root).rstrip("/") + "/"
    old = [p for m, p, _ in sorted(files) if p in done and now - m >= min_age_s and _place(p).startswith(inside) and _place(p) == urlparse(p).path]
    return old[:most]


def collect(store: Store, done: set[str], min_age_s: float = 86_400, most: int | None = None, dry_run: bool = False, now: float | None = None) -> list[str]:
    """Deletes collectable files of the store; a dry run only names them."""
    gone = collectable(store.files(), done, store.home, time.time() if now is None else now, min_age_s, most)
    for path in [] if dry_run else gone:
        store.delete(path)
    return gone


def committed_files(store: Store, checkpoint: str) -> set[str]:
    """Source files of a stream's committed batches, from its checkpoint's file source log."""
    batches = {p.rsplit("/", 1)[-1] for _, p, _ in store.files(f"{checkpoint}/commits")}
    out = set()
    for _, path, size in store.files(f"{checkpoint}/sources/0"):
        name = path.rsplit("/", 1)[-1]
        if name.startswith("."):
            continue
        for line in store.read(path, 0, size).decode().splitlines()[1:]:
            entry = json.loads(line)
            if str(entry["batchId"]) in batches:
                out.add(entry["path"])
    return out


def publish_json(store: Store, path: str, value) -> None:
    store.write(path, json.dumps(value, ensure_ascii=False, sort_keys=True, default=str).encode())


def overwrite_summary(df: DataFrame, path: str, files: int = 1) -> None:
    """A small summary is written whole in a few files."""
    df.coalesce(files).write.mode("overwrite").parquet(path)


def overwrite_buckets(df: DataFrame, path: str, keys: tuple[str, ...] = ("service_date", "bucket")) -> None:
    """Replaces just the (day, bucket) folders that occur."""
    df.repartition(*keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def backfill(df: DataFrame, path: str) -> None:
    """Writes to a new folder, and never over an old one."""
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)


class Spool:
    """JSON lines in files that grow under open/ and move to ready/ when they are old or large enough.  Each line is in its file before add()
    returns; every `sync_every` lines they are forced to disk."""

    def __init__(self, store: Store, seconds: float = 10, size: int = 32 << 20, sync_every: int = 0):
        self.store, self.seconds, self.size, self.sync_every = store, seconds, size, sync_every
        self.stream, self.name, self.bytes, self.lines, self.since = None, None, 0, 0, None

    def recover(self) -> int:
        """Whole lines of files that a crash left open become ready; a broken last line goes."""
        n = 0
        for _, path, size in self.store.files("open"):
            if self.name and path.endswith(f"/{self.name}.tmp"):
                continue
            whole = self.store.read(path, 0, size).rpartition(b"\n")[0]
            if whole:
                self.store.write(f"ready/{path.rsplit('/', 1)[-1].removesuffix('.tmp').removesuffix('.jsonl')}.jsonl", whole + b"\n")
                n += 1
            self.store.delete(path)
        return n

    def add(self, row: dict, now: float | None = None) -> None:
        now = time.time() if now is None else now
        if self.stream is None:
            self.name, self.since = f"{uuid.uuid4().hex}.jsonl", now
            self.store.fs.mkdirs(self.store._at("ready"))
            self.stream = self.store.create(f"open/{self.name}.tmp")
        line = json.dumps(row, ensure_ascii=False).encode() + b"\n"
        self.stream.write(line)
        self.lines += 1
        self.bytes += len(line)
        if self.sync_every and self.lines % self.sync_every == 0:
            self.stream.hsync()
        else:
            self.stream.hflush()
        self.roll_if_due(now)

    def roll_if_due(self, now: float | None = None) -> None:
        """For a timer, too: a file that nothing is added to gets old."""
        now = time.time() if now is None else now
        if self.stream is not None and (self.bytes >= self.size or now - self.since >= self.seconds):
            self.roll()

    def roll(self) -> None:
        if self.stream is not None:
            self.stream.hsync()
            self.stream.close()
            self.store.move(f"open/{self.name}.tmp", f"ready/{self.name}")
        self.stream, self.name, self.bytes, self.lines, self.since = None, None, 0, 0, None
