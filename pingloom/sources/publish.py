"""Tables that grow by numbered steps (batches of a stream, steps of a re-layout), each exactly once.

Layout: `data/<day>=…/` holds the rows (with the step's number in `batch`), `manifest/` a file for each step that is done: a line a day with
rows and files, and how far the step has read.  A step writes to `staging/`, moves its files into place and then puts its
manifest file; only that counts.  Readers take rows of steps in the manifest, so they never see half a step, and a
step that is run again after a crash first removes what it had moved.  Rows of any age are taken: the manifest tells which
days a step has touched, and tables by day are computed again for just those days.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .upkeep import Store, whole_parquet

MANIFEST = "batch long, day string, rows long, files array<string>, upto string"


def _name(number: int) -> str:
    return f"manifest/{number:020d}.json"


def put(store: Store, rows: DataFrame, number: int, day: str = "service_date", upto: str | None = None) -> bool:
    """Takes in a step's rows; False if the step has been done before.  upto: what the step has read, for the next one to start from."""
    if store.exists(_name(number)):
        return False
    staging, mark = f"staging/{number:020d}", f"{number:020d}-"
    store.delete(staging)
    for _, path, _ in store.files("data"):
        if path.rsplit("/", 1)[-1].startswith(mark):
            store.delete(path)
    staged = rows.withColumn("batch", F.lit(number).cast("long"))
    staged.write.option("compression", "zstd").partitionBy(day).parquet(f"{store.root}/{staging}")
    found: dict[str, list[str]] = {}
    for k, (_, path, _) in enumerate(x for x in store.files(staging) if x[1].endswith(".parquet")):
        folder = path.rsplit("/", 2)[-2]
        found.setdefault(folder, []).append(f"data/{folder}/{mark}{k:04d}.parquet")
        store.move(path, found[folder][-1])
    if found:
        paths = [f"{store.root}/{p}" for ps in found.values() for p in ps]
        counts = store.spark.read.parquet(*paths).groupBy(F.element_at(F.split("_metadata.file_path", "/"), -2).alias("folder")).count().collect()
        size = {r.folder: r["count"] for r in counts}
    lines = [{"batch": number, "day": folder.split("=", 1)[1], "rows": size[folder], "files": files, "upto": upto} for folder, files in sorted(found.items())]
    store.write(_name(number), "".join(json.dumps(x) + "\n" for x in lines or [{"batch": number, "rows": 0, "upto": upto}]).encode())
    store.delete(staging)
    return True


def manifest(store: Store) -> DataFrame:
    """A row for each step and day.  Steps of merged files stand there once."""
    if not store.files("manifest"):
        return store.spark.createDataFrame([], MANIFEST)
    return store.spark.read.schema(MANIFEST).json(f"{store.root}/manifest").distinct()


def merge_manifest(store: Store) -> int:
    """Puts the manifest's files into one, which replaces the last of them; a reader in between sees lines twice, which are taken once."""
    paths = [(p, n) for _, p, n in store.files("manifest") if p.endswith(".json")]
    paths.sort()
    if len(paths) > 1:
        store.write(paths[-1][0], b"".join(store.read(p, 0, n) for p, n in paths))
        # The names of steps go on telling that they are done.
        for p, _ in paths[:-1]:
            store.write(p, b"")
    return len(paths)


def published(store: Store, schema: str | None = None, days: list[str] | None = None, day: str = "service_date") -> DataFrame:
    """Rows of the steps that are done, of some days or all."""
    reader = store.spark.read.schema(f"{schema}, batch long, {day} date") if schema else store.spark.read
    rows = reader.parquet(f"{store.root}/data")
    rows = rows if days is None else rows.where(F.col(day).cast("string").isin(days))
    return rows.join(manifest(store).select("batch").distinct(), "batch", "left_semi")


def refresh_days(store: Store, name: str, build: Callable[[DataFrame], DataFrame], target: str, keys: list[str], day: str = "service_date") -> list[str]:
    """Computes the days that steps have touched since the last call from all of their rows (each key once), puts them in place of
    their partitions in target, and then notes the last step.  A crash before the note makes the next call do the same days again."""
    mark = f"marks/{name}.json"
    done = json.loads(store.read(mark, 0, 1 << 20))["batch"] if store.exists(mark) else -1
    new = manifest(store).where(F.col("batch") > done)
    top = new.agg(F.max("batch")).first()[0]
    if top is None:
        return []
    days = sorted(r.day for r in new.where("day is not null").select("day").distinct().collect())  # a few days, whatever the rows
    if days:
        rows = published(store, days=days, day=day).where(F.col("batch") <= top).drop("batch").dropDuplicates(keys)
        built = build(rows).repartition(day)
        built.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(day).parquet(target)
    store.write(mark, json.dumps({"batch": top}).encode())
    return days


def relayout(source: Store, target: Store, by_day: Callable[[DataFrame], DataFrame], step: int = 200, most: int | None = None, min_age_s: float = 0) -> int:
    """Moves a folder of raw files into days, `step` files at a time; the steps done (at most `most`).

    by_day adds the day to raw rows.  Files are taken in the order of their times and paths, from where the last step that is done has
    ended; a run that is killed anywhere leaves nothing that the next one doesn't mend.
    """
    done = manifest(target).agg(F.max(F.struct("batch", "upto")).alias("m")).first().m
    number, upto = (done.batch, json.loads(done.upto)) if done and done.upto else (-1, None)
    files = [(m, p) for m, p, _ in whole_parquet(source, min_age_s) if upto is None or [m, p] > upto]
    steps = range(0, len(files), step)[:most]
    for k, at in enumerate(steps, 1):
        part = files[at : at + step]
        put(target, by_day(target.spark.read.option("mergeSchema", True).parquet(*(p for _, p in part))), number + k, upto=json.dumps(part[-1]))
    return len(steps)

