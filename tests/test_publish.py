import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from pingloom.sources import publish, upkeep
from pingloom.streaming import ingest, traces

T0 = 1_700_000_000


def ping(t, plate="x", lat=1.0):
    return json.dumps({"internalRouteId": "1", "realRouteNumber": "7", "latitude": lat, "longitude": 2.0, "speed": 3, "plate": plate, "timestamp": t})


def drop(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / f".{name}").write_text("\n".join(lines) + "\n")
    (folder / f".{name}").rename(folder / name)


def daily(rows):
    return rows.groupBy("service_date").agg(F.count("*").alias("n"), F.max("timestamp").alias("last"))


def test_late_rows_are_kept_and_reopen_their_day(spark, tmp_path):
    """5 rows, then 7 rows that are an hour older, one of a day before: all 12 are published, and the days they belong to change."""
    spool, out = tmp_path / "spool", str(tmp_path / "out")
    run = lambda: ingest.ingest(spark, str(spool), out, str(tmp_path / "cp")).awaitTermination()
    store = publish.Store(spark, out)
    drop(spool, "a.jsonl", [ping(T0 + k) for k in range(5)] + [ping(T0)])
    run()
    assert publish.refresh_days(store, "daily", daily, f"{tmp_path}/daily", ingest.INGEST_KEY) == ["2023-11-15"]
    drop(spool, "b.jsonl", [ping(T0 - 3600 + k) for k in range(6)] + [ping(T0 - 86400), ping(T0 + 1)])
    run()
    assert ingest.published(spark, out).count() == 12
    assert publish.refresh_days(store, "daily", daily, f"{tmp_path}/daily", ingest.INGEST_KEY) == ["2023-11-14", "2023-11-15"]
    rows = {str(r.service_date): (r.n, r["last"]) for r in spark.read.parquet(f"{tmp_path}/daily").collect()}
    assert rows == {"2023-11-14": (1, T0 - 86400), "2023-11-15": (11, T0 + 4)}
    assert publish.refresh_days(store, "daily", daily, f"{tmp_path}/daily", ingest.INGEST_KEY) == []
    assert ingest.published(spark, out, ["2023-11-14"]).count() == 1


def _failing(monkeypatch, after):
    """Storage that breaks for good after so many changes."""
    left = [after]

    def count(f):
        def run(*a, **k):
            if left[0] <= 0:
                raise OSError("lost")
            left[0] -= 1
            return f(*a, **k)

        return run

    for name in ("move", "write", "delete"):
        monkeypatch.setattr(upkeep.Store, name, count(getattr(upkeep.Store, name)))


@pytest.mark.parametrize("after", range(8))
def test_a_step_is_taken_once_whatever_breaks(spark, tmp_path, monkeypatch, after):
    store = publish.Store(spark, f"file://{tmp_path}/t")
    rows = spark.range(40).select(F.col("id"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 2).cast("int")).alias("service_date")).repartition(2)
    publish.put(store, rows.where("id < 10"), 0)
    with monkeypatch.context() as m:
        _failing(m, after)
        try:
            publish.put(store, rows, 1)
        except OSError:
            assert publish.published(store).count() in (10, 50)  # before the manifest or after it, never between
    publish.put(store, rows, 1)
    assert not publish.put(store, rows, 1)
    assert publish.published(store).count() == 50 and publish.published(store, days=["2024-01-02"]).count() == 25
    assert publish.merge_manifest(store) == 2 and not publish.put(store, rows, 0)
    assert publish.published(store).count() == 50 and publish.manifest(store).agg(F.sum("rows")).first()[0] == 50


def test_refresh_after_a_crash(spark, tmp_path, monkeypatch):
    store = publish.Store(spark, f"file://{tmp_path}/t")
    publish.put(store, spark.range(6).withColumn("service_date", F.lit("2024-01-01").cast("date")), 0)
    build = lambda rows: rows.groupBy("service_date").agg(F.count("*").alias("n"))
    with monkeypatch.context() as m:
        m.setattr(upkeep.Store, "write", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            publish.refresh_days(store, "n", build, f"{tmp_path}/n", ["id"])
    assert publish.refresh_days(store, "n", build, f"{tmp_path}/n", ["id"]) == ["2024-01-01"]
    assert [r.n for r in spark.read.parquet(f"{tmp_path}/n").collect()] == [6]


def test_relayout_goes_on_where_it_was_killed(spark, tmp_path, monkeypatch):
    """Kill it after each number of storage changes; every row is there once at the end."""
    source = upkeep.Store(spark, f"file://{tmp_path}/raw")
    for k in range(5):
        spark.range(k * 10, k * 10 + 10).coalesce(1).write.mode("append").parquet(f"{tmp_path}/raw")
    by_day = lambda rows: rows.withColumn("service_date", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")))
    target = publish.Store(spark, f"file://{tmp_path}/days")
    for after in (1, 3, 4, 6):
        with monkeypatch.context() as m:
            _failing(m, after)
            with pytest.raises(OSError):
                publish.relayout(source, target, by_day, step=2)
    assert publish.relayout(source, target, by_day, step=2, most=1) <= 1
    publish.relayout(source, target, by_day, step=2)
    assert sorted(r.id for r in publish.published(target).collect()) == [*range(50)]
    assert publish.relayout(source, target, by_day, step=2) == 0
    spark.range(50, 53).coalesce(1).write.mode("append").parquet(f"{tmp_path}/raw")
    assert publish.relayout(source, target, by_day) == 1 and publish.published(target).count() == 53


def test_replaced_files_and_growing_spools(spark, tmp_path, monkeypatch):
    store = upkeep.Store(spark, f"file://{tmp_path}/s")
    store.write("view.json", b"old")
    with monkeypatch.context() as m:
        m.setattr("os.replace", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            store.write("view.json", b"new")
    assert store.read("view.json", 0, 10) == b"old"  # still there after a crash at the last step
    store.write("view.json", b"new")
    assert (tmp_path / "s/view.json").read_bytes() == b"new"
    spool = upkeep.Spool(store, seconds=10, sync_every=2)
    spool.add({"a": 1}, now=0)
    spool.add({"a": 2}, now=1)
    assert [p.read_text() for p in (tmp_path / "s/open").glob("*.tmp")] == ['{"a": 1}\n{"a": 2}\n']  # on disk before the roll
    assert upkeep.Spool(store).recover() == 1  # another process after a crash
    assert [r.a for r in spark.read.json(f"{tmp_path}/s/ready").orderBy("a").collect()] == [1, 2]
    other = upkeep.Spool(store, seconds=10)
    other.add({"a": 3}, now=0)
    other.roll_if_due(now=11)
    assert not list((tmp_path / "s/open").glob("*.tmp")) and spark.read.json(f"{tmp_path}/s/ready").count() == 3


def test_traces_survive_a_restart(spark, tmp_path):
    """Two runs with one checkpoint give what one batch gives; repeats go, 5 points stay, and a silent vehicle expires."""
    folder, out = tmp_path / "in", str(tmp_path / "out")
    schema = "plate string, eventTime timestamp, latitude double, longitude double"

    def go():
        lines = spark.readStream.schema(schema).json(str(folder))
        traces.start_traces(lines, out, str(tmp_path / "cp"), once=True, most=5).awaitTermination()

    row = lambda plate, s, lat: (plate, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s), lat)
    first = [row("a", k * 10, 1.0 + k % 3) for k in range(8)] + [row("b", 0, 5.0), row("c", 60, 6.0), row(" ", 5, 1.0)]
    second = [row("a", 70, 2.0), row("a", 75, 9.0), row("a", 65, 8.0), row("c", 200, 6.5)]
    third = [row("c", 2000, 7.0)]
    text = lambda rows: [json.dumps({"plate": p, "eventTime": t.isoformat() + "Z", "latitude": x, "longitude": 2.0}) for p, t, x in rows]
    drop(folder, "1.json", text(first))
    go()
    drop(folder, "2.json", text(second))
    go()
    got = {r.plate: [*zip(r.times, r.lats, strict=True)] for r in traces.latest_traces(spark, out).collect()}
    want = {}
    for p, t, x in first + second:
        want.setdefault(p, set()).add((int((t - dt.datetime(1970, 1, 1)).total_seconds() * 1e6), x))
    want = {p: sorted(v)[-5:] for p, v in want.items() if p != " "}
    assert got == want
    drop(folder, "3.json", text(third))
    go()
    drop(folder, "4.json", text([row("c", 2001, 7.0)]))
    go()
    assert {r.plate: len(r.times) for r in traces.latest_traces(spark, out).collect()} == {"c": 2}
