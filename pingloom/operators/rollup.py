"""Daily tables and their summaries, series and paging: one helper each for all grains."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import when


def rounded(value: Column, digits: int = 0) -> Column:
    """Halves go up; the same in every engine, as it is plain arithmetic on doubles."""
    scale = 10**digits
    whole = F.floor(value * F.lit(float(scale)) + F.lit(0.5))
    return whole / F.lit(float(scale)) if digits else whole


def mean(value: str | Column, digits: int = 2) -> Column:
    return rounded(F.avg(value), digits)


def daily(df: DataFrame, dims: list[str], measures: dict[str, Column], day: str = "service_date") -> DataFrame:
    return df.groupBy(day, *dims).agg(*(m.alias(n) for n, m in measures.items()))


def summary(table: DataFrame, dims: list[str], measures: dict[str, Column], day: str = "service_date", before=None) -> DataFrame:
    """All days and each weekday in one pass; weekday 0 stands for all days.  before: leaves out days from there on."""
    if before is not None:
        table = table.where(F.col(day) < F.lit(before))
    table = table.withColumn("weekday_iso", when.weekday_iso(F.col(day))).withColumn("weekday_iso", F.explode(F.array(F.lit(0), F.col("weekday_iso"))))
    return table.groupBy(*dims, "weekday_iso").agg(*(m.alias(n) for n, m in measures.items()))


def latest(value: str, *order: str) -> Column:
    """The value at the greatest key; the key must tell rows apart, or the result would hang on their order."""
    return F.max(F.struct(*order, value))[value]


def terminal_policies(df: DataFrame, flag: str = "is_terminal") -> DataFrame:
    """Each row under 'with', and under 'without' too if it isn't at a terminal; one pass."""
    both = F.when(F.col(flag), F.array(F.lit("with"))).otherwise(F.array(F.lit("with"), F.lit("without")))
    return df.withColumn("terminal_policy", F.explode(both))


def zero_filled(df: DataFrame, ts: str, seconds: int, value: Column | None = None, where: Column | None = None) -> DataFrame:
    """Counts (or sums) in buckets of epoch seconds, with zeros for empty buckets between the first and the last."""
    if where is not None:
        df = df.where(where)
    bucket = (F.floor(F.unix_timestamp(ts) / seconds) * seconds).cast("long")
    found = df.groupBy(bucket.alias("bucket")).agg((F.count("*") if value is None else F.sum(F.coalesce(value, F.lit(0)))).alias("n"))
    span = found.agg(F.min("bucket").alias("a"), F.max("bucket").alias("b")).where("a is not null")
    spine = span.select(F.explode(F.sequence("a", "b", F.lit(seconds).cast("long"))).alias("bucket"))
    return spine.join(found, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def event_filter(**wanted) -> Column:
    """A conjunction of equalities; None asks for nothing."""
    return reduce(lambda a, b: a & b, [F.col(c) == v for c, v in wanted.items() if v is not None], F.lit(True))


def period_filter(period: str = "all", day=None, today=None, weekday: int | None = None, column: str = "service_date") -> Column:
    """Days that a view asks for: 'previous' is one day, 'all' every day before today, 'weekday' those of one weekday."""
    if period == "previous":
        return F.lit(True) if day is None else F.col(column) == F.lit(day).cast("date")
    past = F.lit(True) if today is None else F.col(column) < F.lit(today).cast("date")
    return past & (when.weekday_iso(F.col(column)) == weekday) if period == "weekday" and weekday else past


def dwell_filter(long: bool = False, policy: str = "with-terminals", **wanted) -> Column:
    """Dwell events: over 60 seconds or any, with or without terminals, of a stop, route or vehicle."""
    kept = (F.col("dwell") > (60 if long else 0)) & event_filter(**wanted)
    return kept & ~F.col("is_terminal") if policy == "without-terminals" else kept


def page(df: DataFrame, order: list[Column], page: int = 1, size: int = 50) -> DataFrame:
    """A page of at most 50 rows."""
    size = min(max(1, size), 50)
    return df.orderBy(*order).offset((max(1, page) - 1) * size).limit(size)


def page_with_total(df: DataFrame, order: list[Column], number: int = 1, size: int = 50) -> DataFrame:
    """A page of at most 50 rows, each with the number of all rows and whether more follow; the total is one row."""
    size, number = min(max(1, size), 50), max(1, number)
    total = df.agg(F.count("*").alias("total"))
    return page(df, order, number, size).join(F.broadcast(total)).withColumn("has_more", F.col("total") > number * size)


def heat(df: DataFrame, point: list[str], measures: dict[str, Column], order: list[Column], top: int = 2000) -> DataFrame:
    """The top points of a map by the given order."""
    return df.groupBy(*point).agg(*(m.alias(n) for n, m in measures.items())).orderBy(*order).limit(top)


def grid(degrees: str, digits: int) -> Column:
    """A coordinate rounded to so many digits, as a whole number of grid steps."""
    return rounded(F.col(degrees) * F.lit(float(10**digits))).cast("long")


def last_movement(pings: DataFrame, key: str = "route") -> DataFrame:
    """The last ping with speed today and yesterday for each key; today is the last day that has a ping."""
    top = pings.agg(F.to_date(F.max("event_time")).alias("__top"))
    rows = pings.where("speed > 0").join(F.broadcast(top))  # one row
    day = F.to_date("event_time")
    on = lambda d: F.max(F.when(day == d, F.col("event_time")))
    found = rows.groupBy(key).agg(on(F.col("__top")).alias("today"), on(F.date_sub("__top", 1)).alias("yesterday"))
    return pings.select(key).distinct().join(found, key, "left")


def active_traces(pings: DataFrame, n: int = 100, minutes: int | None = None, keep_repeats: bool = True) -> DataFrame:
    """The last n pings of each vehicle, of the last minutes before the newest ping; repeats of a place in a row can go."""
    if minutes is not None:
        newest = pings.agg(F.max("event_time").alias("__newest"))
        near = F.unix_timestamp("__newest") - F.unix_timestamp("event_time") <= minutes * 60
        pings = pings.join(F.broadcast(newest)).where(near).drop("__newest")
    if not keep_repeats:
        w = Window.partitionBy("plate").orderBy("event_time", "event_id")
        here = F.struct("lat", "lon")
        pings = pings.withColumn("__same", F.lag(here).over(w).eqNullSafe(here)).where("not __same").drop("__same")
    place = F.row_number().over(Window.partitionBy("plate").orderBy(F.desc("event_time"), F.desc("event_id")))
    return pings.withColumn("__n", place).where(F.col("__n") <= n).drop("__n")


def shift_clock(rows: DataFrame, file_times: DataFrame, file: str = "file", ts: str = "event_time") -> DataFrame:
    """Seconds of each row moved by how far its file's time lies behind the file's last stamp, never back.

    The last stamp is an aggregate of a row a file, so no window puts a file's rows into one task.
    """
    last = rows.groupBy(file).agg(F.max(F.unix_timestamp(ts)).alias("__last")).join(file_times, file)
    shift = last.select(file, F.greatest(F.lit(0), F.col("modified") - F.col("__last")).alias("__shift"))
    return rows.join(shift, file).withColumn("shifted", F.unix_timestamp(ts) + F.col("__shift")).drop("__shift")


def month_then_year(df: DataFrame, place: list[str], value: str, day: str = "service_date") -> tuple[DataFrame, DataFrame]:
    """Means by month and weekday, and the year's mean of its months' means (each month counts once)."""
    keys = [F.year(day).alias("year"), F.month(day).alias("month"), when.weekday_iso(F.col(day)).alias("weekday_iso")]
    months = df.groupBy(*keys, *place).agg(mean(value).alias("mean"), F.count("*").alias("n"))
    years = months.groupBy("year", "weekday_iso", *place).agg(F.sum(rounded(F.col("mean") * 100).cast("long")).alias("__sum"), F.count("*").alias("months"))
    return months, years.withColumn("mean", rounded(F.col("__sum") / F.col("months")) / 100).drop("__sum")
