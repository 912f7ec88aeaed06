"""Columns as few longs for a shuffle."""

import datetime as dt

from pyspark.sql import functions as F

from pingloom.operators import packs

KINDS = "a long, b int, c date, d timestamp, e timestamp_ntz, f timestamp_ntz, g string, h long, i smallint, j long"
MOST, LEAST = 2**63 - 1, -(2**63)


def there_and_back(df):
    found = packs.measured(df, df.columns)
    tight = found.packed(df)
    return found, tight, found.restored(tight, df.columns)


def test_packed_rows_come_back_as_they_were(spark):
    """Signs, nulls, times of a day, times before 1970 and numbers of the whole range."""
    at = dt.datetime
    rows = [
        (-7, 3, dt.date(1969, 12, 31), at(1969, 12, 31, 23, 59, 59, 999_999), at(2024, 3, 31, 2, 30, 0, 1), at(2024, 1, 1), "x", LEAST, -32768, 5),
        (10**12, None, None, at(2024, 3, 31, 3, 0), None, at(1960, 1, 2), None, MOST, 32767, 5),
        (None, -(2**31), dt.date(9999, 12, 31), None, at(1900, 1, 1, 12), None, "y", None, None, 5),
    ]
    df = spark.createDataFrame(rows, KINDS)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in (zone, "Europe/Berlin"):
            spark.conf.set("spark.sql.session.timeZone", name)
            found, tight, back = there_and_back(df)
            assert sorted(map(str, back.collect())) == sorted(map(str, df.collect())) and back.dtypes == df.dtypes
            assert not {"h", "g"} & set(found.fields) and {"h", "g"} < set(tight.columns) and len(tight.columns) < len(df.columns)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_empty_and_null_columns_are_packed(spark):
    for rows in ([], [(None,) * 10] * 2):
        df = spark.createDataFrame(rows, KINDS)
        assert list(map(str, there_and_back(df)[2].collect())) == list(map(str, df.collect()))


def test_a_number_takes_the_room_that_its_range_needs(spark):
    df = spark.range(0, 1000).select(*((F.col("id") * k).alias(f"c{k}") for k in range(1, 6)), F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("t"))
    found, tight, back = there_and_back(df)
    assert tight.columns == ["__p0"] and sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
