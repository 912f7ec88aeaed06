"""Whole numbers and times of a row as few longs, for a shuffle: it moves and stores eight bytes for each column, however small its numbers are."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY = 86_400_000_000


def div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b))


def _digits(c: Column, kind: str, whole_days: bool) -> list[Column]:
    """Whole numbers that a value follows from; none where there aren't any."""
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return [c.cast("long")]
    if kind == "date" or (kind == "timestamp_ntz" and whole_days):
        return [F.unix_date(c.cast("date")).cast("long")]
    if kind == "timestamp":
        rest = F.pmod(F.unix_micros(c), F.lit(DAY))
        return [div(F.unix_micros(c) - rest, DAY), rest]
    if kind == "timestamp_ntz":
        # A time without a zone is taken apart without one: the session's zone may lack it.
        seconds = (F.hour(c) * 3600 + F.minute(c) * 60).cast("long") * 1_000_000
        return [F.unix_date(c.cast("date")).cast("long"), seconds + (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("long")]
    return []


def _value(digits: list[Column], kind: str) -> Column:
    if kind == "date":
        return F.date_from_unix_date(digits[0].cast("int"))
    if kind == "timestamp":
        return F.timestamp_micros(digits[0] * DAY + digits[1])
    if kind == "timestamp_ntz":
        day = F.date_from_unix_date(digits[0].cast("int")).cast("timestamp_ntz")
        return day if len(digits) == 1 else day + F.make_dt_interval(secs=(digits[1].cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)"))
    return digits[0].cast(kind)


class Packs:
    """How columns go into longs and come out again, without loss.  Each digit of a column counts from its least value, or from one less where there are
    nulls; as many digits share a long as their ranges allow.  fields: for each column its type, its digits' least and greatest values, and whether it has nulls."""

    def __init__(self, fields: dict[str, tuple[str, list[tuple[int, int]], bool]]):
        self.fields, self.places, self.sizes = fields, {}, []
        for name, (_, ranges, nulls) in fields.items():
            for k, (least, most) in enumerate(ranges):
                size = most - least + 1 + nulls
                if not self.sizes or self.sizes[-1] * size >= 1 << 63:
                    self.sizes.append(1)
                self.places[name, k] = (len(self.sizes) - 1, self.sizes[-1], size)
                self.sizes[-1] *= size

    def __or__(self, other: Packs) -> Packs:
        return Packs(self.fields | other.fields)

    def only(self, names: Iterable[str]) -> Packs:
        return Packs({c: self.fields[c] for c in names if c in self.fields})

    def packed(self, df: DataFrame) -> DataFrame:
        """df with longs for the columns that are packed; the others follow them, which keeps bytes that differ side by side for the compression."""
        longs: list[Column] = [F.lit(0).cast("long") for _ in self.sizes]
        for name, (kind, ranges, nulls) in self.fields.items():
            for k, (digit, (least, _)) in enumerate(zip(_digits(F.col(name), kind, len(ranges) == 1), ranges)):
                at, factor, _ = self.places[name, k]
                digit = F.coalesce(digit - (least - 1), F.lit(0)) if nulls else digit - least
                longs[at] += digit * factor
        return df.select(*(x.alias(f"__p{k}") for k, x in enumerate(longs)), *(c for c in df.columns if c not in self.fields))

    def column(self, name: str) -> Column:
        """A column, from the longs that packed() made or as it is."""
        if name not in self.fields:
            return F.col(name)
        kind, ranges, nulls = self.fields[name]
        digits = []
        for k, (least, _) in enumerate(ranges):
            at, factor, size = self.places[name, k]
            digit = F.col(f"__p{at}") if factor == 1 else div(F.col(f"__p{at}"), factor)
            digit = digit if factor * size == self.sizes[at] else digit % size
            digits.append(F.when(digit > 0, digit + (least - 1)) if nulls else digit + least)
        return _value(digits, kind)

    def restored(self, df: DataFrame, columns: list[str]) -> DataFrame:
        return df.select(*(self.column(c).alias(c) for c in columns))


def measured(df: DataFrame, columns: list[str]) -> Packs:
    """Packs for columns of df, by one pass over them; a column that is no number or time, or whose range takes more than a long, stays as it is."""
    kinds = {c: df.schema[c].dataType.simpleString() for c in columns}
    kinds = {c: kind for c, kind in kinds.items() if _digits(F.col(c), kind, True)}
    if not kinds:
        return Packs({})
    first = {c: _digits(F.col(c), kind, True)[0] for c, kind in kinds.items()}
    parted = {c: F.max(F.col(c) != F.col(c).cast("date").cast("timestamp_ntz")) for c, kind in kinds.items() if kind == "timestamp_ntz"}
    asked = [x for c, digit in first.items() for x in (F.min(digit), F.max(digit), F.max(F.col(c).isNull()), parted.get(c, F.lit(kinds[c] == "timestamp")))]
    row, found = df.agg(*(x.alias(f"x{k}") for k, x in enumerate(asked))).first(), {}
    for j, (c, kind) in enumerate(kinds.items()):
        least, most, nulls, parts = row[4 * j : 4 * j + 4]
        if least is None:  # no value: null is the only digit
            least, most, nulls = 0, -1, True
        if most - least < (1 << 63) - 2:
            found[c] = (kind, [(least, most), *([(0, DAY - 1)] if parts else [])], bool(nulls))
    return Packs(found)
