"""Names and keys of routes and stops."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the letter before the number of an electric route.
ELECTRIC = "Т"


def route_sort_key(number: Column) -> Column:
    """number:prefix:rest:name.  All digits of the name without its electric prefix are one number, padded to four (9999 if
    there are none); the rest is what isn't a digit.  A null name is empty."""
    name = F.coalesce(number, F.lit(""))
    electric = name.startswith(ELECTRIC)
    bare = F.when(electric, F.substring(name, 2, 1 << 20)).otherwise(name)
    digits = F.ltrim(F.regexp_replace(bare, "[^0-9]", ""), F.lit("0"))
    padded = F.when(F.length(digits) < 4, F.lpad(digits, 4, "0")).otherwise(digits)
    value = F.when(bare.rlike("[0-9]"), padded).otherwise("9999")
    return F.concat_ws(":", value, F.when(electric, ELECTRIC).otherwise(""), F.regexp_replace(bare, "[0-9]", ""), name)


def electric_number(number: Column, transport_type: Column) -> Column:
    return F.when(transport_type.isin(1, 2) & ~number.startswith(ELECTRIC), F.concat(F.lit(ELECTRIC), number)).otherwise(number)


def identity(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", *(p.cast("string") for p in parts)), 256)


def name_key(name: Column) -> Column:
    return F.lower(F.trim(name))


def slug(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "-"), "^-|-$", "")
