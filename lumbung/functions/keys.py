"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def filled(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def text_key(prefix: str, *columns: Column) -> Column:
    """Prefix and 64-bit hash of the columns, as text. A hash leaves nulls out, so fill texts that may be null."""
    return F.concat(F.lit(prefix), F.xxhash64(*columns).cast("string"))


def int_key(*columns: Column) -> Column:
    """Low 32 bits of the 64-bit hash, also under ANSI; for tables that need 32-bit keys. Collisions are possible."""
    return F.shiftright(F.shiftleft(F.xxhash64(*columns), 32), 32).cast("int")


def long_key(*columns: Column) -> Column:
    return F.xxhash64(*columns)
