"""Joins that a naive plan would turn into nested loops or several scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def entity_key(number: Column, name: Column, missing: str = "0") -> list[Column]:
    """(kind, value): the number if there is one, else the name. Two entities are equal if both parts are.

    Stands for the join "numbers are valid and equal, or both are missing and the names are equal" as a plain hash join: a
    valid number never meets a missing one, so the two arms cannot cross.
    """
    valid = number.isNotNull() & (number != missing)
    return [F.when(valid, "N").otherwise("M"), F.when(valid, number).otherwise(name)]


def entity_join(left: DataFrame, right: DataFrame, number: tuple[str, str], name: tuple[str, str], how: str = "left") -> DataFrame:
    """Join by number where both have one, by name where neither has; null names match nothing. Columns named alike in both sides stay
    ambiguous, as in any join."""
    lk, lv = entity_key(F.col(number[0]), F.col(name[0]))
    rk, rv = entity_key(F.col(number[1]), F.col(name[1]))
    a = left.withColumns({"__lk": lk, "__lv": lv})
    b = right.withColumns({"__rk": rk, "__rv": rv})
    return a.join(b, (F.col("__lk") == F.col("__rk")) & (F.col("__lv") == F.col("__rv")), how).drop("__lk", "__lv", "__rk", "__rv")


def normalized(c: Column) -> Column:
    return F.lower(F.trim(c))


def normalized_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str, how: str = "left") -> DataFrame:
    """Equi-join on lower(trim()) of both columns; the right side's rows of a key are all kept."""
    a = left.withColumn("__nk", normalized(F.col(left_on)))
    b = right.withColumn("__mk", normalized(F.col(right_on)))
    return a.join(b, F.col("__nk") == F.col("__mk"), how).drop("__nk", "__mk")


def duplicate_rows(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One row: number of rows in groups of more than one by ``columns`` (0 for none); groups with a null key never count."""
    known = rows
    for c in columns:
        known = known.where(F.col(c).isNotNull())
    return known.groupBy(*columns).count().where("count > 1").agg(F.coalesce(F.sum("count"), F.lit(0)).cast("bigint").alias("rows"))


def same_values(rows: DataFrame, column: str, expected: DataFrame) -> DataFrame:
    """Values of one side only, with the side: empty when the sets are equal."""
    mine, theirs = rows.select(F.col(column).alias("value")).distinct(), expected.select(F.col(expected.columns[0]).alias("value")).distinct()
    return mine.exceptAll(theirs).withColumn("side", F.lit("unexpected")).unionByName(theirs.exceptAll(mine).withColumn("side", F.lit("missing")))


def members(rows: DataFrame, names: str, numbers: str, out: tuple[str, str] = ("nama", "nip")) -> DataFrame:
    """One row a member of two parallel arrays; the shorter one is padded with null; no row where either array is null."""
    zipped = F.arrays_zip(F.col(names).alias("a"), F.col(numbers).alias("b"))
    keep = [c for c in rows.columns if c not in (names, numbers, *out)]
    return rows.select(*keep, F.explode(zipped).alias("__z")).select(*keep, F.col("__z.a").alias(out[0]), F.col("__z.b").alias(out[1]))
