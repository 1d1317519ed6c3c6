"""Data quality of a table in one pass: completeness, validity, consistency of a pair of columns, uniqueness, names.

All rules but uniqueness share one scan and one aggregate; validity compares with reference values by outer joins to
distinct normalised keys. Uniqueness is one grouped count a column.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.functions import names
from lumbung.operators import joins


@dataclass(frozen=True)
class Reference:
    column: str
    table: DataFrame
    key: str


@dataclass(frozen=True)
class Swap:
    """Two columns whose values are taken for each other's: ``a`` belongs to ``a_ref``, ``b`` to ``b_ref``."""

    a: str
    b: str
    a_ref: Reference
    b_ref: Reference


@dataclass(frozen=True)
class Rules:
    mandatory: tuple[str, ...] = ()
    references: tuple[Reference, ...] = ()
    unique: tuple[str, ...] = ()
    swap: Swap | None = None
    threshold: float = 0.0
    names: dict[str, str] = field(default_factory=dict)


def blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c.cast("string")) == "")


def flagged(rows: DataFrame, column: str, ref: Reference, flag: str) -> DataFrame:
    """``rows`` with a boolean: the normalised value is one of the reference's."""
    known = ref.table.select(joins.normalized(F.col(ref.key)).alias("__ref")).where(F.col("__ref").isNotNull()).distinct().withColumn("__hit", F.lit(True))
    out = rows.withColumn("__key", joins.normalized(F.col(column))).join(known, F.col("__key") == F.col("__ref"), "left")
    return out.withColumn(flag, F.coalesce("__hit", F.lit(False))).drop("__key", "__ref", "__hit")


def score(total: Column, failed: Column) -> Column:
    """Share of good records in percent; 100 for no records."""
    return F.when(total == 0, 100.0).otherwise(F.round((total - failed) / F.nullif(total, F.lit(0)) * 100, 2))


def placed(rows: DataFrame, swap: Swap) -> DataFrame:
    """``rows`` with flags: a is of a's list (__aa), of b's (__ab); b is of b's list (__bb), of a's (__ba)."""
    r = flagged(rows, swap.a, swap.a_ref, "__aa")
    r = flagged(r, swap.a, swap.b_ref, "__ab")
    r = flagged(r, swap.b, swap.b_ref, "__bb")
    return flagged(r, swap.b, swap.a_ref, "__ba")


def swap_counts(rows: DataFrame, swap: Swap, title: str | None = None) -> DataFrame:
    """One row: blank titles, pairs swapped both ways, values alone in the wrong column (the other is null), values of neither
    list, equal pairs, total."""
    r = placed(rows, swap)
    a, b = F.col(swap.a), F.col(swap.b)
    aa, ab, bb, ba = (F.col(c) for c in ("__aa", "__ab", "__bb", "__ba"))
    return r.agg(
        (F.count_if(blank(F.col(title))) if title else F.lit(0).cast("bigint")).alias("null_judul"),
        F.count_if(ab & ba & ~aa & ~bb).alias("both_swapped"),
        F.count_if(a.isNull() & ba).alias("a_only"),
        F.count_if(b.isNull() & ab).alias("b_only"),
        F.count_if(a.isNotNull() & ~aa & ~ab).alias("invalid_a"),
        F.count_if(b.isNotNull() & ~bb & ~ba).alias("invalid_b"),
        F.count_if(joins.normalized(a) == joins.normalized(b)).alias("equal"),
        F.count("*").alias("total"),
    )


def title_counts(rows: DataFrame, title: str) -> DataFrame:
    """One row: total and blank titles."""
    return rows.agg(F.count("*").alias("total"), F.count_if(blank(F.col(title))).alias("null_judul"))


def name_counts(rows: DataFrame, column: str, known: DataFrame, name: str) -> DataFrame:
    """One row: total, empty, invalid (whether known or not), unmatched_valid, matched names against exact known names."""
    r = rows.join(known.select(F.col(name).alias(column), F.lit(True).alias("__hit")).distinct(), column, "left")
    r = r.withColumns({"__empty": blank(F.col(column)), "__bad": names.invalid_person(F.col(column))})
    hit, empty, bad = F.coalesce("__hit", F.lit(False)), F.col("__empty"), F.col("__bad")
    return r.agg(
        F.count("*").alias("total"),
        F.count_if(empty).alias("empty"),
        F.count_if(~empty & bad).alias("invalid"),
        F.count_if(~empty & ~hit & ~bad).alias("unmatched_valid"),
        F.count_if(hit).alias("matched"),
    )


def report(rows: DataFrame, name: str, rules: Rules) -> DataFrame:
    """One row a rule: table_name, column_name, dimension, metric, total_records, failed_records, score, threshold, status.

    Validity fails for non-blank values outside the reference, out of all non-null ones. Uniqueness fails for every row of a
    group of equal non-null values. A rule passes if its failures do not exceed ``rules.threshold``.
    """
    marked = rows
    for k, ref in enumerate(rules.references):
        marked = flagged(marked, ref.column, ref, f"__r{k}")
    total = F.count("*")
    cells = []
    for c in rules.mandatory:
        cells.append((c, "Completeness", "completeness_rate", total, F.count_if(blank(F.col(c)))))
    for k, ref in enumerate(rules.references):
        cells.append((ref.column, "Validity", "validity_rate", F.count(ref.column), F.count_if(~blank(F.col(ref.column)) & ~F.col(f"__r{k}"))))
    parts = []
    if cells:
        wide = marked.agg(*[x for k, (*_, n, f) in enumerate(cells) for x in (n.alias(f"n{k}"), f.alias(f"f{k}"))])
        parts.append(
            wide.select(
                F.inline(
                    F.array(
                        *[
                            F.struct(
                                F.lit(c).alias("column_name"), F.lit(d).alias("dimension"), F.lit(m).alias("metric"),
                                F.col(f"n{k}").alias("total_records"), F.col(f"f{k}").alias("failed_records"),
                            )
                            for k, (c, d, m, *_) in enumerate(cells)
                        ]
                    )
                )
            )
        )
    for c in rules.unique:
        counted = rows.groupBy(F.col(c)).count()
        failed = F.coalesce(F.sum(F.when((F.col("count") > 1) & F.col(c).isNotNull(), F.col("count"))), F.lit(0)).cast("bigint")
        one = counted.agg(F.coalesce(F.sum("count"), F.lit(0)).cast("bigint").alias("total_records"), failed.alias("failed_records"))
        parts.append(one.select(F.lit(c).alias("column_name"), F.lit("Uniqueness").alias("dimension"), F.lit("uniqueness_rate").alias("metric"), "total_records", "failed_records"))
    if rules.swap is not None:
        kinds = ("both_swapped", "a_only", "b_only", "equal")
        counts = swap_counts(rows, rules.swap)
        pair = f"{rules.swap.a},{rules.swap.b}"
        parts.append(
            counts.select(
                F.inline(
                    F.array(
                        *[
                            F.struct(F.lit(pair).alias("column_name"), F.lit("Consistency").alias("dimension"), F.lit(k).alias("metric"),
                                     F.col("total").alias("total_records"), F.col(k).alias("failed_records"))
                            for k in kinds
                        ]
                    )
                )
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    failed = F.col("failed_records")
    return out.select(
        F.lit(name).alias("table_name"), "column_name", "dimension", "metric", "total_records", "failed_records",
        score(F.col("total_records"), failed).alias("score"), F.lit(rules.threshold).alias("threshold"),
        F.when(failed <= rules.threshold, "PASS").otherwise("FAIL").alias("status"),
    )


def run(spark: SparkSession, tables: dict[str, tuple[DataFrame, Rules]]) -> DataFrame:
    """Report of several tables under one run id and time."""
    parts = [report(rows, name, rules) for name, (rows, rules) in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    return out.select(F.lit(uuid.uuid4().hex).alias("run_id"), F.lit(now).cast("timestamp").alias("run_timestamp"), "*")
