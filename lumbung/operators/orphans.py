"""References to records that do not exist, were removed or came later.

Plan: the parent keys go into a Bloom filter of a fixed size bound, which every reader of the child table tests inside
whole-stage codegen. A key the filter rejects is *proved* absent, so that row needs no join. Only filter-positive rows
meet the parent table in an exact join, which also supplies the life span of the parent record.

Skew: the parent side of the exact join is broadcast only when its counted keys stay below ``BROADCAST_KEYS``. Beyond
that, the keys that hold more than a hundredth of the positive rows are counted first; these hot keys (at most a hundred, so their parents
are a bounded broadcast) are joined apart from the others, which shuffle.
"""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung.operators.skew import hot_keys, lookup
from lumbung.session import cut

BROADCAST_KEYS = 500_000
MAX_FILTER_BITS = 64 * 1024 * 1024  # 8 MB, also the planner's own bound
MAX_FILTERS = 16  # for some 110 million parents
BITS_PER_KEY = 9.6  # one false positive in a hundred

MISSING, LATE, REMOVED = "hilang", "terlambat", "dihapus"


@dataclass(frozen=True)
class Reference:
    """One foreign key: ``child.column`` refers to ``parent.key``; born and gone bound the parent's life."""

    column: str
    key: str
    born: str = "dimuat_pada"
    gone: str = "dihapus_pada"


def parents(parent: DataFrame, ref: Reference) -> DataFrame:
    """Parent keys with their life span, one row a key. Null keys refer to nothing.

    Repeated keys are merged: known since the first row, removed only when every row of the key is removed.
    """
    return (
        parent.where(F.col(ref.key).isNotNull())
        .groupBy(F.col(ref.key).alias("__key"))
        .agg(
            F.min(ref.born).alias("__born"),
            F.when(F.count_if(F.col(ref.gone).isNull()) == 0, F.max(ref.gone)).alias("__gone"),
        )
    )


def bloom(keys: DataFrame, n: int) -> Column | None:
    """A predicate on ``__key`` that is false only for keys which are surely absent; None without a JVM session.

    The filter is a scalar subquery, aggregated by the executors and sent to them once. Where one of MAX_FILTER_BITS is too small,
    the keys are shared out to as many filters as they need by a hash, at most MAX_FILTERS, each tested for its own keys; with still
    more keys they let more rows through to the exact join, so results never depend on them.
    """
    try:
        from pyspark.sql.classic.column import Column as Classic

        jvm = keys.sparkSession._jvm
        util, catalyst = jvm.org.apache.spark.sql.classic.ExpressionUtils, jvm.org.apache.spark.sql.catalyst.expressions
        expression = lambda c: util.expression(c._jc)
        count = max(1, min(MAX_FILTERS, math.ceil(n * BITS_PER_KEY / MAX_FILTER_BITS)))
        bits = min(MAX_FILTER_BITS, max(1024, math.ceil(n * BITS_PER_KEY / count)))
        share = F.pmod(F.hash("__key"), F.lit(count))

        def one(k: int) -> Column:
            sizes = [expression(F.lit(x).cast("bigint")) for x in (max(n // count, 1), bits)]
            built = catalyst.aggregate.BloomFilterAggregate(expression(F.xxhash64("__key")), *sizes).toAggregateExpression()
            mine = keys if count == 1 else keys.where(share == k)
            made = mine.agg(Classic(util.column(built)).alias("filter")).scalar()
            # An empty share has no filter, and then none of its keys is there.
            return F.coalesce(Classic(util.column(catalyst.BloomFilterMightContain(expression(made), expression(F.xxhash64("__key"))))), F.lit(False))

        found = one(count - 1)
        for k in range(count - 1):
            found = F.when(share == k, one(k)).otherwise(found)
        return found
    except (AttributeError, ImportError, TypeError) as e:
        warnings.warn(f"no Bloom filter in this session ({e}); every reference meets the exact join", stacklevel=2)
        return None


def resolve(rows: DataFrame, keys: DataFrame, n: int) -> DataFrame:
    """Left join of ``rows`` with the parents on ``__key``, whatever the skew of the keys."""
    if n <= BROADCAST_KEYS:
        return rows.join(F.broadcast(keys), "__key", "left")
    return lookup(rows, keys, "__key", hot_keys(rows.groupBy("__key").count(), "__key"), "left")


def orphans(child: DataFrame, parent: DataFrame, ref: Reference, loaded: str = "dimuat_pada") -> DataFrame:
    """Rows of ``child`` whose reference fails, with ``kolom`` and ``sebab`` added.

    sebab: 'hilang' (no parent row), else 'terlambat' (parent first known after ``loaded``), else 'dihapus' (removed not
    later than ``loaded``). Null keys are no references; a null time on either side proves neither lateness nor removal.
    An empty parent table makes every reference 'hilang'; repeated child rows stay repeated; extra columns are kept, and
    names of the parent never clash because only its key and life span travel, under private names; columns of the child named
    kolom or sebab are replaced.
    """
    names = [c for c in child.columns if c not in ("kolom", "sebab")]
    rows = child.where(F.col(ref.column).isNotNull()).withColumn("__key", F.col(ref.column))
    keys = cut(parents(parent, ref))  # counted, filtered by and joined: aggregated once
    n = keys.count()
    if n == 0:
        return rows.select(*names, F.lit(ref.column).alias("kolom"), F.lit(MISSING).alias("sebab"))
    may = bloom(keys, n)
    proved = rows.where(~may) if may is not None else rows.limit(0)
    joined = resolve(rows.where(may) if may is not None else rows, keys.withColumn("__hit", F.lit(True)), n)
    cause = (
        F.when(F.col("__hit").isNull(), MISSING)
        .when(F.col("__born") > F.col(loaded), LATE)
        .when(F.col("__gone") <= F.col(loaded), REMOVED)
    )
    return (
        joined.withColumn("sebab", cause)
        .where(F.col("sebab").isNotNull())
        .select(*names, F.lit(ref.column).alias("kolom"), "sebab")
        .unionByName(proved.select(*names, F.lit(ref.column).alias("kolom"), F.lit(MISSING).alias("sebab")))
    )


def by_period(found: DataFrame, table: str, period: list[str]) -> DataFrame:
    """Orphans per table, column, period and cause."""
    return found.groupBy(F.lit(table).alias("tabel"), "kolom", *period, "sebab").agg(F.count("*").alias("baris"))
