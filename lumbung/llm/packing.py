"""Items of varying length into containers of fixed capacities with little unused space, never splitting an item that fits.

Best-fit-decreasing sees only sizes, so the whole corpus is packed by its size histogram (at most ``capacity`` entries, exact
counts of all items): equal items are placed many at a time, and a plan is a list of patterns, each a multiset of sizes used
some number of times. Several permitted capacities are optimised jointly: where no open container takes an item, the
capacity is opened that the remaining sizes can fill with the least unused share (the larger one on ties), and at the end
each container is downsized to the smallest permitted capacity that holds its contents.

Items then find their container by their rank among items of equal size. Ranks come from groups of (size, bucket) of about
``BUCKET`` items, as many buckets as a size needs, so a size that a third of all items share is spread over many groups. The
plan is bounded by the capacity; the offsets are one number a group.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lumbung.session import cut

BUCKET = 200_000


@dataclass
class Plan:
    """Slots by size: slot k of a size takes ``width[k]`` items into each of consecutive containers from ``first[k]`` on, for
    ranks from ``start[k]``. ``capacity``/``bounds``: capacities of runs of containers."""

    slots: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]
    bounds: np.ndarray
    capacity: np.ndarray
    containers: int

    def place(self, size: int, ranks: np.ndarray) -> np.ndarray:
        start, width, first = self.slots[size]
        k = np.searchsorted(start, ranks, side="right") - 1
        return first[k] + (ranks - start[k]) // width[k]

    def capacities(self, containers: np.ndarray) -> np.ndarray:
        return self.capacity[np.searchsorted(self.bounds, containers, side="right") - 1]


def _reached(bits: int, size: int, capacity: int) -> int:
    """Bit t is set if t is reached by a fill of ``bits`` and any number of items of ``size``."""
    full, step = (1 << capacity + 1) - 1, size
    while step <= capacity:
        bits = (bits | bits << step) & full
        step *= 2
    return bits


def plan(histogram: dict[int, int], capacities: tuple[int, ...]) -> Plan:
    """Best-fit-decreasing of the whole histogram."""
    capacities = tuple(sorted(capacities))
    largest = capacities[-1]
    sizes = sorted((s for s, n in histogram.items() if n > 0), reverse=True)
    # Open containers by free space: groups of equal ones as [count, contents], contents = tuple of (size, number).
    free: list[int] = []
    groups: dict[int, list[list]] = {}

    def put(space: int, count: int, contents: tuple) -> None:
        if count:
            if space not in groups:
                groups[space] = []
                insort(free, space)
            groups[space].append([count, contents])

    # Fills that the sizes still to come can reach, from small to large sizes.
    reach: dict[int, int] = {}
    bits = 1
    for s in reversed(sizes):
        bits = _reached(bits, s, largest)
        reach[s] = bits
    for s in sizes:
        left = histogram[s]
        while left:
            at = bisect_left(free, s)
            if at < len(free):
                space = free[at]
                count, contents = groups[space].pop()
                if not groups[space]:
                    del groups[space]
                    free.pop(at)
            else:
                space = _least_cost(s, capacities, reach[s])
                count, contents = -(-left // (space // s)), ()
            per = space // s
            filled = min(count, left // per)
            put(space - per * s, filled, (*contents, (s, per)))
            left -= filled * per
            count -= filled
            if count and left and left < per:
                put(space - left * s, 1, (*contents, (s, left)))
                count, left = count - 1, 0
            if contents:
                put(space, count, contents)
    patterns = [(count, contents) for space in free for count, contents in groups[space]]
    return _numbered(patterns, capacities)


def _least_cost(size: int, capacities: tuple[int, ...], reach: int) -> int:
    best = None
    for capacity in capacities:
        if capacity >= size:
            window = reach & ((1 << capacity - size + 1) - 1)
            waste = (capacity - size - (window.bit_length() - 1)) / capacity
            if best is None or waste <= best[0]:
                best = (waste, capacity)
    return best[1]


def _numbered(patterns: list[tuple[int, tuple]], capacities: tuple[int, ...]) -> Plan:
    slots: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    bounds, capacity, number = [], [], 0
    for count, contents in patterns:
        total = sum(s * k for s, k in contents)
        bounds.append(number)
        capacity.append(next(c for c in capacities if c >= total))
        for s, k in contents:
            slots.setdefault(s, []).append((used.get(s, 0), k, number))
            used[s] = used.get(s, 0) + k * count
        number += count
    arrays = {s: tuple(np.array(x, np.int64) for x in zip(*rows)) for s, rows in slots.items()}
    return Plan(arrays, np.array(bounds or [0], np.int64), np.array(capacity or [capacities[-1]], np.int64), number)


_PLACED = T.StructType([T.StructField("wadah", T.LongType()), T.StructField("kapasitas", T.IntegerType())])


def _place_udf(broadcast):
    @F.pandas_udf(_PLACED)
    def run(sizes: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        made: Plan = broadcast.value
        out = np.zeros(len(sizes), np.int64)
        values, ranked = sizes.to_numpy(), ranks.to_numpy()
        for size in np.unique(values):
            mine = values == size
            out[mine] = made.place(int(size), ranked[mine])
        return pd.DataFrame({"wadah": out, "kapasitas": made.capacities(out).astype(np.int32)})

    return run


def packed(items: DataFrame, key: str, size: str, capacities: tuple[int, ...] = (2048,), buckets: int = 1) -> DataFrame:
    """One row an item, or a piece of an item longer than the largest capacity: key, potongan (from 0), awal (its first unit),
    panjang, wadah (container), kapasitas (of the downsized container).

    Items of null size or size 0 need no space and are left out. Repeated keys are items of their own. The pieces of a long
    item but the last fill a container each. ``buckets``: the fewest groups of a size.
    """
    largest = max(capacities)
    n = F.col(size).cast("long")
    pieces = items.where(n > 0).select(F.col(key), F.explode(F.sequence(F.lit(0), ((n - 1) / largest).cast("int"))).alias("potongan"), n.alias("__n"))
    pieces = pieces.select(
        key,
        "potongan",
        (F.col("potongan").cast("long") * largest).alias("awal"),
        F.least(F.col("__n") - F.col("potongan").cast("long") * largest, F.lit(largest)).cast("int").alias("panjang"),
    )
    pieces = cut(pieces)
    spark = items.sparkSession
    histogram = {r["panjang"]: r["count"] for r in pieces.groupBy("panjang").count().collect()}  # at most ``largest`` sizes
    groups = {s: max(buckets, -(-n // BUCKET)) for s, n in histogram.items()}
    spread = spark.createDataFrame(list(groups.items()), "panjang int, __buckets int")
    # hash(): a piece's bucket depends on its key and number only, so a lost task gives the same groups again.
    pieces = pieces.join(F.broadcast(spread), "panjang").withColumn("__bucket", F.pmod(F.hash(key, "potongan"), F.col("__buckets"))).drop("__buckets")
    cells = pieces.where(F.col("panjang").isin([s for s, n in groups.items() if n > 1])).groupBy("panjang", "__bucket").count().collect()
    offsets = [(s, 0, 0) for s, n in groups.items() if n == 1]
    placed_so_far: dict[int, int] = {}
    for r in sorted(cells, key=lambda r: (r["panjang"], r["__bucket"])):
        offsets.append((r["panjang"], r["__bucket"], placed_so_far.get(r["panjang"], 0)))
        placed_so_far[r["panjang"]] = offsets[-1][2] + r["count"]
    made = spark.sparkContext.broadcast(plan(histogram, capacities))
    offset = F.broadcast(spark.createDataFrame(offsets, "panjang int, __bucket int, __offset long"))
    order = Window.partitionBy("panjang", "__bucket").orderBy(key, "potongan")
    ranked = pieces.withColumn("__rank", F.row_number().over(order) - 1).join(offset, ["panjang", "__bucket"])
    placed = ranked.withColumn("__placed", _place_udf(made)("panjang", (F.col("__rank") + F.col("__offset"))))
    return placed.select(key, "potongan", "awal", "panjang", "__placed.wadah", "__placed.kapasitas")


def fill(placed: DataFrame) -> DataFrame:
    """One row a capacity: containers, units in them and the share of their space that is used."""
    by_container = placed.groupBy("wadah", "kapasitas").agg(F.sum("panjang").alias("isi"))
    return by_container.groupBy("kapasitas").agg(
        F.count("*").alias("wadah"), F.sum("isi").alias("isi"), (F.sum("isi") / (F.count("*") * F.col("kapasitas"))).alias("terpakai")
    )
