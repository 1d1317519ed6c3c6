"""Column-level data quality: masks, profiles, malformed values and loads that differ.

Every text value is generalised to a mask of character classes (letters ``A``, digits ``9``, blanks `` ``, other white space
``␣``, visible ASCII signs as themselves, anything else ``¿``). Runs of letters collapse; digits keep their number up to ten, so a mask
tells a four-digit from a ten-digit number. Masks are mined per column and load: those with less than ``RARE`` of a column's
values are rare-mask violations, and the Jensen-Shannon divergence of a load's masks from those of all other loads tells a
load whose values are built differently.

A format rule is decided on the mined masks wherever a mask settles it (``bad`` or ``good`` patterns), once a mask; rows find
the verdict of their mask, and only values of the remaining masks are tested by the exact pattern. Everything is built-in
expressions and map-side combined aggregates; the only tables that are not spread are those of loads and of mask counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung.operators.skew import hot_keys, lookup
from lumbung.session import cut

RARE = 0.001
DIGITS = 10
BROADCAST_CHARS = 8_000_000
NUMERIC = {"tinyint", "smallint", "int", "bigint", "float", "double", "decimal"}


def mask(value: Column) -> Column:
    """Character-class mask of a text; null for null, '' for ''."""
    text = F.regexp_replace(value, r"[^\x20-\x7E\s]", "\u0001")  # other than ASCII
    text = F.regexp_replace(text, r"[\t\n\x0B\f\r]", "\u0002")
    text = F.regexp_replace(text, r"[A-Za-z]+", "A")
    text = F.translate(text, "012345678", "9" * 9)
    text = F.regexp_replace(text, rf"9{{{DIGITS},}}", "9" * DIGITS)
    return F.translate(text, "\u0001\u0002", "¿␣")


@dataclass(frozen=True)
class Format:
    """A format: patterns on masks that settle a value, and the exact pattern for the others."""

    bad: str  # masks of malformed values only
    exact: str | None  # pattern of well-formed values; None: the mask settles every value
    good: str | None = None  # masks of well-formed values only

    def verdict(self, shape: Column) -> Column:
        """What a mask says: true for malformed, false for well-formed, null where the value must be looked at."""
        out = F.when(shape.rlike(self.bad), True)
        if self.good is not None:
            out = out.when(shape.rlike(self.good), False)
        return out.otherwise(F.lit(None) if self.exact is not None else F.lit(False))

    def broken(self, verdict: Column, value: Column) -> Column:
        """The verdict, or the exact pattern where there is none."""
        return F.coalesce(verdict, ~value.rlike(self.exact)) if self.exact is not None else verdict

    def malformed(self, value: Column) -> Column:
        """The same for a single value, without mining."""
        return value.isNotNull() & self.broken(self.verdict(mask(value)), value)


def malformed(rows: DataFrame, column: str, fmt: Format) -> DataFrame:
    """Rows whose non-null value breaks the format.

    The column's masks are mined and each mask gets its verdict once. The masks go to the rows where their measured size is at
    most BROADCAST_CHARS; else only dominant masks (more than a hundredth of the values, so at most a hundred) do, and rows
    of rarer masks meet their verdicts in a shuffle. The exact pattern sees only values of masks without a verdict. Repeated rows
    stay repeated; an empty table has no masks.
    """
    shaped = rows.where(F.col(column).isNotNull()).withColumn("__mask", mask(F.col(column)))
    mined = cut(shaped.groupBy("__mask").count())
    verdicts = mined.select("__mask", fmt.verdict(F.col("__mask")).alias("__verdict"))
    if (mined.agg(F.sum(F.length("__mask") + 16)).first()[0] or 0) <= BROADCAST_CHARS:
        judged = shaped.join(F.broadcast(verdicts), "__mask")
    else:
        judged = lookup(shaped, verdicts, "__mask", hot_keys(mined, "__mask"))
    return judged.where(fmt.broken(F.col("__verdict"), F.col(column))).select(*[F.col(f"`{c}`") for c in rows.columns])


def inconsistent(score: Column, total: Column, failed: Column, tolerance: float) -> Column:
    """True where a non-null score isn't 100·(total−failed)/total (100 for no records) within ``tolerance``.

    NaN is malformed; a null count proves nothing.
    """
    want = F.when(total == 0, 100.0).otherwise(100.0 * (total - failed) / F.nullif(total, F.lit(0)))
    residual = F.when(F.isnan(score), "nan").when(F.abs(score - want) <= tolerance, "0").when(want.isNull(), "0").otherwise("off")
    return score.isNotNull() & (residual != "0")


def load_figures(rows: DataFrame, load: str, columns: dict[str, Column], usable: dict[str, Column]) -> DataFrame:
    """One row a load and column: rows, nulls and the mean of ``columns`` over ``usable`` values. One aggregate a table."""
    aggs = [F.count("*").alias("baris")]
    for name, figure in columns.items():
        aggs += [F.count_if(F.col(name).isNull()).alias(f"{name}__nol"), F.avg(F.when(usable[name], figure)).alias(f"{name}__rata")]
    wide = rows.groupBy(F.col(load).cast("string").alias("muat")).agg(*aggs)
    parts = [
        F.struct(F.lit(n).alias("kolom"), F.col(f"{n}__nol").alias("nol"), F.col(f"{n}__rata").cast("double").alias("rata")) for n in columns
    ]
    return wide.select("muat", "baris", F.inline(F.array(*parts))).withColumn("bagian_nol", F.col("nol") / F.col("baris"))


def differing_loads(figures: DataFrame, null_gap: float, mean_gap: float) -> DataFrame:
    """Loads whose null share or mean is far from the median of all loads of the column."""
    middle = figures.groupBy("kolom").agg(F.median("bagian_nol").alias("nol_tengah"), F.median("rata").alias("rata_tengah"))
    far_null = F.abs(F.col("bagian_nol") - F.col("nol_tengah")) > null_gap
    far_mean = F.abs(F.col("rata") - F.col("rata_tengah")) > mean_gap * F.abs(F.col("rata_tengah"))
    return figures.join(middle, "kolom").where(far_null | F.coalesce(far_mean, F.lit(False)))


def profile(rows: DataFrame, load: str, columns: list[str] | None = None) -> DataFrame:
    """One row a load and column: rows, nulls, null share, distinct values (HyperLogLog++, 2 % error), smallest and largest
    value as text (numbers in numeric order; NaN is not in the range), mean length of texts. Classes of values: ``mask_shares``.

    All rows in one aggregate whose state does not grow with the rows. Arrays and structs are profiled as JSON.
    """
    kinds = {f.name: f.dataType.simpleString().split("(")[0] for f in rows.schema.fields}
    names = columns if columns is not None else [c for c in rows.columns if c != load]
    aggs = [F.count("*").alias("baris")]
    for k, name in enumerate(names):
        value = F.col(f"`{name}`")
        if kinds[name].startswith(("array", "struct", "map")):
            value = F.to_json(value)
        ranged = F.when(~F.isnan(value), value) if kinds[name] in ("float", "double") else value
        text = value.cast("string")
        aggs += [
            F.count(value).alias(f"n{k}"),
            F.approx_count_distinct(value, 0.02).alias(f"d{k}"),
            F.min(ranged).cast("string").alias(f"lo{k}"),
            F.max(ranged).cast("string").alias(f"hi{k}"),
            F.avg(F.length(text)).alias(f"len{k}"),
        ]
    wide = rows.groupBy(F.col(f"`{load}`").cast("string").alias("muat")).agg(*aggs)
    parts = [
        F.struct(
            F.lit(name).alias("kolom"),
            (F.col("baris") - F.col(f"n{k}")).alias("nol"),
            F.col(f"d{k}").alias("berbeda"),
            F.col(f"lo{k}").alias("terkecil"),
            F.col(f"hi{k}").alias("terbesar"),
            F.col(f"len{k}").alias("panjang_rata"),
        )
        for k, name in enumerate(names)
    ]
    return wide.select("muat", "baris", F.inline(F.array(*parts))).withColumn("bagian_nol", F.col("nol") / F.col("baris"))


def masks(rows: DataFrame, load: str, columns: list[str]) -> DataFrame:
    """Counts of masks per column and load. Arrays count by element, structs and maps as JSON, other values as text."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def cell(name: str, value: Column, kind: str) -> Column:
        value = F.to_json(value) if kind.startswith(("array", "struct", "map")) else value.cast("string")
        return F.struct(F.lit(name).alias("kolom"), value.alias("nilai"))

    def cells(name: str) -> Column:
        return F.transform(F.coalesce(F.col(f"`{name}`"), F.array()), lambda x: cell(name, x, kinds[name][6:-1]))

    parts = [F.array(*[cell(c, F.col(f"`{c}`"), kinds[c]) for c in columns if not kinds[c].startswith("array")])]
    parts += [cells(c) for c in columns if kinds[c].startswith("array")]
    long = rows.select(F.col(f"`{load}`").cast("string").alias("muat"), F.inline(F.concat(*parts) if len(parts) > 1 else parts[0]))
    long = long.where(F.col("nilai").isNotNull()).withColumn("topeng", mask(F.col("nilai")))
    return long.groupBy("kolom", "muat", "topeng").agg(F.count("*").alias("baris"))


def mask_shares(counts: DataFrame) -> DataFrame:
    """Each mask of a column with its rows and its share of the column's values."""
    by_mask = counts.groupBy("kolom", "topeng").agg(F.sum("baris").alias("baris"))
    total = counts.groupBy("kolom").agg(F.sum("baris").alias("semua"))
    return by_mask.join(total, "kolom").withColumn("bagian", F.col("baris") / F.col("semua")).select("kolom", "topeng", "baris", "bagian")


def rare_masks(counts: DataFrame, share: float = RARE) -> DataFrame:
    """Masks that hold less than ``share`` of their column's values, with their rows and share."""
    return mask_shares(counts).where(F.col("bagian") < share)


def divergence(counts: DataFrame) -> DataFrame:
    """Jensen-Shannon divergence (bits) of each load's mask distribution from that of the column's other loads.

    A load that is alone has no other and gets null.
    """
    load = counts.groupBy("kolom", "muat").agg(F.sum("baris").alias("n"))
    column = counts.groupBy("kolom").agg(F.sum("baris").alias("semua"))
    by_mask = counts.groupBy("kolom", "topeng").agg(F.sum("baris").alias("m"))
    cells = counts.join(by_mask, ["kolom", "topeng"]).join(load.join(column, "kolom"), ["kolom", "muat"])
    p = F.col("baris") / F.col("n")
    q = (F.col("m") - F.col("baris")) / (F.col("semua") - F.col("n"))
    mid = (p + q) / 2
    # Masks the load lacks add q/2 bit each; they are summed as the rest of the other loads' mass.
    seen = cells.where(F.col("semua") > F.col("n")).select("kolom", "muat", p.alias("p"), q.alias("q"), mid.alias("mid"))
    term = 0.5 * F.col("p") * F.log2(F.col("p") / F.col("mid")) + F.when(F.col("q") > 0, 0.5 * F.col("q") * F.log2(F.col("q") / F.col("mid"))).otherwise(0.0)
    js = seen.groupBy("kolom", "muat").agg((F.sum(term) + 0.5 * (1 - F.sum("q"))).alias("divergensi"))
    return load.join(js, ["kolom", "muat"], "left").select("kolom", "muat", F.col("n").alias("baris"), "divergensi")
