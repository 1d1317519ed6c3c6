"""Schemas that drift between files: one consistent table and a report of each change.

Every record is read as a map of tagged values (JSON variants), so that a path keeps all the types it ever had: whole number,
number with a decimal point, string, boolean, object, array. Parallel schemas are fused per column: headers that mean the
same column by its known names, by a spelling near to one of them, or by its values. Where the types of a column conflict,
the consistent table holds one typed branch a type beside the canonical text. Appearing types are reported with the file that brings them.

Distribution: reading is map-only; what is known of a header in a file is one map-side combined aggregate, and everything
after it works on rows of files x headers, by windows over senders' periods. A sender with a third of all records has no
more rows there than it has files and headers.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lumbung.operators.profile import mask
from lumbung.operators.skew import hot_keys, lookup
from lumbung.session import cut

WHOLE, POINT, STRING, BOOLEAN, OBJECT, ARRAY = TAGS = ("bulat", "desimal", "string", "boolean", "objek", "larik")
MAX_COLUMNS = 2_000
INNER = ("jumlah", "nilai", "nama")  # what counts of an object, in this order


@dataclass(frozen=True)
class Layout:
    """Columns of the consistent table, their known other headers, and the columns that keep typed branches."""

    columns: tuple[str, ...]
    names: dict[str, tuple[str, ...]] = field(default_factory=dict)
    branches: tuple[str, ...] = ()
    amounts: tuple[str, ...] = ()  # columns whose canonical form is a whole amount of money
    overlap: float = 0.6  # share of a header's values that must be known values of a column


def squash(header: str) -> str:
    return re.sub(r"[^a-z0-9]", "", re.sub(r"\([^)]*\)", "", header.lower()))


def squashed(header: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(header), r"\([^)]*\)", ""), r"[^a-z0-9]", "")


def by_name(header: Column, layout: Layout) -> Column:
    """Column meant by a header's known name, or by one letter more, less or other than a name of at least six; else null."""
    known = {squash(h): c for c in layout.columns for h in (c, *layout.names.get(c, ()))}
    key = squashed(header)
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    near = F.lit(None).cast("string")
    for name, column in known.items():
        if len(name) >= 6:
            near = F.coalesce(near, F.when(F.levenshtein(key, F.lit(name), 1) == 1, F.lit(column)))
    return F.when(key != "", F.coalesce(F.try_element_at(table, key), near))


def tag(value: Column) -> Column:
    """Type tag of a variant; null for JSON null."""
    return tag_of(F.schema_of_variant(value))


def tag_of(kind: Column) -> Column:
    """Type tag of a variant's schema."""
    wide = F.regexp_extract(kind, r"^DECIMAL\((\d+),0\)$", 1)
    return (
        F.when(kind == "BIGINT", WHOLE)
        .when((wide != "") & (F.try_to_number(wide, F.lit("99")) > 18), WHOLE)  # a whole number beyond 64 bits
        .when(kind.rlike("^(DECIMAL|DOUBLE|FLOAT)"), POINT)
        .when(kind == "STRING", STRING)
        .when(kind == "BOOLEAN", BOOLEAN)
        .when(kind.startswith("OBJECT"), OBJECT)
        .when(kind.startswith("ARRAY"), ARRAY)
    )


def record_map(text: Column) -> Column:
    """A record as map from header to variant; null for what isn't a JSON object."""
    return F.from_json(text, T.MapType(T.StringType(), T.VariantType()))


def headers(raw: DataFrame, file: str, record: str) -> DataFrame:
    """Per file and header: records that have it, non-null values by type, and the type of most (ties: in the order of TAGS)."""
    cells = raw.select(F.col(file), F.explode(record_map(F.col(record))).alias("header", "nilai"))
    cells = cells.select(file, "header", F.schema_of_variant("nilai").alias("skema"))  # apart, so that it is found once a value
    tagged = cells.select(file, "header", tag_of(F.col("skema")).alias("tag"))
    counted = tagged.groupBy(file, "header").agg(F.count("*").alias("rekaman"), *[F.count_if(F.col("tag") == t).alias(t) for t in TAGS])
    most = F.greatest(*[F.col(t) for t in TAGS])
    kind = F.lit(None).cast("string")
    for t in TAGS:
        kind = F.coalesce(kind, F.when((most > 0) & (F.col(t) == most), t))
    return counted.withColumn("tipe", kind)


def shape(text: Column) -> Column:
    """How a value is built: digits and closing zeros of a number, else its mask without the number of words and digits, and
    the magnitude of its length."""
    whole = F.regexp_extract(text, r"^([0-9]+)(\.[0-9]+)?$", 1)
    zeros = F.least(F.lit(4), F.length(F.regexp_extract(whole, "(0*)$", 1)))
    number = F.concat(F.lit("#"), F.length(whole).cast("string"), F.lit("z"), zeros.cast("string"))
    words = F.regexp_replace(F.regexp_replace(mask(text), r"A(?:[ .'-]*A)*", "A"), "9+", "9")
    return F.when(whole != "", number).otherwise(F.concat(F.substring(words, 1, 24), F.lit("|"), F.floor(F.log2(F.length(text))).cast("string")))


def by_values(raw: DataFrame, seen: DataFrame, file: str, record: str, layout: Layout) -> DataFrame:
    """Columns meant by headers of unknown name, from their values: (header, kolom, nilai).

    ``seen`` has the headers of each file with ``__named``, the column of a known name or null. A header can only mean a column
    that none of its files has by name. It means it if its values are the column's: most are (``layout.overlap``, at least
    three); or as many as the column's own files share among one another (half of that, where files share values at all),
    and both are built alike; or, for columns whose files share hardly any value, both are built nearly alike. The
    best of several columns is taken.
    """
    known = seen.select("header", F.col("__named").alias("kolom")).distinct()
    if not known.where(F.col("kolom").isNull()).head(1):
        return known.limit(0).withColumn("nilai", F.lit(0.0))
    cells = raw.select(F.col(file).alias("__file"), F.explode(record_map(F.col(record))).alias("header", "__v"))
    kind, value = F.col("__kind"), F.col("__v")
    text = F.try_variant_get(value, "$", "string")
    inner = F.coalesce(*[F.try_variant_get(value, f"$.{k}", "string") for k in INNER], text)
    parts = F.when(kind.startswith("ARRAY"), F.try_variant_get(value, "$", "array<string>")).otherwise(F.array(F.when(kind.startswith("OBJECT"), inner).otherwise(text)))
    texts = cells.withColumn("__kind", F.schema_of_variant("__v")).where("__kind <> 'VOID'").select("__file", "header", F.explode(parts).alias("t"))
    texts = texts.select("__file", "header", F.lower(F.trim("t")).alias("t")).where("t <> ''")
    texts = texts.withColumn("t", F.when(F.col("t").rlike(r"^(rp|idr)?[ .]*[0-9]"), amount(F.col("t"))).otherwise(F.col("t")))
    label, is_known = F.coalesce("kolom", "header").alias("label"), F.col("kolom").isNotNull().alias("known")
    pieces = texts.distinct().join(known, "header").select("__file", "t", label, is_known).distinct()
    pieces = cut(pieces.groupBy("known", "label", "t").agg(F.count("*").alias("n")))
    # A value's labels are columns and headers: a bounded list, whatever the number of rows.
    met = pieces.groupBy("t").agg(F.collect_list(F.struct("known", "label", "n")).alias("all"))
    met = met.select(F.explode("all").alias("a"), F.filter("all", lambda x: x["known"]).alias("columns"))
    pairs = met.select("a", F.explode("columns").alias("b")).where(~F.col("a.known") | (F.col("a.label") == F.col("b.label")))
    often = F.when(F.col("a.known"), F.when(F.col("a.n") > 1, F.col("a.n")).otherwise(0)).otherwise(F.col("a.n"))
    shared = pairs.groupBy(F.col("a.known").alias("known"), F.col("a.label").alias("label"), F.col("b.label").alias("column")).agg(F.sum(often).alias("shared"), F.count("*").alias("values"))
    total = pieces.groupBy("known", "label").agg(F.sum("n").alias("total"))
    shared = shared.join(total, ["known", "label"]).withColumn("share", F.col("shared") / F.col("total"))
    built = pieces.groupBy("known", "label", shape(F.col("t")).alias("shape")).agg(F.sum("n").alias("n")).join(total, ["known", "label"])
    built = built.withColumn("p", F.col("n") / F.col("total"))
    of = lambda known, name: built.where("known" if known else "NOT known").select("shape", F.col("label").alias(name), F.col("p").alias(f"p_{name}"), F.col("total").alias(f"total_{name}"))
    alike = of(False, "header").join(of(True, "kolom"), "shape").groupBy("header", "kolom", "total_header").agg(F.sum(F.least("p_header", "p_kolom")).alias("alike"))
    own = shared.where("known").select(F.col("label").alias("kolom"), F.col("share").alias("self"))
    values = shared.where("NOT known").select(F.col("label").alias("header"), F.col("column").alias("kolom"), "share", "values")
    beside = seen.where(F.col("__named").isNotNull()).select(file, F.col("__named").alias("kolom"))
    beside = seen.where(F.col("__named").isNull()).select(file, "header").join(beside, file).select("header", "kolom").distinct()
    judged = values.join(alike, ["header", "kolom"], "full").join(own, "kolom", "left").join(beside, ["header", "kolom"], "left_anti")
    judged = judged.fillna(0.0, ["share", "alike", "self"]).fillna(0, ["values", "total_header"])
    same = (F.col("share") >= layout.overlap) & (F.col("values") >= 3)
    as_own = (F.col("self") >= 0.05) & (F.col("share") >= 0.5 * F.col("self")) & (F.col("alike") >= 0.3)
    built_alike = (F.col("self") < 0.05) & (F.col("alike") >= 0.6) & (F.col("total_header") >= 8)
    score = (F.col("share") + F.col("alike")).alias("nilai")
    good = judged.where(same | as_own | built_alike).select("header", "kolom", score)
    return good.groupBy("header").agg(F.max_by(F.struct("kolom", "nilai"), F.struct("nilai", "kolom")).alias("b")).select("header", "b.kolom", "b.nilai")


def fused(raw: DataFrame, file: str, record: str, layout: Layout) -> DataFrame:
    """``headers`` with the column ``kolom`` that each header means in its file; a field the layout lacks keeps its header.

    Two headers of a file that mean one column: the column's own name, else the one whose values are more the column's, else the
    one with more records, is it; the other stays a field of its own.
    """
    seen = headers(raw, file, record).withColumn("__named", by_name(F.col("header"), layout))
    seen = cut(seen)
    guessed = by_values(raw, seen, file, record, layout).withColumnsRenamed({"kolom": "__guess", "nilai": "__score"})
    meant = seen.join(guessed, "header", "left").withColumn("__meant", F.coalesce("__named", "__guess"))
    rank = F.row_number().over(
        Window.partitionBy(file, "__meant").orderBy(
            F.col("__named").isNull(), (F.col("header") != F.col("__meant")), F.col("__score").desc(), F.col("rekaman").desc(), F.col("header")
        )
    )
    column = F.when(F.col("__meant").isNotNull() & (rank == 1), F.col("__meant")).otherwise(F.col("header"))
    return meant.withColumn("kolom", column).drop("__named", "__guess", "__meant", "__score")


def counting_files(raw: DataFrame, file: str, sender: str, period: str, loaded: str) -> DataFrame:
    """The last loaded file of each sender and period (ties: the larger file number), numbered by period, with the next one."""
    files = raw.where(F.col(sender).isNotNull() & F.col(period).isNotNull()).groupBy(file, sender, period).agg(F.max(loaded).alias("__loaded"))
    last = files.groupBy(sender, period).agg(F.max_by(file, F.struct("__loaded", file)).alias(file))
    order = Window.partitionBy(sender).orderBy(period)
    return last.withColumn("__seq", F.row_number().over(order)).withColumn("__next", F.lead(file).over(order))


def changes(raw: DataFrame, file: str, sender: str, period: str, loaded: str, record: str, layout: Layout) -> DataFrame:
    """Changes of each counting file against the sender's previous one: file, kolom, perubahan ('added', 'removed', 'renamed',
    'retyped'), with the header and type before and after.

    Records that are no JSON objects have no fields. A file none of whose records has a field has no headers and then lacks
    every column. Empty tables give no changes.
    """
    files = counting_files(raw, file, sender, period, loaded)
    present = fused(raw, file, record, layout).join(files, file)
    order = Window.partitionBy(sender, "kolom").orderBy("__seq")
    known = F.last("tipe", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    rows = present.withColumn("__type", known)
    rows = rows.select(
        "*",
        F.lag("__seq").over(order).alias("__before"),
        F.lag("header").over(order).alias("header_dulu"),
        F.lag("__type").over(order).alias("tipe_dulu"),
        F.lead("__seq").over(order).alias("__after"),
    )
    follows = F.col("__before") == F.col("__seq") - 1
    lost = F.col("__next").isNotNull() & (F.coalesce(F.col("__after"), F.lit(-1)) != F.col("__seq") + 1)
    events = F.array(
        F.when((F.col("__seq") > 1) & ~F.coalesce(follows, F.lit(False)), F.struct(F.col(file).alias("b"), F.lit("added").alias("p"))),
        F.when(lost, F.struct(F.col("__next").alias("b"), F.lit("removed").alias("p"))),
        F.when(follows & (F.col("header") != F.col("header_dulu")), F.struct(F.col(file).alias("b"), F.lit("renamed").alias("p"))),
        F.when(follows & (F.col("tipe") != F.col("tipe_dulu")), F.struct(F.col(file).alias("b"), F.lit("retyped").alias("p"))),
    )
    return rows.withColumn("__e", F.explode(F.array_compact(events))).select(
        F.col("__e.b").alias(file), "kolom", F.col("__e.p").alias("perubahan"), sender, period, "header", "header_dulu", F.col("__type").alias("tipe"), "tipe_dulu"
    )


def alternatives(raw: DataFrame, file: str, record: str, layout: Layout) -> DataFrame:
    """The tagged union of each column: one row a column and type, with its values, files and the first file that has it."""
    cells = F.array(*[F.struct(F.lit(t).alias("tipe"), F.col(t).alias("nilai")) for t in TAGS])
    long = fused(raw, file, record, layout).select(file, "kolom", "header", F.inline(cells)).where(F.col("nilai") > 0)
    return long.groupBy("kolom", "tipe").agg(
        F.sum("nilai").alias("nilai"), F.countDistinct(file).alias("berkas"), F.countDistinct("header").alias("header"), F.min(file).alias("berkas_pertama")
    )


def cell(value: Column) -> Column:
    """A variant as (tipe, teks, kanon): its type, its text and its canonical text.

    Lists are joined by ', '; of an object its amount or name counts, else its JSON.
    """
    kind = tag(value)
    text = F.try_variant_get(value, "$", "string")
    inner = F.coalesce(*[F.try_variant_get(value, f"$.{k}", "string") for k in INNER], text)
    items = F.coalesce(F.array_join(F.try_variant_get(value, "$", "array<string>"), ", "), text)
    plain = F.when(kind == ARRAY, items).when(kind == OBJECT, inner).otherwise(text)
    return F.struct(kind.alias("tipe"), text.alias("teks"), plain.alias("kanon"))


def amount(text: Column) -> Column:
    """Whole digits of 'Rp 1.250.000,00', 'IDR 1,250,000.00', '1250000.25', '0.125E7', '12 juta'; a text that holds no amount
    stays as it is."""
    bare = F.trim(F.regexp_replace(F.lower(text), r"rp\.?|idr", ""))
    millions = F.regexp_extract(bare, r"^([0-9]+(?:[.,][0-9]+)?)\s*(?:juta|jt)$", 1)
    grouped = F.regexp_extract(bare, r"^([0-9]{1,3}(?:\.[0-9]{3})+)(?:,[0-9]*)?$", 1)
    english = F.regexp_extract(bare, r"^([0-9]{1,3}(?:,[0-9]{3})+(?:\.[0-9]*)?)$", 1)
    number = F.regexp_extract(bare, r"^([0-9]+(?:\.[0-9]+)?(?:e[+-]?[0-9]+)?)$", 1)
    value = F.coalesce(
        F.try_multiply(F.regexp_replace(millions, ",", ".").try_cast("double"), F.lit(1e6)),
        F.regexp_replace(grouped, r"\.", "").try_cast("double"),
        F.regexp_replace(english, ",", "").try_cast("double"),
        number.try_cast("double"),
    )
    return F.coalesce(F.round(value).try_cast("bigint").cast("string"), text)


def consistent(raw: DataFrame, file: str, record: str, layout: Layout) -> DataFrame:
    """Every record of every file in the layout's columns, other columns of ``raw`` kept, then typed branches ("Usulan Biaya
    [bulat]", ...) and further columns for the fields that the layout lacks, named by their headers.

    No record is lost: one that is no JSON object has null columns and stays readable in ``record``. The headers of all files
    (schema, not data) are collected; more than MAX_COLUMNS further columns are refused. Further columns whose
    names clash but for case with others get a number.
    """
    mapping = fused(raw, file, record, layout).select(file, F.struct("header", "kolom").alias("__m"))
    extra = sorted(
        r[0] for r in mapping.select("__m.kolom").where(~F.col("kolom").isin(list(layout.columns))).distinct().limit(MAX_COLUMNS + 1).collect()
    )
    if len(extra) > MAX_COLUMNS:
        raise ValueError(f"more than {MAX_COLUMNS} further columns")
    per_file = mapping.groupBy(file).agg(F.map_from_entries(F.collect_list("__m")).alias("__names"))  # at most the headers of a file
    often = hot_keys(raw.groupBy(file).count(), file)  # a file may hold a third of all records
    rows = lookup(raw, per_file, file, often, "left").withColumn("__record", record_map(F.col(record)))
    meant = F.map_from_entries(
        F.transform(F.map_entries("__record"), lambda e: F.struct(F.coalesce(F.try_element_at(F.col("__names"), e["key"]), e["key"]), e["value"]))
    )
    rows = rows.withColumn("__cells", F.transform_values(meant, lambda _, v: cell(v)))
    taken = {c.lower() for c in (*raw.columns, *layout.columns)}
    out = [F.col(f"`{c}`") for c in raw.columns]
    for column in layout.columns:
        text = F.try_element_at("__cells", F.lit(column))["kanon"]
        out.append((amount(text) if column in layout.amounts else text).alias(column))
    for column in layout.branches:
        found = F.try_element_at("__cells", F.lit(column))
        for t in TAGS:
            name = f"{column} [{t}]"
            taken.add(name.lower())
            kind = {WHOLE: "bigint", POINT: "double", BOOLEAN: "boolean"}.get(t, "string")
            out.append(F.when(found["tipe"] == t, found["teks"].try_cast(kind)).alias(name))
    for column in extra:
        name, k = column, 2
        while name.lower() in taken:
            name, k = f"{column} ({k})", k + 1
        taken.add(name.lower())
        out.append(F.try_element_at("__cells", F.lit(column))["kanon"].alias(name))
    return rows.select(*out)
