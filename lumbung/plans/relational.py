"""Relational operators over the star-schema tables, each with its oracle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumbung.functions import text
from lumbung.operators import joins
from lumbung.session import table

QUERIES = {}
ORACLE = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1997-01-01'")
def scan_project(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").where((F.col("o_orderstatus") == "F") & (F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp")))
    return rows.select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS tahun FROM orders ORDER BY tahun")
def distinct_years(spark, sf):
    return table(spark, sf, "orders").select(F.year("o_orderdate").alias("tahun")).distinct().orderBy("tahun")


_BLANK = r"[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


@query(rf"""SELECT doc_id, teks FROM (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '{_BLANK}', ' ', 'g'), '^ ', ''), ' $', '') AS teks FROM documents)
    WHERE teks <> '' AND lower(teks) NOT IN ('nan', 'none', 'null', 'n/a', 'na', '-', 'nat', 'tidak ada')""")
def norm_ws_filter(spark, sf):
    """All texts that are not null, blank or a stand-in for null, with every run of Unicode white space as one blank."""
    rows = table(spark, sf, "documents").select("doc_id", text.normalize_space(F.col("text")).alias("teks"))
    return rows.where(F.col("teks").isNotNull())


@query()
def norm_ws(spark, sf):
    """Upper case and ASCII white space collapsed, over all texts that are not blank; no SQL, since engines differ in upper case outside ASCII."""
    rows = table(spark, sf, "documents").where(F.col("text").isNotNull() & (F.trim("text") != ""))
    return rows.select("doc_id", F.upper(F.trim(F.regexp_replace("text", r"[\t\n\f\r ]+", " "))).alias("teks"))


@query("""SELECT n_nationkey, upper(coalesce(nullif(trim(CASE WHEN n_nationkey % 3 = 0 THEN ' ' WHEN n_nationkey % 3 = 1 THEN NULL ELSE n_name END), ''), 'Tidak tercatat')) AS label
    FROM nation""")
def default_label(spark, sf):
    dirty = F.when(F.col("n_nationkey") % 3 == 0, " ").when(F.col("n_nationkey") % 3 == 1, None).otherwise(F.col("n_name"))
    return table(spark, sf, "nation").select("n_nationkey", F.upper(F.coalesce(F.nullif(F.trim(dirty), F.lit("")), F.lit("Tidak tercatat"))).alias("label"))


@query("SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, l_linenumber, CAST(floor(l_extendedprice / nullif(CASE WHEN l_linenumber % 5 = 0 THEN 0 ELSE l_quantity END, 0) * 100) AS BIGINT) AS per_unit FROM lineitem")
def ratio_column(spark, sf):
    quantity = F.when(F.col("l_linenumber") % 5 == 0, 0).otherwise(F.col("l_quantity"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.floor(F.try_divide(F.col("l_extendedprice"), quantity) * 100).alias("per_unit"))


@query("""SELECT c_custkey, n_nationkey FROM (SELECT c_custkey, '  ' || upper(n_name) || ' ' AS typed FROM customer JOIN nation ON c_nationkey = n_nationkey) c
    LEFT JOIN nation n ON lower(trim(c.typed)) = lower(trim(n.n_name))""")
def left_join_normalized_key(spark, sf):
    nation = table(spark, sf, "nation")
    typed = table(spark, sf, "customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    typed = typed.select("c_custkey", F.concat(F.lit("  "), F.upper("n_name"), F.lit(" ")).alias("typed"))
    return joins.normalized_join(typed, nation.select("n_nationkey", "n_name"), "typed", "n_name").select("c_custkey", "n_nationkey")


@query("""SELECT l_orderkey, l_linenumber, o_custkey, s_nationkey FROM lineitem
    LEFT JOIN orders ON l_orderkey = o_orderkey AND CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE l_linestatus END = o_orderstatus
    LEFT JOIN supplier ON l_suppkey = s_suppkey""")
def composite_left_join(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("status", F.when(F.col("l_linenumber") % 4 != 0, F.col("l_linestatus")))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    out = lines.join(orders, (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("status") == F.col("o_orderstatus")), "left")
    return out.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"), "left").select("l_orderkey", "l_linenumber", "o_custkey", "s_nationkey")


_PEOPLE = """(SELECT c_custkey, c_name AS nama, CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 7 = 1 THEN '0' ELSE CAST(c_custkey AS VARCHAR) END AS nip FROM customer)"""
_ORDERED = """(SELECT o_orderkey, 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS nama,
    CASE WHEN o_custkey % 7 IN (0, 1) AND o_orderkey % 2 = 0 THEN '0' WHEN o_custkey % 7 IN (0, 1) THEN NULL WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS nip FROM orders)"""


@query(f"""SELECT o.o_orderkey, c.c_custkey FROM {_ORDERED} o JOIN {_PEOPLE} c ON o.nip = c.nip AND o.nip IS NOT NULL AND o.nip <> '0'
    UNION ALL SELECT o.o_orderkey, c.c_custkey FROM (SELECT * FROM {_ORDERED} WHERE nip IS NULL OR nip = '0') o
    JOIN (SELECT * FROM {_PEOPLE} WHERE nip IS NULL OR nip = '0') c ON o.nama = c.nama
    UNION ALL SELECT o.o_orderkey, NULL FROM {_ORDERED} o WHERE NOT EXISTS (SELECT 1 FROM {_PEOPLE} c WHERE o.nip = c.nip AND o.nip <> '0')
    AND NOT ((o.nip IS NULL OR o.nip = '0') AND EXISTS (SELECT 1 FROM {_PEOPLE} c WHERE (c.nip IS NULL OR c.nip = '0') AND c.nama = o.nama))""")
def disjunctive_entity_join(spark, sf):
    c = F.col("c_custkey")
    people = table(spark, sf, "customer").select(
        c, F.col("c_name").alias("d_nama"), F.when(c % 7 == 0, None).when(c % 7 == 1, "0").otherwise(c.cast("string")).alias("d_nip")
    )
    o, missing = F.col("o_custkey"), (F.col("o_custkey") % 7).isin(0, 1)
    ordered = table(spark, sf, "orders").select(
        "o_orderkey",
        F.concat(F.lit("Customer#"), F.lpad(o.cast("string"), 9, "0")).alias("nama"),
        F.when(missing & (F.col("o_orderkey") % 2 == 0), "0").when(missing | (F.col("o_orderkey") % 5 == 0), None).otherwise(o.cast("string")).alias("nip"),
    )
    return joins.entity_join(ordered, people, ("nip", "d_nip"), ("nama", "d_nama")).select("o_orderkey", "c_custkey")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def anti_join_new_members(spark, sf):
    known = table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf, "customer").join(known, "c_custkey", "left_anti").select("c_custkey", "c_name")


@query("""SELECT count(*) AS unmatched FROM (SELECT CASE WHEN p_partkey % 17 = 0 THEN 'zzz' ELSE p_type END AS t FROM part) p
    LEFT JOIN (SELECT DISTINCT p_type FROM part) r ON lower(trim(p.t)) = lower(trim(r.p_type)) WHERE r.p_type IS NULL""")
def anti_as_left_count(spark, sf):
    part = table(spark, sf, "part")
    typed = part.select(joins.normalized(F.when(F.col("p_partkey") % 17 == 0, "zzz").otherwise(F.col("p_type"))).alias("k"))
    return typed.join(part.select(joins.normalized(F.col("p_type")).alias("k")).distinct(), "k", "left_anti").agg(F.count("*").alias("unmatched"))


@query("""SELECT count(*) AS rows FROM lineitem WHERE (l_orderkey, l_linenumber) IN (SELECT (l_orderkey, l_linenumber) FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""")
def dup_rows_semi(spark, sf):
    return joins.duplicate_rows(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""SELECT count(*) FILTER (WHERE a_in_t AND t_in_a) AS both_swapped, count(*) FILTER (WHERE a_in_t AND NOT t_in_a) AS brand_only,
    count(*) FILTER (WHERE t_in_a AND NOT a_in_t) AS type_only, count(*) AS total FROM (SELECT
    coalesce(a IN (SELECT p_type FROM part), false) AS a_in_t, coalesce(t IN (SELECT p_brand FROM part), false) AS t_in_a FROM (
    SELECT CASE WHEN p_partkey % 11 = 0 THEN p_type WHEN p_partkey % 13 = 0 THEN NULL ELSE p_brand END AS a,
           CASE WHEN p_partkey % 11 = 0 OR p_partkey % 13 = 0 THEN p_brand ELSE p_type END AS t FROM part))""")
def self_role_lookup(spark, sf):
    part, k = table(spark, sf, "part"), F.col("p_partkey")
    swapped = part.select(
        F.when(k % 11 == 0, F.col("p_type")).when(k % 13 == 0, None).otherwise(F.col("p_brand")).alias("a"),
        F.when((k % 11 == 0) | (k % 13 == 0), F.col("p_brand")).otherwise(F.col("p_type")).alias("t"),
    )
    types = part.select(F.col("p_type").alias("a"), F.lit(True).alias("a_in_t")).distinct()
    brands = part.select(F.col("p_brand").alias("t"), F.lit(True).alias("t_in_a")).distinct()
    flagged = swapped.join(types, "a", "left").join(brands, "t", "left").fillna(False, ["a_in_t", "t_in_a"])
    a, t = F.col("a_in_t"), F.col("t_in_a")
    return flagged.agg(F.count_if(a & t).alias("both_swapped"), F.count_if(a & ~t).alias("brand_only"), F.count_if(t & ~a).alias("type_only"), F.count("*").alias("total"))


@query("""SELECT s_name, p_type, count(DISTINCT l_orderkey) AS orders FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_name, p_type, p_brand""")
def star_inner_count_distinct(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    star = (
        lines.join(table(spark, sf, "orders").select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf, "part").select("p_partkey", "p_type", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf, "supplier").select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    return star.groupBy("s_name", "p_type", "p_brand").agg(F.countDistinct("l_orderkey").alias("orders")).select("s_name", "p_type", "orders")


@query("""SELECT c_name, count(DISTINCT CASE WHEN o_orderpriority LIKE '1%' THEN o_orderkey END) AS urgent,
    count(DISTINCT CASE WHEN o_orderpriority LIKE '5%' THEN o_orderkey END) AS low, count(DISTINCT o_orderkey) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F' GROUP BY c_name""")
def multi_count_distinct_case(spark, sf):
    rows = table(spark, sf, "orders").where("o_orderstatus = 'F'").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    one = lambda p: F.countDistinct(F.when(F.col("o_orderpriority").startswith(p), F.col("o_orderkey")))
    return rows.groupBy("c_name").agg(one("1").alias("urgent"), one("5").alias("low"), F.countDistinct("o_orderkey").alias("total"))


@query("""SELECT o_orderkey, c_name, top FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS top, max(l_suppkey) AS s FROM lineitem GROUP BY l_orderkey) l ON o_orderkey = l_orderkey
    LEFT JOIN customer ON coalesce(CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey END, s) = c_custkey WHERE o_orderstatus = 'O'""")
def coalesce_key_join(spark, sf):
    top = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("top"), F.max("l_suppkey").alias("s"))
    rows = table(spark, sf, "orders").where("o_orderstatus = 'O'").join(top, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    rows = rows.withColumn("k", F.coalesce(F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey")), F.col("s")))
    return rows.join(table(spark, sf, "customer"), F.col("k") == F.col("c_custkey"), "left").select("o_orderkey", "c_name", "top")


@query("""SELECT l_returnflag, round(stddev_pop(l_quantity), 6) AS sd, round(avg(l_quantity), 6) AS mean, count(*) AS n FROM lineitem GROUP BY l_returnflag""")
def population_deviation(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.round(F.stddev_pop("l_quantity"), 6).alias("sd"), F.round(F.avg("l_quantity"), 6).alias("mean"), F.count("*").alias("n")
    )


@query("""SELECT event_id FROM events, (SELECT avg(value) AS m, stddev_pop(value) AS s FROM events) WHERE value > 0 AND s > 0 AND abs((value - m) / s) < 1.5""")
def zscore_filter(spark, sf):
    events = table(spark, sf, "events")
    mean, deviation = (events.agg(f("value")).scalar() for f in (F.avg, F.stddev_pop))
    score = F.abs(F.try_divide(F.col("value") - mean, deviation))
    return events.where((F.col("value") > 0) & (score < 1.5)).select("event_id")


@query("""SELECT least(CAST(floor((l_quantity - lo) / ((hi - lo) / 22)) AS INTEGER), 21) AS bin, count(*) AS n
    FROM lineitem, (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem) GROUP BY bin""")
def histogram_bins(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_quantity")
    lo, hi = lines.agg(F.min("l_quantity"), F.max("l_quantity")).first()
    width = F.lit((hi - lo) / 22)
    return lines.groupBy(F.least(F.floor((F.col("l_quantity") - lo) / width).cast("int"), F.lit(21)).alias("bin")).agg(F.count("*").alias("n"))


@query("""SELECT l_returnflag, CAST(sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS o, CAST(sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS f,
    CAST(sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) + sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS total FROM lineitem GROUP BY l_returnflag""")
def conditional_sums(spark, sf):
    o, f = F.count_if(F.col("l_linestatus") == "O"), F.count_if(F.col("l_linestatus") == "F")
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(o.alias("o"), f.alias("f"), (o + f).alias("total"))


@query("SELECT p_brand, p_name FROM (SELECT p_brand, p_name, row_number() OVER (PARTITION BY p_brand ORDER BY length(p_name) DESC, p_name) AS rn FROM part) WHERE rn = 1")
def canonical_by_window(spark, sf):
    # One aggregate with a two-part order: map-side combined, no sort of whole groups.
    return table(spark, sf, "part").groupBy("p_brand").agg(F.min_by("p_name", F.struct(-F.length("p_name"), F.col("p_name"))).alias("p_name"))


@query("SELECT l_suppkey, l_orderkey, rn FROM (SELECT l_suppkey, l_orderkey, CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS INTEGER) AS rn FROM lineitem) WHERE rn <= 3")
def top_rows_per_group(spark, sf):
    w = Window.partitionBy("l_suppkey").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber")
    return table(spark, sf, "lineitem").withColumn("rn", F.row_number().over(w)).where("rn <= 3").select("l_suppkey", "l_orderkey", "rn")


@query("SELECT n_name, count(*) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name ORDER BY total DESC, n_name LIMIT 5")
def top5_groups(spark, sf):
    rows = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.join(F.broadcast(table(spark, sf, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.groupBy("n_name").agg(F.count("*").alias("total")).orderBy(F.desc("total"), "n_name").limit(5)


@query("SELECT c_name AS name, c_nationkey AS nation FROM customer UNION ALL SELECT s_name, s_nationkey FROM supplier UNION ALL SELECT n_name, n_nationkey FROM nation")
def union_all_three(spark, sf):
    parts = [
        table(spark, sf, t).select(F.col(f"{k}_name").alias("name"), F.col(f"{k}_nationkey").alias("nation")) for t, k in (("customer", "c"), ("supplier", "s"), ("nation", "n"))
    ]
    return reduce(DataFrame.unionByName, parts)


@query("SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation")).union(table(spark, sf, "supplier").select("s_nationkey")).distinct()


@query("""SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL AS size FROM customer
    UNION ALL SELECT p_partkey, p_name, NULL, p_size FROM part""")
def union_missing_cols(spark, sf):
    a = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    b = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("size"))
    return a.unionByName(b, allowMissingColumns=True)


@query("""SELECT value, side FROM (SELECT DISTINCT p_brand AS value, 'unexpected' AS side FROM part WHERE p_brand NOT IN (SELECT 'Brand#' || CAST(i AS VARCHAR) FROM range(11, 30) t(i))
    UNION ALL SELECT 'Brand#' || CAST(i AS VARCHAR), 'missing' FROM range(11, 30) t(i) WHERE 'Brand#' || CAST(i AS VARCHAR) NOT IN (SELECT p_brand FROM part))""")
def expected_values(spark, sf):
    expected = spark.range(11, 30).select(F.concat(F.lit("Brand#"), F.col("id").cast("string")).alias("value"))
    return joins.same_values(table(spark, sf, "part"), "p_brand", expected)


@query("""SELECT id, z[1] AS nama, z[2] AS nip FROM (SELECT id, unnest(list_zip(nama_anggota_dosen, nip_anggota_dosen)) AS z FROM silver_penelitian
    WHERE nama_anggota_dosen IS NOT NULL AND nip_anggota_dosen IS NOT NULL)""")
def zip_explode_members(spark, sf):
    return joins.members(table(spark, sf, "silver_penelitian").select("id", "nama_anggota_dosen", "nip_anggota_dosen"), "nama_anggota_dosen", "nip_anggota_dosen")


@query("SELECT id, coalesce(len(nama_anggota_dosen), 0) AS dosen, coalesce(len(nama_anggota_mahasiswa), 0) AS mahasiswa, nip_ketua_peneliti[1] AS nip FROM silver_penelitian")
def array_sizes(spark, sf):
    size = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("bigint")
    return table(spark, sf, "silver_penelitian").select(
        "id", size("nama_anggota_dosen").alias("dosen"), size("nama_anggota_mahasiswa").alias("mahasiswa"), F.get("nip_ketua_peneliti", F.lit(0)).alias("nip")
    )


@query("SELECT value FROM (SELECT p_size AS value, count(*) AS n FROM part GROUP BY p_size ORDER BY n DESC, value LIMIT 1)")
def mode_value(spark, sf):
    return table(spark, sf, "part").groupBy(F.col("p_size").alias("value")).count().orderBy(F.desc("count"), "value").limit(1).select("value")


@query("""SELECT strftime(ts, '%Y-%m-%d') AS hari, event_type, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-10' GROUP BY ALL""")
def partition_transform_days(spark, sf):
    from lumbung.sources.store import TRANSFORMS

    rows = table(spark, sf, "events").where(F.col("ts") >= F.lit("2024-01-10").cast("timestamp"))
    return rows.groupBy(TRANSFORMS["days"](F.col("ts")).alias("hari"), "event_type").agg(F.count("*").alias("n"))


@query("SELECT count(*) AS rows, count(l_orderkey) AS l_orderkey, count(l_shipdate) AS l_shipdate, count(CASE WHEN l_linenumber % 3 = 0 THEN l_quantity END) AS l_quantity FROM lineitem")
def frame_counts(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("l_quantity", F.when(F.col("l_linenumber") % 3 == 0, F.col("l_quantity")))
    return rows.agg(F.count("*").alias("rows"), *[F.count(c).alias(c) for c in ("l_orderkey", "l_shipdate", "l_quantity")])
