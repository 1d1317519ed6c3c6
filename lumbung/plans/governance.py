"""Queries of data quality, repair and table-format operators; each with the state after the operation as its oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.plans import quality, repair
from lumbung.session import scratch, table
from lumbung.sources.store import Store

QUERIES = {}
ORACLE = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


def _dirty_orders(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        F.when(k % 97 == 0, None).when(k % 89 == 0, k - 1).otherwise(k).alias("kunci"),
        F.when(k % 50 == 0, None).when(k % 50 == 1, "  ").otherwise(F.col("o_orderpriority")).alias("prioritas"),
        F.when(k % 17 == 0, "zzz").otherwise(F.concat(F.lit(" "), F.lower("o_orderpriority"))).alias("kelas"),
    )


_DIRTY = """(SELECT CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN o_orderkey - 1 ELSE o_orderkey END AS kunci,
    CASE WHEN o_orderkey % 50 = 0 THEN NULL WHEN o_orderkey % 50 = 1 THEN '  ' ELSE o_orderpriority END AS prioritas,
    CASE WHEN o_orderkey % 17 = 0 THEN 'zzz' ELSE ' ' || lower(o_orderpriority) END AS kelas FROM orders)"""


@query(f"""WITH d AS {_DIRTY}, r AS (
    SELECT 'prioritas' AS column_name, 'Completeness' AS dimension, 'completeness_rate' AS metric, count(*) AS total_records, count(*) FILTER (WHERE prioritas IS NULL OR trim(prioritas) = '') AS failed_records FROM d
    UNION ALL SELECT 'kunci', 'Completeness', 'completeness_rate', count(*), count(*) FILTER (WHERE kunci IS NULL) FROM d
    UNION ALL SELECT 'kelas', 'Validity', 'validity_rate', count(kelas), count(*) FILTER (WHERE trim(kelas) <> '' AND lower(trim(kelas)) NOT IN (SELECT lower(trim(o_orderpriority)) FROM orders)) FROM d
    UNION ALL SELECT 'kunci', 'Uniqueness', 'uniqueness_rate', (SELECT count(*) FROM d), count(*) FROM d WHERE kunci IN (SELECT kunci FROM d GROUP BY kunci HAVING count(*) > 1))
    SELECT 'orders' AS table_name, *, round((total_records - failed_records) / total_records * 100, 2) AS score, CAST(0 AS DOUBLE) AS threshold, CASE WHEN failed_records <= 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM r""")
def dq_scores(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    rules = quality.Rules(
        mandatory=("prioritas", "kunci"), references=(quality.Reference("kelas", orders, "o_orderpriority"),), unique=("kunci",)
    )
    return quality.report(_dirty_orders(spark, sf), "orders", rules)


def _swapped(spark: SparkSession, sf: str) -> tuple[DataFrame, quality.Swap]:
    part, k = table(spark, sf, "part"), F.col("p_partkey")
    rows = part.select(
        "p_partkey",
        F.when(k % 23 == 0, " ").otherwise(F.col("p_name")).alias("judul"),
        F.when(k % 11 == 0, F.col("p_type")).when(k % 13 == 0, None).when(k % 17 == 0, "zzz").otherwise(F.col("p_brand")).alias("merek"),
        F.when((k % 11 == 0) | (k % 13 == 0), F.col("p_brand")).otherwise(F.col("p_type")).alias("jenis"),
    )
    swap = quality.Swap("merek", "jenis", quality.Reference("merek", part, "p_brand"), quality.Reference("jenis", part, "p_type"))
    return rows, swap


_SWAPPED = """(SELECT p_partkey, CASE WHEN p_partkey % 23 = 0 THEN ' ' ELSE p_name END AS judul,
    CASE WHEN p_partkey % 11 = 0 THEN p_type WHEN p_partkey % 13 = 0 THEN NULL WHEN p_partkey % 17 = 0 THEN 'zzz' ELSE p_brand END AS merek,
    CASE WHEN p_partkey % 11 = 0 OR p_partkey % 13 = 0 THEN p_brand ELSE p_type END AS jenis FROM part)"""
_REPAIRED = f"""(SELECT p_partkey, judul, CASE WHEN p_partkey % 11 = 0 THEN jenis WHEN p_partkey % 13 = 0 THEN jenis ELSE merek END AS merek,
    CASE WHEN p_partkey % 11 = 0 THEN merek WHEN p_partkey % 13 = 0 THEN NULL ELSE jenis END AS jenis FROM {_SWAPPED} WHERE judul IS NOT NULL AND trim(judul) <> '')"""
_COUNTS = """SELECT count(*) FILTER (WHERE judul IS NULL OR trim(judul) = '') AS null_judul, count(*) FILTER (WHERE aj AND bm AND NOT am AND NOT bj) AS both_swapped,
    count(*) FILTER (WHERE merek IS NULL AND bm) AS a_only, count(*) FILTER (WHERE jenis IS NULL AND aj) AS b_only, count(*) FILTER (WHERE merek IS NOT NULL AND NOT am AND NOT aj) AS invalid_a,
    count(*) FILTER (WHERE jenis IS NOT NULL AND NOT bj AND NOT bm) AS invalid_b, count(*) FILTER (WHERE lower(trim(merek)) = lower(trim(jenis))) AS equal, count(*) AS total FROM (
    SELECT *, coalesce(merek IN (SELECT p_brand FROM part), false) AS am, coalesce(merek IN (SELECT p_type FROM part), false) AS aj,
    coalesce(jenis IN (SELECT p_type FROM part), false) AS bj, coalesce(jenis IN (SELECT p_brand FROM part), false) AS bm FROM {})"""


@query(_COUNTS.format(_SWAPPED))
def swap_audit_before(spark, sf):
    rows, swap = _swapped(spark, sf)
    return quality.swap_counts(rows, swap, "judul")


def _fixed(spark, sf) -> tuple[DataFrame, quality.Swap]:
    rows, swap = _swapped(spark, sf)
    return repair.unswap(repair.purge_blank(rows, "judul"), swap), swap


@query(f"SELECT * FROM {_REPAIRED}")
def swap_repair(spark, sf):
    return _fixed(spark, sf)[0]


@query(_COUNTS.format(_REPAIRED))
def swap_audit_after(spark, sf):
    rows, swap = _fixed(spark, sf)
    return quality.swap_counts(rows, swap, "judul")


@query("""SELECT count(*) AS total, count(*) FILTER (WHERE e) AS empty, count(*) FILTER (WHERE NOT e AND hit) AS matched, count(*) FILTER (WHERE NOT e AND NOT hit) AS other FROM (
    SELECT ketua_peneliti IS NULL OR trim(ketua_peneliti) = '' AS e, coalesce(ketua_peneliti IN (SELECT nama FROM dim_dosen), false) AS hit FROM silver_sitasi)""")
def name_match_audit(spark, sf):
    counts = quality.name_counts(table(spark, sf, "silver_sitasi"), "ketua_peneliti", table(spark, sf, "dim_dosen"), "nama")
    return counts.select("total", "empty", "matched", (F.col("total") - F.col("empty") - F.col("matched")).alias("other"))


@query(f"SELECT * FROM {_REPAIRED}")
def wap_publish_pass(spark, sf):
    store = Store(spark, scratch(spark, "wap"))
    rows, swap = _swapped(spark, sf)
    store.table("silver.part").create_or_replace(rows)
    repair.audit_and_publish(
        store, "silver.part", lambda r: repair.unswap(repair.purge_blank(r, "judul"), swap), lambda r: quality.swap_counts(r, swap, "judul"), repair.SWAP_GATES
    )
    return store.table("silver.part").read()


@query(f"SELECT * FROM {_SWAPPED}")
def wap_publish_block(spark, sf):
    """A repair that loses rows is not published: main is as before."""
    store = Store(spark, scratch(spark, "wap"))
    rows, swap = _swapped(spark, sf)
    store.table("silver.part").create_or_replace(rows)
    try:
        repair.audit_and_publish(store, "silver.part", lambda r: r.where("p_partkey % 2 = 0"), lambda r: quality.swap_counts(r, swap, "judul"), repair.SWAP_GATES)
    except repair.Blocked:
        return store.table("silver.part").read()
    raise AssertionError("published")


def _orders(spark: SparkSession, sf: str):
    store = Store(spark, scratch(spark, "orders"))
    t = store.table("silver.orders")
    t.create_or_replace(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"))
    return t


_O = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders"


@query(_O)
def time_travel(spark, sf):
    t = _orders(spark, sf)
    first = t._meta().refs["main"]
    t.delete("o_orderstatus = 'F'")
    return t.read(first)


@query(_O + " WHERE NOT (o_totalprice > 100000)")
def delete_where(spark, sf):
    t = _orders(spark, sf)
    t.delete("o_totalprice > 100000")
    return t.read()


@query("SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice, o_orderdate FROM orders")
def update_set(spark, sf):
    t = _orders(spark, sf)
    t.update({"o_orderstatus": F.lit("X")}, "o_orderkey % 3 = 0")
    return t.read()


@query(f"""SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 10 = 0 THEN 'U' ELSE o_orderstatus END AS o_orderstatus, o_totalprice, o_orderdate FROM orders
    UNION ALL SELECT -o_orderkey, o_custkey, 'U', o_totalprice, o_orderdate FROM orders WHERE o_orderkey % 10 = 0""")
def upsert(spark, sf):
    t = _orders(spark, sf)
    changed = t.read().where("o_orderkey % 10 = 0").withColumn("o_orderstatus", F.lit("U"))
    t.upsert(changed.unionByName(changed.withColumn("o_orderkey", -F.col("o_orderkey"))), ["o_orderkey"])
    return t.read()


@query("""SELECT o_orderkey, CAST(NULL AS VARCHAR) AS catatan, o_custkey AS pelanggan, o_totalprice, o_orderdate FROM orders
    UNION ALL SELECT 0, 'baru', 1, 2.5, TIMESTAMP '2024-01-01'""")
def schema_evolve(spark, sf):
    t = _orders(spark, sf)
    t.rename_column("o_custkey", "pelanggan")
    t.drop_column("o_orderstatus")
    t.add_column("catatan", "string", after="o_orderkey")
    t.append(spark.sql("SELECT 0L AS o_orderkey, 'baru' AS catatan, 1L AS pelanggan, 2.5D AS o_totalprice, TIMESTAMP '2024-01-01' AS o_orderdate"))
    return t.read()


@query(_O + " UNION ALL " + _O)
def compact(spark, sf):
    t = _orders(spark, sf)
    t.append(t.read())
    t.rewrite_data_files()
    t.rewrite_manifests()
    return t.read()


@query(_O + " WHERE o_orderstatus <> 'F'")
def expire(spark, sf):
    t = _orders(spark, sf)
    t.delete("o_orderstatus = 'F'")
    t.expire_snapshots(retain_last=1)
    return t.read()


@query(_O)
def rollback(spark, sf):
    t = _orders(spark, sf)
    first = t._meta().refs["main"]
    t.delete("o_orderstatus = 'F'")
    t.rollback(first)
    return t.read()


@query(_O + " UNION ALL " + _O + " WHERE o_orderstatus = 'P' UNION ALL " + _O + " WHERE o_orderkey < 100")
def cherrypick(spark, sf):
    t = _orders(spark, sf)
    staged = t.stage(t.read().where("o_orderstatus = 'P'"), "w1")
    t.append(t.read().where("o_orderkey < 100"))
    t.cherrypick(staged)
    return t.read()


@query(_O + " WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1998-02-01'")
def hidden_partitions(spark, sf):
    from datetime import datetime

    store = Store(spark, scratch(spark, "orders"))
    t = store.table("silver.orders")
    t.create_or_replace(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"), [("o_orderdate", "months")])
    return t.read(where=[("o_orderdate", ">=", datetime(1998, 1, 1)), ("o_orderdate", "<", datetime(1998, 2, 1))])


@query(_O + " UNION ALL " + _O + " WHERE o_orderstatus = 'P'")
def append_partitioned(spark, sf):
    """Rows appended to a table that is partitioned by months and by status."""
    t = Store(spark, scratch(spark, "orders")).table("silver.orders")
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    t.create_or_replace(rows, [("o_orderdate", "years"), ("o_orderstatus", "identity")])
    t.append(rows.where("o_orderstatus = 'P'"))
    return t.read()


@query(_O + " WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1998-02-01'")
def hourly_partitions(spark, sf):
    """Days first, hours for the rows appended after the partitioning changed."""
    from datetime import datetime

    t = Store(spark, scratch(spark, "orders")).table("silver.orders")
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate").where("o_orderdate >= '1997-12-15' AND o_orderdate < '1998-02-15'")
    t.create_or_replace(rows.where("o_orderkey % 2 = 0"), [("o_orderdate", "days")])
    t.drop_partition_field("o_orderdate", "days")
    t.add_partition_field("o_orderdate", "hours")
    t.append(rows.where("o_orderkey % 2 = 1"))
    return t.read(where=[("o_orderdate", ">=", datetime(1998, 1, 1)), ("o_orderdate", "<", datetime(1998, 2, 1))])


@query("SELECT CAST(count(DISTINCT year(o_orderdate)) AS BIGINT) AS semua, CAST(1 AS BIGINT) AS dibaca FROM orders")
def pruned_files(spark, sf):
    """Files of a table partitioned by years, and those that a condition on one year reads."""
    from datetime import datetime

    t = Store(spark, scratch(spark, "orders")).table("silver.orders")
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    t.create_or_replace(rows.repartition(F.year("o_orderdate")), [("o_orderdate", "years")])
    one = t.read(where=[("o_orderdate", ">=", datetime(1995, 1, 1)), ("o_orderdate", "<", datetime(1995, 12, 31))]).select(F.input_file_name().alias("f"))
    return t.data_files().agg(F.count("*").alias("semua")).crossJoin(one.agg(F.countDistinct("f").alias("dibaca")))  # one row each


@query("SELECT 32 AS sebelum, 4 AS sesudah, count(*) AS baris FROM orders")
def compact_files(spark, sf):
    """Files of four partitions before and after compaction."""
    t = Store(spark, scratch(spark, "orders")).table("silver.orders")
    rows = table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") % 4).alias("k"), "o_totalprice")
    t.create_or_replace(rows.repartition(8, F.rand(7)), [("k", "identity")])
    before = t.data_files().count()
    t.rewrite_data_files()
    return t.read().agg(F.lit(before).cast("int").alias("sebelum"), F.lit(t.data_files().count()).cast("int").alias("sesudah"), F.count("*").alias("baris"))


@query("SELECT * FROM (VALUES ('belum', 5), ('dipakai', 1)) v(kelompok, direktori)")
def expire_keeps_uncommitted(spark, sf):
    """Directories after expiry: those that snapshots use, and that of a writer that has not committed (by its files)."""
    t = _orders(spark, sf)
    t.overwrite(t.read().where("o_orderstatus = 'P'"))
    running = t._meta()
    made = t._write(running, t._aligned(running, t.read().repartition(5, "o_orderkey"), False), 77)
    t.expire_snapshots(retain_last=1)
    files = [f["path"] for f in t.files.walk(f"{t.path}/data") if f["name"].endswith(".parquet")]
    used = {p.rsplit("/", 2)[1] for p in files if f"/{made['dir']}/" not in p}
    return spark.createDataFrame([("belum", sum(f"/{made['dir']}/" in p for p in files)), ("dipakai", len(used))], "kelompok string, direktori int")


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders WHERE o_orderkey % 5 > 0")
def time_travel_schema(spark, sf):
    """A snapshot read after its columns were dropped and renamed."""
    t = _orders(spark, sf)
    t.delete("o_orderkey % 5 = 0")
    old = t._meta().refs["main"]
    t.drop_column("o_orderstatus")
    t.rename_column("o_custkey", "pelanggan")
    t.overwrite(t.read().where("o_orderkey = 1"))
    return t.read(old)


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders UNION ALL SELECT o_orderkey, o_custkey, NULL, o_totalprice, NULL FROM orders WHERE o_orderkey % 7 = 0")
def added_files(spark, sf):
    """Files written elsewhere, with fewer columns in another order, added as they are."""
    t = _orders(spark, sf)
    folder = scratch(spark, "luar")
    table(spark, sf, "orders").where("o_orderkey % 7 = 0").select("o_totalprice", "o_custkey", "o_orderkey").write.parquet(folder)
    t.add_files([folder])
    return t.read()


@query("SELECT 'main' AS name, 'BRANCH' AS type, 2 AS berkas UNION ALL SELECT 'audit', 'BRANCH', 3")
def refs_and_files(spark, sf):
    """Branches with the number of their data files, from the metadata frames."""
    t = Store(spark, scratch(spark, "orders")).table("silver.orders")
    rows = table(spark, sf, "orders").select("o_orderkey").repartition(2, "o_orderkey")
    t.create_or_replace(rows)
    t.create_branch("audit")
    t.append(rows.where("o_orderkey % 3 = 0").coalesce(1), branch="audit")
    counts = spark.createDataFrame([(r.name, t.data_files(r.name).count()) for r in t.refs().collect()], "name string, berkas int")
    return t.refs().join(counts, "name").select("name", "type", "berkas")


@query("SELECT c_nationkey AS negara, count(*) AS baris FROM customer GROUP BY c_nationkey")
def partition_rows(spark, sf):
    """Rows by partition value, from the table's hidden partitions."""
    t = Store(spark, scratch(spark, "customer")).table("silver.customer")
    t.create_or_replace(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), [("c_nationkey", "identity")])
    found = t.partitions().select(F.col("partition").cast("int").alias("negara"))
    return found.join(t.read(), F.col("negara") == F.col("c_nationkey")).groupBy("negara").agg(F.count("*").alias("baris"))


@query("SELECT 'append' AS operation, 3 AS snapshots, true AS current UNION ALL SELECT 'delete', 3, true UNION ALL SELECT 'overwrite', 3, true")
def snapshot_log(spark, sf):
    t = _orders(spark, sf)
    t.delete("o_orderstatus = 'F'")
    t.update({"o_totalprice": F.lit(0.0)}, "o_orderstatus = 'P'")
    log, line = t.snapshots(), t.history().select("snapshot_id", F.col("is_current_ancestor").alias("current"))
    return log.join(line, "snapshot_id").select("operation", F.lit(log.count()).cast("int").alias("snapshots"), "current")


@query("SELECT l_returnflag AS tanda, count(*) AS baris FROM lineitem WHERE l_linestatus = 'O' GROUP BY l_returnflag")
def view_create_replace(spark, sf):
    table(spark, sf, "lineitem").createOrReplaceTempView("lineitem_rows")
    spark.sql("CREATE OR REPLACE TEMPORARY VIEW ringkas (tanda COMMENT 'flag', baris) AS SELECT l_returnflag, count(*) FROM lineitem_rows GROUP BY l_returnflag")
    spark.sql("CREATE OR REPLACE TEMPORARY VIEW ringkas (tanda COMMENT 'flag', baris) AS SELECT l_returnflag, count(*) FROM lineitem_rows WHERE l_linestatus = 'O' GROUP BY l_returnflag")
    return spark.table("ringkas")


@query("SELECT * FROM (VALUES ('a.xlsx', 'penelitian', false), ('b.xlsx', 'sitasi', true), ('d.xlsx', 'pengabdian', true)) t(file, category, changed)")
def changed_sources(spark, sf):
    from lumbung.plans import pipeline

    categories = {"a.xlsx": "penelitian", "b.xlsx": "sitasi", "c.xlsx": "buku_keilmuan", "d.xlsx": "pengabdian"}
    old = {"a.xlsx": {"etag": "1"}, "b.xlsx": {"etag": "1"}, "c.xlsx": {"etag": "1"}}
    new, _ = pipeline.compare(old, {"a.xlsx": "1", "b.xlsx": "2", "d.xlsx": "9"}, categories)
    return spark.createDataFrame([(f, m["category"], m["changed"]) for f, m in new.items()], "file string, category string, changed boolean")
