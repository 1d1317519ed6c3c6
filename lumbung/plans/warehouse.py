"""Queries of sources, views, databases, audits and repairs of several tables; each with the state after it as its oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.functions import names, text
from lumbung.plans import governance, marts, pipeline, quality, repair
from lumbung.session import scratch, table
from lumbung.sources import xlsx
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


@query("""SELECT CAST(prodi_id AS VARCHAR) AS prodi_id, nama_prodi, nama_fakultas, NULL AS skema_id, NULL AS nama_skema, NULL AS pendanaan_maks, 2023 AS tahun FROM dim_prodi
    UNION ALL SELECT NULL, NULL, NULL, CAST(skema_id AS VARCHAR), nama_skema, CAST(pendanaan_maks AS VARCHAR), 2024 FROM dim_skema""")
def workbook_sheets(spark: SparkSession, sf: str) -> DataFrame:
    """Year sheets of a workbook, and one without a year that is left out; the columns are united by name."""
    path = scratch(spark, "buku") + ".xlsx"
    frames = {"2023": table(spark, sf, "dim_prodi"), "Petunjuk": table(spark, sf, "dim_sdgs"), "2024": table(spark, sf, "dim_skema")}
    xlsx.save(spark, path, frames)
    return xlsx.workbook(spark, path)


@query("SELECT 1 AS urutan, 'Petunjuk' AS sheet, 17 AS baris UNION ALL SELECT 2, '2023', 30")
def workbook_names(spark, sf):
    """Sheets in the order of the workbook, with their rows."""
    path = scratch(spark, "buku") + ".xlsx"
    xlsx.save(spark, path, {"Petunjuk": table(spark, sf, "dim_sdgs"), "2023": table(spark, sf, "dim_prodi")})
    rows = xlsx.cells(spark, path)
    order = F.when(F.col("sheet") == "Petunjuk", 1).otherwise(2).alias("urutan")
    return rows.groupBy(order, "sheet").agg(F.count("*").cast("int").alias("baris"))


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def json_multiline(spark, sf):
    """A JSON document over several lines, its types inferred."""
    folder = scratch(spark, "json")
    rows = table(spark, sf, "nation").agg(F.to_json(F.collect_list(F.struct("*")), {"pretty": "true"}).alias("value"))  # 25 nations
    rows.write.text(folder)
    return spark.read.json(folder, multiLine=True).select("n_nationkey", "n_name", "n_regionkey")


_STATIC = [(k, p.upper(), faculty) for k, (p, faculty) in enumerate(((p, f) for f, ps in text.FACULTY_PROGRAMMES.items() for p in ps), 1)]


@query("SELECT * FROM (VALUES " + ", ".join(f"({k}, '{p}', '{f}')" for k, p, f in _STATIC) + ") v(prodi_id, nama_prodi, nama_fakultas)")
def static_dimension(spark, sf):
    """A dimension of literal rows, numbered in their order."""
    rows = [f"({k}, '{p}', '{f}')" for k, p, f in _STATIC]
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS v(prodi_id, nama_prodi, nama_fakultas)")


@query("SELECT * FROM (VALUES ('wawasan', 'ringkas_baris', 'tanda:flag,baris:', 'b=2')) v(database, view, kolom, properti)")
def view_catalog(spark, sf):
    """A view of a database created, replaced, found by name, described, altered and dropped."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS wawasan LOCATION '{scratch(spark, 'wawasan')}'")
    path = f"{sf}/lineitem.parquet"
    for where in ("true", "l_linestatus = 'O'"):
        spark.sql(
            "CREATE OR REPLACE VIEW wawasan.ringkas_baris (tanda COMMENT 'flag', baris) COMMENT 'rows by flag' TBLPROPERTIES ('a' = '1') AS "
            f"SELECT l_returnflag, count(*) AS n FROM parquet.`{path}` WHERE {where} GROUP BY l_returnflag"
        )
    spark.sql("ALTER VIEW wawasan.ringkas_baris SET TBLPROPERTIES ('b' = '2')")
    spark.sql("ALTER VIEW wawasan.ringkas_baris UNSET TBLPROPERTIES ('a')")
    found = [(r["namespace"], r["viewName"]) for r in spark.sql("SHOW VIEWS IN wawasan LIKE 'ringkas*'").collect() if not r["isTemporary"]]
    columns = [(r["col_name"], r["comment"] or "") for r in spark.sql("DESCRIBE wawasan.ringkas_baris").collect()]
    shown = spark.sql("SHOW CREATE TABLE wawasan.ringkas_baris").first()[0]
    kept = [p for p in ("a=1", "b=2") if "'{}' = '{}'".format(*p.split("=")) in shown]
    counted = spark.table("wawasan.ringkas_baris").agg(F.sum("baris")).first()[0]
    if counted != table(spark, sf, "lineitem").where("l_linestatus = 'O'").count():
        raise AssertionError("the view was not replaced")
    spark.sql("DROP VIEW wawasan.ringkas_baris")
    if spark.sql("SHOW VIEWS IN wawasan").where("NOT isTemporary").count():  # temporary views show in every database
        raise AssertionError("the view was not dropped")
    spark.sql("DROP DATABASE wawasan")
    return spark.createDataFrame([(*f, ",".join(map(":".join, columns)), ",".join(kept)) for f in found], "database string, view string, kolom string, properti string")


@query("SELECT * FROM (VALUES ('a', 'x', 'id:bigint,nilai:double'), ('a', 'y', 'id:bigint'), ('b', 'z', 'kota:string')) v(ruang, tabel, kolom)")
def namespaces(spark, sf):
    """Tables of the store's namespaces with their columns, after one namespace was dropped and one table too."""
    store = Store(spark, scratch(spark, "gudang"))
    for name, ddl in (("a.x", "id bigint, nilai double"), ("a.y", "id bigint"), ("b.z", "kota string"), ("b.w", "n int"), ("c.v", "n int")):
        store.create_namespace(name[0])
        store.table(name).create_if_not_exists(ddl)
    store.table("b.w").drop()
    store.drop_namespace("c")
    rows = [(n, t.partition(".")[2], ",".join(f"{c}:{k}" for c, k, _ in store.table(t).schema())) for n in store.namespaces() for t in store.tables(n)]
    return spark.createDataFrame(rows, "ruang string, tabel string, kolom string")


@query(f"""WITH s AS {governance._SWAPPED}, c AS ({governance._COUNTS.format("s")}), n AS (SELECT * FROM c UNPIVOT (failed_records FOR metric IN (both_swapped, a_only, b_only, equal)))
    SELECT 'merek,jenis' AS column_name, 'Consistency' AS dimension, metric, total AS total_records, failed_records,
        round((total - failed_records) / total * 100, 2) AS score, CASE WHEN failed_records <= 0 THEN 'PASS' ELSE 'FAIL' END AS status, 1 AS runs, true AS timed FROM n
    UNION ALL SELECT 'judul', 'Completeness', 'completeness_rate', total, null_judul, round((total - null_judul) / total * 100, 2), CASE WHEN null_judul <= 0 THEN 'PASS' ELSE 'FAIL' END, 1, true FROM c""")
def dq_report(spark, sf):
    """A run over a table with a pair of columns; its id and time are counted, since they differ from run to run."""
    rows, swap = governance._swapped(spark, sf)
    out = quality.run(spark, {"part": (rows, quality.Rules(mandatory=("judul",), swap=swap))})
    runs = out.agg(F.countDistinct("run_id").cast("int").alias("runs"), F.bool_and(F.col("run_timestamp").isNotNull()).alias("timed"))
    return out.select("column_name", "dimension", "metric", "total_records", "failed_records", "score", "status").crossJoin(runs)  # one row


@query("""SELECT count(*) AS total, count(*) FILTER (WHERE judul_proposal IS NULL OR trim(judul_proposal) = '') AS null_judul FROM silver_sitasi""")
def title_audit(spark, sf):
    return quality.title_counts(table(spark, sf, "silver_sitasi"), "judul_proposal")


@query()
def name_match_kinds(spark, sf):
    """Names of citations by kind: empty, invalid, valid but unknown, known. Roots of names have no SQL."""
    return quality.name_counts(table(spark, sf, "silver_sitasi"), "ketua_peneliti", table(spark, sf, "dim_dosen"), "nama")


@query("""SELECT * FROM silver_sitasi WHERE judul_proposal IS NOT NULL AND trim(judul_proposal) <> ''""")
def purge_publish(spark, sf):
    """Rows without a title purged on a branch, audited and published."""
    store = Store(spark, scratch(spark, "wap"))
    store.table("silver.sitasi").create_or_replace(table(spark, sf, "silver_sitasi"))
    audit = lambda r: quality.title_counts(r, "judul_proposal")
    repair.audit_and_publish(store, "silver.sitasi", lambda r: repair.purge_blank(r, "judul_proposal"), audit, repair.PURGE_GATES)
    return store.table("silver.sitasi").read()


@query("""WITH m AS (SELECT o_orderkey, c_name, CASE o_orderkey % 3 WHEN 0 THEN c_name WHEN 1 THEN upper(c_name) ELSE c_name || ', S.T., M.T.' END AS ditulis, c_custkey % 4 = 0 AS baru FROM orders JOIN customer ON o_custkey = c_custkey),
    after AS (SELECT o_orderkey, CASE WHEN baru THEN ditulis ELSE c_name END AS nama FROM m)
    SELECT 'sebutan' AS tabel, nama, count(*) AS baris FROM after GROUP BY nama
    UNION ALL SELECT 'orang', c_name, 1 FROM customer WHERE c_custkey % 4 > 0
    UNION ALL SELECT DISTINCT 'orang', ditulis, 1 FROM m WHERE baru""")
def two_table_repair(spark, sf):
    """Names of mentions made canonical and unknown persons added, both tables published together."""
    store = Store(spark, scratch(spark, "wap"))
    people = table(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("nama"))
    k = F.col("o_orderkey") % 3
    typed = F.when(k == 0, F.col("nama")).when(k == 1, F.upper("nama")).otherwise(F.concat("nama", F.lit(", S.T., M.T.")))
    mentions = table(spark, sf, "orders").join(people, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", typed.alias("ketua"))
    store.table("silver.sebutan").create_or_replace(mentions)
    store.table("gold.orang").create_or_replace(people.where("c_custkey % 4 > 0").select(F.col("c_custkey").cast("int").alias("dosen_id"), "nama"))
    repair.map_names(store, "silver.sebutan", "ketua", "gold.orang", "nama", "dosen_id")
    after = store.table("silver.sebutan").read().groupBy(F.lit("sebutan").alias("tabel"), F.col("ketua").alias("nama")).agg(F.count("*").alias("baris"))
    known = store.table("gold.orang").read().select(F.lit("orang").alias("tabel"), "nama", F.lit(1).cast("bigint").alias("baris"))
    return after.unionByName(known)


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN c_name ELSE trim(ditulis) END AS nama FROM (
    SELECT o_orderkey, c_name, CASE o_orderkey % 3 WHEN 0 THEN 'dr. ' || c_name || ', M.Sc' WHEN 1 THEN ' tidak dikenal ' ELSE NULL END AS ditulis FROM orders JOIN customer ON o_custkey = c_custkey)""")
def mapped_names(spark, sf):
    """Names by a table of spellings: exact, else by root, else only trimmed."""
    people = table(spark, sf, "customer").select("c_custkey", "c_name")
    k = F.col("o_orderkey") % 3
    typed = F.when(k == 0, F.concat(F.lit("dr. "), "c_name", F.lit(", M.Sc"))).when(k == 1, " tidak dikenal ")
    rows = table(spark, sf, "orders").join(people, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", typed.alias("nama"))
    mapping = people.select(F.upper("c_name").alias("dari"), F.col("c_name").alias("menjadi"))
    return names.mapped_names(rows, "nama", mapping)


_KIND = "CASE WHEN tahun % 3 = 0 THEN 'penelitian' WHEN tahun % 3 = 1 THEN 'pengabdian' ELSE 'buku_keilmuan' END"


@query(f"""SELECT {_KIND.replace('tahun', 's.tahun')} AS jenis_lembar, s.id, s.judul_proposal, br."Anggota Dosen" AS nama_anggota_dosen, br."Anggota Mahasiswa" AS nama_anggota_mahasiswa
    FROM silver_penelitian s JOIN bronze_penelitian br ON upper(trim(br."Judul Proposal")) = upper(trim(s.judul_proposal)) AND {_KIND.replace('tahun', 's.tahun')} = {_KIND.replace('tahun', 'br.tahun')}
    WHERE s.status = 'diterima'""")
def grants_of_three_sheets(spark, sf):
    """The dataset of all grants over three kinds of sheets, each joined with its own sheet and then united. The kinds are years here."""
    kinds = {"penelitian": 0, "pengabdian": 1, "buku_keilmuan": 2}
    silver_rows, sheet = table(spark, sf, "silver_penelitian"), table(spark, sf, "bronze_penelitian")
    of = lambda rows, k: rows.where(F.col("tahun") % 3 == k)
    made = marts.all_grants_of({name: (of(silver_rows, k), of(sheet, k)) for name, k in kinds.items()})
    return made.select("jenis_lembar", "id", "judul_proposal", "nama_anggota_dosen", "nama_anggota_mahasiswa")


@query("SELECT * FROM (VALUES (1, 'baru', 'string', 'catatan baru'), (2, 'o_orderkey', 'bigint', NULL), (3, 'jumlah', 'bigint', 'banyak'), (4, 'rasio', 'double', NULL)) v(urutan, kolom, tipe, komentar)")
def alter_columns(spark, sf):
    """Columns after types were widened, comments set, one moved to the front and one renamed."""
    t = Store(spark, scratch(spark, "orders")).table("silver.orders")
    t.create_or_replace(table(spark, sf, "orders").select("o_orderkey", F.lit(1).alias("n"), F.lit(0.5).cast("float").alias("rasio")))
    t.alter_column("n", "bigint", "banyak")
    t.alter_column("rasio", "double")
    t.add_column("baru", "string")
    t.alter_column("baru", comment="catatan baru", after="")
    t.rename_column("n", "jumlah")
    rows = [(k, *c) for k, c in enumerate(t.schema(), 1)]
    return spark.createDataFrame(rows, "urutan int, kolom string, tipe string, komentar string")


@query("SELECT n_nationkey, n_name, NULL AS catatan FROM nation UNION ALL SELECT n_nationkey + 100, n_name, 'baru' FROM nation")
def schema_union(spark, sf):
    """A column more is refused unless the schemas are united by name."""
    t = Store(spark, scratch(spark, "nation")).table("silver.nation")
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    t.create_or_replace(nation)
    more = nation.select(F.lit("baru").alias("catatan"), (F.col("n_nationkey") + 100).alias("n_nationkey"), "n_name")
    try:
        t.append(more)
    except ValueError:
        t.append(more, merge_schema=True)
    return t.read()


@query("SELECT 'pemilik' AS kunci, 'lab' AS nilai UNION ALL SELECT 'umur', '2'")
def table_properties(spark, sf):
    """Properties set, replaced and unset; a table that exists is not made anew."""
    t = Store(spark, scratch(spark, "nation")).table("silver.nation")
    t.create_or_replace(table(spark, sf, "nation"), properties={"umur": "1", "sementara": "x"})
    if t.create_if_not_exists("id int"):
        raise AssertionError("the table was made anew")
    t.set_properties(umur="2", pemilik="lab")
    t.unset_properties("sementara", "tidak_ada")
    return spark.createDataFrame(sorted(t.properties().items()), "kunci string, nilai string")


@query("SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 1")
def arrow_result(spark, sf):
    """A filtered scan of a versioned table fetched as an Arrow table, and row by row."""
    t = Store(spark, scratch(spark, "nation")).table("silver.nation")
    t.create_or_replace(table(spark, sf, "nation"), [("n_regionkey", "identity")])
    found = t.read(where=[("n_regionkey", "=", 1)]).select("n_nationkey", "n_name")
    fetched = found.toArrow()
    if sorted(r["n_nationkey"] for r in found.toLocalIterator()) != sorted(fetched["n_nationkey"].to_pylist()):
        raise AssertionError("the results differ")
    return spark.createDataFrame(fetched)


SCRIPT = """
-- Priorities of late orders; a semicolon in a text or a comment ends nothing: ;
CREATE OR REPLACE TEMPORARY VIEW pesanan_lambat AS SELECT o_orderpriority, o_totalprice, 'a;b' AS teks FROM pesanan WHERE o_orderdate >= '1997-01-01';
/* counted ; by priority */
SELECT o_orderpriority, teks, count(*) AS n FROM pesanan_lambat GROUP BY o_orderpriority, teks;
"""


@query("SELECT o_orderpriority, 'a;b' AS teks, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' GROUP BY o_orderpriority")
def sql_script(spark, sf):
    """A script of several statements; the last one is the result."""
    table(spark, sf, "orders").createOrReplaceTempView("pesanan")
    return pipeline.run_script(spark, SCRIPT)


@query("SELECT * FROM (VALUES ('silver.penelitian', true), ('silver.sitasi', false), ('gold.dim_dosen', true), ('gold.dim_hibah_proposal', true), ('gold.fact_hibah', true), ('gold.fact_dosen_hibah', true)) v(tabel, dibangun)")
def selective_rebuild(spark, sf):
    """Tables that a change of one category builds anew: its silver table and the whole gold layer."""
    store = _office(spark, sf)
    store.table("silver.sitasi").create_or_replace(table(spark, sf, "silver_sitasi"))
    pipeline.run(store, ["penelitian"])
    names = ("silver.penelitian", "silver.sitasi", "gold.dim_dosen", "gold.dim_hibah_proposal", "gold.fact_hibah", "gold.fact_dosen_hibah")
    before = {n: store.table(n).snapshots().count() for n in names}
    pipeline.run(store, ["penelitian"])
    return spark.createDataFrame([(n, store.table(n).snapshots().count() > before[n]) for n in names], "tabel string, dibangun boolean")


def _office(spark: SparkSession, sf: str) -> Store:
    store = Store(spark, scratch(spark, "kantor"))
    store.table("bronze.penelitian").create_or_replace(table(spark, sf, "bronze_penelitian").drop("baris_id"))
    store.table("gold.dim_skema").create_or_replace(table(spark, sf, "dim_skema"))
    store.table("gold.dim_sdgs").create_or_replace(table(spark, sf, "dim_sdgs"))
    return store


@query("SELECT CAST(count(*) > 0 AS INTEGER) AS gagal_dulu, 0 AS gagal_kini, count(*) FILTER (WHERE true) * 0 + (SELECT count(*) FROM bronze_penelitian) - count(*) AS baris FROM bronze_penelitian WHERE \"Judul Proposal\" IS NULL OR lower(trim(\"Judul Proposal\")) IN ('', 'nan', 'none', 'null', 'n/a', 'na', '-', 'nat', 'tidak ada')")
def check_repair_check(spark, sf):
    """Failed checks before and after the repair that removes rows without a title, and the rows that are left."""
    store = _office(spark, sf)
    pipeline.run(store, ["penelitian"])
    checks = lambda s: quality.run(spark, {"silver.penelitian": (s.table("silver.penelitian").read(), quality.Rules(mandatory=("judul_proposal",)))})
    audit = lambda r: quality.title_counts(r, "judul_proposal")
    purge = lambda s: repair.audit_and_publish(s, "silver.penelitian", lambda r: repair.purge_blank(r, "judul_proposal"), audit, repair.PURGE_GATES)
    before, after = pipeline.check_repair_check(store, checks, [purge])
    return store.table("silver.penelitian").read().agg(F.lit(before).alias("gagal_dulu"), F.lit(after).alias("gagal_kini"), F.count("*").alias("baris"))
