"""Dashboard datasets over the star schema. The accepted status is a parameter."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.functions import keys
from lumbung.operators import joins
from lumbung.plans import gold
from lumbung.session import table

ACCEPTED = "diterima"
UNKNOWN = "Tidak tercatat"


@dataclass(frozen=True)
class Star:
    grants: DataFrame
    bronze: DataFrame
    person: DataFrame
    scheme: DataFrame
    theme: DataFrame
    grant: DataFrame
    person_grant: DataFrame
    citation: DataFrame


def star(spark: SparkSession, sf: str, key: gold.Key = keys.long_key) -> Star:
    """Star of the project's tables, with 64-bit keys."""
    grants, citations = table(spark, sf, "silver_penelitian"), table(spark, sf, "silver_sitasi")
    person = gold.dim_person(grants, key)
    scheme, theme = table(spark, sf, "dim_skema"), table(spark, sf, "dim_sdgs")
    return Star(
        grants,
        table(spark, sf, "bronze_penelitian"),
        person,
        scheme,
        theme,
        gold.fact_grant(grants, person, scheme, theme, key),
        gold.fact_person_grant(grants, person, key),
        gold.fact_citation(citations, person, gold.dim_journal(citations, key), key),
    )


def schemes(s: Star) -> DataFrame:
    return s.scheme


def years(s: Star) -> DataFrame:
    return s.grant.select("tahun").distinct()


def most_grants(s: Star, status: str = ACCEPTED) -> DataFrame:
    """Grants of each person by role and kind, in one aggregate with several distinct counts."""
    rows = s.person_grant.where(F.col("status_hibah") == status).join(s.person.select("dosen_id", "nama"), "dosen_id")
    one = lambda c, v: F.countDistinct(F.when(F.col(c) == v, F.col("hibah_proposal_id")))
    return (
        rows.groupBy("nama")
        .agg(
            one("role", "ketua").alias("total_ketua"),
            one("role", "anggota").alias("total_anggota"),
            *[one("jenis_hibah", j).alias(f"total_{j}") for j in ("penelitian", "pengabdian", "buku_keilmuan")],
            F.countDistinct("hibah_proposal_id").alias("total_hibah"),
        )
        .orderBy(F.desc("total_hibah"), "nama")
    )


def _by(s: Star, dim: DataFrame, key: str, label: str, more: tuple[str, ...] = ()) -> DataFrame:
    rows = (
        s.person.select("dosen_id", "nama")
        .join(s.person_grant.select("dosen_id", "hibah_proposal_id"), "dosen_id")
        .join(s.grant.select("hibah_proposal_id", key), "hibah_proposal_id")
        .join(dim, key)
    )
    counted = rows.groupBy("nama", label, *more).agg(F.countDistinct("hibah_proposal_id").alias("total_proposal"))
    return counted.select("nama", label, "total_proposal").orderBy(F.desc("total_proposal"), "nama", label)


def by_theme(s: Star) -> DataFrame:
    return _by(s, s.theme, "sdgs_id", "kode_sdgs")


def by_scheme(s: Star) -> DataFrame:
    """Grouped by the whole scheme but shown by its name, so that schemes of equal name stay apart."""
    return _by(s, s.scheme, "skema_id", "nama_skema", ("skema_id", "pendanaan_maks"))


def top_programmes(s: Star, k: int = 5, status: str = ACCEPTED) -> DataFrame:
    rows = s.person_grant.where((F.col("role") == "ketua") & (F.col("status_hibah") == status))
    return rows.groupBy("prodi").agg(F.count("*").alias("total")).orderBy(F.desc("total"), F.asc_nulls_last("prodi")).limit(k)


def _led(s: Star, status: str) -> DataFrame:
    led = s.person_grant.where((F.col("status_hibah") == status) & (F.col("role") == "ketua"))
    return (
        led.join(s.person.select("dosen_id", "nama"), "dosen_id", "left")
        .join(s.grant.select("hibah_proposal_id", "skema_id"), "hibah_proposal_id", "left")
        .join(s.scheme.select("skema_id", "nama_skema"), "skema_id", "left")
    )


def by_programme(s: Star, status: str = ACCEPTED) -> DataFrame:
    label = lambda c: F.coalesce(c, F.lit(UNKNOWN)).alias(c)
    return _led(s, status).select(label("fakultas"), label("prodi"), "nama", "jenis_hibah", "tahun", "nama_skema", "hibah_proposal_id")


def by_faculty(s: Star, status: str = ACCEPTED) -> DataFrame:
    return _led(s, status).select(F.coalesce("fakultas", F.lit(UNKNOWN)).alias("fakultas"), "prodi", "nama", "jenis_hibah", "tahun", "nama_skema", "hibah_proposal_id")


def _accepted(s: Star, status: str) -> DataFrame:
    leads = (
        s.person_grant.where(F.col("role") == "ketua")
        .groupBy("hibah_proposal_id")
        .agg(F.max("prodi").alias("prodi"), F.max("fakultas").alias("fakultas"), F.max("dosen_id").alias("__lead"))
    )
    rows = s.grant.where(F.col("status_hibah") == status).join(s.scheme.select("skema_id", "nama_skema"), "skema_id", "left")
    rows = rows.join(leads, "hibah_proposal_id", "left").withColumn("dosen_id", F.coalesce("ketua_id", "__lead"))
    return rows.join(s.person.select("dosen_id", "nama"), "dosen_id", "left")


def accepted(s: Star, status: str = ACCEPTED) -> DataFrame:
    return _accepted(s, status).select("fakultas", "prodi", "nama", "jenis_hibah", "tahun", "nama_skema", "usulan_biaya")


def accepted_amounts(s: Star, status: str = ACCEPTED) -> DataFrame:
    return _accepted(s, status).select("hibah_proposal_id", "jenis_hibah", "fakultas", "prodi", "nama", "tahun", "nama_skema", "usulan_biaya")


def accepted_counts(s: Star, status: str = ACCEPTED) -> DataFrame:
    return accepted_amounts(s, status).drop("usulan_biaya")


def all_grants_of(kinds: dict[str, tuple[DataFrame, DataFrame]], status: str = ACCEPTED) -> DataFrame:
    """Grants of several kinds, (silver, sheet) each, united with the column ``jenis_lembar``."""
    parts = [_with_members(rows, sheet, status).withColumn("jenis_lembar", F.lit(kind)) for kind, (rows, sheet) in kinds.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def all_grants(s: Star, status: str = ACCEPTED) -> DataFrame:
    return _with_members(s.grants, s.bronze, status)


def _with_members(grants: DataFrame, bronze: DataFrame, status: str) -> DataFrame:
    """Grants with the members as typed in the sheet, joined by normalised title; repeated titles multiply."""
    sheet = bronze.select(
        F.upper(F.trim("Judul Proposal")).alias("__title"), F.col("Anggota Mahasiswa").alias("nama_anggota_mahasiswa"), F.col("Anggota Dosen").alias("nama_anggota_dosen")
    )
    rows = grants.where(F.col("status") == status).withColumn("__title", F.upper(F.trim("judul_proposal"))).drop("nama_anggota_mahasiswa", "nama_anggota_dosen")
    own = ("judul_proposal", "ketua_peneliti", "jenis", "status", "scope", "sdgs", "advisor", "usulan_biaya", "status_proposal", "tahun", "prodi", "fakultas", "id")
    return rows.join(sheet, "__title").select(
        *own, F.col("skema").alias("nama_skema"), F.get("nip_ketua_peneliti", F.lit(0)).alias("nip_ketua_peneliti"), "nama_anggota_mahasiswa", "nama_anggota_dosen"
    )


def citations_by_person(s: Star) -> DataFrame:
    i, n = F.sum("total_internasional").cast("bigint"), F.sum("total_nasional").cast("bigint")
    rows = s.citation.join(s.person.select("dosen_id", "nama"), "dosen_id")
    return rows.groupBy("nama").agg(i.alias("total_internasional"), n.alias("total_nasional"), (i + n).alias("total"))


def rollup_by_kind(s: Star, status: str = ACCEPTED) -> DataFrame:
    rows = s.grant.where(F.col("status_hibah") == status)
    return rows.groupBy("jenis_hibah").agg(F.count("*").alias("total"), F.sum("usulan_biaya").cast("bigint").alias("total_dana"))


def rollup_by_faculty(s: Star, status: str = ACCEPTED) -> DataFrame:
    rows = s.person_grant.where((F.col("status_hibah") == status) & (F.col("role") == "ketua"))
    return rows.groupBy("fakultas").agg(F.countDistinct("hibah_proposal_id").alias("total_hibah"))


MARTS = {
    "mart_dimensi_skema": schemes,
    "mart_tahun": years,
    "mart_dosen_hibah_terbanyak": most_grants,
    "mart_partisipasi_dosen_per_sdgs": by_theme,
    "mart_partisipasi_dosen_per_skema": by_scheme,
    "mart_prodi_penerimaan_hibah_terbanyak": top_programmes,
    "mart_program_studi_hibah_terbanyak": by_programme,
    "mart_total_hibah_tiap_fakultas": by_faculty,
    "mart_hibah_diterima": accepted,
    "mart_total_dana_dan_jumlah_tiap_hibah": accepted_amounts,
    "mart_total_diterima_tiap_hibah": accepted_counts,
    "mart_semua_tabel_hibah": all_grants,
    "mart_sitasi_dosen": citations_by_person,
    "mart_rekap_jenis": rollup_by_kind,
    "mart_rekap_fakultas": rollup_by_faculty,
}


def _query(mart):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return mart(star(spark, sf))

    return run


def readable_key(*columns):
    """Keys that SQL can make too: the parts with bars between."""
    return F.concat_ws("|", *[c.cast("string") for c in columns])


def _readable(mart):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return mart(star(spark, sf, readable_key))

    return run


def dim_person(spark: SparkSession, sf: str) -> DataFrame:
    return gold.dim_person(table(spark, sf, "silver_penelitian"), keys.long_key).select("nama", "nip")


def dim_proposal(spark: SparkSession, sf: str) -> DataFrame:
    return gold.dim_proposal(table(spark, sf, "silver_penelitian"))


def dim_journal(spark: SparkSession, sf: str) -> DataFrame:
    return gold.dim_journal(table(spark, sf, "silver_sitasi"), keys.long_key).drop("jurnal_id")


def fact_grant(spark: SparkSession, sf: str) -> DataFrame:
    s = star(spark, sf)
    lead = s.person.select(F.col("dosen_id").alias("ketua_id"), "nama", "nip")
    return s.grant.join(lead, "ketua_id", "left").drop("ketua_id", "hibah_fact_id")


def fact_person_grant(spark: SparkSession, sf: str) -> DataFrame:
    s = star(spark, sf)
    return s.person_grant.join(s.person, "dosen_id", "left").drop("dosen_id", "dosen_hibah_id")


def fact_citation(spark: SparkSession, sf: str) -> DataFrame:
    s = star(spark, sf)
    journals = gold.dim_journal(table(spark, sf, "silver_sitasi"), keys.long_key)
    return s.citation.join(s.person, "dosen_id", "left").join(journals, "jurnal_id", "left").select("nama", "nip", "nama_jurnal", "kategori_jurnal", "total_publikasi", "total_internasional", "total_nasional")


LARGEST_LEAD = ("mart_hibah_diterima", "mart_total_dana_dan_jumlah_tiap_hibah", "mart_total_diterima_tiap_hibah")  # depend on the order of keys
QUERIES = {name: (_readable if name in LARGEST_LEAD else _query)(mart) for name, mart in MARTS.items()} | {
    "gold_dim_dosen": dim_person,
    "gold_dim_hibah_proposal": dim_proposal,
    "gold_dim_jurnal": dim_journal,
    "gold_fact_hibah": fact_grant,
    "gold_fact_dosen_hibah": fact_person_grant,
    "gold_fact_sitasi": fact_citation,
}

_CTE = """WITH people AS (
    SELECT ketua_peneliti AS nama, nip_ketua_peneliti[1] AS nip FROM silver_penelitian
    UNION ALL SELECT z[1], z[2] FROM (SELECT unnest(list_zip(nama_anggota_dosen, nip_anggota_dosen)) AS z FROM silver_penelitian
        WHERE nama_anggota_dosen IS NOT NULL AND nip_anggota_dosen IS NOT NULL)),
named AS (SELECT * FROM people WHERE nama IS NOT NULL AND trim(nama) <> ''),
person AS (
    SELECT nama, nip FROM (SELECT *, row_number() OVER (PARTITION BY nip ORDER BY length(nama) DESC, nama) AS rn FROM named WHERE nip IS NOT NULL AND nip <> '0') WHERE rn = 1
    UNION SELECT nama, nip FROM named WHERE nip IS NULL OR nip = '0'),
fh AS (SELECT h.id AS hibah_proposal_id, d.nama, d.nip, skema_id, sdgs_id, jenis AS jenis_hibah, tahun, status AS status_hibah,
        CAST(coalesce(len(nama_anggota_mahasiswa), 0) AS INTEGER) AS total_anggota_mahasiswa, CAST(coalesce(len(nama_anggota_dosen), 0) AS INTEGER) AS total_anggota_dosen, usulan_biaya
    FROM silver_penelitian h LEFT JOIN person d ON h.ketua_peneliti = d.nama AND h.nip_ketua_peneliti[1] = d.nip
    LEFT JOIN dim_skema sk ON lower(trim(h.skema)) = lower(trim(sk.nama_skema)) LEFT JOIN dim_sdgs sd ON lower(trim(h.sdgs)) = lower(trim(sd.kode_sdgs))),
rows AS (SELECT id, jenis, tahun, status, ketua_peneliti AS nama, nip_ketua_peneliti[1] AS nip, 'ketua' AS role, prodi, fakultas FROM silver_penelitian
    UNION ALL SELECT id, jenis, tahun, status, z[1], z[2], 'anggota', prodi, fakultas FROM (SELECT *, unnest(list_zip(nama_anggota_dosen, nip_anggota_dosen)) AS z
        FROM silver_penelitian WHERE nama_anggota_dosen IS NOT NULL AND nip_anggota_dosen IS NOT NULL)),
kv AS (SELECT *, CASE WHEN nip IS NOT NULL AND nip <> '0' THEN 'N' || nip ELSE 'M' || nama END AS k FROM rows),
pk AS (SELECT *, CASE WHEN nip IS NOT NULL AND nip <> '0' THEN 'N' || nip ELSE 'M' || nama END AS k FROM person),
fdh AS (SELECT d.nama, d.nip, d.nama || '|' || coalesce(d.nip, '') AS person, h.id AS hibah_proposal_id, tahun, role, jenis AS jenis_hibah, status AS status_hibah, prodi, fakultas FROM kv h LEFT JOIN pk d ON h.k = d.k),
fs AS (SELECT d.nama, d.nip, j.jurnal AS nama_jurnal, j.jurnal_kategori AS kategori_jurnal, count(*) AS total_publikasi,
        CAST(sum(CASE WHEN j.jurnal_kategori = 'INTERNASIONAL' THEN 1 ELSE 0 END) AS BIGINT) AS total_internasional, CAST(sum(CASE WHEN j.jurnal_kategori = 'NASIONAL' THEN 1 ELSE 0 END) AS BIGINT) AS total_nasional
    FROM silver_sitasi s LEFT JOIN person d ON s.ketua_peneliti = d.nama LEFT JOIN (SELECT DISTINCT jurnal, jurnal_kategori FROM silver_sitasi) j ON s.jurnal = j.jurnal AND s.jurnal_kategori = j.jurnal_kategori
    GROUP BY d.nama, d.nip, d.nama || '|' || coalesce(d.nip, ''), j.jurnal, j.jurnal_kategori)
"""
_ACCEPTED = """ FROM (SELECT *, nama || '|' || coalesce(nip, '') AS lead FROM fh) fh LEFT JOIN dim_skema USING (skema_id)
    LEFT JOIN (SELECT hibah_proposal_id, max(prodi) AS prodi, max(fakultas) AS fakultas, max(person) AS lead FROM fdh WHERE role = 'ketua' GROUP BY hibah_proposal_id) l USING (hibah_proposal_id)
    LEFT JOIN person d ON coalesce(fh.lead, l.lead) = d.nama || '|' || coalesce(d.nip, '') WHERE fh.status_hibah = 'diterima'"""
_SHEET = "upper(trim(br.\"Judul Proposal\")) = upper(trim(s.judul_proposal))"
ORACLE = {
    "mart_dimensi_skema": "SELECT * FROM dim_skema",
    "mart_tahun": "SELECT DISTINCT tahun FROM silver_penelitian",
    "mart_dosen_hibah_terbanyak": _CTE + """SELECT nama, count(DISTINCT CASE WHEN role = 'ketua' THEN hibah_proposal_id END) AS total_ketua,
        count(DISTINCT CASE WHEN role = 'anggota' THEN hibah_proposal_id END) AS total_anggota, count(DISTINCT CASE WHEN jenis_hibah = 'penelitian' THEN hibah_proposal_id END) AS total_penelitian,
        count(DISTINCT CASE WHEN jenis_hibah = 'pengabdian' THEN hibah_proposal_id END) AS total_pengabdian, count(DISTINCT CASE WHEN jenis_hibah = 'buku_keilmuan' THEN hibah_proposal_id END) AS total_buku_keilmuan,
        count(DISTINCT hibah_proposal_id) AS total_hibah FROM fdh WHERE nama IS NOT NULL AND status_hibah = 'diterima' GROUP BY nama""",
    "mart_partisipasi_dosen_per_sdgs": _CTE + """SELECT fdh.nama, kode_sdgs, count(DISTINCT hibah_proposal_id) AS total_proposal FROM fdh JOIN fh USING (hibah_proposal_id)
        JOIN dim_sdgs USING (sdgs_id) WHERE fdh.nama IS NOT NULL GROUP BY fdh.nama, kode_sdgs""",
    "mart_partisipasi_dosen_per_skema": _CTE + """SELECT fdh.nama, nama_skema, count(DISTINCT hibah_proposal_id) AS total_proposal FROM fdh JOIN fh USING (hibah_proposal_id)
        JOIN dim_skema USING (skema_id) WHERE fdh.nama IS NOT NULL GROUP BY fdh.nama, skema_id, nama_skema, pendanaan_maks""",
    "mart_prodi_penerimaan_hibah_terbanyak": _CTE + "SELECT prodi, count(*) AS total FROM fdh WHERE role = 'ketua' AND status_hibah = 'diterima' GROUP BY prodi ORDER BY total DESC, prodi NULLS LAST LIMIT 5",
    "mart_program_studi_hibah_terbanyak": _CTE + """SELECT coalesce(fakultas, 'Tidak tercatat') AS fakultas, coalesce(prodi, 'Tidak tercatat') AS prodi, fdh.nama, fdh.jenis_hibah, fdh.tahun, nama_skema, fdh.hibah_proposal_id
        FROM fdh LEFT JOIN fh USING (hibah_proposal_id) LEFT JOIN dim_skema USING (skema_id) WHERE fdh.status_hibah = 'diterima' AND role = 'ketua'""",
    "mart_total_hibah_tiap_fakultas": _CTE + """SELECT coalesce(fakultas, 'Tidak tercatat') AS fakultas, prodi, fdh.nama, fdh.jenis_hibah, fdh.tahun, nama_skema, fdh.hibah_proposal_id
        FROM fdh LEFT JOIN fh USING (hibah_proposal_id) LEFT JOIN dim_skema USING (skema_id) WHERE fdh.status_hibah = 'diterima' AND role = 'ketua'""",
    "mart_hibah_diterima": _CTE + "SELECT fakultas, prodi, d.nama, jenis_hibah, tahun, nama_skema, usulan_biaya" + _ACCEPTED,
    "mart_total_dana_dan_jumlah_tiap_hibah": _CTE + "SELECT hibah_proposal_id, jenis_hibah, fakultas, prodi, d.nama, tahun, nama_skema, usulan_biaya" + _ACCEPTED,
    "mart_total_diterima_tiap_hibah": _CTE + "SELECT hibah_proposal_id, jenis_hibah, fakultas, prodi, d.nama, tahun, nama_skema" + _ACCEPTED,
    "mart_semua_tabel_hibah": f"""SELECT s.judul_proposal, s.ketua_peneliti, s.jenis, s.status, s.skema AS nama_skema, s.scope, s.sdgs, s.advisor, s.usulan_biaya, s.status_proposal, s.tahun, s.prodi, s.fakultas,
        s.nip_ketua_peneliti[1] AS nip_ketua_peneliti, br."Anggota Mahasiswa" AS nama_anggota_mahasiswa, br."Anggota Dosen" AS nama_anggota_dosen, s.id
        FROM silver_penelitian s JOIN bronze_penelitian br ON {_SHEET} WHERE s.status = 'diterima'""",
    "mart_sitasi_dosen": _CTE + """SELECT nama, CAST(sum(total_internasional) AS BIGINT) AS total_internasional, CAST(sum(total_nasional) AS BIGINT) AS total_nasional,
        CAST(sum(total_internasional) + sum(total_nasional) AS BIGINT) AS total FROM fs WHERE nama IS NOT NULL GROUP BY nama""",
    "mart_rekap_jenis": _CTE + "SELECT jenis_hibah, count(*) AS total, CAST(sum(usulan_biaya) AS BIGINT) AS total_dana FROM fh WHERE status_hibah = 'diterima' GROUP BY jenis_hibah",
    "mart_rekap_fakultas": _CTE + "SELECT fakultas, count(DISTINCT hibah_proposal_id) AS total_hibah FROM fdh WHERE status_hibah = 'diterima' AND role = 'ketua' GROUP BY fakultas",
    "gold_dim_dosen": _CTE + "SELECT nama, nip FROM person",
    "gold_dim_hibah_proposal": "SELECT DISTINCT id AS hibah_proposal_id, judul_proposal, status_proposal, jenis AS jenis_hibah FROM silver_penelitian",
    "gold_dim_jurnal": "SELECT DISTINCT jurnal AS nama_jurnal, jurnal AS rank_jurnal, jurnal_kategori AS kategori_jurnal FROM silver_sitasi",
    "gold_fact_hibah": _CTE + "SELECT * FROM fh",
    "gold_fact_dosen_hibah": _CTE + "SELECT nama, nip, hibah_proposal_id, tahun, role, jenis_hibah, status_hibah, prodi, fakultas FROM fdh",
    "gold_fact_sitasi": _CTE + "SELECT * FROM fs",
}
