"""Star schema from silver tables: dimensions and facts as DataFrame functions; keys are replaceable."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung.functions import keys
from lumbung.operators import joins

Key = Callable[..., Column]


def together(*tables: DataFrame) -> DataFrame:
    """Union by name of grant tables of the same shape."""
    return reduce(DataFrame.unionByName, tables)


def _lead(grants: DataFrame, *more: str) -> DataFrame:
    return grants.select(*more, F.col("ketua_peneliti").alias("nama"), F.get("nip_ketua_peneliti", F.lit(0)).alias("nip"))


def _members(grants: DataFrame, *more: str) -> DataFrame:
    return joins.members(grants.select(*more, "nama_anggota_dosen", "nip_anggota_dosen"), "nama_anggota_dosen", "nip_anggota_dosen")


def dim_person(grants: DataFrame, key: Key = keys.int_key) -> DataFrame:
    """Persons: of each valid number the longest name (ties: the smaller text); of others each (name, number)."""
    people = _lead(grants).unionByName(_members(grants)).where(F.col("nama").isNotNull() & (F.trim("nama") != ""))
    valid = F.col("nip").isNotNull() & (F.col("nip") != "0")
    best = people.where(valid).groupBy("nip").agg(F.min_by("nama", F.struct(-F.length("nama"), F.col("nama"))).alias("nama"))
    others = people.where(~valid).select("nama", "nip").distinct()
    rows = best.select("nama", "nip").unionByName(others)
    return rows.select(key(F.coalesce("nama", F.lit("")), F.coalesce("nip", F.lit(""))).alias("dosen_id"), "nama", "nip")


def dim_proposal(grants: DataFrame) -> DataFrame:
    return grants.select(F.col("id").alias("hibah_proposal_id"), "judul_proposal", "status_proposal", F.col("jenis").alias("jenis_hibah")).distinct()


def dim_journal(citations: DataFrame, key: Key = keys.int_key) -> DataFrame:
    """Journals are told apart by their class text and group; their name is the class text, as dashboards expect."""
    rows = citations.select("jurnal", "jurnal_kategori").distinct()
    return rows.select(
        key(F.coalesce("jurnal", F.lit("")), F.coalesce("jurnal", F.lit("")), F.coalesce("jurnal_kategori", F.lit(""))).alias("jurnal_id"),
        F.col("jurnal").alias("nama_jurnal"),
        F.col("jurnal").alias("rank_jurnal"),
        F.col("jurnal_kategori").alias("kategori_jurnal"),
    )


def fact_grant(grants: DataFrame, person: DataFrame, scheme: DataFrame, theme: DataFrame, key: Key = keys.int_key) -> DataFrame:
    """One row a grant: the lead by name and number (another spelling gives null), scheme and theme by normalised text."""
    lead = grants.withColumns({"nama": F.col("ketua_peneliti"), "nip": F.get("nip_ketua_peneliti", F.lit(0))})
    rows = lead.join(person.select("dosen_id", "nama", "nip"), ["nama", "nip"], "left")
    rows = joins.normalized_join(rows, scheme.select("skema_id", "nama_skema"), "skema", "nama_skema")
    rows = joins.normalized_join(rows, theme.select("sdgs_id", "kode_sdgs"), "sdgs", "kode_sdgs")
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    return rows.select(
        key(F.col("id")).alias("hibah_fact_id"),
        F.col("dosen_id").alias("ketua_id"),
        F.col("id").alias("hibah_proposal_id"),
        "skema_id",
        "sdgs_id",
        F.col("jenis").alias("jenis_hibah"),
        "tahun",
        F.col("status").alias("status_hibah"),
        size("nama_anggota_mahasiswa").alias("total_anggota_mahasiswa"),
        size("nama_anggota_dosen").alias("total_anggota_dosen"),
        "usulan_biaya",
    )


def fact_person_grant(grants: DataFrame, person: DataFrame, key: Key = keys.int_key) -> DataFrame:
    """One row a grant and person: the lead always, also without a name, and each zipped member."""
    more = ("id", "jenis", "tahun", "status", "prodi", "fakultas")
    people = _lead(grants, *more).withColumn("role", F.lit("ketua")).unionByName(_members(grants, *more).withColumn("role", F.lit("anggota")))
    known = person.select("dosen_id", F.col("nama").alias("__nama"), F.col("nip").alias("__nip"))
    rows = joins.entity_join(people, known, ("nip", "__nip"), ("nama", "__nama"))
    return rows.select(
        key(F.coalesce("dosen_id", F.lit(0)), F.col("id"), F.col("role")).alias("dosen_hibah_id"),
        "dosen_id",
        F.col("id").alias("hibah_proposal_id"),
        "tahun",
        "role",
        F.col("jenis").alias("jenis_hibah"),
        F.col("status").alias("status_hibah"),
        "prodi",
        "fakultas",
    )


def fact_citation(citations: DataFrame, person: DataFrame, journal: DataFrame, key: Key = keys.int_key) -> DataFrame:
    """Publications by person and journal. Homonyms multiply rows, as a join by name does; citations are pre-aggregated by
    (name, class, group) before the joins, so hot names shuffle as one row."""
    counted = citations.groupBy("ketua_peneliti", "jurnal", "jurnal_kategori").agg(F.count("*").alias("n"))
    rows = counted.join(person.select("dosen_id", F.col("nama").alias("ketua_peneliti")), "ketua_peneliti", "left").join(
        journal.select("jurnal_id", F.col("nama_jurnal").alias("jurnal"), F.col("kategori_jurnal").alias("jurnal_kategori")), ["jurnal", "jurnal_kategori"], "left"
    )
    kind = F.when(F.col("jurnal_id").isNotNull(), F.col("jurnal_kategori"))
    part = lambda k: F.sum(F.when(kind == k, F.col("n")).otherwise(0)).cast("bigint")
    out = rows.groupBy("dosen_id", "jurnal_id").agg(
        F.sum("n").cast("bigint").alias("total_publikasi"), part("INTERNASIONAL").alias("total_internasional"), part("NASIONAL").alias("total_nasional")
    )
    return out.select(key(F.coalesce("dosen_id", F.lit(0)), F.coalesce("jurnal_id", F.lit(0))).alias("sitasi_id"), "*")
