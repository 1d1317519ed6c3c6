"""Silver tables from raw sheets in one pass over all years: native columns, no loop over years, no Python in the hot path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.functions import keys, names, text

# Header -> (name, whole number?) of the kinds of sheets.
GRANT = {
    "Judul Proposal": ("judul_proposal", False),
    "Ketua Peneliti": ("ketua_peneliti", False),
    "Jenis": ("jenis", False),
    "Status": ("status", False),
    "Skema": ("skema", False),
    "Scope": ("scope", False),
    "SDGs": ("sdgs", False),
    "Program Studi": ("prodi", False),
    "Anggota Dosen": ("anggota_dosen", False),
    "Anggota Mahasiswa": ("anggota_mahasiswa", False),
    "Advisor": ("advisor", False),
    "Usulan Biaya": ("usulan_biaya", True),
    "Status Proposal": ("status_proposal", False),
}
CITATION = {
    "Nama Dosen": ("ketua_peneliti", False),
    "Nama Prodi": ("prodi", False),
    "Fakultas": ("fakultas", False),
    "Tanggal Terbit": ("tanggal_terbit", False),
    "Kategori": ("kategori", False),
    "Judul": ("judul_proposal", False),
    "Sitasi": ("sitasi", True),
    "Triwulan": ("triwulan", True),
    "Publikasi": ("publikasi", False),
    "DOI": ("doi", False),
}
DROPPED = ("_c0", "No")
LAYOUTS = {"penelitian": GRANT, "pengabdian": GRANT, "buku_keilmuan": GRANT, "sitasi": CITATION}


def renamed(bronze: DataFrame, layout: dict[str, tuple[str, bool]]) -> DataFrame:
    """Known headers renamed and typed, their null stand-ins nulled; unknown columns pass unchanged, missing ones are skipped."""
    out = []
    for c, kind in bronze.dtypes:
        if c in DROPPED:
            continue
        value = F.col(f"`{c}`")
        name, whole = layout.get(c, (c, False))
        if kind == "string" and c in layout:
            value = text.lenient_bigint(value) if whole else text.null_sentinel(value)
        elif whole:
            value = value.cast("bigint")
        out.append(value.alias(name))
    return bronze.select(*out)


def empty_to_null(rows: DataFrame) -> DataFrame:
    """NaN and '' become null; elements of arrays stay."""
    new = {}
    for c, kind in rows.dtypes:
        if kind == "string":
            new[c] = F.nullif(F.col(f"`{c}`"), F.lit(""))
        elif kind in ("double", "float"):
            new[c] = F.nanvl(F.col(f"`{c}`"), F.lit(None))
    return rows.withColumns(new)


def grants(bronze: DataFrame, prefix: str = "PN", kind: str = "penelitian") -> DataFrame:
    """Grant proposals: lead and members with their numbers, programme, faculty, repaired scheme and theme, key ``id``.

    Several sheets may be united by name before or after: every step is row-wise.
    """
    rows = renamed(bronze, LAYOUTS[kind])
    have = set(rows.columns)
    need = [c for c in ("ketua_peneliti", "prodi", "anggota_dosen", "anggota_mahasiswa", "skema", "sdgs", "judul_proposal", "advisor", "scope") if c not in have]
    rows = rows.withColumns({c: F.lit(None).cast("string") for c in need}) if need else rows
    lead = F.col("ketua_peneliti")
    rows = rows.withColumns(
        {
            "nip_ketua_peneliti": text.people_ids(lead),
            "ketua_peneliti": F.get(text.people_names(lead), F.lit(0)),
            "nim_anggota_mahasiswa": text.people_ids(F.col("anggota_mahasiswa")),
            "nama_anggota_mahasiswa": text.people_names(F.col("anggota_mahasiswa")),
            "nip_anggota_dosen": text.people_ids(F.col("anggota_dosen")),
            "nama_anggota_dosen": text.people_names(F.col("anggota_dosen")),
            "fakultas": text.faculty_by_code(F.col("prodi")),
            "prodi": text.programme(F.col("prodi")),
            "advisor": F.get(text.people_names(F.col("advisor")), F.lit(0)),
            "skema": text.scheme(text.strip_punctuation(F.col("skema"))),
            "sdgs": text.scheme(text.strip_punctuation(F.col("sdgs"))),
        }
    ).drop("anggota_dosen", "anggota_mahasiswa")
    rows = empty_to_null(rows)
    return rows.withColumn("id", keys.text_key(prefix, keys.filled(F.col("judul_proposal")), keys.filled(F.col("ketua_peneliti")), F.col("tahun")))


def citations(bronze: DataFrame, prefix: str = "ST", mapping: DataFrame | None = None) -> DataFrame:
    """Citations: date parts, DOI, category and publication split; blanks of other texts stay. Key ``id``.

    The faculty is that of the programme, null for unknown ones. ``mapping`` (dari, menjadi) replaces known spellings of names
    before the key is made.
    """
    rows = renamed(bronze, LAYOUTS["sitasi"]).drop("tahun", "triwulan")
    rows = rows.withColumns(
        {
            "__date": text.strict_date(F.col("tanggal_terbit")),
            "__class": text.journal_class(F.col("kategori")),
            "__source": text.publication(F.col("publikasi")),
            "doi": text.doi(F.col("doi")),
            "ketua_peneliti": F.get(text.people_names(F.col("ketua_peneliti")), F.lit(0)),
            "fakultas": text.faculty_by_programme(F.lower("prodi")),
            "prodi": text.programme(F.col("prodi")),
        }
    )
    split = {
        "tanggal_terbit_hari": "__date.hari", "tanggal_terbit_bulan": "__date.bulan", "tanggal_terbit_tahun": "__date.tahun",
        "tanggal_terbit_timestamp": "__date.waktu", "jurnal": "__class.jurnal", "jurnal_kategori": "__class.kelompok",
        "jurnal_nama": "__source.nama", "jurnal_volume": "__source.volume", "jurnal_issue": "__source.issue",
        "jurnal_halaman": "__source.halaman", "jurnal_tahun": "__source.tahun",
    }
    rows = rows.withColumns({n: F.col(c) for n, c in split.items()}).drop("__date", "__class", "__source", "tanggal_terbit", "kategori", "publikasi")
    if mapping is not None:
        rows = names.mapped_names(rows, "ketua_peneliti", mapping)
    return rows.withColumn("id", keys.text_key(prefix, *[keys.filled(F.col(c)) for c in ("judul_proposal", "ketua_peneliti", "doi")]))
