"""The queries of problems 1, 4, 7, 8 and 9."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.llm import canonical, packing, stuffing, tokens, variants
from lumbung.operators.skew import hot_keys, lookup
from lumbung.session import cut, ship, table


# Other names of the entries of the reference lists, as entry: names.
SCHEMES = {
    "Hibah Rintisan Dosen Muda (HRDM)": ("Rintisan Dosen Junior", "Starter Grant for Young Lecturers"),
    "Hibah Unggulan Fakultas (HUF)": ("Unggulan Tingkat Fakultas", "Faculty Flagship Grant"),
    "Riset Terapan Mitra Desa (RTMD)": ("Penelitian Terapan Mitra Desa", "Applied Research with Villages"),
    "Riset Kolaborasi Antar Kampus (RKAK)": ("Penelitian Kolaboratif Antarkampus", "Inter-campus Collaboration"),
    "Riset Dasar Mandiri": ("Penelitian Dasar Swadana", "Independent Basic Research"),
    "Penugasan Rektor": ("Tugas dari Rektor", "Penugasan Pimpinan (Rektor)", "Rector Assignment"),
    "Pendampingan Usaha Kecil (PUK)": ("Pendampingan UMKM", "Small Business Mentoring"),
    "Karya Buku Ajar": ("Penulisan Buku Ajar", "Textbook Writing"),
    "Karya Buku Monograf": ("Penulisan Monograf", "Monograph Writing"),
    "Magang Riset Mahasiswa (MRM)": ("Magang Penelitian Mahasiswa", "Student Research Internship"),
    "Riset Inovasi Purwarupa (RIP)": ("Inovasi Prototipe", "Prototype Innovation Research"),
    "Dana Padanan Industri (DPI)": ("Matching Fund Industri", "Industry Matching Fund"),
    "Riset Pascasarjana (RPS)": ("Penelitian Program Pascasarjana", "Graduate School Research"),
    "Ekspedisi Lapangan Bersama": ("Ekspedisi Lapangan Gabungan", "Joint Field Expedition"),
    "Bina Wilayah Terluar (BWT)": ("Pembinaan Daerah Terluar", "Outer Region Support"),
    "Bina Wilayah Terluar Tahap Lanjut": ("Pembinaan Daerah Terluar Lanjutan", "BWT Lanjutan", "Outer Region Support Phase II"),
    "Riset Cepat Tanggap Bencana": ("Penelitian Tanggap Darurat Bencana", "Rapid Disaster Response Research"),
    "Pertukaran Pakar Tamu": ("Pertukaran Ahli Tamu", "Visiting Expert Exchange"),
}
THEMES = {
    "Tema 1 Dapur Cukup Gizi": ("Gizi Dapur Cukup", "Enough food in every kitchen"),
    "Tema 2 Air Layak Kampung": ("Air Minum Layak untuk Kampung", "Safe water for hamlets"),
    "Tema 3 Energi Mikro Mandiri": ("Energi Skala Mikro", "Self-reliant micro energy"),
    "Tema 4 Sekolah Tanpa Sekat": ("Sekolah Inklusif Tanpa Sekat", "Barrier-free schools"),
    "Tema 5 Kerja Laik Muda Mudi": ("Pekerjaan Layak Pemuda", "Fair jobs for the young"),
    "Tema 6 Kota Pesisir Tangguh": ("Ketangguhan Kota Pantai", "Resilient coastal towns"),
    "Tema 7 Laut Terjaga Bersama": ("Penjagaan Laut Bersama", "Shared care of the sea"),
    "Tema 8 Hutan dan Tanah Pulih": ("Pemulihan Hutan serta Tanah", "Recovering forests and soils"),
    "Tema 9 Sampah Jadi Bahan": ("Limbah Menjadi Bahan Baku", "Waste into feedstock"),
    "Tema 10 Iklim dan Cuaca Desa": ("Perubahan Iklim Tingkat Desa", "Village climate and weather"),
    "Tema 11 Sehat Sejak Dini": ("Kesehatan Sejak Usia Dini", "Healthy from early on"),
    "Tema 12 Perempuan Pengambil Peran": ("Peran Serta Perempuan", "Women taking part"),
    "Tema 13 Tata Kelola Jujur": ("Pemerintahan Jujur", "Honest governance"),
    "Tema 14 Inovasi Alat Tepat Guna": ("Inovasi Alat TTG", "Appropriate tool innovation"),
    "Tema 15 Budaya Bahari Hidup": ("Kebudayaan Maritim yang Hidup", "Living maritime culture"),
    "Tema 16 Jejaring Mitra Dunia": ("Jejaring Kemitraan Global", "Global partner network"),
}
PROGRAMMES = {
    "OSEANOGRAFI PESISIR": ("Ilmu Kelautan Pesisir", "Coastal Oceanography"),
    "STATISTIKA TERAPAN": ("Statistik Terapan", "Applied Statistics"),
    "MAGISTER STATISTIKA TERAPAN": ("Master of Applied Statistics", "Magister Statistik Terapan", "Mag. Stat. Terapan"),
    "ASTRONOMI OBSERVASI": ("Astronomi Pengamatan", "Observational Astronomy"),
    "ILMU TANAH VULKANIK": ("Ilmu Tanah Gunung Api", "Volcanic Soil Science"),
    "BIOKIMIA PANGAN": ("Biokimia Makanan", "Food Biochemistry"),
    "KARTOGRAFI DIGITAL": ("Pemetaan Digital", "Digital Cartography"),
    "TEKNIK IRIGASI RAWA": ("Teknik Pengairan Rawa", "Tek. Pengairan Rawa", "Swamp Irrigation Engineering"),
    "TEKNIK IRIGASI LAHAN KERING": ("Teknik Pengairan Lahan Kering", "Tek. Pengairan Lahan Kering", "Dryland Irrigation Engineering"),
    "TEKNIK KERAMIK": ("Rekayasa Keramik", "Ceramic Engineering"),
    "TEKNIK AKUSTIK": ("Rekayasa Akustik", "Acoustical Engineering", "Acoustic Engineering"),
    "TEKNIK TURBIN ANGIN": ("Rekayasa Kincir Angin", "Wind Turbine Engineering"),
    "REKAYASA BAMBU": ("Teknik Bambu", "Bamboo Engineering"),
    "REKAYASA PELABUHAN": ("Teknik Pelabuhan", "Harbour Engineering", "Port Engineering"),
    "REKAYASA PERANGKAT TERTANAM": ("Rekayasa Embedded", "Embedded Systems Engineering"),
    "SISTEM CERDAS": ("Sistem Kecerdasan Artifisial", "Intelligent Systems"),
    "LINGUISTIK KOMPUTASI": ("Ilmu Bahasa Komputasional", "Computational Linguistics"),
    "ARKEOLOGI BAHARI": ("Arkeologi Maritim", "Maritime Archaeology"),
    "EKONOMI PERDESAAN": ("Ekonomi Desa", "Rural Economics"),
    "KEBIJAKAN PUBLIK DAERAH": ("Kebijakan Publik Lokal", "Regional Public Policy"),
    "PSIKOLOGI KOMUNITAS": ("Psikologi Masyarakat", "Community Psychology"),
    "HUKUM AGRARIA": ("Hukum Pertanahan", "Agrarian Law"),
    "MUSIK NUSANTARA": ("Seni Musik Nusantara", "Music of the Archipelago"),
    "SENI KRIYA KAYU": ("Kerajinan Kayu", "Wood Craft"),
    "GIZI KELUARGA PESISIR": ("Ilmu Gizi Keluarga Pantai", "Coastal Family Nutrition"),
    "KESEHATAN HEWAN TROPIS": ("Kesehatan Satwa Tropis", "Tropical Animal Health"),
    "PERIKANAN BUDIDAYA": ("Budi Daya Ikan", "Aquaculture"),
    "AGROEKOLOGI TROPIKA": ("Ekologi Pertanian Tropis", "Tropical Agroecology"),
    "KEPERAWATAN KOMUNAL": ("Ilmu Perawatan Komunal", "Communal Nursing"),
}


def _aliases(names: dict[str, tuple[str, ...]]) -> dict[str, str]:
    return {other: entry for entry, others in names.items() for other in others}


RULES = {
    "skema": canonical.Rules(
        wrappers=(r"^skema ", r" internal$", r" maks(imal)? (rp )?\d+ (juta|jt)$", r" 20 ?\d\d$", r" \d+$"),
        initials=True,
        aliases=_aliases(SCHEMES),
    ),
    "sdgs": canonical.Rules(
        wrappers=(r" (tema )?\d+$", r"^(tema|t) "),
        numbered=r"(?:tema|t) (\d+)\b|(\d+)\b",
        number=r"tema (\d+)",
        aliases=_aliases(THEMES),
    ),
    "prodi": canonical.Rules(
        wrappers=(r"^f(sb|rt|hm|kh) ", r"^(program studi|prodi|jurusan) ", r"^s 1 "),
        initials=True,
        rewrites=((r"^s 2 (?!magister)", "magister "),),
        aliases=_aliases(PROGRAMMES),
    ),
}
REFERENCES = {"skema": ("dim_skema", "skema_id", "nama_skema"), "sdgs": ("dim_sdgs", "sdgs_id", "kode_sdgs"), "prodi": ("dim_prodi", "prodi_id", "nama_prodi")}


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns are one long frame, so that the table is read once for its distinct values and once for its rows."""
    entered = table(spark, sf_dir, "silver_penelitian").select("id", *RULES).unpivot("id", list(RULES), "kolom", "nilai")
    entered = entered.where(F.trim(F.regexp_replace("nilai", r"\s", " ")) != "").withColumn("kunci", F.concat_ws("\u0001", "kolom", "nilai"))
    counted = cut(entered.groupBy("kolom", "nilai", "kunci").count())
    parts = []
    for column, (name, key, label) in REFERENCES.items():
        reference = table(spark, sf_dir, name).select(key, label)
        own = reference.select(F.col(label).alias("v")).distinct()
        free = counted.where(F.col("kolom") == column).select(F.col("nilai").alias("v")).join(own, "v", "left_anti")
        decided = canonical.decided(free, reference, key, label, RULES[column])
        parts.append(decided.select(F.concat_ws("\u0001", F.lit(column), "v").alias("kunci"), "__found.ref_id"))
    meant = parts[0].unionByName(parts[1]).unionByName(parts[2])
    found = lookup(entered.select("id", "kolom", "kunci"), meant, "kunci", hot_keys(counted, "kunci"))
    return found.select("id", "kolom", "ref_id").distinct()


NICKNAMES = 10_000


def nicknames(spark: SparkSession, sf_dir: str) -> dict[str, frozenset[str]]:
    """The bounded list of nicknames (some hundreds) as nickname -> official words."""
    rows = table(spark, sf_dir, "panggilan").distinct().limit(NICKNAMES + 1).collect()
    if len(rows) > NICKNAMES:
        raise ValueError(f"more than {NICKNAMES} nicknames; they are not broadcast")
    out = defaultdict(set)
    for r in rows:
        if r.nama_resmi and r.nama_panggilan:
            out[r.nama_panggilan.lower()].add(r.nama_resmi.lower())
    return {k: frozenset(v) for k, v in out.items()}


def _mentions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Every mention of a person, and the main rows of the lecturers."""
    lecturers = table(spark, sf_dir, "dim_dosen").select("dosen_id", "nama", "nip")
    has_number = F.col("nip").isNotNull() & (F.col("nip") != "0")
    main = lecturers.where(has_number).select("dosen_id", "nama")
    cited = table(spark, sf_dir, "silver_sitasi").select(
        F.lit("sitasi").alias("sumber"), "id", F.lit(0).alias("posisi"), F.col("ketua_peneliti").alias("ditulis")
    )
    members = table(spark, sf_dir, "silver_penelitian").select("id", F.posexplode("nama_anggota_dosen").alias("k", "ditulis"))
    members = members.select(F.lit("penelitian").alias("sumber"), "id", (F.col("k") + 1).alias("posisi"), "ditulis")
    others = lecturers.where(~has_number).select(
        F.lit("dim_dosen").alias("sumber"), F.col("dosen_id").cast("string").alias("id"), F.lit(0).alias("posisi"), F.col("nama").alias("ditulis")
    )
    return cited.unionByName(members).unionByName(others), main


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    mentions, main = _mentions(spark, sf_dir)
    found = variants.mentions_linked(mentions, "ditulis", main, "dosen_id", "nama", nicknames(spark, sf_dir))
    return found.select("sumber", "id", "posisi", "dosen_id").distinct()


def p1_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spellings of people without a main row, grouped: ditulis, kelompok."""
    mentions, main = _mentions(spark, sf_dir)
    names = cut(mentions.select("ditulis").where(F.col("ditulis").isNotNull()).distinct())
    linked = variants.link(names, "ditulis", main, "dosen_id", "nama", nicknames(spark, sf_dir))
    return variants.grouped(names.join(linked, "ditulis", "left_anti"), "ditulis")


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode(table(spark, sf_dir, "documents"), keep=["doc_id"])


CONTAINER = 2_048
LENGTHS = (256, 512, 1_024, CONTAINER)


def p8_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in containers of at most 2,048 tokens: the permitted lengths are optimised jointly, the longest where it fills
    as well, and each container is downsized to its contents."""
    sizes = tokens.measured(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return packing.packed(sizes, "doc_id", "n_token", LENGTHS)


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.fill(p8_packed(spark, sf_dir))


def p8_lengths_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``p8_packed``."""
    return p8_packed(spark, sf_dir)


def p8_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.fill(p8_lengths_packed(spark, sf_dir))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stuffing.stuffed(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id").distinct()


def prepared(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    run.__name__ = query.__name__
    return run


QUERIES = {q.__name__: prepared(q) for q in (p1_found, p1_groups, p4_found, p7_ids, p8_packed, p8_fill, p8_lengths_packed, p8_lengths, p9_found)}
ORACLE: dict[str, str] = {}
