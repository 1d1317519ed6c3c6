"""The queries of the general training-data problems (2, 3, 5 and 6) over the project's tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.operators import drift
from lumbung.operators import orphans as orphan
from lumbung.operators import packed
from lumbung.operators import profile as prof
from lumbung.session import cut, ship, table

FACT_REFERENCES = (
    (orphan.Reference("dosen_id", "dosen_id"), "dim_dosen"),
    (orphan.Reference("jurnal_id", "jurnal_id"), "dim_jurnal"),
)


# Other headers of the columns of bronze_penelitian. Only the oracle SQL and tests use them.
HEADERS = {
    "Judul Proposal": ("Judul", "Judul Usulan", "Judul Penelitian", "Title"),
    "Ketua Peneliti": ("Ketua", "Nama Ketua Peneliti", "Nama Ketua", "Ketua Pengusul"),
    "Skema": ("Nama Skema", "Skema Pendanaan", "Skema Penelitian", "Scheme"),
    "SDGs": ("Tema SDGs", "SDG", "Tema SDG"),
    "Program Studi": ("Prodi", "Nama Prodi", "Jurusan", "Homebase", "Study Program", "Prog. Studi", "Asal Prodi Ketua", "Prodi Ketua", "Prodi Pengusul"),
    "Anggota Dosen": ("Dosen Anggota", "Dosen Terlibat", "Nama Anggota Dosen"),
    "Anggota Mahasiswa": ("Mahasiswa Terlibat", "Mahasiswa Anggota", "Mahasiswa", "Nama Anggota Mahasiswa"),
    "Usulan Biaya": (
        "Biaya Usulan", "Anggaran Diajukan", "Dana Diusulkan", "Proposed Budget", "RAB", "Nilai Usulan", "Usulan Dana", "Dana Usulan",
        "Biaya Diusulkan", "Biaya Diajukan", "Dana Diajukan", "Anggaran Usulan", "Usulan Anggaran", "Anggaran Diusulkan", "Usulan Biaya Rp",
    ),
    "Status": ("Status Usulan",),
    "Status Proposal": ("Status Laporan",),
}
LAYOUT = drift.Layout(
    columns=(
        "No", "Judul Proposal", "Ketua Peneliti", "Jenis", "Status", "Skema", "Scope", "SDGs", "Program Studi", "Anggota Dosen",
        "Anggota Mahasiswa", "Advisor", "Usulan Biaya", "Status Proposal",
    ),
    names=HEADERS,
    branches=("Usulan Biaya", "Program Studi"),
    amounts=("Usulan Biaya",),
)
LEARNED = replace(LAYOUT, names={})  # headers other than the columns' own are known by their values alone
_RAW = ("berkas_id", "pengirim_id", "periode", "dimuat_pada", "rekaman")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.changes(table(spark, sf_dir, "raw_penelitian"), *_RAW, LEARNED).select("berkas_id", "kolom", "perubahan").distinct()


def p2_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "raw_penelitian")
    return drift.consistent(raw, "berkas_id", "rekaman", LEARNED).withColumn("tahun", F.floor(F.col("periode") / 10).cast("int")).drop("rekaman")


def p2_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.alternatives(table(spark, sf_dir, "raw_penelitian"), "berkas_id", "rekaman", LEARNED)


def p2_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of each column of the consistent table by file."""
    rows = p2_table(spark, sf_dir)
    raw = set(table(spark, sf_dir, "raw_penelitian").columns)
    names = [c for c in rows.columns if c not in raw and c != "tahun" and not any(c == f"{b} [{t}]" for b in LAYOUT.branches for t in drift.TAGS)]
    counted = rows.groupBy("berkas_id").agg(*[F.count(f"`{c}`").alias(c) for c in names])
    return counted.unpivot("berkas_id", [f"`{c}`" for c in names], "kolom", "nilai").where("nilai > 0")


MEMBER_COLUMNS = ("Anggota Dosen", "Anggota Mahasiswa")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = table(spark, sf_dir, "bronze_penelitian").select("baris_id", *[f"`{c}`" for c in MEMBER_COLUMNS])
    long = bronze.unpivot("baris_id", [f"`{c}`" for c in MEMBER_COLUMNS], "kolom", "teks")
    return packed.split(long, "teks").select("baris_id", "kolom", "posisi", "nama", "nomor")  # distinct, as baris_id is


TITLE = prof.Format(bad=r"[^A9 .,:()/'-]|  |^ | $|^(?!(?:.* )?A(?: .*)? A(?: .*)? A(?: .*)? A(?: .*)?$)", exact=None)
DOI = prof.Format(bad=r"[¿␣ <>\"]|^(?!A://A\.A/99\.9{4,9}/)", exact=r"^https://doi\.example/10\.[0-9]{4,9}/[!-~&&[^<>\"]]+$")
NULL_GAP, MEAN_GAP = 0.21, 0.26
PROFILED = {"silver_penelitian": ("muat_id", "judul_proposal"), "silver_sitasi": ("muat_id", "doi")}


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = []
    for (name, (load, column)), fmt in zip(PROFILED.items(), (TITLE, DOI)):
        rows = table(spark, sf_dir, name).select("id", load, column)
        bad = prof.malformed(rows, column, fmt)
        parts.append(bad.select(F.lit(name).alias("tabel"), F.lit(column).alias("kolom"), F.lit("nilai").alias("jenis"), F.col("id").alias("kunci")))
        figures = prof.load_figures(rows, load, {column: F.length(column)}, {column: F.col(column).isNotNull()})
        parts.append(_loads(figures, name))
    rows = table(spark, sf_dir, "dq_report")
    bad = rows.where(prof.inconsistent(F.col("score"), F.col("total_records"), F.col("failed_records"), 0.015))
    key = F.concat_ws("/", *[F.coalesce(F.col(c), F.lit("")) for c in ("run_id", "table_name", "column_name", "metric")])
    parts.append(bad.select(F.lit("dq_report").alias("tabel"), F.lit("score").alias("kolom"), F.lit("nilai").alias("jenis"), key.alias("kunci")))
    usable = {"score": F.col("score").between(0, 100)}
    parts.append(_loads(prof.load_figures(rows, "run_id", {"score": F.col("score")}, usable), "dq_report"))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.distinct()


def _loads(figures: DataFrame, name: str) -> DataFrame:
    far = prof.differing_loads(figures, NULL_GAP, MEAN_GAP)
    return far.select(F.lit(name).alias("tabel"), "kolom", F.lit("muat").alias("jenis"), F.col("muat").alias("kunci"))


LOADS = {"silver_penelitian": "muat_id", "silver_sitasi": "muat_id", "dq_report": "run_id"}
MASKED = {"silver_penelitian": ["judul_proposal", "ketua_peneliti", "skema", "sdgs", "prodi"], "silver_sitasi": ["doi", "ketua_peneliti", "jurnal_halaman"]}


def p5_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [prof.profile(table(spark, sf_dir, t), load).withColumn("tabel", F.lit(t)) for t, load in LOADS.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _masks(spark: SparkSession, sf_dir: str, what, columns: dict[str, list[str]]) -> DataFrame:
    parts = [what(prof.masks(table(spark, sf_dir, t), LOADS[t], names)).withColumn("tabel", F.lit(t)) for t, names in columns.items()]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def p5_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dominant and rare masks of every column of the profiled tables."""
    columns = {t: table(spark, sf_dir, t).columns for t in LOADS}
    kind = F.when(F.col("bagian") < prof.RARE, "jarang").otherwise("dominan")
    return _masks(spark, sf_dir, prof.mask_shares, columns).withColumn("jenis", kind)


def p5_rare_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rare masks of the columns that its SQL covers; ``p5_masks`` has those of all columns."""
    return _masks(spark, sf_dir, prof.rare_masks, MASKED)


def p5_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = {t: [c for c in table(spark, sf_dir, t).columns if c != load] for t, load in LOADS.items()}
    found = _masks(spark, sf_dir, lambda counts: prof.divergence(cut(counts)), columns)  # the counts are used four times
    return found.withColumn("divergensi", F.round("divergensi", 9))


def _malformed_sql(name: str, column: str, good: str) -> str:
    return f"""SELECT '{name}' AS tabel, '{column}' AS kolom, 'nilai' AS jenis, id AS kunci FROM {name}
        WHERE {column} IS NOT NULL AND NOT ({good})"""


def _loads_sql(name: str, load: str, column: str, figure: str) -> str:
    return f"""SELECT '{name}' AS tabel, '{column}' AS kolom, 'muat' AS jenis, muat AS kunci FROM (
        SELECT muat, s, r, median(s) OVER () AS ms, median(r) OVER () AS mr FROM (
            SELECT CAST({load} AS VARCHAR) AS muat, count(*) FILTER (WHERE {column} IS NULL) / count(*) AS s, avg({figure}) AS r
            FROM {name} GROUP BY {load})) WHERE abs(s - ms) > 0.21 OR abs(r - mr) > 0.26 * mr"""


_WANTED = "CASE WHEN total_records = 0 THEN 100.0 ELSE 100.0 * (total_records - failed_records) / total_records END"
P5_SQL = " UNION ".join(
    [
        _malformed_sql(
            "silver_penelitian",
            "judul_proposal",
            """regexp_full_match(judul_proposal, '[A-Za-z0-9 .,:()/''-]*') AND judul_proposal NOT LIKE ' %'
            AND judul_proposal NOT LIKE '% ' AND judul_proposal NOT LIKE '%  %'
            AND len(list_filter(string_split(judul_proposal, ' '), lambda w: regexp_full_match(w, '[A-Za-z]+'))) >= 4""",
        ),
        _malformed_sql(
            "silver_sitasi", "doi", r"""regexp_full_match(doi, 'https://doi\.example/10\.[0-9]{4,9}/[!#-;=?-~]+')"""
        ),
        f"""SELECT 'dq_report' AS tabel, 'score' AS kolom, 'nilai' AS jenis,
            coalesce(run_id, '') || '/' || coalesce(table_name, '') || '/' || coalesce(column_name, '') || '/' || coalesce(metric, '') AS kunci
            FROM dq_report WHERE score IS NOT NULL AND (isnan(score) OR abs(score - ({_WANTED})) > 0.015)""",
        _loads_sql("silver_penelitian", "muat_id", "judul_proposal", "length(judul_proposal)"),
        _loads_sql("silver_sitasi", "muat_id", "doi", "length(doi)"),
        _loads_sql("dq_report", "run_id", "score", "CASE WHEN score BETWEEN 0 AND 100 THEN score END"),
    ]
)


def fact_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = table(spark, sf_dir, "fact_sitasi").select("sitasi_id", "dosen_id", "jurnal_id", "tahun", "triwulan", "dimuat_pada")
    parts = [orphan.orphans(facts, table(spark, sf_dir, dim), ref) for ref, dim in FACT_REFERENCES]
    return parts[0].unionByName(parts[1])


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_orphans(spark, sf_dir).select("sitasi_id", "kolom", "sebab").distinct()


def p6_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphan.by_period(fact_orphans(spark, sf_dir), "fact_sitasi", ["tahun", "triwulan"])


_P6_ROWS = """
    SELECT f.sitasi_id, 'dosen_id' AS kolom, f.tahun, f.triwulan,
           CASE WHEN d.dosen_id IS NULL THEN 'hilang' WHEN d.dimuat_pada > f.dimuat_pada THEN 'terlambat'
                WHEN d.dihapus_pada <= f.dimuat_pada THEN 'dihapus' END AS sebab
    FROM fact_sitasi f LEFT JOIN dim_dosen d ON d.dosen_id = f.dosen_id WHERE f.dosen_id IS NOT NULL
    UNION ALL
    SELECT f.sitasi_id, 'jurnal_id', f.tahun, f.triwulan,
           CASE WHEN j.jurnal_id IS NULL THEN 'hilang' WHEN j.dimuat_pada > f.dimuat_pada THEN 'terlambat'
                WHEN j.dihapus_pada <= f.dimuat_pada THEN 'dihapus' END
    FROM fact_sitasi f LEFT JOIN dim_jurnal j ON j.jurnal_id = f.jurnal_id WHERE f.jurnal_id IS NOT NULL
"""

QUERIES = {
    "p2_found": p2_found,
    "p2_table": p2_table,
    "p2_types": p2_types,
    "p2_filled": p2_filled,
    "p3_found": p3_found,
    "p5_found": p5_found,
    "p5_profile": p5_profile,
    "p5_masks": p5_masks,
    "p5_rare_masks": p5_rare_masks,
    "p5_divergence": p5_divergence,
    "p6_found": p6_found,
    "p6_report": p6_report,
}

def _mask_sql(name: str, columns: list[str], arrays: tuple[str, ...] = ()) -> str:
    steps = "CAST({c} AS VARCHAR)"
    for pattern, to in (
        ("[^\\x20-\\x7E\\s]", "chr(1)"), ("[\\t\\n\\x0B\\f\\r]", "chr(2)"), ("[A-Za-z]+", "'A'"), ("[0-9]", "'9'"), ("9{{10,}}", "'9999999999'"),
    ):
        steps = f"regexp_replace({steps}, '{pattern}', {to}, 'g')"
    steps = f"translate({steps}, chr(1) || chr(2), '¿␣')"
    return " UNION ALL ".join(
        f"SELECT '{c}' AS kolom, CAST({LOADS[name]} AS VARCHAR) AS muat, {steps.format(c='v')} AS topeng FROM (SELECT {LOADS[name]}, {f'unnest({c})' if c in arrays else c} AS v FROM {name}) WHERE v IS NOT NULL"
        for c in columns
    )


P5_RARE_SQL = " UNION ALL ".join(
    f"""SELECT '{t}' AS tabel, kolom, topeng, n AS baris, n / semua AS bagian FROM (
        SELECT kolom, topeng, n, CAST(sum(n) OVER (PARTITION BY kolom) AS BIGINT) AS semua FROM (
            SELECT kolom, topeng, count(*) AS n FROM ({_mask_sql(t, columns)}) GROUP BY kolom, topeng))
        WHERE n / semua < 0.001"""
    for t, columns in MASKED.items()
)

# The columns of the profiled tables, arrays apart.
_COLUMNS = {
    "silver_penelitian": (
        ("judul_proposal", "ketua_peneliti", "jenis", "status", "skema", "scope", "sdgs", "advisor", "usulan_biaya", "status_proposal", "tahun", "prodi", "fakultas", "id", "muat_id", "dimuat_pada"),
        ("nip_ketua_peneliti", "nim_anggota_mahasiswa", "nama_anggota_mahasiswa", "nip_anggota_dosen", "nama_anggota_dosen"),
    ),
    "silver_sitasi": (
        (
            "fakultas", "judul_proposal", "sitasi", "doi", "prodi", "ketua_peneliti", "tanggal_terbit_hari", "tanggal_terbit_bulan", "tanggal_terbit_tahun", "tanggal_terbit_timestamp",
            "jurnal", "jurnal_kategori", "jurnal_nama", "jurnal_volume", "jurnal_issue", "jurnal_halaman", "jurnal_tahun", "id", "muat_id", "dimuat_pada",
        ),
        (),
    ),
    "dq_report": (
        ("run_id", "run_timestamp", "table_name", "column_name", "dimension", "metric", "total_records", "failed_records", "score", "threshold", "status"),
        (),
    ),
}
P5_MASKS_SQL = " UNION ALL ".join(
    f"""SELECT '{t}' AS tabel, kolom, topeng, n AS baris, n / semua AS bagian, CASE WHEN n / semua < 0.001 THEN 'jarang' ELSE 'dominan' END AS jenis FROM (
        SELECT kolom, topeng, n, CAST(sum(n) OVER (PARTITION BY kolom) AS BIGINT) AS semua FROM (
            SELECT kolom, topeng, count(*) AS n FROM ({_mask_sql(t, [*plain, *arrays], arrays)}) GROUP BY kolom, topeng))"""
    for t, (plain, arrays) in _COLUMNS.items()
)
P5_DIVERGENCE_SQL = " UNION ALL ".join(
    f"""SELECT '{t}' AS tabel, * FROM (WITH c AS MATERIALIZED (SELECT kolom, muat, topeng, count(*) AS n FROM ({_mask_sql(t, [x for x in (*plain, *arrays) if x != LOADS[t]], arrays)}) GROUP BY ALL),
        l AS (SELECT kolom, muat, sum(n) AS n FROM c GROUP BY ALL), k AS (SELECT kolom, sum(n) AS n FROM c GROUP BY ALL), m AS (SELECT kolom, topeng, sum(n) AS n FROM c GROUP BY ALL),
        p AS (SELECT l.kolom, l.muat, l.n, coalesce(c.n, 0) / l.n AS p, (m.n - coalesce(c.n, 0)) / nullif(k.n - l.n, 0) AS q
            FROM l JOIN k USING (kolom) JOIN m USING (kolom) LEFT JOIN c ON c.kolom = l.kolom AND c.muat = l.muat AND c.topeng = m.topeng)
        SELECT kolom, muat, CAST(n AS BIGINT) AS baris, round(sum(CASE WHEN q IS NOT NULL THEN CASE WHEN p > 0 THEN 0.5 * p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN 0.5 * q * log2(2 * q / (p + q)) ELSE 0 END END), 9) AS divergensi
        FROM p GROUP BY kolom, muat, n)"""
    for t, (plain, arrays) in _COLUMNS.items()
)


def _p2_sql(types: bool = False, filled: bool = False) -> str:
    names = {drift.squash(h): c for c in LAYOUT.columns for h in (c, *HEADERS.get(c, ()))}
    meant = " ".join(f"WHEN '{k}' THEN '{c}'" for k, c in names.items())
    squashed = r"regexp_replace(regexp_replace(lower(header), '\([^)]*\)', '', 'g'), '[^a-z0-9]', '', 'g')"
    kinds = """CASE json_type(json_extract(rekaman, '$."' || header || '"')) WHEN 'UBIGINT' THEN 1 WHEN 'BIGINT' THEN 1 WHEN 'HUGEINT' THEN 1 WHEN 'DOUBLE' THEN 2
        WHEN 'VARCHAR' THEN 3 WHEN 'BOOLEAN' THEN 4 WHEN 'OBJECT' THEN 5 WHEN 'ARRAY' THEN 6 END"""
    cells = f"""WITH cells AS (SELECT berkas_id, unnest(json_keys(rekaman)) AS header, rekaman FROM raw_penelitian WHERE json_valid(rekaman)),
    counted AS (SELECT berkas_id, header, {kinds} AS t, count(*) AS n FROM cells GROUP BY ALL)"""
    if filled:
        return cells + f""" SELECT berkas_id, CASE {squashed} {meant} ELSE header END AS kolom, CAST(sum(n) AS BIGINT) AS nilai FROM counted WHERE t IS NOT NULL GROUP BY 1, 2"""
    if types:
        return cells + f""" SELECT CASE {squashed} {meant} ELSE header END AS kolom, ['bulat', 'desimal', 'string', 'boolean', 'objek', 'larik'][t] AS tipe,
            CAST(sum(n) AS BIGINT) AS nilai, count(DISTINCT berkas_id) AS berkas, count(DISTINCT header) AS header, min(berkas_id) AS berkas_pertama
            FROM counted WHERE t IS NOT NULL GROUP BY 1, 2"""
    return f"""{cells},
    fields AS (SELECT berkas_id, header, CASE {squashed} {meant} ELSE header END AS kolom, max_by(t, n * 10 - t) FILTER (WHERE t IS NOT NULL) AS tipe FROM counted GROUP BY berkas_id, header),
    files AS (SELECT pengirim_id, periode, max_by(berkas_id, (d, berkas_id)) AS berkas_id FROM (SELECT berkas_id, pengirim_id, periode, max(dimuat_pada) AS d FROM raw_penelitian GROUP BY ALL) GROUP BY ALL),
    numbered AS (SELECT *, row_number() OVER w AS seq, lead(berkas_id) OVER w AS berikut FROM files WINDOW w AS (PARTITION BY pengirim_id ORDER BY periode)),
    kept AS (SELECT f.*, n.pengirim_id, n.seq, n.berikut, last_value(tipe IGNORE NULLS) OVER (PARTITION BY pengirim_id, kolom ORDER BY seq) AS t FROM fields f JOIN numbered n USING (berkas_id)),
    seen AS (SELECT *, lag(seq) OVER w AS s0, lead(seq) OVER w AS s1, lag(header) OVER w AS h0, lag(t) OVER w AS t0 FROM kept WINDOW w AS (PARTITION BY pengirim_id, kolom ORDER BY seq))
    SELECT DISTINCT berkas_id, kolom, 'added' AS perubahan FROM seen WHERE seq > 1 AND s0 IS DISTINCT FROM seq - 1
    UNION ALL SELECT DISTINCT berikut, kolom, 'removed' FROM seen WHERE berikut IS NOT NULL AND s1 IS DISTINCT FROM seq + 1
    UNION ALL SELECT DISTINCT berkas_id, kolom, 'renamed' FROM seen WHERE s0 = seq - 1 AND header <> h0
    UNION ALL SELECT DISTINCT berkas_id, kolom, 'retyped' FROM seen WHERE s0 = seq - 1 AND tipe <> t0"""


ORACLE = {
    "p2_found": _p2_sql(),
    "p2_types": _p2_sql(types=True),
    "p2_filled": _p2_sql(filled=True),
    "p5_found": P5_SQL,
    "p5_rare_masks": P5_RARE_SQL,
    "p5_masks": P5_MASKS_SQL,
    "p5_divergence": P5_DIVERGENCE_SQL,
    "p6_found": f"SELECT DISTINCT sitasi_id, kolom, sebab FROM ({_P6_ROWS}) WHERE sebab IS NOT NULL",
    "p6_report": f"""SELECT 'fact_sitasi' AS tabel, kolom, tahun, triwulan, sebab, count(*) AS baris
        FROM ({_P6_ROWS}) WHERE sebab IS NOT NULL GROUP BY kolom, tahun, triwulan, sebab""",
}


def prepared(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    run.__name__ = query.__name__
    return run
