"""Queries of the text functions over the sheets, citations and documents, each with its oracle where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.functions import keys, names, sections, text
from lumbung.plans import silver
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


# SQL of the functions. White space is spelled out, since the engines' short forms differ outside ASCII.
_WS = r"[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_SENTINELS = ", ".join(f"'{s}'" for s in text.SENTINELS)


def _strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{_WS}+', ''), '{_WS}+$', '')"


def _sentinel(x: str) -> str:
    return f"CASE WHEN lower({_strip(x)}) IN ({_SENTINELS}) THEN NULL ELSE {x} END"


def _spaced(x: str) -> str:
    return f"nullif(regexp_replace({_strip(_sentinel(x))}, '{_WS}+', ' ', 'g'), '')"


def _bare(x: str) -> str:
    return _spaced(f"regexp_replace({x}, '[^a-zA-Z0-9\\t-\\r \\x{{85}}\\x{{a0}}\\x{{1680}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{205f}}\\x{{3000}}]', ' ', 'g')")


def _table(x: str, known: dict) -> str:
    return f"CASE {x} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in known.items()) + " END"


def _ids(x: str) -> str:
    groups = f"list_filter(list_transform(regexp_extract_all({_sentinel(x)}, '\\(([^)]*)\\)', 1), lambda g: trim(g)), lambda g: regexp_matches(g, '^[0-9]*$'))"
    return f"CASE WHEN len({groups}) > 0 THEN list_transform({groups}, lambda g: CASE WHEN g = '' THEN '0' ELSE g END) END"


def _person(x: str) -> str:
    bare = f"regexp_replace(regexp_replace(regexp_replace({x}, '^[^a-zA-Z0-9]+', ''), '[^a-zA-Z0-9]+$', ''), '{_WS}+', ' ', 'g')"
    return f"nullif(array_to_string(list_transform(string_split({bare}, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' '), '') || '.'"


def _names(x: str) -> str:
    hidden = f"regexp_replace({_sentinel(x)}, '\\(([^)]*[^)0-9\\s][^)]*)\\)', chr(2) || '\\1' || chr(3), 'g')"
    parts = f"string_split_regex({hidden}, '\\(\\s*[0-9]*\\s*\\)')"
    cut = f"CASE WHEN len({parts}) > 1 THEN {parts}[:-2] ELSE {parts} END"
    found = f"list_filter(list_transform({cut}, lambda p: {_person('translate(p, chr(2) || chr(3), chr(40) || chr(41))')}), lambda n: n IS NOT NULL)"
    return f"CASE WHEN len({found}) > 0 THEN {found} END"


def _programme(x: str) -> str:
    clean = _strip(f"replace({_strip(f'lower({_sentinel(x)})')}, 'program studi', '')")
    name = f"upper(CASE WHEN contains({clean}, '-') THEN {_strip(f'split_part({clean}, chr(45), 2)')} ELSE {clean} END)"
    return f"coalesce({_table(name, text.PROGRAMME_FIXES)}, {name})"


def _faculty_code(x: str) -> str:
    return f"coalesce({_table(_sentinel(x), text.FACULTY_CODES)}, {_table(_strip(f'split_part({_sentinel(x)}, chr(45), 1)'), text.FACULTY_CODES)})"


def _scheme(x: str) -> str:
    return f"coalesce({_table(x, text.SCHEME_FIXES)}, {x})"


_TEXTS = ("Judul Proposal", "Ketua Peneliti", "Skema", "Scope", "SDGs", "Program Studi", "Anggota Dosen", "Anggota Mahasiswa", "Usulan Biaya")


def _long(spark: SparkSession, sf: str, columns: tuple[str, ...]) -> DataFrame:
    rows = table(spark, sf, "bronze_penelitian").select("baris_id", *[f"`{c}`" for c in columns])
    return rows.unpivot("baris_id", [f"`{c}`" for c in columns], "kolom", "nilai")


def _long_sql(columns: tuple[str, ...]) -> str:
    return "(" + " UNION ALL ".join(f"SELECT baris_id, '{c}' AS kolom, \"{c}\" AS nilai FROM bronze_penelitian" for c in columns) + ")"


@query(f"SELECT baris_id, kolom, {_sentinel('nilai')} AS nilai FROM {_long_sql(_TEXTS)}")
def null_sentinels(spark: SparkSession, sf: str) -> DataFrame:
    return _long(spark, sf, _TEXTS).withColumn("nilai", text.null_sentinel(F.col("nilai")))


@query(f"SELECT baris_id, kolom, {_spaced('nilai')} AS rapi, {_bare('nilai')} AS polos FROM {_long_sql(_TEXTS)}")
def name_normalize(spark, sf):
    value = F.col("nilai")
    return _long(spark, sf, _TEXTS).select("baris_id", "kolom", text.normalize_space(value).alias("rapi"), text.strip_punctuation(value).alias("polos"))


_PEOPLE = ("Ketua Peneliti", "Anggota Dosen", "Anggota Mahasiswa", "Advisor")


@query(f"SELECT baris_id, kolom, {_ids('nilai')} AS nomor, {_names('nilai')} AS nama, {_person(_sentinel('nilai'))} AS orang FROM {_long_sql(_PEOPLE)}")
def parse_people_list(spark, sf):
    value = F.col("nilai")
    return _long(spark, sf, _PEOPLE).select(
        "baris_id", "kolom", text.people_ids(value).alias("nomor"), text.people_names(value).alias("nama"), text.person(value).alias("orang")
    )


_FACULTY_OF = {p: faculty for faculty, programmes in text.FACULTY_PROGRAMMES.items() for p in programmes}
_CODED = " UNION ALL ".join(
    [f"SELECT '{code} - Program Studi {p}' AS nilai, '{p}' AS program" for code in text.FACULTY_CODES for p in _FACULTY_OF]
    + [f"SELECT '{p}', '{p.upper()}'" for p in text.PROGRAMME_FIXES]
)
_PROGRAMMES = f"""(SELECT "Program Studi" AS nilai, lower("Program Studi") AS program FROM bronze_penelitian UNION ALL {_CODED})"""


@query(f"""SELECT nilai, {_programme('nilai')} AS prodi, {_faculty_code('nilai')} AS fakultas, {_table(_sentinel('program'), _FACULTY_OF)} AS fakultas_prodi FROM {_PROGRAMMES}""")
def parse_programme(spark, sf):
    typed = table(spark, sf, "bronze_penelitian").select(F.col("`Program Studi`").alias("nilai"), F.lower("`Program Studi`").alias("program"))
    listed = [(f"{code} - Program Studi {p}", p) for code in text.FACULTY_CODES for p in _FACULTY_OF] + [(p, p.upper()) for p in text.PROGRAMME_FIXES]
    rows = typed.unionByName(spark.createDataFrame(listed, "nilai string, program string"))
    value = F.col("nilai")
    return rows.select("nilai", text.programme(value).alias("prodi"), text.faculty_by_code(value).alias("fakultas"), text.faculty_by_programme(F.col("program")).alias("fakultas_prodi"))


_SCHEMES = " UNION ALL ".join(f"SELECT '{s}' AS skema, NULL AS scope" for s in (*text.SCHEME_FIXES, "Program Kemitraan Masyarakat PKM"))


@query(f"""SELECT skema, {_scheme(_bare('skema'))} AS baku, CASE WHEN {_strip('upper(scope)')} = 'LAIN - LAIN' THEN 'LAIN-LAIN' ELSE {_strip('upper(scope)')} END AS lingkup
    FROM (SELECT skema, scope FROM silver_penelitian UNION ALL {_SCHEMES})""")
def scheme_scope(spark, sf):
    listed = spark.createDataFrame([(s, None) for s in (*text.SCHEME_FIXES, "Program Kemitraan Masyarakat PKM")], "skema string, scope string")
    rows = table(spark, sf, "silver_penelitian").select("skema", "scope").unionByName(listed)
    return rows.select("skema", text.scheme(text.strip_punctuation(F.col("skema"))).alias("baku"), text.scope(F.col("scope")).alias("lingkup"))


# Texts of dates in every form that the functions know, and some that they do not, made from the dates of orders.
_MONTH_NAMES = tuple(text.MONTHS)
_MONTH_LIST = "[" + ", ".join(f"'{m}'" for m in _MONTH_NAMES) + "]"
_MONTH_NUMBERS = "[" + ", ".join(str(text.MONTHS[m]) for m in _MONTH_NAMES) + "]"
_DATED = f"""(SELECT o_orderkey, CASE o_orderkey % 12 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, ' %Y-%m-%d ')
    WHEN 2 THEN day(o_orderdate) || ' ' || {_MONTH_LIST}[1 + o_orderkey % {len(_MONTH_NAMES)}] || ' ' || year(o_orderdate)
    WHEN 3 THEN upper({_MONTH_LIST}[1 + o_orderkey % {len(_MONTH_NAMES)}]) || ' ' || year(o_orderdate) WHEN 4 THEN CAST(year(o_orderdate) AS VARCHAR) WHEN 5 THEN '-'
    WHEN 6 THEN '31 februari ' || year(o_orderdate) WHEN 7 THEN 'sep ' || year(o_orderdate) WHEN 8 THEN year(o_orderdate) || '-00-' || lpad(CAST(day(o_orderdate) AS VARCHAR), 2, '0')
    WHEN 9 THEN strftime(o_orderdate, '%Y-%m-%d 00:00:00') WHEN 10 THEN '5 foo ' || year(o_orderdate) END AS teks FROM orders)"""


def _dated(spark: SparkSession, sf: str) -> DataFrame:
    day, year, k = F.dayofmonth("o_orderdate").cast("string"), F.year("o_orderdate").cast("string"), F.col("o_orderkey") % 12
    iso = F.date_format("o_orderdate", "yyyy-MM-dd")
    month = F.element_at(F.array(*[F.lit(m) for m in _MONTH_NAMES]), (1 + F.col("o_orderkey") % len(_MONTH_NAMES)).cast("int"))
    forms = [
        iso, F.concat(F.lit(" "), iso, F.lit(" ")), F.concat_ws(" ", day, month, year), F.concat_ws(" ", F.upper(month), year), year, F.lit("-"),
        F.concat(F.lit("31 februari "), year), F.concat(F.lit("sep "), year), F.concat(year, F.lit("-00-"), F.lpad(day, 2, "0")),
        F.concat(iso, F.lit(" 00:00:00")), F.concat(F.lit("5 foo "), year),
    ]
    form = F.lit(None).cast("string")
    for n, value in enumerate(forms):
        form = F.when(k == n, value).otherwise(form)
    return table(spark, sf, "orders").select("o_orderkey", form.alias("teks"))


def _month(x: str) -> str:
    return f"{_MONTH_NUMBERS}[list_position({_MONTH_LIST}, {x})]"


def _date_parts(rows: str, t: str) -> str:
    """Rows with d, m, y and the kind of text: iso, full (day and month), month, year, other."""
    iso, full, month = r"^(\d{4})-(\d{1,2})-(\d{1,2})$", r"^(\d{1,2})\s+([a-z]+)\s+(\d{4})$", r"^([a-z]+)\s+(\d{4})$"

    def part(pattern: str, k: int) -> str:
        return f"regexp_extract(t, '{pattern}', {k})"

    kinds = f"CASE WHEN regexp_matches(t, '{iso}') THEN 'iso' WHEN regexp_matches(t, '{full}') THEN 'full' WHEN regexp_matches(t, '{month}') THEN 'month' WHEN regexp_matches(t, '^\\d{{4}}$') THEN 'year' ELSE 'other' END"
    return f"""(SELECT *, CASE kind WHEN 'iso' THEN TRY_CAST({part(iso, 3)} AS INTEGER) WHEN 'full' THEN TRY_CAST({part(full, 1)} AS INTEGER) ELSE 0 END AS d,
        CASE kind WHEN 'iso' THEN TRY_CAST({part(iso, 2)} AS INTEGER) WHEN 'full' THEN {_month(part(full, 2))} WHEN 'month' THEN {_month(part(month, 1))} ELSE 0 END AS m,
        CASE kind WHEN 'iso' THEN TRY_CAST({part(iso, 1)} AS INTEGER) WHEN 'full' THEN TRY_CAST({part(full, 3)} AS INTEGER) WHEN 'month' THEN TRY_CAST({part(month, 2)} AS INTEGER)
            WHEN 'year' THEN TRY_CAST(t AS INTEGER) ELSE 0 END AS y
        FROM (SELECT *, {kinds} AS kind FROM (SELECT *, {_strip(f'lower({_sentinel(t)})')} AS t FROM {rows})))"""


def _strict(rows: str, t: str) -> str:
    """Rows with hari, bulan, tahun and waktu."""
    return f"""(SELECT *, CASE WHEN zero THEN 0 ELSE d END AS hari, CASE WHEN zero THEN 0 ELSE m END AS bulan, CASE WHEN zero THEN 0 ELSE y END AS tahun_, CASE WHEN NOT zero AND NOT partial THEN moment END AS waktu FROM (
        SELECT *, coalesce(d = 0, false) OR coalesce(m = 0, false) OR coalesce(y = 0, false) AS partial, t IS NULL OR (moment IS NULL AND NOT (coalesce(d = 0, false) OR coalesce(m = 0, false) OR coalesce(y = 0, false))) AS zero FROM (
            SELECT *, try_strptime(lpad(CAST(y AS VARCHAR), 4, '0') || '-' || lpad(CAST(m AS VARCHAR), 2, '0') || '-' || lpad(CAST(d AS VARCHAR), 2, '0'), '%Y-%m-%d') AS moment FROM {_date_parts(rows, t)})))"""


@query(f"""SELECT o_orderkey, teks, hari, bulan, tahun_ AS tahun, waktu FROM {_strict(_DATED, 'teks')}""")
def parse_dates(spark, sf):
    """Dates read strictly: only whole texts count."""
    return _dated(spark, sf).withColumn("d", text.strict_date(F.col("teks"))).select("o_orderkey", "teks", "d.*")


@query(f"""SELECT o_orderkey, teks, CASE WHEN t ~ '^\\d{{4}}-\\d{{2}}-\\d{{2}}.*' THEN CAST(t[9:10] AS INTEGER) WHEN kind = 'full' THEN d END AS hari,
    CASE WHEN t ~ '^\\d{{4}}-\\d{{2}}-\\d{{2}}.*' THEN CAST(t[6:7] AS INTEGER) WHEN kind IN ('full', 'month') THEN m END AS bulan,
    CASE WHEN t ~ '^\\d{{4}}-\\d{{2}}-\\d{{2}}.*' THEN CAST(t[1:4] AS INTEGER) WHEN kind IN ('full', 'month', 'year') THEN y END AS tahun FROM {_date_parts(_DATED, 'teks')}""")
def parse_dates_loose(spark, sf):
    """Dates read loosely: what follows them does not matter."""
    return _dated(spark, sf).withColumn("d", text.loose_date(F.col("teks"))).select("o_orderkey", "teks", "d.*")


# Citation lines in every layout, made from parts; the parts are the oracle.
_LINE = """(SELECT *, 'N' || id AS n, jurnal_volume AS v, jurnal_issue AS i, jurnal_halaman AS h, jurnal_tahun AS th, abs(coalesce(sitasi, 0)) % 6 AS k FROM silver_sitasi)"""
_LINE_PARTS = """CASE WHEN k = 5 OR th IS NULL THEN 'plain' WHEN v IS NOT NULL AND i IS NOT NULL AND (k = 0 OR h IS NULL) THEN 'issue' WHEN v IS NOT NULL AND i IS NOT NULL AND k = 1 THEN 'issue_pages'
    WHEN v IS NOT NULL AND i IS NOT NULL AND k = 2 THEN 'issue_no_year' WHEN v IS NOT NULL AND h IS NOT NULL AND k = 3 THEN 'volume' WHEN h IS NOT NULL THEN 'pages' ELSE 'year' END"""


@query(f"""SELECT id, upper(n) AS nama, CASE WHEN p IN ('issue', 'issue_pages', 'issue_no_year', 'volume') THEN v END AS volume, CASE WHEN p IN ('issue', 'issue_pages', 'issue_no_year') THEN i END AS issue,
    CASE WHEN p IN ('issue_pages', 'issue_no_year', 'volume', 'pages') THEN h END AS halaman, CASE WHEN p NOT IN ('plain', 'issue_no_year') THEN th END AS tahun FROM (SELECT *, {_LINE_PARTS} AS p FROM {_LINE})""")
def parse_publication(spark, sf):
    rows = table(spark, sf, "silver_sitasi")
    return rows.withColumn("__p", text.publication(_citation_line())).select("id", "__p.*")


def _citation_line():
    """A citation line of the parts of a row, in one of its layouts; its name is the row's key."""
    n, v, i, h, y = F.concat(F.lit("N"), F.col("id")), *[F.col(f"jurnal_{c}") for c in ("volume", "issue", "halaman", "tahun")]
    k = F.abs(F.coalesce(F.col("sitasi"), F.lit(0))) % 6
    issue = v.isNotNull() & i.isNotNull()
    dash = F.replace(h, F.lit("-"), F.lit("–"))
    return (
        F.when((k == 5) | y.isNull(), n)
        .when(issue & ((k == 0) | h.isNull()), F.concat(n, F.lit(" "), v, F.lit(" ("), i, F.lit("), "), y))
        .when(issue & (k == 1), F.concat(n, F.lit(" "), v, F.lit(" ("), i, F.lit("), "), dash, F.lit(", "), y))
        .when(issue & (k == 2), F.concat(n, F.lit(" "), v, F.lit("("), i, F.lit(") , "), h, F.lit("..")))
        .when(v.isNotNull() & h.isNotNull() & (k == 3), F.concat(n, F.lit(" "), v, F.lit(", "), h, F.lit(", "), y))
        .when(h.isNotNull(), F.concat(n, F.lit(", "), h, F.lit(", "), y))
        .otherwise(F.concat(n, F.lit(", NULL-NULL, "), y))
    )


def _doi(x: str) -> str:
    return f"""CASE WHEN regexp_matches({x}, '(?i)10\\.\\d{{4,9}}/[^\\s"<>]+') THEN 'https://doi.org/' || regexp_extract({x}, '(?i)(10\\.\\d{{4,9}}/[^\\s"<>]+)', 1) ELSE {x} END"""


@query(f"SELECT id, {_doi('doi')} AS doi FROM silver_sitasi")
def doi(spark, sf):
    return table(spark, sf, "silver_sitasi").select("id", text.doi(F.col("doi")).alias("doi"))


def _class(x: str) -> str:
    u = _strip(f"upper({_sentinel(x)})")
    return f"CASE WHEN {u} LIKE '%INTERNASIONAL%' THEN 'INTERNASIONAL' WHEN {u} LIKE '%NASIONAL%' OR {u} LIKE '%SINTA%' THEN 'NASIONAL' WHEN {u} IS NOT NULL THEN 'LAINNYA' END"


@query(f"SELECT id, {_strip('upper(j)')} AS jurnal, {_class('j')} AS kelompok FROM (SELECT id, '  ' || lower(jurnal) || ' ' AS j FROM silver_sitasi)")
def category_class(spark, sf):
    typed = F.concat(F.lit("  "), F.lower("jurnal"), F.lit(" "))
    return table(spark, sf, "silver_sitasi").withColumn("c", text.journal_class(typed)).select("id", "c.*")


@query(f"SELECT baris_id, CASE WHEN regexp_full_match(trim(b), '[+-]?[0-9]+(\\.[0-9]*)?') THEN TRY_CAST(regexp_extract(trim(b), '^([+-]?[0-9]+)', 1) AS BIGINT) END AS biaya FROM (SELECT baris_id, \"Usulan Biaya\" AS b FROM bronze_penelitian)")
def lenient_numbers(spark, sf):
    return table(spark, sf, "bronze_penelitian").select("baris_id", text.lenient_bigint(F.col("`Usulan Biaya`")).alias("biaya"))


@query()
def name_roots(spark, sf):
    """Roots of the names of silver citations with their longest spelling; Python rules, so no SQL."""
    return names.longest_by_root(table(spark, sf, "silver_sitasi").select("ketua_peneliti").distinct(), "ketua_peneliti")


@query("SELECT count(*) AS baris, count(DISTINCT (coalesce(judul_proposal, ''), coalesce(ketua_peneliti, ''), coalesce(doi, ''))) AS kunci, count(*) AS muat, true AS berawalan FROM silver_sitasi")
def surrogate_keys(spark, sf):
    """Text keys differ exactly where their columns do; whole-number keys are the low 32 bits of the hash."""
    columns = [keys.filled(F.col(c)) for c in ("judul_proposal", "ketua_peneliti", "doi")]
    rows = table(spark, sf, "silver_sitasi").select(keys.text_key("ST", *columns).alias("k"), keys.int_key(*columns).cast("bigint").alias("i"), keys.long_key(*columns).alias("h"))
    low = F.pmod(F.col("h"), F.lit(2**32)) == F.pmod(F.col("i"), F.lit(2**32))
    prefixed = F.bool_and(F.col("k") == F.concat(F.lit("ST"), F.col("h").cast("string")))
    return rows.agg(F.count("*").alias("baris"), F.countDistinct("k").alias("kunci"), F.count_if(low).alias("muat"), prefixed.alias("berawalan"))


def _null_if_empty(x: str) -> str:
    return f"nullif({x}, '')"


def _plain(c: str) -> str:
    return _null_if_empty(_sentinel(f'"{c}"'))


SILVER_GRANTS_SQL = f"""SELECT baris_id, {_plain('Judul Proposal')} AS judul_proposal, ({_names('"Ketua Peneliti"')})[1] AS ketua_peneliti, {_plain('Jenis')} AS jenis, {_plain('Status')} AS status,
    {_scheme(_bare(_sentinel('"Skema"')))} AS skema, {_plain('Scope')} AS scope, {_scheme(_bare(_sentinel('"SDGs"')))} AS sdgs, {_null_if_empty(_programme('"Program Studi"'))} AS prodi,
    ({_names('"Advisor"')})[1] AS advisor, CASE WHEN regexp_full_match(trim("Usulan Biaya"), '[+-]?[0-9]+(\\.[0-9]*)?') THEN TRY_CAST(regexp_extract(trim("Usulan Biaya"), '^([+-]?[0-9]+)', 1) AS BIGINT) END AS usulan_biaya,
    {_plain('Status Proposal')} AS status_proposal, tahun, {_ids('"Ketua Peneliti"')} AS nip_ketua_peneliti, {_ids('"Anggota Mahasiswa"')} AS nim_anggota_mahasiswa,
    {_names('"Anggota Mahasiswa"')} AS nama_anggota_mahasiswa, {_ids('"Anggota Dosen"')} AS nip_anggota_dosen, {_names('"Anggota Dosen"')} AS nama_anggota_dosen, {_faculty_code('"Program Studi"')} AS fakultas
    FROM bronze_penelitian"""


@query(SILVER_GRANTS_SQL)
def silver_grants(spark, sf):
    """Silver grants built from the sheet; the key, a hash, is checked by ``surrogate_keys``."""
    return silver.grants(table(spark, sf, "bronze_penelitian")).drop("id")


# A sheet of citations made of silver ones: names with numbers, dates as texts, publications as lines.
_CITED = f"""(SELECT *, ketua_peneliti || ' (' || coalesce(jurnal_volume, '') || ')' AS nama_, 'FS - Program Studi ' || prodi AS prodi_,
    CASE WHEN tanggal_terbit_hari > 0 THEN tanggal_terbit_hari || ' ' || {_MONTH_LIST}[tanggal_terbit_bulan] || ' ' || tanggal_terbit_tahun ELSE CAST(tanggal_terbit_tahun AS VARCHAR) END AS tanggal_ FROM {_LINE})"""


@query(f"""SELECT {_null_if_empty(_sentinel('judul_proposal'))} AS judul_proposal, sitasi, {_null_if_empty(_doi(_sentinel('doi')))} AS doi, {_programme('prodi_')} AS prodi, ({_names('nama_')})[1] AS ketua_peneliti,
    {_table('lower(prodi_)', _FACULTY_OF)} AS fakultas, hari AS tanggal_terbit_hari, bulan AS tanggal_terbit_bulan, tahun_ AS tanggal_terbit_tahun, waktu AS tanggal_terbit_timestamp,
    {_strip('upper(jurnal)')} AS jurnal, {_class('jurnal')} AS jurnal_kategori, upper(n) AS jurnal_nama,
    CASE WHEN p IN ('issue', 'issue_pages', 'issue_no_year', 'volume') THEN v END AS jurnal_volume, CASE WHEN p IN ('issue', 'issue_pages', 'issue_no_year') THEN i END AS jurnal_issue,
    CASE WHEN p IN ('issue_pages', 'issue_no_year', 'volume', 'pages') THEN h END AS jurnal_halaman, CASE WHEN p NOT IN ('plain', 'issue_no_year') THEN th END AS jurnal_tahun
    FROM (SELECT *, {_LINE_PARTS} AS p FROM {_strict(_CITED, 'tanggal_')})""")
def silver_citations(spark, sf):
    rows = table(spark, sf, "silver_sitasi")
    month = F.get(F.array(*[F.lit(m) for m in _MONTH_NAMES[:12]]), F.col("tanggal_terbit_bulan") - 1)
    day, year = F.col("tanggal_terbit_hari"), F.col("tanggal_terbit_tahun").cast("string")
    sheet = rows.select(
        F.concat("ketua_peneliti", F.lit(" ("), F.coalesce("jurnal_volume", F.lit("")), F.lit(")")).alias("Nama Dosen"),
        F.concat(F.lit("FS - Program Studi "), "prodi").alias("Nama Prodi"),
        F.col("fakultas").alias("Fakultas"),
        F.when(day > 0, F.concat(day.cast("string"), F.lit(" "), month, F.lit(" "), year)).otherwise(year).alias("Tanggal Terbit"),
        F.col("jurnal").alias("Kategori"),
        F.col("judul_proposal").alias("Judul"),
        F.col("sitasi").cast("string").alias("Sitasi"),
        _citation_line().alias("Publikasi"),
        F.col("doi").alias("DOI"),
    )
    return silver.citations(sheet).drop("id")


# Headings and templates for the documents' lines.
HEADINGS = ["Daftar Pustaka", "Daftar Isi", "Daftar Hadir", "No | Uraian | Volume | Jumlah"]
TEMPLATES = {"laporan": ["partner village", "short guide", "tidal channel"], "proposal": ["anggaran", "jadwal", "tujuan"]}


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines and sentences of the documents as lines: the first of each document is bold, every fourth larger."""
    rows = table(spark, sf, "documents").where(F.col("text").isNotNull())
    lines = rows.select(F.col("doc_id").alias("doc"), F.posexplode(F.split("text", r"(?<=[.?!])[\t-\r ]+|\n")).alias("y_position", "text"))
    return lines.select(
        "doc", F.lit(1).alias("page"), "y_position", "text", F.when(F.col("y_position") % 4 == 3, 14.0).otherwise(11.0).alias("font_size"), (F.col("y_position") == 0).alias("is_bold")
    )


@query(
    "SELECT doc_id AS doc, CASE WHEN b >= 0.4 THEN CASE WHEN l >= p THEN 'laporan' ELSE 'proposal' END END AS jenis, b AS bagian FROM (SELECT *, greatest(l, p) AS b FROM (SELECT doc_id, "
    + ", ".join("(" + " + ".join(f"CASE WHEN contains(t, '{h}') THEN 1 ELSE 0 END" for h in heads) + f") / {float(len(heads))} AS {name[0]}" for name, heads in TEMPLATES.items())
    + r" FROM (SELECT doc_id, lower(replace(regexp_replace(text, '([.?!])[\t-\r ]+', '\1 ', 'g'), chr(10), ' ')) AS t FROM documents WHERE text IS NOT NULL)))"
)
def document_type(spark, sf):
    return sections.document_type(_lines(spark, sf), TEMPLATES)


@query()
def heading_sections(spark, sf):
    """Sections by fuzzy headings; the similarity has no SQL."""
    return sections.sections(_lines(spark, sf), HEADINGS, {"No | Uraian | Volume | Jumlah": "1 |"})
