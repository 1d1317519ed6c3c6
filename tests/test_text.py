import datetime as dt
import re

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumbung.functions import keys, names, text

CASES = [
    (text.null_sentinel, [(" NaN ", None), ("Tidak Ada", None), ("-", None), ("", None), (" x ", " x "), (None, None),
        ("\u00a0NaT\u2003\n", None), ("nan.", "nan."), ("- -", "- -"), (" " * 50_000 + "x", " " * 50_000 + "x"), (" " * 50_000, None)]),
    (text.people_ids, [("Budi Santoso (198501), Ani (), Cici (abc)", ["198501", "0"]), ("Budi", None), ("(1), Ani (2)", ["1", "2"]), ("(abc (12)", None), ("A (x) (5)", ["5"]), (None, None), ("-", None)]),
    (text.people_names, [
        ("Budi Santoso (198501), Ani (), Cici (abc)", ["Budi Santoso.", "Ani."]), ("dr. BUDI, M.Si", ["Dr. Budi, M.si."]), ("(1), Ani (2)", ["Ani."]),
        ("(abc (12)", ["Abc (12."]), ("A (x) (5)", ["A (x."]), (None, None), ("-", None), ("(3)", None)]),
    (text.programme, [("FTI - Program Studi Teknik Kima", "TEKNIK KIMIA"), ("SAP", "SAINS ATMOSFER DAN KEPLANETAN"), ("FS-Sains-Data", "SAINS"), (None, None)]),
    (text.faculty_by_code, [("FTI - Teknik Kimia", "Fakultas Teknologi Industri"), ("fti - x", None), ("FS", "Fakultas Sains"), (None, None)]),
    (text.faculty_by_programme, [("biologi", "FAKULTAS SAINS"), (" biologi", None), (None, None)]),
    (text.doi, [("doi: 10.1234/ab.c", "https://doi.org/10.1234/ab.c"), ("abc", "abc"), (None, None)]),
    (text.journal_class, [("Jurnal Internasional Q1", ("JURNAL INTERNASIONAL Q1", "INTERNASIONAL")), ("Sinta 2", ("SINTA 2", "NASIONAL")), ("Prosiding", ("PROSIDING", "LAINNYA")), (None, (None, None))]),
    (text.strip_punctuation, [("GBU-45", "GBU 45"), ("Revolusi Industri 4.0", "Revolusi Industri 4 0"), (None, None)]),
    (text.scheme, [("Program Pengabdian Penugasan PPP", "Program Pengabdian Penugasan (PPP)"), ("Program Kemitraan Masyarakat PKM", "Program Kemitraan Masyarakat PKM")]),
    (text.scope, [(" lain - lain ", "LAIN-LAIN"), ("Nasional", "NASIONAL"), (None, None)]),
    (text.lenient_bigint, [("15000000.0", 15000000), (" 12 ", 12), ("Rp 10", None), ("1.5E7", None), (None, None)]),
    (text.strict_date, [
        ("2023-01-05", (5, 1, 2023, dt.datetime(2023, 1, 5))), ("5 Januari 2023", (5, 1, 2023, dt.datetime(2023, 1, 5))), ("Maret 2022", (0, 3, 2022, None)),
        ("2021", (0, 0, 2021, None)), ("2023-02-30", (0, 0, 0, None)), ("5 Foo 2023", (0, 0, 0, None)), ("2023-01-05 00:00:00", (0, 0, 0, None)),
        (None, (0, 0, 0, None)), ("Foo 2023", (0, None, 2023, None)), ("Sep 2023", (0, None, 2023, None)), ("2023-00-05", (5, 0, 2023, None))]),
    (text.loose_date, [("2023-01-05 10:00", (5, 1, 2023)), ("5 mei 2020 sore", (5, 5, 2020)), ("Maret 2022", (None, 3, 2022)), ("2021", (None, None, 2021)), ("x", (None, None, None)), (None, (None, None, None))]),
    (text.publication, [
        ("Jurnal X 12 (3), 2025", ("JURNAL X", "12", "3", None, "2025")), ("Jurnal X 12 (3), 10–20, 2024", ("JURNAL X", "12", "3", "10-20", "2024")),
        ("Jurnal X 12 (3), 10-20", ("JURNAL X", "12", "3", "10-20", None)), ("Jurnal X 7, 1-9, 2020", ("JURNAL X", "7", None, "1-9", "2020")),
        ("Jurnal X, 1-9, 2020", ("JURNAL X", None, None, "1-9", "2020")), ("Jurnal X, NULL-NULL, 2020", ("JURNAL X", None, None, None, "2020")),
        ("Jurnal X, 1234, 2020", ("JURNAL X", None, None, "1234", "2020")), ("Biro &amp; Co", ("BIRO & CO", None, None, None, None)), (None, (None,) * 5), ("", ("", None, None, None, None)),
        ("J 12 (3), 2025.", ("J", "12", "3", "2025", None)), ("J 12 (3), 10-20, 2024..", ("J", "12", "3", "10-20", "2024")), ("J 12, 2020", ("J 12", None, None, None, "2020")),
        ("J (3), 2020", ("J (3)", None, None, None, "2020")), ("A 5, 6, 7, 2020", ("A 5", "6", None, "7", "2020")), ("J 12 (3, 4), 2024", ("J", "12", "3, 4", None, "2024")),
        ("J, 1-9, 2020.", ("J, 1-9, 2020.", None, None, None, None)), ("J,, 2020", ("J", None, None, None, "2020")), ("J " * 3000 + "7, 1, 2020", (("J " * 3000).strip(), "7", None, "1", "2020"))]),
    (text.unescape, [("&eacute;&#233;&#xE9; &#128512;&lt;", "\u00e9\u00e9\u00e9 \U0001f600<"), ("a & b &nosuch; &#x110000;&", "a & b &nosuch; &#x110000;&"), ("&amp;lt;", "&lt;"), ("", ""), (None, None)]),
    (text.person, [("  budi  SANTOSO,", "Budi Santoso."), ("...", None), (None, None), ("Ani", "Ani.")]),
    (text.normalize_space, [("  a \t b ", "a b"), ("nan", None), (None, None)]),
]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_functions(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for f, rows in CASES:
            df = spark.createDataFrame([(v,) for v, _ in rows], "v string")
            got = [r[0] if not hasattr(r[0], "asDict") else tuple(r[0]) for r in df.select(f(F.col("v"))).collect()]
            assert got == [w for _, w in rows], f.__name__
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_roots():
    assert names.root("Dr. Budi Santoso, S.T., M.T.") == "BUDI SANTOSO"
    assert names.root("Budi, Ani") == "BUDI, ANI"
    assert names.root("Penerbit X") is None and names.root("Budi, ...") is None and names.root("") is None
    assert names.root("Ani Dea") == "ANI"
    for written, bare in (("Budi.S.T", "BUDI"), ("Budi S. T. P.", "BUDI"), ("Budi (ex", "BUDI"), ("Budi, S.T (", "BUDI"), ("Budi, M.Sc (Eng)", "BUDI, M.SC (ENG)"), ("Dea", "DEA"),
                          ("Dr,-Ing. Budi Ph.D", "BUDI"), ("Dr. Ir, Budi", "BUDI"), ("Prof. Dr.Eng. Budi  A. Sari, B.Sc(Hons), M.Sc.(Eng).", "BUDI A. SARI"), ("x " * 5000, ("X " * 5000).strip())):
        assert names.root(written) == bare


@given(st.lists(st.sampled_from(names.TITLES), max_size=3), st.lists(st.sampled_from(names.DEGREES), max_size=4), st.sampled_from([", ", " ", ",", ", "]), st.booleans())
def test_titles_and_degrees_come_off(titles, degrees, sep, dots):
    written = " ".join([*titles, "Budi Ani"]) + "".join(sep + d + ("." if dots else "") for d in degrees)
    assert names.root(written) == "BUDI ANI"


def test_canonical_names(spark):
    df = spark.createDataFrame([("Dr. Budi S, M.T.",), ("budi s",), ("Ani, Cici",), (None,), (" Eko ",)], "nama string")
    best = names.longest_by_root(df, "nama")
    assert sorted(map(tuple, best.collect())) == [("BUDI S", "Dr. Budi S, M.T."), ("EKO", " Eko ")]
    got = sorted(str(r[0]) for r in names.canonicalised(df, "nama", best).collect())
    assert got == sorted(["Dr. Budi S, M.T.", "Dr. Budi S, M.T.", "Ani, Cici", "None", " Eko "])
    assert [r[0] for r in df.select(names.invalid_person(F.col("nama"))).collect()] == [False, False, True, True, False]
    mapping = spark.createDataFrame([("budi s", "Budi Setia")], "dari string, menjadi string")
    assert {r[0] for r in names.mapped_names(df, "nama", mapping).collect()} == {"Budi Setia", "Ani, Cici", None, "Eko"}


def test_keys(spark):
    r = spark.range(50).select(keys.int_key(F.col("id")).alias("i"), F.xxhash64("id").alias("h"), keys.text_key("PN", F.col("id")).alias("t")).collect()
    assert all(x.i == (x.h + 2**31) % 2**32 - 2**31 for x in r) and len({x.t for x in r}) == 50


def brute_people(value):
    """(names, ids) of a packed list, from the description: brackets reach to their first closing one; a bracket with only
    digits or nothing ends a name."""
    if value is None or value.strip().lower() in text.SENTINELS:
        return None, None
    ids, parts, start = [], [], 0
    for m in re.finditer(r"\(([^)]*)\)", value):
        if re.fullmatch(r"\s*[0-9]*\s*", m[1]):
            ids.append(m[1].strip() or "0")
            parts.append(value[start : m.start()])
            start = m.end()
    found = []
    for part in parts if ids else [value]:
        bare = re.sub(r"^[^a-zA-Z0-9]+|[^a-zA-Z0-9]+$", "", part)
        if bare:
            found.append(" ".join(w[:1].upper() + w[1:].lower() for w in bare.split()) + ".")
    return found or None, ids or None


def test_people_of_the_sheet(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/bronze_penelitian.parquet")
    for c in ("Ketua Peneliti", "Anggota Dosen", "Anggota Mahasiswa"):
        got = rows.select(F.col(f"`{c}`").alias("v"), text.people_names(F.col(f"`{c}`")).alias("n"), text.people_ids(F.col(f"`{c}`")).alias("i")).collect()
        wrong = [(r.v, r.n, r.i, brute_people(r.v)) for r in got if (r.n, r.i) != brute_people(r.v)]
        assert not wrong, wrong[:3]


def test_kinds_of_names_equal_a_look_at_each(spark):
    from lumbung.plans import quality

    rows = spark.read.parquet("/root/testdata/sf0.01/silver_sitasi.parquet").select("ketua_peneliti").unionByName(
        spark.createDataFrame([(None,), (" ",), ("Penerbit X",), ("Budi, Ani",), ("Budi, ...",), ("Tak Dikenal",)], "ketua_peneliti string")
    )
    known = spark.read.parquet("/root/testdata/sf0.01/dim_dosen.parquet")
    full = {r.nama for r in known.collect()}
    want = dict.fromkeys(("total", "empty", "invalid", "unmatched_valid", "matched"), 0)
    for (name,) in rows.collect():
        root = names.root(name)
        empty, bad, hit = name is None or not name.strip(" "), root is None or "," in root, name in full
        want["total"] += 1
        want["empty"] += empty
        want["invalid"] += not empty and bad
        want["unmatched_valid"] += not empty and not bad and not hit
        want["matched"] += hit
    assert quality.name_counts(rows, "ketua_peneliti", known, "nama").first().asDict() == want
