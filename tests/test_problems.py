import datetime as dt

import pytest
from pyspark.sql import functions as F

from lumbung.operators import orphans, profile, skew

T1, T2, T3 = (dt.datetime(2024, m, 1) for m in (1, 2, 3))
CHILD = "fk int, dimuat_pada timestamp, kolom string, __x int"
PARENT = "k int, dimuat_pada timestamp, dihapus_pada timestamp, kolom string"


def child(spark):
    rows = [(1, T2, "a", 0), (1, T2, "a", 0), (2, T1, None, 0), (3, T3, "", 0), (9, T2, "x" * 9999, 0), (None, T2, "n", 0), (1, None, "t", 0), (4, T3, "g", 0)]
    return spark.createDataFrame(rows + [(5, T2, "h", i) for i in range(500)], CHILD)


def parent(spark):
    return spark.createDataFrame([(1, T1, None, "p"), (2, T2, None, "p"), (3, T1, T2, "p"), (4, T1, T2, "p"), (4, T1, None, "p"), (None, T1, None, "p")], PARENT)


@pytest.mark.parametrize("limit", [500_000, 0])
def test_orphans(spark, monkeypatch, limit):
    monkeypatch.setattr(orphans, "BROADCAST_KEYS", limit)
    ref = orphans.Reference("fk", "k")
    got = orphans.orphans(child(spark), parent(spark), ref)
    assert got.where("fk = 5 AND sebab = 'hilang'").count() == 500
    assert sorted((r.fk, r.sebab) for r in got.where("fk <> 5").collect()) == [(2, "terlambat"), (3, "dihapus"), (9, "hilang")]
    assert got.where("kolom <> 'fk'").count() == 0
    assert orphans.orphans(child(spark).limit(0), parent(spark), ref).count() == 0
    assert orphans.orphans(child(spark), parent(spark).limit(0), ref).where("sebab = 'hilang'").count() == 507
    report = {(r.sebab, r.baris) for r in orphans.by_period(got, "anak", ["dimuat_pada"]).where("sebab = 'hilang'").collect()}
    assert report == {("hilang", 501)}


def test_filter_never_rejects_a_parent(spark):
    keys = spark.range(0, 4000, 3).select(F.col("id").alias("__key"))
    may = orphans.bloom(keys, keys.count())
    passed = {r[0] for r in spark.range(4000).select(F.col("id").alias("__key")).where(may).collect()}
    assert set(range(0, 4000, 3)) <= passed and len(passed) < 1334 + 250


def test_skewed_lookup(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id")).alias("k"), "id")
    mapping = spark.range(0, 3000, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).unionByName(spark.createDataFrame([(7, 70)], "k long, v long"))
    hot = skew.hot_keys(rows.groupBy("k").count(), "k")
    assert hot == [7]
    for how in ("inner", "left"):
        assert sorted(map(str, skew.lookup(rows, mapping, "k", hot, how).collect())) == sorted(map(str, rows.join(mapping, "k", how).collect()))


def test_masks_and_formats(spark):
    cases = {"Ab 12-x": "A 99-A", "a\tb": "A␣A", "é!": "¿!", "": "", "1" * 30: "9" * 10, None: None}
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    assert [r[0] for r in df.select(profile.mask(F.col("v"))).collect()] == list(cases.values())
    from lumbung.plans.problems import DOI, TITLE

    titles = {"Satu dua tiga empat": False, "satu dua tiga": True, " satu dua tiga empat": True, "satu  dua tiga empat": True, "satu dua tiga empat_": True,
              "a b2 c d e (f)": False, "": True, None: False, "kajian " * 4000 + "x": False, "a b c d’": True, "a b c d\n": True}
    df = spark.createDataFrame([(k, v) for k, v in titles.items()], "v string, want boolean")
    assert df.where(TITLE.malformed(F.col("v")) != F.col("want")).collect() == []
    dois = {"https://doi.example/10.1234/ab?c": False, "https://doi.example/10.123/ab": True, "https://doi.example/10.1234567890/a": True, "https://doi.example/10.1234/": True,
            "http://doi.example/10.1234/a": True, "https://doi.example/10.1234/a b": True, "https://doi.example/10.1234/a<": True, "HTTPS://doi.example/10.1234/a": True,
            "https://doi.example/10.1234/é": True, "https://doi.example/10.1234/a\n": True, None: False}
    df = spark.createDataFrame([(k, v) for k, v in dois.items()], "v string, want boolean")
    assert df.where(DOI.malformed(F.col("v")) != F.col("want")).collect() == []


def test_scores(spark):
    rows = [(100.0, 0, 0, False), (99.5, 200, 1, False), (99.48, 200, 1, True), (float("nan"), 10, 1, True), (None, 10, 1, False), (50.0, None, 1, False), (0.0, 0, 0, True)]
    df = spark.createDataFrame(rows, "s double, t long, f long, want boolean")
    assert df.where(profile.inconsistent(F.col("s"), F.col("t"), F.col("f"), 0.015) != F.col("want")).collect() == []


def test_loads_and_profile(spark):
    rows = [(m, "x" * (10 if m < 5 else 30), float(i), [str(i)]) for m in range(6) for i in range(20)] + [(7, None, float("nan"), None)] * 10 + [(None, "x" * 10, None, None)] * 3
    df = spark.createDataFrame(rows, "muat_id int, v string, angka double, larik array<string>")
    figures = profile.load_figures(df, "muat_id", {"v": F.length("v")}, {"v": F.col("v").isNotNull()})
    assert {r.muat for r in profile.differing_loads(figures, 0.21, 0.26).collect()} == {"5", "7"}
    got = {(r.muat, r.kolom): r for r in profile.profile(df, "muat_id").collect()}
    assert (got["0", "angka"].terkecil, got["0", "angka"].terbesar, got["0", "angka"].berbeda) == ("0.0", "19.0", 20)
    assert (got["7", "v"].nol, got["7", "v"].bagian_nol, got["7", "angka"].nol, got["7", "angka"].terkecil) == (10, 1.0, 0, None)
    assert profile.profile(df.limit(0), "muat_id").count() == 0
    counts = profile.masks(df, "muat_id", ["v"])
    js = {r.muat: r.divergensi for r in profile.divergence(counts).collect()}
    assert abs(js["0"]) < 1e-9 and "7" not in js
    mixed = profile.masks(spark.createDataFrame([(1, "a1"), (1, "a2"), (2, "b")], "m int, v string"), "m", ["v"])
    assert {r.muat: round(r.divergensi, 9) for r in profile.divergence(mixed).collect()} == {"1": 1.0, "2": 1.0}
    assert profile.rare_masks(mixed, 0.5).select("topeng").collect()[0][0] == "A"


def test_several_filters_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(orphans, "MAX_FILTER_BITS", 1024)
    keys = spark.range(0, 3000, 3).select(F.col("id").cast("int").alias("k"), F.lit(T1).alias("dimuat_pada"), F.lit(None).cast("timestamp").alias("dihapus_pada"))
    facts = spark.range(3000).select(F.col("id").cast("int").alias("fk"), F.lit(T2).alias("dimuat_pada"))
    for parents in (keys, keys.limit(3)):
        there = {r.k for r in parents.collect()}
        got = orphans.orphans(facts, parents, orphans.Reference("fk", "k")).collect()
        assert {r.fk for r in got} == set(range(3000)) - there and len(got) == 3000 - len(there)
    distinct = orphans.parents(keys, orphans.Reference("fk", "k"))
    passed = facts.withColumn("__key", F.col("fk")).where(orphans.bloom(distinct, 1000)).count()
    assert 1000 <= passed < 1200


@pytest.mark.parametrize("most", [8_000_000, 0])
def test_mined_verdicts_equal_a_look_at_each_value(spark, monkeypatch, most):
    monkeypatch.setattr(profile, "BROADCAST_CHARS", most)
    from lumbung.plans.problems import DOI, TITLE

    rows = spark.read.parquet("/root/testdata/sf0.01/silver_penelitian.parquet").select("id", "judul_proposal")
    extra = spark.createDataFrame([("a", None), ("b", ""), ("c", "satu dua tiga empat " * 800), ("d", "A"), ("d", "A")], "id string, judul_proposal string")
    rows = rows.unionByName(extra).withColumn("kolom", F.lit(1))
    doi = spark.read.parquet("/root/testdata/sf0.01/silver_sitasi.parquet").select("id", "doi")
    for df, column, fmt in ((rows, "judul_proposal", TITLE), (doi, "doi", DOI), (doi.limit(0), "doi", DOI)):
        want = sorted(map(str, df.where(fmt.malformed(F.col(column))).collect()))
        found = profile.malformed(df, column, fmt)
        assert sorted(map(str, found.collect())) == want and found.columns == df.columns


def test_masks_of_every_column(spark):
    import __spark_entry__ as entry
    from lumbung.plans.problems import LOADS
    from lumbung.session import table

    rows = spark.createDataFrame([(1, [10, None], 1.5, "a"), (2, None, None, "b1"), (2, [7], 2.5, "c")], "m int, xs array<int>, s double, t string")
    got = {(r.kolom, r.topeng): r.baris for r in profile.mask_shares(profile.masks(rows, "m", rows.columns)).collect()}
    assert got == {("m", "9"): 3, ("xs", "99"): 1, ("xs", "9"): 1, ("s", "9.9"): 2, ("t", "A"): 2, ("t", "A9"): 1}
    masks = entry.queries()["p5_masks"](spark, entry.SMALLEST).collect()
    loads = entry.queries()["p5_divergence"](spark, entry.SMALLEST).collect()
    for name, load in LOADS.items():
        rows = table(spark, entry.SMALLEST, name)
        filled = {c for c, kind in rows.dtypes for e in [F.exists(c, F.isnotnull) if kind.startswith("array") else F.col(c).isNotNull()] if rows.where(e).head(1)}
        assert {r.kolom for r in masks if r.tabel == name} == filled
        assert {r.kolom for r in loads if r.tabel == name} == filled - {load}
    assert {r.jenis for r in masks if r.bagian >= profile.RARE} == {"dominan"} and all(r.bagian < profile.RARE for r in masks if r.jenis == "jarang")
