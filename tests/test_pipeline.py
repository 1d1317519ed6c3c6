import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumbung.operators import joins
from lumbung.plans import gold, marts, pipeline, quality, repair, silver
from lumbung.sources.store import Files, Store

COLUMNS = ["No", "Judul Proposal", "Ketua Peneliti", "Jenis", "Status", "Skema", "SDGs", "Program Studi", "Anggota Dosen", "Usulan Biaya", "Status Proposal"]
BRONZE = [
    ("1", "A", "Budi (11)", "penelitian", "diterima", "Madya", "SDG 4 Quality education", "FTI - Teknik Kimia", "Ani (12), Cici ()", "15000000.0", None),
    ("2", "B", "Budi Santoso (11)", "penelitian", "ditolak", "SDG 4 Quality education", "Madya", "FTI - Teknik Kimia", "Cici", "Rp 10", None),
    ("3", None, None, None, None, None, None, None, None, None, None),
]


@pytest.fixture
def store(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}/w")
    s.table("gold.dim_skema").create_or_replace(spark.createDataFrame([(3, "Madya", 5)], "skema_id int, nama_skema string, pendanaan_maks int"))
    s.table("gold.dim_sdgs").create_or_replace(spark.createDataFrame([(4, "SDG 4 Quality education")], "sdgs_id int, kode_sdgs string"))
    sheet = spark.createDataFrame(BRONZE, ", ".join(f"`{c}` string" for c in COLUMNS)).withColumn("tahun", F.lit(2023))
    pipeline.build_bronze(s, "penelitian", [sheet])
    return s


def swap(store):
    skema, sdgs = store.table("gold.dim_skema").read(), store.table("gold.dim_sdgs").read()
    return quality.Swap("skema", "sdgs", quality.Reference("skema", skema, "nama_skema"), quality.Reference("sdgs", sdgs, "kode_sdgs"))


def test_from_sheet_to_mart(spark, store):
    pipeline.run(store, ["penelitian"])
    rows = {r.judul_proposal: r for r in store.table("silver.penelitian").read().collect()}
    assert (rows["A"].ketua_peneliti, rows["A"].nip_ketua_peneliti, rows["A"].nama_anggota_dosen, rows["A"].nip_anggota_dosen, rows["A"].usulan_biaya) == (
        "Budi.", ["11"], ["Ani.", "Cici."], ["12", "0"], 15000000)
    assert rows["A"].prodi == "TEKNIK KIMIA" and rows["A"].fakultas == "Fakultas Teknologi Industri"
    assert (rows["B"].nama_anggota_dosen, rows["B"].nip_anggota_dosen, rows["B"].usulan_biaya) == (["Cici."], None, None)
    assert rows[None].id.startswith("PN")
    people = {(r.nama, r.nip) for r in store.table("gold.dim_dosen").read().collect()}
    assert people == {("Budi Santoso.", "11"), ("Ani.", "12"), ("Cici.", "0")}
    facts = store.table("gold.fact_hibah").read()
    assert facts.count() == 3 and facts.where("ketua_id is not null").count() == 1
    assert sorted(r.total_anggota_dosen for r in facts.collect()) == [0, 1, 2]
    assert store.table("gold.fact_dosen_hibah").read().groupBy("role").count().collect() and store.table("gold.fact_dosen_hibah").read().count() == 5
    s = swap(store)
    audit = lambda r: quality.swap_counts(r, s, "judul_proposal")
    fix = lambda r: repair.unswap(repair.purge_blank(r, "judul_proposal"), s)
    before, after = repair.audit_and_publish(store, "silver.penelitian", fix, audit, repair.SWAP_GATES)
    assert (before["total"], before["null_judul"], before["both_swapped"], after["total"], after["both_swapped"]) == (3, 1, 1, 2, 0)
    pipeline.build_people(store)
    pipeline.build_dependents(store)
    facts = store.table("gold.fact_hibah").read()
    assert [(r.skema_id, r.sdgs_id) for r in facts.collect()] == [(3, 4), (3, 4)]
    star = marts.Star(None, None, store.table("gold.dim_dosen").read(), None, None, facts, store.table("gold.fact_dosen_hibah").read(), None)
    got = {r.nama: (r.total_ketua, r.total_anggota, r.total_hibah) for r in marts.most_grants(star).collect()}
    assert got == {"Budi Santoso.": (1, 0, 1), "Ani.": (0, 1, 1), "Cici.": (0, 1, 1)}


def test_check_repair_check(spark, store):
    pipeline.run(store, ["penelitian"])
    s = swap(store)
    rules = quality.Rules(mandatory=("judul_proposal",), references=(s.a_ref,), unique=("id",), swap=s)
    checks = lambda st: quality.run(spark, {"silver.penelitian": (st.table("silver.penelitian").read(), rules)})
    fix = lambda r: repair.unswap(repair.purge_blank(r, "judul_proposal"), s)
    mend = lambda st: repair.audit_and_publish(st, "silver.penelitian", fix, lambda r: quality.swap_counts(r, s, "judul_proposal"), repair.SWAP_GATES)
    before, after = pipeline.check_repair_check(store, checks, [mend])
    assert before > after == 0 and store.table("dq.dq_report").read().select("run_id").distinct().count() == 2


def test_name_mapping_and_block(spark, store):
    people = spark.createDataFrame([(1, "Budi Santoso, M.T."), (2, "Ani.")], "dosen_id int, nama string")
    cited = spark.createDataFrame([("BUDI SANTOSO",), ("Dr. Ani",), ("Eko Putra",), ("Ani, Budi",), (None,)], "ketua_peneliti string")
    store.table("gold.dim_dosen").create_or_replace(people)
    store.table("silver.sitasi").create_or_replace(cited)
    before, after = repair.map_names(store, "silver.sitasi", "ketua_peneliti", "gold.dim_dosen", "nama", "dosen_id")
    assert (before["matched"], after["matched"], after["invalid"], after["empty"]) == (0, 3, 1, 1)
    assert {r.nama for r in store.table("gold.dim_dosen").read().collect()} == {"Budi Santoso, M.T.", "Ani.", "Eko Putra"}
    assert store.table("gold.dim_dosen").read().where("dosen_id is null").count() == 0
    repair.map_names(store, "silver.sitasi", "ketua_peneliti", "gold.dim_dosen", "nama")
    with pytest.raises(repair.Blocked):
        repair.map_names(store, "silver.sitasi", "ketua_peneliti", "gold.dim_dosen", "nama", strict=True)
    assert {r.name for r in store.table("silver.sitasi").refs().collect()} == {"main", "audit"}


def test_manifest(spark, tmp_path):
    files, path = Files(spark), f"file://{tmp_path}/m.json"
    assert pipeline.load_manifest(files, path) == {}
    new, changed = pipeline.compare({}, {"a": "1", "b": "2"}, {"a": "x", "b": "y"})
    assert changed == ["x", "y"]
    pipeline.write_manifest(files, path, new)
    again, changed = pipeline.compare(pipeline.load_manifest(files, path), {"a": "1", "b": "3"}, {"a": "x", "b": "y"})
    assert changed == ["y"] and not again["a"]["changed"]
    files.create(f"file://{tmp_path}/s/a", b"1")
    assert list(pipeline.etags(files, f"file://{tmp_path}/s", {"a": "x", "b": "y"})) == ["a"]


ids = st.sampled_from([None, "0", "", "1", "2"])
names = st.sampled_from([None, "", "a", "b"])


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(ids, names), max_size=8), st.lists(st.tuples(ids, names), max_size=8))
def test_entity_join_is_the_disjunctive_join(spark, left, right):
    a = spark.createDataFrame([(i, *r) for i, r in enumerate(left)], "i int, nip string, nama string")
    b = spark.createDataFrame([(j, *r) for j, r in enumerate(right)], "j int, nip2 string, nama2 string")
    got = sorted(str((r.i, r.j)) for r in joins.entity_join(a, b, ("nip", "nip2"), ("nama", "nama2")).collect())
    ok = lambda n: n is not None and n != "0"
    want = []
    for i, (n, m) in enumerate(left):
        hits = [j for j, (p, q) in enumerate(right) if (ok(n) and n == p) or (not ok(n) and not ok(p) and m is not None and m == q)]
        want += [str((i, j)) for j in hits] or [str((i, None))]
    assert got == sorted(want)


def test_transform_commutes_with_union_and_repair_is_idempotent(spark, store):
    sheet = store.table("bronze.penelitian").read()
    a, b = sheet.where("No = '1'"), sheet.where("No <> '1'")
    one = sorted(map(str, silver.grants(a.unionByName(b)).collect()))
    assert one == sorted(map(str, silver.grants(a).unionByName(silver.grants(b)).collect()))
    s = swap(store)
    rows = silver.grants(sheet)
    once = repair.unswap(rows, s)
    assert sorted(map(str, once.collect())) == sorted(map(str, repair.unswap(once, s).collect())) and once.count() == rows.count()
    assert gold.dim_person(rows.limit(0)).count() == 0


def test_statements_of_a_script(spark):
    from lumbung.plans import pipeline

    script = """-- a; b
    SELECT 'x;y', "p;q" ; /* c; d */ SELECT `a;b`, 'it''s; fine' - 1 / 2 ;; SELECT 'back\\'; slash'  ;  """
    assert pipeline.statements(script) == ["""SELECT 'x;y', "p;q\"""", "SELECT `a;b`, 'it''s; fine' - 1 / 2", "SELECT 'back\\'; slash'"]
    assert pipeline.statements("") == pipeline.statements(" ; -- x") == []
    assert pipeline.run_script(spark, "") is None
    assert pipeline.run_script(spark, "SELECT 1 AS a; SELECT 2 AS b").collect()[0].b == 2


def test_a_cluster_without_a_shared_folder_is_refused(spark):
    from types import SimpleNamespace

    from lumbung import session

    def fake(master, folder):
        conf = SimpleNamespace(get=lambda key, other=None: folder if key == "spark.checkpoint.dir" and folder else other)
        return SimpleNamespace(sparkContext=SimpleNamespace(master=master, getConf=lambda: conf))

    assert session.shared_folder(fake("spark://x:7077", "/shared")) == "/shared" and session.shared_folder(fake("local[2]", None)) is None
    with pytest.raises(RuntimeError):
        session.shared_folder(fake("spark://x:7077", None))
