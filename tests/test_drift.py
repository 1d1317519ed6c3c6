import json
from collections import Counter, defaultdict

from lumbung.operators import drift
from lumbung.plans.problems import _RAW, LAYOUT, LEARNED

NAMES = {drift.squash(h): c for c in LAYOUT.columns for h in (c, *LAYOUT.names.get(c, ()))}


def kind(value):
    return next(t for t, p in ((drift.BOOLEAN, bool), (drift.WHOLE, int), (drift.POINT, float), (drift.STRING, str), (drift.OBJECT, dict), (drift.ARRAY, list)) if isinstance(value, p))


def brute(rows):
    """(file, sender, period, loaded, record) -> changes, one file after the other."""
    files, meta = defaultdict(list), {}
    for file, sender, period, loaded, record in rows:
        files[file].append(json.loads(record))
        meta[file] = max(meta.get(file, (sender, period, loaded)), (sender, period, loaded))
    last = {}
    for file, (sender, period, loaded) in meta.items():
        last[sender, period] = max(last.get((sender, period), ((loaded, file))), (loaded, file))
    out, before = set(), {}
    for (sender, period), (_, file) in sorted(last.items()):
        fields, counts = {}, defaultdict(Counter)
        for record in files[file]:
            for header, value in record.items():
                fields[NAMES.get(drift.squash(header), header)] = header
                if value is not None:
                    counts[NAMES.get(drift.squash(header), header)][kind(value)] += 1
        old, types = before.get(sender, (None, {}))
        if old is not None:
            out |= {(file, c, "added") for c in fields.keys() - old.keys()} | {(file, c, "removed") for c in old.keys() - fields.keys()}
            out |= {(file, c, "renamed") for c in fields.keys() & old.keys() if fields[c] != old[c]}
        new = dict(types)
        for c in fields:
            if counts[c]:
                best = max(counts[c].values())
                new[c] = next(t for t in drift.TAGS if counts[c][t] == best)
                if old is not None and c in old and c in types and types[c] != new[c]:
                    out.add((file, c, "retyped"))
        before[sender] = (fields, new)
    return out


def test_against_brute_force(spark):
    raw = spark.read.parquet("/root/testdata/sf0.01/raw_penelitian.parquet")
    rows = [tuple(r) for r in raw.select(*_RAW).collect()]
    got = {tuple(r) for r in drift.changes(raw, *_RAW, LAYOUT).select("berkas_id", "kolom", "perubahan").collect()}
    assert got == brute(rows)


def frame(spark, files):
    rows = [(f, s, p, l, json.dumps(r) if not isinstance(r, (str, type(None))) else r) for f, s, p, l, records in files for r in records]
    schema = "berkas_id long, pengirim_id long, periode int, dimuat_pada int, rekaman string"
    return spark.createDataFrame(rows, schema).withColumnRenamed("x", "x")


def test_cases(spark):
    files = [
        (1, 1, 20231, 1, [{"Judul": "a", "Usulan Biaya": 5, "Z": None}, {"Judul": None, "Usulan Biaya": 6}, None, "{bad", "[1]"]),
        (2, 1, 20232, 2, [{"Judul ": "a", "Usulan Biaya": None, "X": True}]),
        (3, 1, 20232, 3, [{"Judul": "a", "Usulan Biaya": None, "X": 1}]),
        (4, 1, 20234, 4, [{"Judul": "a", "usulanBiaya": 1.5, "X": {"a": 1}}, {"X": 2}, {"X": [1]}, {"X": {"b": 2}}]),
        (5, 2, 20231, 1, [{"Q": "b"}]),
        (6, 2, 20232, 9, [None]),
    ]
    df = frame(spark, files)
    got = {tuple(r) for r in drift.changes(df, *_RAW, LAYOUT).select("berkas_id", "kolom", "perubahan").collect()}
    assert got == {
        (3, "Z", "removed"), (3, "X", "added"), (4, "X", "retyped"), (4, "Usulan Biaya", "renamed"), (4, "Usulan Biaya", "retyped"), (6, "Q", "removed"),
    }
    table = drift.consistent(df, "berkas_id", "rekaman", LAYOUT)
    assert table.count() == df.count() and {"Q", "X", "Z", "Usulan Biaya [desimal]"} <= set(table.columns)
    assert drift.changes(df.limit(0), *_RAW, LAYOUT).count() == 0
    assert drift.consistent(df.limit(0), "berkas_id", "rekaman", LAYOUT).count() == 0


def test_header_known_by_its_values(spark):
    names = [f"Skema Riset {w}" for w in ("Satu", "Dua", "Tiga", "Empat")]
    files = [(1, 1, 20231, 1, [{"Skema": n} for n in names]), (2, 1, 20232, 2, [{"Jenis Dukungan": n, "Lain": n[::-1]} for n in names])]
    got = {tuple(r) for r in drift.changes(frame(spark, files), *_RAW, LAYOUT).select("berkas_id", "kolom", "perubahan").collect()}
    assert got == {(2, "Skema", "renamed"), (2, "Lain", "added")}


def test_amounts(spark):
    cases = {"Rp 1.250.000,00": "1250000", "Rp1.250.000": "1250000", 1250000: "1250000", 1250000.25: "1250000", "0.125E7": "1250000", "12 juta": "12000000",
             "IDR 1,250,000.00": "1250000", " 1250000 ": "1250000", "gratis": "gratis"}
    df = frame(spark, [(1, 1, 20231, 1, [{"RAB": v} for v in (*cases, {"jumlah": 7, "mata_uang": "IDR"}, {"nilai": "8", "satuan": "Rp"}, None)])])
    got = [r[0] for r in drift.consistent(df, "berkas_id", "rekaman", LAYOUT).select("Usulan Biaya").collect()]
    assert sorted(map(str, got)) == sorted([*cases.values(), "7", "8", "None"])


def test_headers_are_learned_from_values(spark):
    """Without any list of other headers the values tell them, as the list does."""
    for sf in ("sf0.01", "sf0.1"):
        raw = spark.read.parquet(f"/root/testdata/{sf}/raw_penelitian.parquet")
        listed, learned = ({tuple(r) for r in drift.fused(raw, "berkas_id", "rekaman", layout).select("berkas_id", "header", "kolom").collect()} for layout in (LAYOUT, LEARNED))
        assert listed == learned, sorted(listed ^ learned)[:9]


def test_other_fields_stay_their_own(spark):
    """Fields beside a column, of other values or of other numbers than its, are not taken for it."""
    amounts = [{"Usulan Biaya": 50_000 * (20 + k % 37), "Judul Proposal": f"Kajian air {k} di desa"} for k in range(80)]
    files = [(1, 1, 20231, 1, amounts[:40]), (2, 1, 20232, 2, amounts[40:])]
    files += [(3, 1, 20233, 3, [{"Dana": r["Usulan Biaya"], "Judul Proposal": r["Judul Proposal"], "Luaran": w} for r, w in zip(amounts, ["jurnal", "poster", "paten"] * 27)])]
    files += [(4, 1, 20234, 4, [{"Halaman": 1_000_003 + 7 * k, "Judul Proposal": r["Judul Proposal"]} for k, r in enumerate(amounts)])]
    got = {tuple(r) for r in drift.changes(frame(spark, files), *_RAW, LEARNED).select("berkas_id", "kolom", "perubahan").collect()}
    assert got == {(3, "Usulan Biaya", "renamed"), (3, "Luaran", "added"), (4, "Usulan Biaya", "removed"), (4, "Luaran", "removed"), (4, "Halaman", "added")}
