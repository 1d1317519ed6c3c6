import zipfile

from pyspark.sql import functions as F

from lumbung.functions import sections
from lumbung.sources import xlsx
from lumbung.sources.store import Files, Store
from lumbung.streaming.incremental import follow

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


def book(path, sheets):
    """A small workbook: {name: rows}, cells of text, numbers or None; ('d', 45000) is a date."""
    shared, parts = [], {}
    for k, rows in enumerate(sheets.values(), 1):
        xml = []
        for r, cells in enumerate(rows, 1):
            if cells is None:
                continue
            out = []
            for c, value in enumerate(cells):
                ref = f"{chr(65 + c)}{r}"
                if value is None:
                    continue
                if isinstance(value, tuple):
                    out.append(f'<c r="{ref}" s="1"><v>{value[1]}</v></c>')
                elif isinstance(value, str):
                    shared.append(value)
                    out.append(f'<c r="{ref}" t="s"><v>{len(shared) - 1}</v></c>')
                else:
                    out.append(f'<c r="{ref}"><v>{value}</v></c>')
            xml.append(f'<row r="{r}">{"".join(out)}</row>')
        parts[f"xl/worksheets/sheet{k}.xml"] = f"<worksheet {MAIN}><sheetData>{''.join(xml)}</sheetData></worksheet>"
    names = "".join(f'<sheet name="{n}" sheetId="{k}" r:id="r{k}"/>' for k, n in enumerate(sheets, 1))
    rels = "".join(f'<Relationship Id="r{k}" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(sheets) + 1))
    parts["xl/workbook.xml"] = f"<workbook {MAIN}><sheets>{names}</sheets></workbook>"
    parts["xl/_rels/workbook.xml.rels"] = f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{rels}</Relationships>'
    parts["xl/sharedStrings.xml"] = f"<sst {MAIN}>{''.join(f'<si><t>{s}</t></si>' for s in shared)}</sst>"
    parts["xl/styles.xml"] = f'<styleSheet {MAIN}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>'
    with zipfile.ZipFile(path, "w") as z:
        for name, data in parts.items():
            z.writestr(name, data)


def test_workbook(spark, tmp_path):
    path = str(tmp_path / "a.xlsx")
    book(path, {
        "Petunjuk": [["x"]],
        "2022": [None, [None, "No", "Judul", "Judul", None, "Tanggal"], [None, 1, "A", None, "z", ("d", 45000)], None, [None, 2.5, " ", None, None, None]],
        "2023": [["Judul", "Baru"], ["B", "q"]],
    })
    assert xlsx.sheet_names(path) == ["Petunjuk", "2022", "2023"] and xlsx.year_sheets(["2022", "x2022", "20222"]) == ["2022"]
    got = xlsx.workbook(spark, path)
    assert got.columns == ["No", "Judul", "Judul_2", "_c4", "Tanggal", "tahun", "Baru"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [("1", "A", None, "z", "2023-03-15", 2022, None), ("2.5", None, None, None, None, 2022, None), (None, "B", None, None, None, 2023, "q")], key=str
    )
    raw = spark.read.format("lumbung_xlsx").option("sheets", "2022").load(path)
    assert raw.count() == 5 and raw.where("row = 4").select(F.coalesce(*[c for c in raw.columns if c.startswith("_c")])).first()[0] is None
    assert xlsx.unique_headers(["No", "Judul", "Judul", None], ["_c0", "_c1", "_c2", "_c3"]) == ["No", "Judul", "Judul_2", "_c3"]
    empty = spark.createDataFrame([(1, None, " ")], "row int, a string, b string")
    assert xlsx.with_headers(empty).columns == ["row"]


def test_workbooks_of_a_folder(spark, tmp_path):
    folder = tmp_path / "buku & co"
    folder.mkdir()
    book(folder / "a.xlsx", {"2022": [["Judul", "Judul"], ["A", "B"]], "2023": [[None], ["Judul", None, "Lain"], [None, None, 7]], "2021": [[None, " "]]})
    xlsx.save(spark, f"file://{folder}/b.xlsx", {"2022": spark.createDataFrame([(1, "x < y & \"z\"", None), (None, "", 2.5)], "No int, Judul string, Baru double")})
    got = xlsx.workbook(spark, str(folder))
    assert got.columns == ["Judul", "Judul_2", "tahun", "_c1", "Lain", "No", "Baru"]
    want = [("A", "B", 2022, None, None, None, None), (None, None, 2023, None, "7", None, None), ('x < y & "z"', None, 2022, None, None, "1", None), (None, None, 2022, None, None, None, "2.5")]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert {(r.sheet, r["count"]) for r in xlsx.cells(spark, str(folder), ["2022"]).groupBy("berkas", "sheet").count().collect()} == {("2022", 2), ("2022", 3)}
    assert xlsx.width_of(f"{folder}/b.xlsx", "2022") == 3 and xlsx.width_of(f"{folder}/a.xlsx", "2023") == 3
    assert [xlsx._letters(k) for k in (0, 25, 26, 701, 702)] == ["A", "Z", "AA", "ZZ", "AAA"]


def test_sections(spark):
    lines = [("a", 1, 10, "Judul laporan", 12.0, False), ("a", 1, 20, "PENDAHULUAN", 12.0, True), ("a", 1, 30, "Isi petunjuk: tulis.", 12.0, False), ("a", 1, 40, "teks satu", 12.0, False),
             ("a", 2, 5, "Metodee", 14.0, False), ("a", 2, 9, "cara  kerja", 12.0, False), ("a", 2, 12, "Pendahuluan", 12.0, True), ("b", 1, 1, "tanpa judul", 10.0, None)]
    df = spark.createDataFrame(lines, "doc string, page int, y_position int, text string, font_size double, is_bold boolean")
    got = {(r.doc, r.judul): r.teks for r in sections.sections(df, ["Pendahuluan", "Metode"], {"Pendahuluan": "Isi petunjuk: tulis."}).collect()}
    assert got == {("a", "Pendahuluan"): "teks satu", ("a", "Metode"): "cara  kerja Pendahuluan"}
    assert {tuple(r) for r in sections.body_size(df).collect()} == {("a", 12.0), ("b", 10.0)}
    kinds = {r.doc: r.jenis for r in sections.document_type(df, {"laporan": ["Pendahuluan", "Metode"], "lain": ["Abstrak"]}).collect()}
    assert kinds == {"a": "laporan", "b": None}
    assert sections.sections(df.limit(0), ["Metode"]).count() == 0


def test_stream_into_a_table(spark, tmp_path):
    folder, store = str(tmp_path / "in"), Store(spark, f"file://{tmp_path}/w")
    go = lambda: follow(spark, folder, "id long, v string", store, "silver.x", ["id"], lambda r: r.withColumn("v", F.upper("v")), str(tmp_path / "c")).awaitTermination()
    spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string").write.parquet(folder)
    go()
    spark.createDataFrame([(2, "c"), (3, "d"), (3, "d")], "id long, v string").write.mode("append").parquet(folder)
    go()
    go()
    assert sorted(map(tuple, store.table("silver.x").read().collect())) == [(1, "A"), (2, "C"), (3, "D")]
    assert store.table("silver.x").snapshots().count() == 2


def test_files(spark, tmp_path):
    files, path = Files(spark), f"file://{tmp_path}/o/x.txt"
    assert not files.exists(path) and files.list(f"file://{tmp_path}/o") == []
    files.create(path, b"abc")
    assert files.read(path) == b"abc" and [f["length"] for f in files.walk(f"file://{tmp_path}/o")] == [3]
    assert files.rename(path, f"file://{tmp_path}/o/y.txt") and files.delete(f"file://{tmp_path}/o") and not files.exists(path)
