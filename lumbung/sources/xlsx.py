"""Spreadsheet workbooks from the files' XML, and tables with unknown header rows.

``cells(spark, path)`` reads workbooks of any Hadoop file system, many at a time (a path may be a folder or a pattern): one
task parses a workbook once and gives each row of each sheet with its number and its cells as an array of texts.
``workbook`` puts year sheets under their own headers. ``spark.read.format("lumbung_xlsx").load(path)`` is a data source for a
workbook that all workers reach as a local path, with columns ``sheet``, ``row`` and ``_c0`` ... ``_cN``; its width is the
sheet's stated dimension where there is one. Row numbers are explicit, so the order of a sheet survives any plan.
``save`` writes small frames as a workbook.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from lumbung.session import cut
from lumbung.sources.store import Files

_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
#: Built-in number formats that show dates.
_DATES = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}


def _open(book: str | bytes) -> zipfile.ZipFile:
    return zipfile.ZipFile(io.BytesIO(book) if isinstance(book, bytes) else book.removeprefix("file://"))


def sheet_names(book: str | bytes) -> list[str]:
    """Sheets in the order of the workbook, a local path or its contents."""
    with _open(book) as z:
        return [s.get("name") for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(_NS + "sheet")]


def year_sheets(names: list[str]) -> list[str]:
    """Sheets whose whole name is a four-digit year."""
    return [n for n in names if re.fullmatch(r"\d{4}", n)]


def _column(ref: str) -> int:
    k = 0
    for char in re.match(r"[A-Z]+", ref)[0]:
        k = k * 26 + ord(char) - 64
    return k - 1


def _shared(z: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in z.namelist():
        return []
    out = []
    for _, node in ElementTree.iterparse(io.BytesIO(z.read("xl/sharedStrings.xml"))):
        if node.tag == _NS + "si":
            out.append("".join(t.text or "" for t in node.iter(_NS + "t")))
            node.clear()
    return out


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    if "xl/styles.xml" not in z.namelist():
        return set()
    root = ElementTree.fromstring(z.read("xl/styles.xml"))
    own = {int(f.get("numFmtId")) for f in root.iter(_NS + "numFmt") if re.search(r"[dmyhs]", re.sub(r'"[^"]*"|\[[^\]]*\]', "", f.get("formatCode", "").lower()))}
    cells = root.find(_NS + "cellXfs")
    return {k for k, x in enumerate(cells if cells is not None else []) if int(x.get("numFmtId", 0)) in _DATES | own}


def _place(z: zipfile.ZipFile, sheet: str) -> str:
    """The name of a sheet's XML."""
    book = ElementTree.fromstring(z.read("xl/workbook.xml"))
    rid = next(s.get(_REL + "id") for s in book.iter(_NS + "sheet") if s.get("name") == sheet)
    rels = ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    target = next(r.get("Target") for r in rels if r.get("Id") == rid)
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def width_of(path: str, sheet: str) -> int:
    """Columns of a sheet by its stated dimension; by its rows where it states none or only one cell."""
    with _open(path) as z, z.open(_place(z, sheet)) as stream:
        stated = re.search(rb'<(?:\w+:)?dimension[^>]*ref="[A-Z]+[0-9]+:([A-Z]+)[0-9]+"', stream.read(4096))
    return _column(stated[1].decode()) + 1 if stated else max((len(r) for r in rows_of(path, sheet)), default=0)


def rows_of(book: str | bytes, sheet: str) -> Iterator[list[str | None]]:
    """Rows of a sheet as lists of texts, empty rows included; numbers as written, dates as ISO, empty cells as None."""
    with _open(book) as z:
        about = ElementTree.fromstring(z.read("xl/workbook.xml"))
        shared, dates = _shared(z), _date_styles(z)
        start = datetime(1904, 1, 1) if any(p.get("date1904") in ("1", "true") for p in about.iter(_NS + "workbookPr")) else datetime(1899, 12, 30)
        at = 0
        with z.open(_place(z, sheet)) as stream:
            for _, node in ElementTree.iterparse(stream):
                if node.tag != _NS + "row":
                    continue
                number = int(node.get("r", at + 1))
                while at < number - 1:
                    at += 1
                    yield []
                cells: list[str | None] = []
                for c in node.iter(_NS + "c"):
                    k = _column(c.get("r")) if c.get("r") else len(cells)
                    cells += [None] * (k - len(cells))
                    cells.append(_text(c, shared, dates, start))
                at = number
                yield cells
                node.clear()


def _text(cell, shared: list[str], dates: set[int], start: datetime) -> str | None:
    kind, value = cell.get("t"), cell.find(_NS + "v")
    if kind == "inlineStr":
        text = "".join(t.text or "" for t in cell.iter(_NS + "t"))
    elif value is None or value.text is None:
        return None
    elif kind == "s":
        text = shared[int(value.text)]
    elif kind == "b":
        text = "true" if value.text == "1" else "false"
    elif kind in (None, "n") and int(cell.get("s", 0)) in dates:
        when = start + timedelta(days=float(value.text))
        text = when.date().isoformat() if when.time() == datetime.min.time() else when.isoformat(sep=" ", timespec="seconds")
    else:
        text = value.text
    return text if text != "" else None


class _Sheet(InputPartition):
    def __init__(self, path: str, sheet: str):
        self.path, self.sheet = path, sheet


class _Reader(DataSourceReader):
    def __init__(self, path: str, sheets: list[str], width: int):
        self.path, self.sheets, self.width = path, sheets, width

    def partitions(self):
        return [_Sheet(self.path, s) for s in self.sheets]

    def read(self, partition):
        for k, cells in enumerate(rows_of(partition.path, partition.sheet), 1):
            yield (partition.sheet, k, *(cells + [None] * (self.width - len(cells)))[: self.width])


class XlsxSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "lumbung_xlsx"

    def _sheets(self) -> list[str]:
        wanted = self.options.get("sheets")
        names = sheet_names(self.options["path"])
        return names if wanted is None else [n for n in names if n in wanted.split(",")]

    def schema(self) -> T.StructType:
        path = self.options["path"]
        width = int(self.options.get("width") or max((width_of(path, s) for s in self._sheets()), default=0))
        fields = [T.StructField("sheet", T.StringType()), T.StructField("row", T.IntegerType())]
        return T.StructType(fields + [T.StructField(f"_c{k}", T.StringType()) for k in range(width)])

    def reader(self, schema: T.StructType) -> _Reader:
        return _Reader(self.options["path"], self._sheets(), len(schema.fields) - 2)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(XlsxSource)


def unique_headers(cells: list[str | None], fallback: list[str]) -> list[str]:
    """Blank headers take the positional name; repeated ones get _2, _3, ..."""
    out, seen = [], {}
    for cell, name in zip(cells, fallback):
        header = (cell or "").strip() or name
        seen[header] = seen.get(header, 0) + 1
        out.append(header if seen[header] == 1 else f"{header}_{seen[header]}")
    return out


def with_headers(rows: DataFrame, order: str = "row") -> DataFrame:
    """A raw sheet (all texts) under its own headers: the first row with content names the columns between the first and last
    column that have content; empty rows go. One aggregate finds columns and row, one lookup reads the header.

    A sheet without content gives no columns but ``order``.
    """
    cells = [c for c in rows.columns if c != order]
    filled = {c: F.nullif(F.trim(F.col(f"`{c}`")), F.lit("")) for c in cells}
    some = F.coalesce(*filled.values()).isNotNull()
    found = rows.agg(F.min(F.when(some, F.col(order))).alias("first"), *[F.count(v).alias(f"n{k}") for k, v in enumerate(filled.values())]).first()
    used = [k for k in range(len(cells)) if found[f"n{k}"]]
    if not used:
        return rows.select(order).limit(0)
    kept = cells[used[0] : used[-1] + 1]
    head = rows.where(F.col(order) == found["first"]).select(*[F.col(f"`{c}`") for c in kept]).first()
    names = unique_headers(list(head), kept)
    return rows.where((F.col(order) > found["first"]) & some).select(order, *[filled[c].alias(n) for c, n in zip(kept, names)])


_CELLS = "berkas string, sheet string, row int, cells array<string>"


def cells(spark: SparkSession, path: str | list[str], sheets: list[str] | None = None) -> DataFrame:
    """Rows of workbooks: berkas (the file), sheet, row (from 1, empty rows kept), cells. ``sheets``: only those; None: all."""

    def parse(batches):
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                for sheet in sheet_names(content):
                    if sheets is None or sheet in sheets:
                        rows = [(name, sheet, k, row) for k, row in enumerate(rows_of(content, sheet), 1)]
                        yield pd.DataFrame(rows, columns=["berkas", "sheet", "row", "cells"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(parse, _CELLS)


def workbook(spark: SparkSession, path: str | list[str], sheets: list[str] | None = None) -> DataFrame:
    """Year sheets of one or several workbooks as one bronze table: headers found per sheet, columns united by name, ``tahun``
    the sheet. Each workbook is parsed once; one aggregate finds every sheet's header row and columns, and only the headers
    come to the driver."""
    register(spark)
    raw = cells(spark, path, sheets)
    raw = cut(raw if sheets is not None else raw.where(F.col("sheet").rlike(r"^\d{4}$")))
    filled = raw.withColumn("cells", F.transform("cells", lambda c: F.nullif(F.trim(c), F.lit("")))).where(F.exists("cells", lambda c: c.isNotNull()))
    places = F.filter(F.sequence(F.lit(0), F.size("cells") - 1), lambda k: F.get(F.col("cells"), k).isNotNull())
    spans = filled.withColumn("__at", places).groupBy("berkas", "sheet").agg(
        F.min(F.array_min("__at")).alias("first"), F.max(F.array_max("__at")).alias("last"), F.min("row").alias("head"), F.min_by("cells", "row").alias("names")
    )
    found = spans.orderBy("berkas", "sheet").collect()  # one row a sheet
    if not found:
        raise ValueError(f"no sheet of a year in {path}")
    columns: dict[str, None] = {}
    headers = []
    for r in found:
        fallback = [f"_c{k}" for k in range(r["first"], r["last"] + 1)]
        names = unique_headers([*(r["names"] + [None] * (r["last"] + 1))[r["first"] : r["last"] + 1]], fallback)
        headers.append((r["berkas"], r["sheet"], r["head"], r["first"], names))
        columns |= dict.fromkeys([*names, "tahun"])
    known = spark.createDataFrame(headers, "berkas string, sheet string, head int, first int, names array<string>")
    rows = filled.join(F.broadcast(known), ["berkas", "sheet"]).where(F.col("row") > F.col("head"))  # one row a sheet
    values = F.transform("names", lambda _, k: F.get(F.col("cells"), F.col("first") + k))
    named = rows.withColumn("__values", F.map_from_arrays("names", values))
    return named.select(*[F.col("sheet").cast("int").alias(c) if c == "tahun" else F.try_element_at("__values", F.lit(c)).alias(c) for c in columns])


MOST_ROWS = 1_048_576  # of a sheet, by the format


def save(spark: SparkSession, path: str, sheets: dict[str, DataFrame]) -> None:
    """Small frames as the sheets of a workbook on any Hadoop file system: headers, then rows; numbers as numbers, null as
    empty cells, other values as texts. A frame of more rows than a sheet can have is refused."""
    parts = {}
    main, office = _NS[1:-1], _REL[1:-1]
    for k, df in enumerate(sheets.values(), 1):
        rows = df.limit(MOST_ROWS).collect()
        if len(rows) == MOST_ROWS:
            raise ValueError(f"a sheet has at most {MOST_ROWS} rows")
        lines = []
        for n, row in enumerate([df.columns, *rows], 1):
            made = []
            for c, value in enumerate(row):
                ref = f'r="{_letters(c)}{n}"'
                if isinstance(value, (int, float)) and not isinstance(value, bool):
                    made.append(f"<c {ref}><v>{value}</v></c>")
                elif value is not None:
                    made.append(f'<c {ref} t="inlineStr"><is><t xml:space="preserve">{escape(str(value))}</t></is></c>')
            lines.append(f'<row r="{n}">{"".join(made)}</row>')
        size = f'<dimension ref="A1:{_letters(max(1, len(df.columns)) - 1)}{len(lines)}"/>'
        parts[f"xl/worksheets/sheet{k}.xml"] = f'<worksheet xmlns="{main}">{size}<sheetData>{"".join(lines)}</sheetData></worksheet>'
    listed = "".join(f'<sheet name="{escape(n)}" sheetId="{k}" r:id="r{k}"/>' for k, n in enumerate(sheets, 1))
    parts["xl/workbook.xml"] = f'<workbook xmlns="{main}" xmlns:r="{office}"><sheets>{listed}</sheets></workbook>'
    relation = "http://schemas.openxmlformats.org/package/2006/relationships"
    targets = "".join(f'<Relationship Id="r{k}" Type="{office}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(sheets) + 1))
    parts["xl/_rels/workbook.xml.rels"] = f'<Relationships xmlns="{relation}">{targets}</Relationships>'
    parts["_rels/.rels"] = f'<Relationships xmlns="{relation}"><Relationship Id="r1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>'
    kinds = "".join(f'<Override PartName="/{n}" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.{"worksheet" if "sheets/" in n else "sheet.main"}+xml"/>' for n in parts if n.endswith(".xml"))
    parts["[Content_Types].xml"] = f'<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>{kinds}</Types>'
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        for name, xml in parts.items():
            z.writestr(name, '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n' + xml)
    Files(spark).create(path, buffer.getvalue(), overwrite=True)


def _letters(k: int) -> str:
    """The name of a column: A, B, ..., Z, AA, ..."""
    return (_letters(k // 26 - 1) if k >= 26 else "") + chr(65 + k % 26)
