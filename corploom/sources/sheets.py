"""Excel workbooks by a Python data source: the standard library's zip and XML readers, no other package."""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator, Sequence
from itertools import chain, count, islice
from xml.etree import ElementTree

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
#: Rows that a sheet can hold, by the format.
SHEET_ROWS = 1_048_576
SCHEMA = "sheet string, row int, col int, value string, number double"


def _column(ref: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", ref).group():
        n = n * 26 + ord(c) - 64
    return n - 1


def sheet_names(path: str) -> list[tuple[str, str]]:
    """(name, part) of the sheets of a workbook, in order."""
    with zipfile.ZipFile(path) as z:
        rels = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        return [(s.get("name"), "xl/" + rels[s.get(_REL + "id")].lstrip("/").removeprefix("xl/")) for s in book.iter(_NS + "sheet")]


def read_cells(path: str, sheet: str, part: str) -> Iterator[tuple]:
    """(sheet, row, col, value, number) of the cells with a value, from 0; numbers have both forms."""
    with zipfile.ZipFile(path) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(_NS + "t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(_NS + "si")]
        with z.open(part) as f:
            held = None
            for event, c in ElementTree.iterparse(f, ("start", "end")):
                if event == "start":
                    held = c if c.tag == _NS + "sheetData" else held
                    continue
                if c.tag == _NS + "row":
                    held.clear()  # else all rows stay in memory
                if c.tag != _NS + "c":
                    continue
                kind, v = c.get("t"), c.find(_NS + "v")
                text = "".join(t.text or "" for t in c.iter(_NS + "t")) if kind == "inlineStr" else None if v is None else v.text
                if text is not None:
                    ref = c.get("r")
                    number = None
                    if kind == "s":
                        text = shared[int(text)]
                    elif kind in (None, "n"):
                        number = float(text)
                    yield sheet, int(re.search(r"\d+", ref).group()) - 1, _column(ref), text, number


class _Sheet(InputPartition):
    def __init__(self, path: str, name: str, part: str) -> None:
        super().__init__((path, name))
        self.path, self.name, self.part = path, name, part


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path = options["path"]

    def partitions(self) -> Sequence[InputPartition]:
        return [_Sheet(self.path, name, part) for name, part in sheet_names(self.path)]

    def read(self, partition: _Sheet) -> Iterator[tuple]:
        yield from read_cells(partition.path, partition.name, partition.part)


class XlsxSource(DataSource):
    """``spark.read.format("xlsx").load(path)``: one partition a sheet, one row a cell."""

    @classmethod
    def name(cls) -> str:
        return "xlsx"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def read_xlsx(spark: SparkSession, path: str) -> DataFrame:
    """(sheet, row, col, value, number): the cells of a workbook."""
    spark.dataSource.register(XlsxSource)
    return spark.read.format("xlsx").load(path)


def as_text(value: Column, number: Column) -> Column:
    """Numbers as integers (decimals are cut off), others as they are."""
    return F.when(number.isNotNull(), number.cast("bigint").cast("string")).otherwise(value)


def cell(cells: DataFrame, sheet: str, row: int, col: int, text: bool = True) -> DataFrame:
    return cells.where((F.col("sheet") == sheet) & (F.col("row") == row) & (F.col("col") == col)).select((as_text(F.col("value"), F.col("number")) if text else F.col("value")).alias("value"))


def rows(cells: DataFrame, sheet: str, first: int = 0, last: int | None = None, start: int = 0, end: int | None = None, text: bool = True) -> DataFrame:
    """(row, values): values of the columns start to end (both included); missing cells are null."""
    c = cells.where((F.col("sheet") == sheet) & (F.col("row") >= first) & (F.col("col") >= start))
    c = c if last is None else c.where(F.col("row") <= last)
    c = c if end is None else c.where(F.col("col") <= end)
    v = as_text(F.col("value"), F.col("number")) if text else F.col("value")
    g = c.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("col", v.alias("v")))).alias("m"), F.max("col").alias("top"))
    return g.select("row", F.transform(F.sequence(F.lit(start), F.lit(end) if end is not None else F.col("top")), lambda i: F.try_element_at("m", i)).alias("values"))


def columns(cells: DataFrame, sheet: str, first: int = 0, last: int | None = None, start: int = 0, end: int | None = None, text: bool = True) -> DataFrame:
    """(col, values), as ``rows`` with rows and columns exchanged."""
    turned = cells.withColumnsRenamed({"row": "_r", "col": "row"}).withColumnRenamed("_r", "col")
    return rows(turned, sheet, first, last, start, end, text).withColumnRenamed("row", "col")


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, src, tgt) of a workbook with exactly one sheet, and those that continue it, of exactly two columns; trimmed, missing cells are ''."""
    names = [name for name, _ in sheet_names(path)]
    if not names or names != [continued(names[0], k) for k in range(len(names))]:
        raise ValueError(f"{path} has {len(names)} sheets, not 1")
    cells = read_xlsx(spark, path)
    wide = cells.agg(F.max("col")).first()[0]
    if wide is not None and wide != 1:
        raise ValueError(f"{path} has {wide + 1} columns, not 2")
    before = (F.array_position(F.array(*map(F.lit, names)), F.col("sheet")) - 1) * SHEET_ROWS
    r = rows(cells.withColumn("row", F.col("row") + before).withColumn("sheet", F.lit(names[0])), names[0], end=1)
    get = lambda i: F.trim(F.coalesce(F.get("values", F.lit(i)), F.lit("")))
    return r.select(F.col("row").cast("long").alias("line_no"), get(0).alias("src"), get(1).alias("tgt"))


def continued(name: str, k: int) -> str:
    """The name of the k-th sheet that continues one; names have 31 characters at most."""
    end = f" ({k + 1})" if k else ""
    return name[: 31 - len(end)] + end if k else name


def write_xlsx(sheets: dict[str, DataFrame], path: str, most_rows: int = SHEET_ROWS - 1) -> None:
    """A workbook with the columns' names as first rows, written by the driver row by row. A sheet can't hold more than ``most_rows`` rows below its first: larger frames go on in further sheets, without names."""
    from xml.sax.saxutils import escape

    def letters(i: int) -> str:
        out = ""
        i += 1
        while i:
            i, r = divmod(i - 1, 26)
            out = chr(65 + r) + out
        return out

    def line(i: int, row: tuple) -> str:
        cs = []
        for j, v in enumerate(row):
            if v is not None:
                r = f"{letters(j)}{i}"
                cs.append(f'<c r="{r}"><v>{v}</v></c>' if isinstance(v, int | float) and not isinstance(v, bool) else f'<c r="{r}" t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>')
        return f'<row r="{i}">{"".join(cs)}</row>'

    names: list[str] = []
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, df in sheets.items():
            # partition by partition, so that the driver never holds a sheet
            lines = chain([tuple(df.columns)], map(tuple, df.toLocalIterator()))
            for k in count():
                first = list(islice(lines, 1))
                if not first:
                    break
                names.append(continued(name, k))
                with z.open(f"xl/worksheets/sheet{len(names)}.xml", "w", force_zip64=True) as out:
                    out.write(f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{_NS[1:-1]}"><sheetData>'.encode())
                    for i, row in enumerate(chain(first, islice(lines, most_rows)), 1):
                        out.write(line(i, row).encode())
                    out.write(b"</sheetData></worksheet>")
        z.writestr("[Content_Types].xml", '<?xml version="1.0"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>' + "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in range(1, len(names) + 1)) + "</Types>")
        z.writestr("_rels/.rels", f'<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="{_REL[1:-1]}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'<?xml version="1.0"?><workbook xmlns="{_NS[1:-1]}" xmlns:r="{_REL[1:-1]}"><sheets>' + "".join(f'<sheet name="{escape(n)}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(names, 1)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", '<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="rId{i}" Type="{_REL[1:-1]}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(names) + 1)) + "</Relationships>")
