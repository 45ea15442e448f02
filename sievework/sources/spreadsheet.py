"""Spreadsheets (.xlsx) as a data source: the zipped XML is streamed, a file a partition.

    spark.dataSource.register(SpreadsheetSource)
    spark.read.format("xlsx").option("sheet", "Data").load("/data/*.xlsx")

The first row names the columns.  Without a schema all columns are strings;
with one, values are read as its types by column name, and a value that
isn't one is null.  Cells without a value are null; a number that stands for
a date stays the number it is.  Of a file only its table of shared strings is
held at once.
"""

from __future__ import annotations

import posixpath
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import BooleanType, DoubleType, FloatType, IntegerType, LongType, StringType, StructField, StructType

from sievework.sources.files import open_uri

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINKS = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def _whole(value: float) -> int | None:
    return int(value) if value == int(value) else None


#: How a cell's value, a string, number or boolean, becomes one of each type.
READ_AS = {
    StringType: lambda v: v if isinstance(v, str) else str(v).lower() if isinstance(v, bool) else str(_whole(v) if _whole(v) is not None else v),
    DoubleType: float, FloatType: float, IntegerType: lambda v: _whole(float(v)), LongType: lambda v: _whole(float(v)),
    BooleanType: lambda v: v if isinstance(v, bool) else {"true": True, "1": True, "false": False, "0": False}.get(str(v).strip().lower(), v == 1 if isinstance(v, float) and v in (0, 1) else None),
}


def convert(value, kind):
    """A cell's value as a type; null if it isn't one."""
    if value is None:
        return None
    try:
        return READ_AS[type(kind)](value)
    except (ValueError, OverflowError):
        return None


def column_number(reference: str) -> int:
    """Number from 0 of a cell's column, as in ``AB12``."""
    number = 0
    for letter in re.match(r"[A-Z]+", reference)[0]:
        number = 26 * number + ord(letter) - 64
    return number - 1


def _text(node) -> str:
    return "".join(t.text or "" for t in node.iter(f"{_MAIN}t"))


def _streamed(book: zipfile.ZipFile, name: str, tag: str) -> Iterator[ElementTree.Element]:
    """Elements of a tag, one by one; what was read is let go."""
    with book.open(name) as source:
        events = ElementTree.iterparse(source, events=("start", "end"))
        _, root = next(events)
        for event, node in events:
            if event == "end" and node.tag == f"{_MAIN}{tag}":
                yield node
                node.clear()
                root.clear()


def sheet_file(book: zipfile.ZipFile, sheet: str | None) -> str:
    """Place in the archive of a sheet by name, or of the first."""
    sheets = {n.get("name"): n.get(f"{_LINKS}id") for n in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet")}
    if sheet is not None and sheet not in sheets:
        raise ValueError(f"no sheet {sheet!r}; there are {', '.join(sheets)}")
    wanted = sheets[sheet] if sheet is not None else next(iter(sheets.values()))
    for link in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels")):
        if link.get("Id") == wanted:
            target = link.get("Target")
            return target.lstrip("/") if target.startswith("/") else posixpath.normpath(f"xl/{target}")
    raise ValueError(f"the workbook has no file for sheet {sheet!r}")


def rows(uri: str, sheet: str | None) -> Iterator[list]:
    """Values of every row: strings, floats, booleans and None."""
    system, path = open_uri(uri)
    with system.open_input_file(path) as source, zipfile.ZipFile(source) as book:
        shared = [_text(n) for n in _streamed(book, "xl/sharedStrings.xml", "si")] if "xl/sharedStrings.xml" in book.namelist() else []
        for row in _streamed(book, sheet_file(book, sheet), "row"):
            values: list = []
            for cell in row.iter(f"{_MAIN}c"):
                at = column_number(cell.get("r")) if cell.get("r") else len(values)
                values += [None] * (at + 1 - len(values))
                kind, found = cell.get("t", "n"), cell.find(f"{_MAIN}v")
                if kind == "inlineStr":
                    values[at] = _text(cell)
                elif found is not None and found.text is not None and kind != "e":
                    text = found.text
                    values[at] = shared[int(text)] if kind == "s" else text == "1" if kind == "b" else text if kind in ("str", "d") else float(text)
            yield values


def header(uri: str, sheet: str | None) -> list[str]:
    """Names of the columns; unnamed ones are numbered, repeated ones get a number."""
    names: list[str] = []
    for i, value in enumerate(next(rows(uri, sheet), [])):
        name = convert(value, StringType()) or f"column_{i + 1}"
        names.append(name if name not in names else f"{name}_{i + 1}")
    return names


def _files(pattern: str) -> list[str]:
    """Files of a path or pattern, on any file system."""
    spark = SparkSession.getActiveSession()
    if spark is None:
        return [pattern]
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path) or []
    return sorted(re.sub("^file:/+", "/", s.getPath().toString()) for s in found)


class _File(InputPartition):
    def __init__(self, uri: str):
        self.uri = uri


class _Reader(DataSourceReader):
    def __init__(self, files: list[str], sheet: str | None, schema: StructType):
        self.files, self.sheet, self.schema = files, sheet, schema

    def partitions(self) -> list[InputPartition]:
        return [_File(uri) for uri in self.files]

    def read(self, partition: _File) -> Iterator[tuple]:
        names = header(partition.uri, self.sheet)
        at = [names.index(f.name) if f.name in names else None for f in self.schema]
        found = rows(partition.uri, self.sheet)
        next(found, None)
        for values in found:
            if any(v is not None for v in values):
                yield tuple(convert(values[i], f.dataType) if i is not None and i < len(values) else None for i, f in zip(at, self.schema, strict=True))


class SpreadsheetSource(DataSource):
    """Rows of one sheet of one or more workbooks; options ``path`` and ``sheet``."""

    @classmethod
    def name(cls) -> str:
        return "xlsx"

    def _found(self) -> list[str]:
        given = [f for f in (self.options.get("files") or "").split("\n") if f]
        return given or [self.options["path"]]

    def schema(self) -> StructType:
        return StructType([StructField(n, StringType()) for n in header(self._found()[0], self.options.get("sheet"))])

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self._found(), self.options.get("sheet"), schema)


def read_spreadsheet(spark: SparkSession, path: str, sheet: str | None = None, schema: StructType | str | None = None) -> DataFrame:
    """A sheet of the workbooks that fit a path or pattern."""
    found = _files(path)
    if not found:
        raise FileNotFoundError(path)
    spark.dataSource.register(SpreadsheetSource)
    reader = spark.read.format("xlsx").option("files", "\n".join(found))
    reader = reader.option("sheet", sheet) if sheet is not None else reader
    return (reader.schema(schema) if schema is not None else reader).load()
