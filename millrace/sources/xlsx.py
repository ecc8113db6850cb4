"""Sheets of XLSX workbooks: a zip of XML parts, read with the standard library."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.sources.io import read_blobs

_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def _column(reference: str) -> int:
    """Place (from 0) of the column in a cell reference such as ``AB12``."""
    n = 0
    for c in re.match(r"[A-Z]+", reference).group():
        n = n * 26 + ord(c) - 64
    return n - 1


def first_sheet(blob: bytes) -> list[list[str | None]]:
    """Rows of the first sheet as texts; empty cells are None."""
    book = zipfile.ZipFile(io.BytesIO(blob))
    shared: list[str] = []
    if "xl/sharedStrings.xml" in book.namelist():
        shared = ["".join(t.text or "" for t in item.iter(f"{_NS}t")) for item in ElementTree.fromstring(book.read("xl/sharedStrings.xml"))]
    name = min((n for n in book.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.search(r"\d+", n).group()))
    rows = []
    for row in ElementTree.fromstring(book.read(name)).iter(f"{_NS}row"):
        cells: dict[int, str | None] = {}
        for i, cell in enumerate(row.iter(f"{_NS}c")):
            kind, value = cell.get("t"), cell.find(f"{_NS}v")
            if kind == "inlineStr":
                text = "".join(t.text or "" for t in cell.iter(f"{_NS}t"))
            elif value is None or value.text is None:
                text = None
            else:
                text = shared[int(value.text)] if kind == "s" else value.text
            cells[_column(cell.get("r")) if cell.get("r") else i] = text
        rows.append([cells.get(i) for i in range(max(cells, default=-1) + 1)])
    return rows


def read_xlsx(spark: SparkSession, path: str, schema: str, pattern: str = "*.xlsx") -> DataFrame:
    """First sheets of the workbooks below ``path``, by the names in their first row; ``file`` names the workbook.

    Cells that do not fit their type are null, as are columns a sheet lacks;
    broken workbooks are skipped. One task reads a workbook at a time.
    """
    fields = StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    head, *rows = first_sheet(blob) or [[]]
                except (zipfile.BadZipFile, ElementTree.ParseError, ValueError, KeyError):
                    continue
                at = {h: i for i, h in enumerate(head)}
                columns = [[r[at[f.name]] if f.name in at and at[f.name] < len(r) else None for r in rows] for f in fields]
                yield pa.RecordBatch.from_arrays([pa.array([file] * len(rows), pa.string()), *(pa.array(c, pa.string()) for c in columns)], names=["file", *(f.name for f in fields)])

    texts = read_blobs(spark, path, pattern).mapInArrow(run, "file string, " + ", ".join(f"{f.name} string" for f in fields))
    whole = lambda f: F.col(f.name).try_cast("double").try_cast(f.dataType) if f.dataType.simpleString() in ("int", "bigint") else F.col(f.name).try_cast(f.dataType)
    return texts.select("file", *[whole(f).alias(f.name) for f in fields])


def newest_workbooks(books: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the workbook whose name is last for each key."""
    last = books.groupBy(*keys).agg(F.max("file").alias("file"))
    return books.join(last, [*keys, "file"], "left_semi")
