"""Sheets as workbooks (xlsx), written by Spark tasks.

Rows are numbered where they lie, in their order, which deals them out to workbooks of as many rows as a sheet may have. A
task turns runs of its rows into compressed XML, so that rows aren't shuffled for it; one task for each workbook strings its blocks together, and Spark's
text writer stores the bytes. So no task holds more than one workbook, compressed, and the driver moves names only.
"""

from __future__ import annotations

import io
import math
import re
import zipfile
import zlib
from datetime import date, datetime
from decimal import Decimal
from functools import reduce
from xml.sax.saxutils import escape

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.tables import before_parts, new_path, write_table

# The rows of a sheet below its header, the most characters of a cell, the largest exact whole number.
SHEET_ROWS, CELL_CHARS, EXACT = 1_048_575, 32_767, 10**15
BLOCK_ROWS = 20_000
#: Characters that XML can't hold.
_BAD = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\ud800-\udfff￾￿]")
_SPECIAL = re.compile(f"[&<>\r{_BAD.pattern[1:]}")
PLAIN, MONEY, HEAD = 0, 1, 2
_STYLES = (
    "<styleSheet xmlns='http://schemas.openxmlformats.org/spreadsheetml/2006/main'><fonts count='2'><font/><font><b/></font></fonts><fills count='1'><fill/></fills><borders count='1'><border/></borders>"
    "<cellStyleXfs count='1'><xf/></cellStyleXfs><cellXfs count='3'><xf numFmtId='0'/><xf numFmtId='4' applyNumberFormat='1'/><xf numFmtId='0' fontId='1' applyFont='1'/></cellXfs></styleSheet>"
)
_MAIN, _LINKS = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def cell(value, style: int = PLAIN) -> str:
    """A cell: numbers and truth values as such, amounts with two decimals shown, anything else as text."""
    if value is None or isinstance(value, float) and math.isnan(value):
        return "<c/>"
    if isinstance(value, bool):
        return f"<c t='b'><v>{int(value)}</v></c>"
    if isinstance(value, int) and abs(value) < EXACT:
        return f"<c><v>{value}</v></c>"
    if isinstance(value, (float, Decimal)) and math.isfinite(value):
        return f"<c s='{MONEY}'><v>{value!r}</v></c>" if isinstance(value, float) else f"<c s='{MONEY}'><v>{value}</v></c>"
    text = value.strftime("%Y-%m-%d %H:%M:%S") if isinstance(value, datetime) else value.isoformat() if isinstance(value, date) else str(value)
    shown = escape(_BAD.sub("", text)[:CELL_CHARS], {"\r": "&#13;"}) if _SPECIAL.search(text) else text[:CELL_CHARS]
    return f"<c t='inlineStr'{f" s='{style}'" if style else ''}><is><t xml:space='preserve'>{shown}</t></is></c>"


def _pieces(sheet: int, sheet_rows: int):
    """Rows (rank from 0, cells) as they lie in order to runs of rows that follow each other in a workbook, compressed; block
    is the place of a run's first row."""

    def run(batches):
        held: list[str] = []
        begin = 0

        def piece():
            nonlocal held
            data, held = zlib.compress("".join(held).encode(), 1), []
            return pa.record_batch([pa.array([begin // sheet_rows]), pa.array([sheet], pa.int32()), pa.array([begin % sheet_rows]), pa.array([data], pa.binary())], names=["book", "sheet", "block", "data"])

        for batch in batches:
            ranks, *columns = (c.to_pylist() for c in batch.columns)
            for rank, row in zip(ranks, zip(*columns)):
                if held and (rank != begin + len(held) or rank % sheet_rows == 0 or len(held) >= BLOCK_ROWS):
                    yield piece()
                if not held:
                    begin = rank
                held.append(f"<row>{''.join(map(cell, row))}</row>")
        if held:
            yield piece()

    return run


def _book(names: list[str], heads: list[list[str]]):
    """The blocks of a workbook to its bytes, without the last one: a line end, which is the archive's comment."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        data, number = io.BytesIO(), int(pdf["book"].iloc[0])
        parts = pdf.sort_values(["sheet", "block"])
        sheets = sorted({int(s) for s in parts["sheet"]})
        with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as book:
            book.comment = b"\n"
            kinds = "".join(f"<Override PartName='/xl/worksheets/sheet{s}.xml' ContentType='application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml'/>" for s in sheets)
            book.writestr("[Content_Types].xml", "<Types xmlns='http://schemas.openxmlformats.org/package/2006/content-types'><Default Extension='rels' ContentType='application/vnd.openxmlformats-package.relationships+xml'/><Default Extension='xml' ContentType='application/xml'/><Override PartName='/xl/workbook.xml' ContentType='application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml'/><Override PartName='/xl/styles.xml' ContentType='application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml'/>" + kinds + "</Types>")
            link = lambda i, kind, target: f"<Relationship Id='rId{i}' Type='{_LINKS}/{kind}' Target='{target}'/>"
            links = lambda body: f"<Relationships xmlns='http://schemas.openxmlformats.org/package/2006/relationships'>{body}</Relationships>"
            book.writestr("_rels/.rels", links(link(1, "officeDocument", "xl/workbook.xml")))
            book.writestr("xl/_rels/workbook.xml.rels", links("".join(link(s + 1, "worksheet", f"worksheets/sheet{s}.xml") for s in sheets) + link(len(names) + 1, "styles", "styles.xml")))
            book.writestr("xl/workbook.xml", f"<workbook xmlns='{_MAIN}' xmlns:r='{_LINKS}'><sheets>" + "".join(f"<sheet name='{escape(names[s])}' sheetId='{s + 1}' r:id='rId{s + 1}'/>" for s in sheets) + "</sheets></workbook>")
            book.writestr("xl/styles.xml", _STYLES)
            for s in sheets:
                with book.open(f"xl/worksheets/sheet{s}.xml", "w") as part:
                    part.write(f"<worksheet xmlns='{_MAIN}'><sheetData><row>{''.join(cell(h, HEAD) for h in heads[s])}</row>".encode())
                    for block in parts.loc[parts["sheet"] == s, "data"]:
                        part.write(zlib.decompress(block))
                    part.write(b"</sheetData></worksheet>")
        return pd.DataFrame({"book": [number], "content": [data.getvalue()[:-1]]})

    return run


def sheet_name(name: str) -> str:
    """A name that a sheet may have."""
    return re.sub(r"[\\/*?:\[\]']", "_", name)[:31] or "_"


def write_workbooks(sheets: dict[str, DataFrame], path: str, sheet_rows: int = SHEET_ROWS) -> list[str]:
    """Writes 1.xlsx and so on to the folder, and returns their paths. The rows of a sheet keep the order of its DataFrame;
    one with more than sheet_rows goes on in the next workbook. An empty sheet has its header in the first."""
    parts, names, heads = [], [sheet_name(n) for n in sheets], []
    for k, df in enumerate(sheets.values()):
        columns = [f"c{i}" for i in range(len(df.columns))]
        heads.append(df.columns)
        # partitions of an ordered DataFrame follow each other
        held = write_table(df.toDF(*columns).withColumn("_at", F.monotonically_increasing_id()), "rows")
        part, place = F.shiftright("_at", 33).alias("__part"), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
        before = before_parts(held.groupBy(part).agg(F.count("*").alias("__n")), "__n", "__before")  # a row for each part
        ranked = held.withColumn("__part", part).join(F.broadcast(before), "__part").select((F.col("__before") + place).alias("_rank"), *columns)
        parts.append(ranked.mapInArrow(_pieces(k, sheet_rows), "book long, sheet int, block long, data binary"))
        empty = [(0, k, -1, bytearray(zlib.compress(b"")))]
        parts.append(df.sparkSession.createDataFrame(empty, "book long, sheet int, block long, data binary"))
    blocks = write_table(reduce(DataFrame.unionByName, parts), "blocks")
    books = blocks.groupBy("book").applyInPandas(_book(names, heads), "book long, content binary")
    spark = books.sparkSession
    written = new_path(spark, "workbooks")
    books.select("book", F.col("content").cast("string").alias("value")).write.partitionBy("book").text(written)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop(path))
    out = []
    for found in fs.globStatus(hadoop(f"{written}/book=*/part-*")):
        part = found.getPath()
        number = int(part.getParent().getName().partition("=")[2])
        target = f"{path.rstrip('/')}/{number + 1}.xlsx"
        fs.delete(hadoop(target), False)
        if not fs.rename(part, hadoop(target)):
            raise OSError(f"can't write {target}")
        out.append((number, target))
    return [t for _, t in sorted(out)]
