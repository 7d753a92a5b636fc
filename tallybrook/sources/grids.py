"""Raw statement files as grids: (file, row_idx, cells). Row -1 holds the comments of a text file.

Text files are read in splits (`textfiles`); a workbook or a PDF is one task's, as its bytes are only readable as a
whole. Every file has an outcome, so none vanishes, and one that can't be read stops no other.
"""

from __future__ import annotations

import posixpath
from collections.abc import Callable, Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.sources import textfiles, workbooks
from tallybrook.tables import own_splits, write_table

GRID = "file string, row_idx long, cells array<string>"
# Extensions by reader, and those that are looked for in a folder.
WORKBOOK, SPREADSHEET, TEXT, PDF = (".xlsx", ".xlsm"), (".xlsx", ".xlsm", ".xls"), (".csv", ".txt", ".tsv"), (".pdf",)
DISCOVERED = (".xlsx", ".xls", ".csv", ".txt", ".tsv", ".pdf")
#: Outcomes of a file.
READ, NO_HEADER, UNREADABLE, UNKNOWN_TYPE = "read", "no header", "unreadable", "unknown type"

Rows = list[list[str | None]]
Extractors = dict[str, Callable[[bytes], list[Rows]]]


def table_rows(tables: list[Rows]) -> Rows:
    """Cells of tables page by page, without line breaks, empty rows and repetitions of the very first row."""
    out: Rows = []
    for row in (r for t in tables for r in t):
        cells = [(c or "").replace("\n", "").strip() for c in row]
        if any(cells) and (not out or cells != out[0]):
            out.append(cells)
    return out


def kind_of(path: str) -> str:
    return posixpath.splitext(path)[1].lower()


def rows_of(path: str, data: bytes, extractors: Extractors) -> Rows:
    """The rows of a file that is read as a whole."""
    kind = kind_of(path)
    if kind in extractors:
        return table_rows(extractors[kind](data)) if kind in PDF else extractors[kind](data)[0]
    if kind in WORKBOOK:
        return workbooks.first_table(data)
    raise ValueError(f"no reader for files of type {kind}")


def whole_files(files: DataFrame, extractors: Extractors | None = None) -> DataFrame:
    """files(file, content) to file, record, cells, error."""
    extractors = extractors or {}

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            for path, data in zip(pdf["file"], pdf["content"]):
                try:
                    rows = rows_of(path, bytes(data), extractors)
                except Exception as e:  # whatever a file or a caller's extractor holds, it is that file's outcome
                    yield pd.DataFrame({"file": [path], "record": [0], "cells": [None], "error": [f"{type(e).__name__}: {e}"[:500]]})
                    continue
                for at in range(0, len(rows), 10_000):
                    part = rows[at : at + 10_000]
                    yield pd.DataFrame({"file": path, "record": range(at, at + len(part)), "cells": part, "error": None})

    return files.select("file", "content").mapInPandas(run, "file string, record long, cells array<string>, error string")


def named_files(spark: SparkSession, *paths: str) -> set[str]:
    """Those of the paths that are files themselves."""
    out = set()
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        for found in p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p) or []:
            if found.isFile():
                out.add(found.getPath().toString())
    return out


def scan_files(spark: SparkSession, *paths: str, extractors: Extractors | None = None, full_path: bool = True) -> tuple[DataFrame, DataFrame]:
    """Grids of files and folders, written once, and the outcome of each file: file, status, reason. In a folder, files
    of other types aren't looked at; a file that is named itself always has an outcome. file is the whole path, so that
    files of one name stay apart."""
    extractors = extractors or {}
    named = named_files(spark, *paths)
    files = [f for f in textfiles.files_in(spark, *paths) if f in named or kind_of(f) in (*DISCOVERED, *WORKBOOK, *extractors)]
    text = [f for f in files if kind_of(f) in TEXT and kind_of(f) not in extractors]
    known = [f for f in files if kind_of(f) in (*SPREADSHEET, *PDF, *extractors)]
    rows = textfiles.records(spark, text)
    if known:
        rows = rows.unionByName(write_table(whole_files(textfiles.binary(spark, known), extractors), "grids"))
    with own_splits(spark):
        failed = {r["file"]: r["error"] for r in rows.where("error is not null").groupBy("file").agg(F.min("error").alias("error")).collect()}
    read = {*text, *known}
    shown = (lambda f: f) if full_path else posixpath.basename
    outcomes = [(shown(f), UNREADABLE if f in failed else READ if f in read else UNKNOWN_TYPE, failed.get(f) or (None if f in read else f"no reader for files of type {kind_of(f) or 'none'}")) for f in files]
    grids = rows.where("error is null")
    if failed:
        grids = grids.join(spark.createDataFrame([(f,) for f in failed], "file string"), "file", "left_anti")
    name = F.col("file") if full_path else F.regexp_extract("file", r"([^/]*)$", 1)
    return grids.select(name.alias("file"), F.col("record").alias("row_idx"), "cells"), spark.createDataFrame(outcomes, "file string, status string, reason string")


def read_grids(spark: SparkSession, *paths: str, extractors: Extractors | None = None, full_path: bool = True) -> DataFrame:
    """The grids of scan_files() alone; a file without a reader, or one that can't be read, is an error here."""
    grids, outcomes = scan_files(spark, *paths, extractors=extractors, full_path=full_path)
    bad = outcomes.where(F.col("status") != READ).orderBy("file").first()
    if bad is not None:
        raise ValueError(f"{bad['file']}: {bad['reason']}")
    return grids


def sheets_of(files: DataFrame, sheet: str | None = None) -> DataFrame:
    """files(file, content) of workbooks to file, sheet_idx, sheet, row_idx, cells of every sheet, or of the sheets of a
    name. A workbook that can't be read is an error."""

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            for path, data in zip(pdf["file"], pdf["content"]):
                book = workbooks.Workbook(bytes(data))
                for k, (name, part) in enumerate(book.sheets):
                    rows = enumerate(book.rows(part) if sheet in (None, name) else ())
                    while held := list(islice(rows, 10_000)):
                        yield pd.DataFrame({"file": path, "sheet_idx": k, "sheet": name, "row_idx": [i for i, _ in held], "cells": [row for _, row in held]})

    return files.select("file", "content").mapInPandas(run, "file string, sheet_idx int, sheet string, row_idx long, cells array<string>")


def read_sheets(spark: SparkSession, *paths: str, sheet: str | None = None) -> DataFrame:
    """The sheets of workbooks, by path or in folders."""
    files = [f for f in textfiles.files_in(spark, *paths) if kind_of(f) in WORKBOOK]
    if not files:
        raise FileNotFoundError(f"no workbook in {', '.join(paths)}")
    return sheets_of(textfiles.binary(spark, files), sheet)
