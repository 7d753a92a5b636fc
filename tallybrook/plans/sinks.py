"""Sinks: CSV, JSON reports, the daily panel and sets of sheets. All are Spark writers that replace what was there."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.operators import portfolio
from tallybrook.schema import published


def safe_name(name: str) -> str:
    """A file name without separators and signs that file systems refuse."""
    return re.sub(r'[\\/:*?"<>|\s]+', "_", name).strip("_") or "_"


def write_csv(df: DataFrame, path: str, names: bool = True, mark: bool = True, partition: str | None = None) -> None:
    """Text-only columns with a header; published names if asked. Fields keep their blanks, quotes and line breaks. mark:
    each file begins with a byte order mark, which spreadsheets need to see that it is UTF-8. partition: a column whose
    values go to a folder each."""
    out = published(df) if names else df
    times = {f.name: F.date_format(F.col(f"`{f.name}`"), "yyyy-MM-dd HH:mm:ss") for f in out.schema if f.dataType.typeName() == "timestamp_ntz"}
    out = out.withColumns(times)
    if mark:
        out = out.toDF("\ufeff" + out.columns[0], *out.columns[1:])
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    out.write.mode("overwrite").partitionBy(*([partition] if partition else [])).options(header=True, escape='"', **kept).csv(path)


def write_report(sections: dict[str, DataFrame], path: str) -> None:
    """Each section as JSON lines below the path."""
    for name, df in sections.items():
        df.write.mode("overwrite").json(f"{path}/{safe_name(name)}")


def write_panel(ledger: DataFrame, path: str, accounts: list[str]) -> None:
    """The daily panel with a column for each of the accounts, two decimals, and the total over all of the ledger's."""
    daily = portfolio.daily_balance(ledger).where(F.col("acct").isin(*accounts))
    wide = portfolio.daily_wide(daily, accounts).drop("total")
    total = portfolio.total_by_day(ledger)
    total.join(wide, "day", "left").select("day", *(F.col(f"`{a}`") for a in accounts), "total").orderBy("day").write.mode("overwrite").option("header", True).csv(path)


def write_sheets(sheets: dict[str, DataFrame], folder: str) -> None:
    """A folder of CSV per sheet; spreadsheets of a big ledger are cut from these."""
    for name, df in sheets.items():
        write_csv(df, f"{folder}/{safe_name(name)}", names=False)
