"""Workbooks (xlsx): the rows of their sheets as texts, each cell as a reader of typed cells would print it.

A date is a number whose style says so; dates and times print as `2025-03-21 10:53:00` or `10:53:00`, whole numbers
without a fraction, truth values as True or False; errors and the usual texts for a missing value are null.
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree

# Number formats that mean dates and times (14 to 22, 45 to 47; 27 to 36 and 50 to 58 in East Asian
# editions), days of the two calendars, and texts that mean a missing value.
DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
DURATIONS = {46}
CALENDARS = {False: datetime(1899, 12, 30), True: datetime(1904, 1, 1)}
MISSING = {"", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"}

_QUOTED = re.compile(r'"[^"]*"|\\.|_.|\[(?!(?:h+|m+|s+)\])[^\]]*\]', re.IGNORECASE)
_WHOLE = re.compile(r"[+-]?\d+")
Row = list[str | None]


def _tag(e: ElementTree.Element) -> str:
    return e.tag.rpartition("}")[2]


def _text(e: ElementTree.Element) -> str:
    """The text of runs, without readings printed above it."""
    if _tag(e) == "rPh":
        return ""
    return (e.text or "") if _tag(e) == "t" else "".join(map(_text, e))


def _kind_of_format(code: str) -> str:
    """date, duration or number."""
    bare = _QUOTED.sub("", code.split(";")[0])
    if re.search(r"\[(h+|m+|s+)\]", bare, re.IGNORECASE):
        return "duration"
    return "date" if re.search(r"[dmhysDMHYS]", bare) else "number"


def moment(serial: float, of_1904: bool, duration: bool = False) -> str:
    """A serial number of days as text, rounded to milliseconds."""
    days, part = divmod(serial, 1)
    clock = timedelta(milliseconds=round(part * 86_400_000))
    if duration:
        return str(timedelta(days=days) + clock)
    if 0 <= serial < 1 and clock < timedelta(days=1):
        return str((CALENDARS[True] + clock).time())
    if not of_1904 and 0 < serial < 60:
        days += 1  # the calendar has a 29th of February 1900
    return str(CALENDARS[of_1904] + timedelta(days=days) + clock)


def number(value: str) -> str:
    if _WHOLE.fullmatch(value):
        return str(int(value))
    x = float(value)
    return str(int(x)) if x.is_integer() else repr(x)


class Workbook:
    def __init__(self, data: bytes):
        self.zip = zipfile.ZipFile(io.BytesIO(data))
        names = set(self.zip.namelist())
        parsed = lambda name: ElementTree.fromstring(self.zip.read(name))
        self.shared = [_text(e) for e in parsed("xl/sharedStrings.xml")] if "xl/sharedStrings.xml" in names else []
        self.styles = self._styles(parsed("xl/styles.xml")) if "xl/styles.xml" in names else []
        links = {e.get("Id"): e.get("Target") for e in parsed("xl/_rels/workbook.xml.rels")}
        self.of_1904, self.sheets = False, []
        for e in parsed("xl/workbook.xml").iter():
            if _tag(e) == "workbookPr":
                self.of_1904 = e.get("date1904") in ("1", "true")
            elif _tag(e) == "sheet":
                target = links[next(v for k, v in e.attrib.items() if k.endswith("}id"))]
                self.sheets.append((e.get("name"), target.lstrip("/") if target.startswith("/") else posixpath.join("xl", target)))

    @staticmethod
    def _styles(root: ElementTree.Element) -> list[str]:
        """date, duration or number by style."""
        codes = {int(e.get("numFmtId")): e.get("formatCode") or "" for e in root.iter() if _tag(e) == "numFmt"}
        by_id = lambda i: _kind_of_format(codes[i]) if i in codes else "duration" if i in DURATIONS else "date" if i in DATE_FORMATS else "number"
        return [by_id(int(x.get("numFmtId") or 0)) for e in root if _tag(e) == "cellXfs" for x in e]

    def _shown(self, cell: ElementTree.Element) -> str | None:
        kind = cell.get("t") or "n"
        # as a rule a cell holds a value alone, or one text alone
        only = cell[0] if len(cell) == 1 else None
        if kind == "inlineStr":
            if only is not None and len(only) == 1 and only.tag.endswith("is") and only[0].tag.endswith("}t"):
                return only[0].text or ""
            return _text(cell)
        value = only.text if only is not None and only.tag.endswith("}v") else next((e.text for e in cell if _tag(e) == "v"), None)
        if value is None or kind == "e":
            return None
        if kind == "s":
            return self.shared[int(value)]
        if kind == "b":
            return str(value.strip() not in ("0", "false"))
        if kind == "d":
            return str(datetime.fromisoformat(value))
        if kind != "n":
            return value
        style = int(cell.get("s") or 0)
        sort = self.styles[style] if style < len(self.styles) else "number"
        try:
            return number(value) if sort == "number" else moment(float(value), self.of_1904, sort == "duration")
        except (ValueError, OverflowError):
            return value

    def rows(self, path: str) -> Iterator[Row]:
        """The rows of a sheet, one after another; rows that the file leaves out are empty."""
        with self.zip.open(path) as part:
            at, tags = 0, {}
            for _, row in ElementTree.iterparse(part):
                if (tag := tags.get(row.tag)) is None:
                    tag = tags[row.tag] = _tag(row)
                if tag != "row":
                    continue
                place = int(row.get("r") or at + 1) - 1
                yield from ([] for _ in range(place - at))
                cells: Row = []
                for cell in row:
                    if tags.get(cell.tag) != "c":
                        continue
                    if reference := cell.get("r"):
                        k = column(reference)
                        cells += [None] * (k + 1 - len(cells))
                    else:
                        k = len(cells)
                        cells.append(None)
                    shown = self._shown(cell) if len(cell) else None
                    cells[k] = None if shown in MISSING else shown
                at = place + 1
                yield cells
                row.clear()


def column(reference: str) -> int:
    """The place of a cell such as AB12, from 0."""
    n = 0
    for c in re.match(r"[A-Z]*", reference)[0]:
        n = 26 * n + ord(c) - 64
    return max(n - 1, 0)


def is_filled(row: Row) -> bool:
    return any(c not in (None, "") for c in row)


def first_table(data: bytes) -> list[Row]:
    """The first sheet with two rows that aren't empty, else the first sheet."""
    book, first = Workbook(data), None
    for _, path in book.sheets:
        rows = list(book.rows(path))
        first = rows if first is None else first
        if sum(map(is_filled, rows)) >= 2:
            return rows
    return first or []
