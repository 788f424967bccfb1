"""Spreadsheets (.xlsx), read with the standard library only.

Files come through Spark's ``binaryFile`` reader, so they may lie in any store that Spark
reads, and are parsed in the workers, a file at a time.  All cells come as text.
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Callable, Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import fold_header, fold_ledger_header

# Name spaces, and limits.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
PACKAGE = "{http://schemas.openxmlformats.org/package/2006/relationships}"
MAX_ROWS, MAX_UNZIPPED, HEADER_ROWS = 50_000, 200 << 20, 10
_DATE_FORMATS = frozenset({14, 15, 16, 17, 22})


def column_number(reference: str) -> int:
    """0 for A, 25 for Z, 26 for AA."""
    n = 0
    for c in re.match("[A-Z]+", reference)[0]:
        n = 26 * n + ord(c) - 64
    return n - 1


class Workbook:
    """Rows of a workbook's sheets as lists of texts."""

    def __init__(self, content: bytes, max_unzipped: int = MAX_UNZIPPED) -> None:
        if content[:2] != b"PK":
            raise ValueError("not a workbook")
        self.zip = zipfile.ZipFile(io.BytesIO(content))
        if sum(i.file_size for i in self.zip.infolist()) > max_unzipped:
            raise ValueError("the workbook is too large when unzipped")
        names = set(self.zip.namelist())
        self.shared = ["".join(t.text or "" for t in s.iter(f"{MAIN}t")) for s in self._xml("xl/sharedStrings.xml")] if "xl/sharedStrings.xml" in names else []
        self.formats, self.dates = [], set(_DATE_FORMATS)
        if "xl/styles.xml" in names:
            styles = self._xml("xl/styles.xml")
            codes = {int(f.get("numFmtId")): f.get("formatCode") or "" for f in styles.iter(f"{MAIN}numFmt")}
            self.codes = codes
            self.dates |= {k for k, c in codes.items() if re.search("[dy]", re.sub(r'"[^"]*"|\[[^\]]*\]', "", c).lower())}
            cells = styles.find(f"{MAIN}cellXfs")
            self.formats = [int(x.get("numFmtId") or 0) for x in cells] if cells is not None else []
        else:
            self.codes = {}
        targets = {r.get("Id"): r.get("Target") for r in self._xml("xl/_rels/workbook.xml.rels")}
        self.sheets = {s.get("name"): "xl/" + targets[s.get(f"{REL}id")].removeprefix("/xl/") for s in self._xml("xl/workbook.xml").iter(f"{MAIN}sheet")}

    def tables(self) -> Iterator[tuple[str, str, str]]:
        """(sheet, table, range) of every named table, sheet by sheet, by way of the sheets' relationships."""
        names = set(self.zip.namelist())
        for sheet, part in self.sheets.items():
            folder, _, name = part.rpartition("/")
            links = f"{folder}/_rels/{name}.rels"
            if links not in names:
                continue
            for r in self._xml(links):
                if not (r.get("Type") or "").endswith("/table"):
                    continue
                target = r.get("Target")
                at = target.lstrip("/") if target.startswith("/") else posixpath.normpath(f"{folder}/{target}")
                if at in names:
                    table = self._xml(at)
                    yield sheet, table.get("displayName") or table.get("name"), table.get("ref")

    def _xml(self, name: str):
        return ElementTree.fromstring(self.zip.read(name))

    def rows(self, sheet: str, raw: bool = False) -> Iterator[tuple[int, list[str | None]]]:
        """(row number, cells) of the rows that aren't blank, streamed; ``raw`` cells are the text that is written in them, whatever their type."""
        with self.zip.open(self.sheets[sheet]) as stream:
            for _, row in ElementTree.iterparse(stream):
                if row.tag != f"{MAIN}row":
                    continue
                cells: list[str | None] = []
                for c in row.iter(f"{MAIN}c"):
                    at = column_number(c.get("r")) if c.get("r") else len(cells)
                    cells += [None] * (at + 1 - len(cells))
                    cells[at] = self._raw(c) if raw else self._cell(c)
                if any(x and x.strip() for x in cells):
                    yield int(row.get("r")), cells
                row.clear()

    def _raw(self, c) -> str | None:
        value = c.find(f"{MAIN}v")
        if c.get("t") == "s" and value is not None and value.text:
            return self.shared[int(value.text)]
        return "".join(x.text or "" for x in c.iter() if x.tag in (f"{MAIN}v", f"{MAIN}t")) or None

    def _cell(self, c) -> str | None:
        kind, value = c.get("t"), c.find(f"{MAIN}v")
        if kind == "inlineStr":
            return "".join(t.text or "" for t in c.iter(f"{MAIN}t"))
        if value is None or value.text is None:
            return None
        if kind == "s":
            return self.shared[int(value.text)]
        if kind in ("str", "b", "e"):
            return value.text
        style = int(c.get("s") or 0)
        form = self.formats[style] if style < len(self.formats) else 0
        number = float(value.text)
        if form in self.dates:
            day = datetime(1899, 12, 30) + timedelta(days=number)
            return day.strftime("%Y-%m-%d") if number == int(number) else day.isoformat(timespec="milliseconds")
        if number == int(number) and abs(number) < 1e15:
            code = self.codes.get(form, "")
            return str(int(number)).zfill(len(code)) if code and set(code) == {"0"} else str(int(number))
        return value.text


def read_sheet(book: Workbook, columns: list[str], sheet: str | None = None, header_rows: int = HEADER_ROWS, max_rows: int = MAX_ROWS, fold: Callable[[str], str] = fold_ledger_header) -> Iterator[tuple[int, list[str | None]]]:
    """(row number, cells of ``columns``) below the header; headers match after folding."""
    wanted = [fold(c) for c in columns]
    if sheet is not None and sheet not in book.sheets:
        raise ValueError(f"no sheet {sheet!r}")
    for name in [sheet] if sheet is not None else book.sheets:
        places, n = None, 0
        for row, cells in book.rows(name):
            if places is None:
                folded = [fold(c or "") for c in cells]
                if set(wanted) <= set(folded):
                    if any(folded.count(w) > 1 for w in wanted):
                        raise ValueError("a column comes twice")
                    places = [folded.index(w) for w in wanted]
                elif row >= header_rows:
                    break
                continue
            n += 1
            if n > max_rows:
                raise ValueError(f"more than {max_rows} rows")
            yield row, [cells[p] if p < len(cells) else None for p in places]
        if places is not None:
            if not n:
                raise ValueError("the sheet has no rows")
            return
    raise ValueError("no sheet has the required columns")


def read_workbooks(spark: SparkSession, path: str, columns: list[str], sheet: str | None = None, header_rows: int = HEADER_ROWS, max_rows: int = MAX_ROWS, max_unzipped: int = MAX_UNZIPPED, listing: bool = False) -> DataFrame:
    """(path, row, columns, error) of the workbooks at ``path``.

    The sheet is the one named, else the first whose first ``header_rows`` rows hold all
    columns; headers match after folding, listing headers by words, ledger headers by letters
    and digits.  A workbook that breaks a rule gives one row with its error.
    """
    names = [f"c{i}" for i in range(len(columns))]
    fold = fold_header if listing else fold_ledger_header

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    rows = [(name, row, *cells, None) for row, cells in read_sheet(Workbook(content, max_unzipped), columns, sheet, header_rows, max_rows, fold)]
                except (ValueError, KeyError, zipfile.BadZipFile, ElementTree.ParseError) as e:
                    rows = [(name, None, *[None] * len(columns), str(e))]
                yield pd.DataFrame(rows, columns=["path", "row", *names, "error"]).astype({"row": "Int64"})

    schema = "path string, row long, " + "".join(f"{c} string, " for c in names) + "error string"
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(of, schema).toDF("path", "row", *columns, "error")


def records(book: Workbook, required: set[str], fold: Callable[[str], str], sheet: str | None = None, header_rows: int = HEADER_ROWS, max_rows: int = MAX_ROWS) -> Iterator[tuple[int, dict[str, str | None], dict[str, str | None]]]:
    """(row number, cells by folded header, cells by header as written) of the first fitting sheet."""
    if sheet is not None and sheet not in book.sheets:
        raise ValueError(f"no sheet {sheet!r}")
    for name in [sheet] if sheet is not None else book.sheets:
        heads, n = None, 0
        for row, cells in book.rows(name):
            if heads is None:
                folded = [fold(c or "") for c in cells]
                if required <= set(folded):
                    known = [f for f in folded if f]
                    if any(known.count(f) > 1 for f in required):
                        raise ValueError("a column comes twice")
                    heads = [(f, c) for f, c in zip(folded, cells, strict=True)]
                elif row >= header_rows:
                    break
                continue
            n += 1
            if n > max_rows:
                raise ValueError(f"more than {max_rows} rows")
            padded = cells + [None] * (len(heads) - len(cells))
            pairs = [(f, c, v) for (f, c), v in zip(heads, padded) if f]
            yield row, {f: v for f, _, v in pairs}, {c: v for _, c, v in pairs}
        if heads is not None:
            if not n:
                raise ValueError("the sheet has no rows")
            return
    raise ValueError("no sheet has the required columns")


def read_records(spark: SparkSession, path: str, required: set[str], fold: Callable[[str], str], sheet: str | None = None, max_rows: int = MAX_ROWS, max_unzipped: int = MAX_UNZIPPED) -> DataFrame:
    """(path, row, cells, original, error): cells is a map by folded header, original one by the header as written."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    rows = [(name, row, cells, raw, None) for row, cells, raw in records(Workbook(content, max_unzipped), required, fold, sheet, max_rows=max_rows)]
                except (ValueError, KeyError, zipfile.BadZipFile, ElementTree.ParseError) as e:
                    rows = [(name, None, None, None, str(e))]
                yield pd.DataFrame(rows, columns=["path", "row", "cells", "original", "error"]).astype({"row": "Int64"})

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(of, "path string, row long, cells map<string,string>, original map<string,string>, error string")


def choose(book: Workbook, table: str | None = None) -> tuple[str, str]:
    """(sheet, range) to read: the table of that name in any case; without a name the first table, else the first sheet with two rows."""
    tables = list(book.tables())
    if table is not None and table.strip():
        for sheet, name, ref in tables:
            if name.casefold() == table.strip().casefold():
                return sheet, ref
        raise ValueError(f"no table {table.strip()!r}")
    if tables:
        return tables[0][0], tables[0][2]
    for sheet in book.sheets:
        if sum(1 for _, _ in zip(range(2), book.rows(sheet))) == 2:
            return sheet, ""
    raise ValueError("neither a table nor a sheet with rows")


def table_records(book: Workbook, required: set[str], fold: Callable[[str], str], table: str | None = None, max_rows: int = MAX_ROWS, recover: tuple[str, ...] = ()) -> Iterator[tuple[int, dict[str, str | None], dict[str, str | None]]]:
    """(row number, cells by folded header, cells by header as written) of the table that ``choose`` finds; its first row is the header.

    A column of ``recover`` (folded) that is wholly empty is read again as the text written in its cells.
    """
    sheet, ref = choose(book, table)
    low, high = (re.findall(r"([A-Z]+)(\d+)", ref.replace("$", "")) + [None, None])[:2] if ref else (None, None)
    first_row, first = (int(low[1]), column_number(low[0])) if low else (1, 0)
    last_row, last = (int(high[1]), column_number(high[0])) if high else ((first_row, first) if low else (None, None))

    def inside(raw: bool = False) -> Iterator[tuple[int, list[str | None]]]:
        for row, cells in book.rows(sheet, raw):
            if row >= first_row and (last_row is None or row <= last_row):
                yield row, cells[first : None if last is None else last + 1]

    heads, found = None, []
    for row, cells in inside():
        if heads is None:
            folded = [fold(c or "") for c in cells]
            if not required <= set(folded):
                raise ValueError("the table lacks required columns")
            if any(folded.count(f) > 1 for f in required):
                raise ValueError("a column comes twice")
            heads = list(zip(folded, cells, strict=True))
        elif any(x and x.strip() for x in cells):
            found.append((row, cells + [None] * (len(heads) - len(cells))))
            if len(found) > max_rows:
                raise ValueError(f"more than {max_rows} rows")
    if not found:
        raise ValueError("the table has no rows")
    empty = [i for i, (f, _) in enumerate(heads) if f in recover and not any(cells[i] and cells[i].strip() for _, cells in found)]
    if empty:
        written = dict(inside(raw=True))
        for row, cells in found:
            for i in empty:
                cells[i] = written[row][i] if i < len(written.get(row, [])) else None
    for row, cells in found:
        pairs = [(f, c, v) for (f, c), v in zip(heads, cells) if f]
        yield row, {f: v for f, _, v in pairs}, {c: v for _, c, v in pairs}


def read_tables(spark: SparkSession, path: str, required: set[str], fold: Callable[[str], str], table: str | None = None, max_rows: int = MAX_ROWS, max_unzipped: int = MAX_UNZIPPED, recover: tuple[str, ...] = ()) -> DataFrame:
    """As ``read_records``, of a named table, the first one, or the first sheet with rows."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    rows = [(name, row, cells, raw, None) for row, cells, raw in table_records(Workbook(content, max_unzipped), required, fold, table, max_rows, recover)]
                except (ValueError, KeyError, IndexError, zipfile.BadZipFile, ElementTree.ParseError) as e:
                    rows = [(name, None, None, None, str(e))]
                yield pd.DataFrame(rows, columns=["path", "row", "cells", "original", "error"]).astype({"row": "Int64"})

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(of, "path string, row long, cells map<string,string>, original map<string,string>, error string")


def upload_error(path: Column, content: Column, most: int = 20 << 20) -> Column:
    """The first rule that an uploaded file breaks: name, size, or the mark of a ZIP file; null if none."""
    name = F.regexp_extract(path, r"[^/]*$", 0)
    return (
        F.when(~name.rlike(r"(?i)\.xlsx$"), "not an .xlsx file")
        .when(~name.rlike(r"^[\w .()-]{1,180}$"), "file name")
        .when(F.length(content) > most, "too large")
        .when(F.hex(F.substring(content, 1, 2)) != "504B", "not a workbook")
    )
