"""Workbooks and delimited files as sheets: one row per non-blank row, with cells and formulas as text.

Files are read whole by one task each here (there are limits on their size); books of any size are split by the data
source of sources/datasource.py, large delimited data by scan_delimited(). Queries see at most `ROWS` rows and `COLUMNS` columns of a
sheet, and are told; whatever is converted, edited or scanned is whole."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator
from datetime import datetime, timedelta
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabweave.errors import EngineError
from tabweave.functions.model import column_index, fmt
from tabweave.plans.table import ROW, Table
from tabweave.sources.package import TABLE_BYTES, Package, local, opened, parse_xml, remembered, sheet_entries
from tabweave.sources.sniff import checked, sniff

ROWS, COLUMNS, WIDEST = 200_000, 200, 16_384
SCHEMA = "path string, sheet string, sheet_no int, row_no long, physical_row long, cells array<string>, formulas array<string>, truncated boolean"
# Built-in number formats that show dates.
DATE_FORMATS = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])


def _clean(value: str | None) -> str:
    return (value or "").strip()


class Sheet:
    """Rows of a sheet; if it is capped, what lies beyond the limits of queries is cut and told."""

    def __init__(self, name: str, capped: bool = False) -> None:
        self.name, self.rows, self.truncated, self.capped = name, [], False, capped

    def add(self, number: int, cells: list[str], formulas: list[str]) -> None:
        """Blank rows are left out."""
        if self.capped and len(cells) > COLUMNS:
            self.truncated = self.truncated or any(cells[COLUMNS:])
            cells, formulas = cells[:COLUMNS], formulas[:COLUMNS]
        while cells and not cells[-1] and not formulas[len(cells) - 1]:
            cells.pop()
        if not any(cells) and not any(formulas):
            return
        if self.capped and len(self.rows) >= ROWS:
            self.truncated = True
            return
        self.rows.append((number, cells, formulas[:len(cells)]))


@lru_cache(maxsize=1 << 16)
def excel_day(serial: float, epoch_1904: bool = False) -> str:
    return (datetime(1904, 1, 1) if epoch_1904 else datetime(1899, 12, 30)).__add__(timedelta(days=int(serial))).strftime("%Y-%m-%d")


@remembered
def _from_1904(book: bytes) -> bool:
    return any(local(e.tag) == "workbookPr" and e.get("date1904") in ("1", "true") for e in parse_xml(book))


@remembered
def _shows_days(styles: bytes) -> list[bool]:
    """Of each format of cells: whether it shows a date."""
    root, out = parse_xml(styles), []
    own = {f.get("numFmtId"): f.get("formatCode", "") for f in root.iter() if local(f.tag) == "numFmt"}
    for xf in (xf for x in root if local(x.tag) == "cellXfs" for xf in x):
        code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", own.get(xf.get("numFmtId"), ""))
        out.append(int(xf.get("numFmtId") or 0) in DATE_FORMATS or bool(re.search("[ymdhs]", code, re.I)) and "General" not in code)
    return out


class Cells:
    """What the cells of a book mean: shared texts, formats that show dates, the first day, and where shared formulas begin."""

    def __init__(self, pack: Package, main: str) -> None:
        self.epoch_1904 = _from_1904(pack.read(main))
        self.shared: list[str] = []
        self.dates: list[bool] = []
        self.known: dict[tuple[str, str | None], dict[str, str]] = {}  # by kind and style, what values show as
        for kind, target in pack.relations(main).values():
            if kind == "sharedStrings" and pack.has(target):
                self.shared = ["".join(t.text or "" for t in item.iter() if local(t.tag) == "t") for item in pack.xml(target) if local(item.tag) == "si"]
            if kind == "styles" and pack.has(target):
                self.dates += _shows_days(pack.read(target))

    def of(self, row: object, base: dict[str, str], wanted: frozenset[int] | None = None) -> tuple[list[str], list[str]]:
        """Values and formulas of a row. base: first cells of the sheet's shared formulas so far. wanted: the columns that are looked at, all if None."""
        cells: list[str] = []
        formulas: list[str] = []
        for c in row:
            if local(c.tag) != "c":
                continue
            at = column_index(re.match("[A-Za-z]+", c.get("r"))[0]) if c.get("r") else len(cells)
            cells.extend([""] * (at + 1 - len(cells)))
            formulas.extend([""] * (at + 1 - len(formulas)))
            if wanted is not None and at not in wanted:
                continue
            parts = {local(x.tag): x for x in c}
            shown = self._shown(c, parts)
            if "f" in parts:
                f = parts["f"]
                if f.get("t") == "shared" and f.text:
                    base[f.get("si", "")] = c.get("r") or ""
                text = f.text or (f"shared with {base[f.get('si', '')]}" if f.get("si", "") in base else "")
                formulas[at] = f"={text}"
                shown = shown or formulas[at]
            cells[at] = _clean(shown)
        return cells, formulas

    def _shown(self, c: object, parts: dict) -> str:
        kind = c.get("t", "n")
        if kind == "inlineStr":
            return "".join(t.text or "" for t in c.iter() if local(t.tag) == "t")
        return self.shown(kind, parts["v"].text if "v" in parts else None, c.get("s"))

    def shown(self, kind: str, value: str | None, style: str | None) -> str:
        """A stored value as it shows. kind: of the cell, not one with a text of its own."""
        if kind == "s":
            return self.shared[int(value)] if value else ""
        if kind == "b":
            return "TRUE" if value == "1" else "FALSE" if value == "0" else ""
        if kind in ("str", "e", "d"):
            return (value or "")[:10] if kind == "d" else value or ""
        if value is None:
            return ""
        style = int(style or 0)
        return excel_day(float(value), self.epoch_1904) if style < len(self.dates) and self.dates[style] else fmt(float(value))


def xlsx_sheets(pack: Package) -> tuple[str, list[tuple[str, str]]]:
    """The main part, and (name, part) of the sheets in order."""
    family, main = pack.main_part()
    if family != "xlsx":
        raise EngineError("BAD_XLSX", "not a workbook")
    rels = pack.relations(main)
    return main, [(name, rels[at][1]) for name, at in sheet_entries(pack.read(main))]


def parse_xlsx(data: bytes, capped: bool = False) -> list[Sheet]:
    pack = opened(data)
    main, sheets = xlsx_sheets(pack)
    meaning, out = Cells(pack, main), []
    for name, target in sheets:
        sheet, number, base = Sheet(name, capped), 0, {}
        for row in pack.tree(target).iter():
            if local(row.tag) == "row":
                number = int(row.get("r") or number + 1)
                sheet.add(number, *meaning.of(row, base))
        out.append(sheet)
    return out


def parse_ods(data: bytes, capped: bool = False) -> list[Sheet]:
    pack = Package(data)
    out = []
    for t in (e for e in pack.xml("content.xml").iter() if local(e.tag) == "table"):
        attr = lambda e, name: next((v for k, v in e.attrib.items() if local(k) == name), None)
        sheet, number = Sheet(attr(t, "name") or "", capped), 0
        for row in (e for e in t.iter() if local(e.tag) == "table-row"):
            cells, formulas = [], []
            for c in row:
                if local(c.tag) not in ("table-cell", "covered-table-cell"):
                    continue
                kind = attr(c, "value-type")
                text = "\n".join("".join(p.itertext()) for p in c if local(p.tag) == "p")
                shown = {"float": lambda c=c: fmt(float(attr(c, "value"))), "currency": lambda c=c: fmt(float(attr(c, "value"))), "percentage": lambda c=c: fmt(float(attr(c, "value"))),
                         "date": lambda c=c: (attr(c, "date-value") or "")[:10], "boolean": lambda c=c: (attr(c, "boolean-value") or "").upper()}.get(kind, lambda text=text: text)()
                repeat = min(int(attr(c, "number-columns-repeated") or 1), WIDEST)
                formula = re.sub(r"^(?:of|oooc):", "", attr(c, "formula") or "")
                cells += [_clean(shown)] * repeat
                formulas += [formula] * repeat
            repeat = int(attr(row, "number-rows-repeated") or 1)
            for k in range(repeat if any(cells) else 0):
                sheet.add(number + k + 1, list(cells), list(formulas))
            number += repeat
        out.append(sheet)
    return out


def parse_delimited(data: bytes, separator: str, capped: bool = False) -> list[Sheet]:
    sheet = Sheet("Sheet1", capped)
    csv.field_size_limit(1 << 26)
    for i, row in enumerate(csv.reader(io.StringIO(data.decode("utf-8-sig", "replace"), newline=""), delimiter=separator)):
        sheet.add(i + 1, [_clean(x) for x in row], [""] * len(row))
    return [sheet]


def parse(data: bytes, path: str = "", capped: bool = False) -> list[Sheet]:
    checked(data, TABLE_BYTES)
    kind = sniff(data, path)
    if kind in ("csv", "tsv", "txt"):
        return parse_delimited(data, "\t" if kind == "tsv" else ",", capped)
    if kind in ("xlsx", "ods"):
        return parse_xlsx(data, capped) if kind == "xlsx" else parse_ods(data, capped)
    raise EngineError("UNSUPPORTED_FORMAT", f"{path or 'the file'} is {kind}; tables are read from xlsx, ods, csv, tsv and txt (old binary workbooks need an external parser)")


def _rows(capped: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for k, sheet in enumerate(parse(content, path, capped)):
                    for i in range(0, max(1, len(sheet.rows)), 2000):
                        rows = sheet.rows[i:i + 2000]
                        n = len(rows)
                        yield pa.RecordBatch.from_arrays([pa.array([path] * n, pa.string()), pa.array([sheet.name] * n, pa.string()), pa.array([k + 1] * n, pa.int32()), pa.array(range(i + 1, i + 1 + n), pa.int64()), pa.array([r[0] for r in rows], pa.int64()),
                                                         pa.array([r[1] for r in rows], pa.list_(pa.string())), pa.array([r[2] for r in rows], pa.list_(pa.string())), pa.array([sheet.truncated] * n, pa.bool_())], ["path", "sheet", "sheet_no", "row_no", "physical_row", "cells", "formulas", "truncated"])
    return run


def read_sheets(spark: SparkSession, path: str, capped: bool = False) -> DataFrame:
    """All rows of all sheets of the files at a path or pattern; capped: up to the limits of queries."""
    return parsed_sheets(spark.read.format("binaryFile").load(path), capped)  # a file over the limit raises TOO_LARGE


def parsed_sheets(files: DataFrame, capped: bool = False) -> DataFrame:
    """files: path, content."""
    return files.select("path", "content").mapInArrow(_rows(capped), SCHEMA)


def scan_delimited(spark: SparkSession, path: str, separator: str = ",", header: bool = True) -> Table:
    """Delimited files of any size, split among tasks; every cell stays text. Rows have no order."""
    df = spark.read.option("sep", separator).option("quote", '"').option("escape", '"').option("header", header).option("encoding", "UTF-8").option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path)
    return Table.of(df)


def pick(sheets: DataFrame, sheet: object = None) -> DataFrame:
    """The first sheet, the one of a number from 1, or the one of a name."""
    if sheet in (None, ""):
        return sheets.where("sheet_no = 1")
    found = sheets.where(F.col("sheet_no") == int(sheet) if isinstance(sheet, int) or str(sheet).isdigit() and not sheets.where(F.col("sheet") == str(sheet)).limit(1).count() else F.col("sheet") == str(sheet))
    if found.isEmpty():
        raise EngineError("UNKNOWN_SHEET", f"no sheet {sheet!r}; there are {', '.join(r[0] for r in sheets.select('sheet').distinct().limit(200).collect())}")
    return found


def load_table(spark: SparkSession, path: str, sheet: object = None, header_row: int = 1) -> Table:
    rows = pick(read_sheets(spark, path, capped=True).persist(), sheet)  # looked at several times, parsed once
    first = rows.select("sheet", "truncated").first()
    if first is None:
        return Table.of(spark.createDataFrame([], "A string"), "empty")
    return Table.from_matrix(rows.select(ROW, "cells"), first["sheet"], header_row, truncated=first["truncated"])


def window(sheets: DataFrame, first: int = 1, last: int | None = None, max_rows: int = 400, max_columns: int = 60, mode: str = "value") -> DataFrame:
    """Rows first to last of the physical sheet: sheet, row, line (tab-separated). mode: value, formula or both."""
    rows = sheets.where((F.col("physical_row") >= first) & (F.lit(last is None) | (F.col("physical_row") <= (last or 0))))
    value = {"value": lambda v, f: v, "formula": lambda v, f: F.when(f != "", f).otherwise(v), "both": lambda v, f: F.when((f != "") & (f != v), F.concat(f, F.lit(" → "), v)).otherwise(v)}[mode]
    cells = F.slice(F.zip_with("cells", "formulas", value), 1, min(max_columns, COLUMNS))
    shown = F.transform(cells, lambda c: F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), "\t", "␉"), "\r?\n", "⏎"))
    return rows.orderBy("sheet_no", "physical_row").limit(min(max_rows, 5000)).select("sheet", F.col("physical_row").alias("row"), F.array_join(shown, "\t").alias("line"))


def summary(sheets: DataFrame) -> DataFrame:
    return sheets.groupBy("sheet_no", "sheet").agg(F.max("physical_row").alias("rows"), F.max(F.size("cells")).alias("cols"))
