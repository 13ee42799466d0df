"""Workbook edit scripts over cells in long form. Steps that move or write cells are composed (see script.py) and applied together.

Cells: sheet, row, col (from 1), value, formula, style. Presentation (merges, widths, panes, filters, images,
charts, conditional formats, validations) is kept beside them as small lists."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabweave.edit.script import Script
from tabweave.errors import EngineError
from tabweave.functions.model import column_index, column_letter
from tabweave.sinks import presentation

CELLS = "sheet string, row long, col long, value string, formula string, style string"
#: Cells of a range that get a style though they are blank.
NAME, OPS, LOOKS = 31, 200, 100_000
_REF = re.compile(r"^\$?([A-Za-z]{1,3})\$?([1-9][0-9]*)$")


def cell_ref(ref: str) -> tuple[int, int]:
    """(row, col) of A1, from 1."""
    m = _REF.match(ref.strip())
    if not m:
        raise EngineError("INVALID_ARGS", f"not a cell: {ref!r}")
    return int(m[2]), column_index(m[1]) + 1


def range_ref(ref: str) -> tuple[str | None, int, int, int, int]:
    """(sheet, first row, first col, last row, last col) of A1:B2, 'My sheet'!A1 and the like."""
    sheet, _, rest = ref.strip().rpartition("!")
    sheet = sheet[1:-1].replace("''", "'") if sheet.startswith("'") and sheet.endswith("'") else sheet
    a, _, b = rest.partition(":")
    (r1, c1), (r2, c2) = cell_ref(a), cell_ref(b or a)
    return sheet or None, min(r1, r2), min(c1, c2), max(r1, r2), max(c1, c2)


def rectangles(cells: Iterable[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """(first row, first col, last row, last col) that cover a set of cells: runs in rows, joined over equal runs below."""
    runs: dict[tuple[int, int], list[int]] = {}
    left = sorted(set(cells))
    i = 0
    while i < len(left):
        row, start = left[i]
        end = start
        while i + 1 < len(left) and left[i + 1] == (row, end + 1):
            i, end = i + 1, end + 1
        runs.setdefault((start, end), []).append(row)
        i += 1
    out = []
    for (start, end), rows in runs.items():
        first = last = rows[0]
        for r in rows[1:]:
            if r != last + 1:
                out.append((first, start, last, end))
                first = r
            last = r
        out.append((first, start, last, end))
    return sorted(out)


@dataclass
class Workbook:
    """base: cells before the steps that script holds."""
    base: DataFrame
    sheets: list[str]
    shown: dict[str, list] = field(default_factory=lambda: {k: [] for k in presentation.KINDS})
    notes: list[str] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.script = Script(self.sheets)

    @property
    def cells(self) -> DataFrame:
        """Cells after all steps so far."""
        if self.script.changes:
            patch = self.script.patches()
            mapped = self.script.mapped(self.base)
            self.cells = upserted(mapped, patch) if patch else mapped
        return self.base

    @cells.setter
    def cells(self, cells: DataFrame) -> None:
        self.base, self.script = cells, Script(self.sheets)

    @classmethod
    def of_sheets(cls, rows: DataFrame) -> Workbook:
        """From rows of read_sheets()."""
        names = [r[0] for r in rows.groupBy("sheet_no", "sheet").count().orderBy("sheet_no").select("sheet").collect()]
        each = rows.select("sheet", F.col("physical_row").alias("row"), F.posexplode(F.arrays_zip("cells", "formulas")).alias("at", "x"))
        return cls(each.select("sheet", "row", (F.col("at") + 1).cast("long").alias("col"), F.col("x.cells").alias("value"), F.when(F.col("x.formulas") != "", F.col("x.formulas")).alias("formula"), F.lit(None).cast("string").alias("style")).where("value <> '' OR formula IS NOT NULL"), names)

    @property
    def spark(self) -> SparkSession:
        return self.base.sparkSession

    def sheet(self, op: dict) -> str:
        wanted = op.get("sheet")
        if wanted in (None, ""):
            return self.sheets[0]
        if isinstance(wanted, int) or str(wanted).isdigit() and str(wanted) not in self.sheets:
            if 1 <= int(wanted) <= len(self.sheets):
                return self.sheets[int(wanted) - 1]
        elif wanted in self.sheets:
            return wanted
        raise EngineError("UNKNOWN_SHEET", f"no sheet {wanted!r}; there are {', '.join(self.sheets)}")

    @classmethod
    def of_file(cls, rows: DataFrame, data: bytes) -> Workbook:
        """From rows of read_sheets() and the bytes of the same file: with its empty sheets, styles and looks."""
        names, shown, styled, notes = presentation.read(data)
        book = cls.of_sheets(rows)
        looks = rows.sparkSession.createDataFrame(styled, "sheet string, row long, col long, look string")  # of one file, which is limited in size
        cells = book.cells.join(F.broadcast(looks) if not styled else looks, ["sheet", "row", "col"], "full")
        return cls(cells.select("sheet", "row", "col", "value", "formula", F.coalesce("style", "look").alias("style")), names, shown, notes)

    def rows(self, sheet: str, styled: bool = False) -> list[list]:
        """Values of a sheet, on the driver, for writing it."""
        out: list[list] = []
        for r in self.cells.where(F.col("sheet") == sheet).orderBy("row", "col").toLocalIterator():
            out.extend([] for _ in range(r["row"] - len(out)))
            line = out[r["row"] - 1]
            line.extend([None] * (r["col"] - len(line)))
            value = r["formula"] or r["value"]
            line[r["col"] - 1] = (value, r["style"]) if styled else value
        return out


def _on(name: str) -> Column:
    return F.col("sheet") == name


def _inside(name: str, ref: str) -> Column:
    _, r1, c1, r2, c2 = range_ref(ref)
    return _on(name) & F.col("row").between(r1, r2) & F.col("col").between(c1, c2)


def upserted(cells: DataFrame, patch: list[tuple]) -> DataFrame:
    """Cells with those of the patch in their place; blanks of the patch clear cells. The patch is the script's own values."""
    new = cells.sparkSession.createDataFrame([(s, r, c, None if v is None else str(v), f, st) for s, r, c, v, f, st in patch], CELLS)
    places = F.broadcast(new.select("sheet", "row", "col"))
    kept = cells.join(places, ["sheet", "row", "col"], "left_anti")
    looks = cells.where("style IS NOT NULL").join(places, ["sheet", "row", "col"], "left_semi").select("sheet", "row", "col", F.col("style").alias("look"))  # a new value keeps its cell's style
    put = new.join(looks, ["sheet", "row", "col"], "left").select("sheet", "row", "col", "value", "formula", F.coalesce("style", "look").alias("style"))
    return kept.unionByName(put.where("coalesce(value, '') <> '' OR formula IS NOT NULL OR style IS NOT NULL"))


def _style(op: dict) -> str | None:
    return presentation.laid_over(None, presentation.cell_style(op["style"])) if op.get("style") else None


def _set_cells(book: Workbook, op: dict) -> None:
    name, (row, col) = book.sheet(op), cell_ref(op.get("start", "A1"))
    if not isinstance(op.get("values"), list) or not all(isinstance(v, list) for v in op["values"]):
        raise EngineError("INVALID_ARGS", "set_cells needs values, an array of arrays")
    for i, line in enumerate(op["values"]):
        for k, v in enumerate(line):
            formula = v if isinstance(v, str) and v.startswith("=") and len(v) > 1 else None
            book.script.sheets[name].put(row + i, col + k, None if formula else v, formula, _style(op))


def _set_value(book: Workbook, op: dict) -> None:
    row, col = cell_ref(op.get("cell", ""))
    book.script.sheets[book.sheet(op)].put(row, col, op.get("value"), None, _style(op))


def _set_formula(book: Workbook, op: dict) -> None:
    row, col = cell_ref(op.get("cell", ""))
    book.script.sheets[book.sheet(op)].put(row, col, None, "=" + str(op.get("formula", "")).lstrip("="), _style(op))


def _style_range(book: Workbook, op: dict) -> None:
    """A style over those that cells have; blank cells of the range get it too, up to LOOKS of them."""
    name, ref = book.sheet(op), str(op.get("range") or op.get("ref") or "")
    _, r1, c1, r2, c2 = range_ref(ref)
    new = presentation.cell_style(op.get("style") or {})
    held = [r[0] for r in book.cells.where(_inside(name, ref) & F.col("style").isNotNull()).select("style").distinct().collect()]  # styles, not cells: a workbook has few
    made = F.lit(presentation.laid_over(None, new))
    for old in held:
        made = F.when(F.col("style") == old, F.lit(presentation.laid_over(old, new))).otherwise(made)
    cells = book.cells.withColumn("style", F.when(_inside(name, ref), made).otherwise(F.col("style")))
    if (r2 - r1 + 1) * (c2 - c1 + 1) <= LOOKS:
        grid = book.spark.range(r1, r2 + 1).select(F.lit(name).alias("sheet"), F.col("id").alias("row"), F.explode(F.sequence(F.lit(c1).cast("long"), F.lit(c2).cast("long"))).alias("col"))
        blank = grid.join(book.cells.where(_inside(name, ref)).select("row", "col"), ["row", "col"], "left_anti")
        cells = cells.unionByName(blank.select("sheet", "row", "col", F.lit(None).cast("string").alias("value"), F.lit(None).cast("string").alias("formula"), F.lit(presentation.laid_over(None, new)).alias("style")))
    else:
        book.notes.append(f"{ref}: only cells with contents are styled")
    book.cells = cells


def moved(axis: str, insert: bool) -> Callable[[Workbook, dict], None]:
    """Insertion or deletion of rows or columns: what lies behind moves."""
    def run(book: Workbook, op: dict) -> None:
        name, at, n = book.sheet(op), int(op.get("at", op.get("start", 1))), int(op.get("count", 1))
        if at < 1 or n < 1:
            raise EngineError("INVALID_ARGS", "at and count are whole numbers from 1")
        book.script.sheets[name].move(axis, at, n, insert)
        presentation.moved(book.shown, name, axis, at, n, insert)
        if insert and op.get("values"):
            first = at
            _set_cells(book, {"sheet": name, "start": f"A{first}" if axis == "row" else f"{column_letter(first - 1)}1", "values": op["values"]})
    return run


def _add_sheet(book: Workbook, op: dict) -> None:
    name = str(op.get("name") or "").strip()[:NAME]
    if not name or name.lower() in (s.lower() for s in book.sheets):
        raise EngineError("INVALID_ARGS", f"a new sheet needs a name of its own, not {name!r}")
    book.sheets.append(name)
    book.script.add(name)
    if op.get("values"):
        _set_cells(book, {"sheet": name, "values": op["values"]})


def _rename_sheet(book: Workbook, op: dict) -> None:
    old, new = book.sheet(op), str(op.get("name") or op.get("newName") or "").strip()[:NAME]
    if not new or new in book.sheets and new != old:
        raise EngineError("INVALID_ARGS", f"a sheet needs a name of its own, not {new!r}")
    book.sheets[book.sheets.index(old)] = new
    for ops in book.shown.values():
        for kept in ops:
            kept["sheet"] = new if kept["sheet"] == old else kept["sheet"]
    book.script.rename(old, new)


def _delete_sheet(book: Workbook, op: dict) -> None:
    if len(book.sheets) == 1:
        raise EngineError("INVALID_ARGS", "the last sheet stays")
    name = book.sheet(op)
    book.sheets.remove(name)
    for ops in book.shown.values():
        ops[:] = [kept for kept in ops if kept["sheet"] != name]
    book.script.delete(name)


def _ruled(kind: str) -> Callable[[Workbook, dict], None]:
    """Checks a conditional format or validation by writing it once."""
    def run(book: Workbook, op: dict) -> None:
        op = {**op, "range": str(op.get("range") or op.get("ref") or "").replace("$", ""), "sheet": book.sheet(op)}
        presentation.all_ranges([op])
        presentation.look_of({k: [op] if k == kind else [] for k in presentation.KINDS}, op["sheet"], presentation.Styles())
        book.shown[kind].append(op)
    return run


def _keep(kind: str, check: Callable[[dict], object] = lambda op: None) -> Callable[[Workbook, dict], None]:
    def run(book: Workbook, op: dict) -> None:
        check(op)
        book.shown[kind].append({**op, "sheet": book.sheet(op)})
    return run


def _unmerge(book: Workbook, op: dict) -> None:
    name, target = book.sheet(op), range_ref(op.get("range", ""))[1:]
    book.shown["merge"] = [m for m in book.shown["merge"] if m["sheet"] != name or range_ref(m["range"])[1:] != target]


OPERATIONS: dict[str, Callable[[Workbook, dict], None]] = {
    "set_cells": _set_cells, "set_value": _set_value, "set_formula": _set_formula, "style_range": _style_range, "merge": _keep("merge", lambda op: range_ref(op.get("range", ""))), "unmerge": _unmerge,
    "insert_rows": moved("row", True), "delete_rows": moved("row", False), "insert_cols": moved("col", True), "delete_cols": moved("col", False), "add_sheet": _add_sheet, "rename_sheet": _rename_sheet, "delete_sheet": _delete_sheet,
    "set_col_width": _keep("col_width"), "set_row_height": _keep("row_height"), "freeze": _keep("freeze"), "auto_filter": _keep("auto_filter"), "add_image": _keep("image"), "add_chart": _keep("chart"),
    "conditional_format": _ruled("conditional_format"), "data_validation": _ruled("data_validation"),
}


def edited(book: Workbook, script: list[dict]) -> Workbook:
    """The steps in order; an optional step that fails leaves a note."""
    if len(script) > OPS:
        raise EngineError("INVALID_ARGS", f"at most {OPS} steps")
    for i, op in enumerate(script):
        if op.get("op") not in OPERATIONS:
            raise EngineError("INVALID_ARGS", f"unknown step {op.get('op')!r}; there are {', '.join(OPERATIONS)}")
        try:
            OPERATIONS[op["op"]](book, op)
        except EngineError as e:
            if not op.get("optional"):
                raise
            book.notes.append(f"step {i + 1}: {e}")
    return book
