"""Workbooks as a Spark data source: spark.read.format("tabweave").load(path) and df.write.format("tabweave").save(path).

Reading is planned by file, sheet and range of bytes of the sheet's XML, so that one large sheet is read by many
tasks; a task takes the rows that begin in its range, as readers of text files do. The driver opens directories of
archives and the list of sheets, never the sheets. Conditions on path, sheet, sheet_no and physical_row are pushed into the scan: sheets that
they exclude are not planned, rows beyond them not parsed. There is no limit on rows or columns.

The schema is path, sheet, sheet_no, physical_row, cells and formulas; or, given by .schema(), any of these and columns by their letters
("physical_row long, A string, F string"): cells of other columns are then not looked at.

Writing makes a workbook (or more, of `rowsPerFile` rows) in each task, in a staging folder. The commit moves them to their names
and writes what they hold to `_files.json`; an aborted write leaves nothing. Tables are written under a header row.

Paths are those of the file systems that Arrow knows (local, HDFS, S3, GCS)."""

from __future__ import annotations

import fnmatch
import json
import math
import posixpath
import re
import uuid
import xml.etree.ElementTree as ET
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from datetime import date, datetime
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.types import ArrayType, StructType

from tabweave.errors import EngineError
from tabweave.functions.model import column_index
from tabweave.sources import plain
from tabweave.sources.package import Package, local
from tabweave.sources.workbook import Cells, xlsx_sheets

NAME, SPLIT, BLOCK, BATCH, FILE_ROWS, TOGETHER = "tabweave", 8 << 20, 1 << 20, 2000, 500_000, 1 << 16
SCHEMA = "path string, sheet string, sheet_no int, physical_row long, cells array<string>, formulas array<string>"
#: Days before this one have no number that all programs agree on.
FIRST_DAY = date(1900, 3, 1)
FIXED = tuple(x.split()[0] for x in SCHEMA.split(", "))
_ROW = re.compile(rb"<(?:\w+:)?row(?=[\s/>])(?:[^>]*?\sr=\"(\d+)\")?")
_END = re.compile(rb"</(?:\w+:)?sheetData>")
_ROOT = re.compile(rb"<(?:\w+:)?worksheet\b[^>]*>")
_SHARED = re.compile(rb"<(?:\w+:)?c\b[^>]*?\br=\"([A-Z]+\d+)\"[^>]*>(?:(?!</(?:\w+:)?c>).)*?<(?:\w+:)?f\b(?=[^>]*\bt=\"shared\")[^>]*?\bsi=\"(\d+)\"[^>]*>[^<]", re.S)


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    path = re.sub("^file:/+", "/", path)
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def files_at(path: str) -> list[str]:
    """Workbooks at a path: a file, those of a folder, or those that fit a pattern of the last name."""
    system, at = filesystem(path)
    folder, name = posixpath.split(at)
    pattern = name if any(c in name for c in "*?[") else None
    info = None if pattern else system.get_file_info(at)
    if info is not None and info.type == fs.FileType.File:
        return [path]
    found = system.get_file_info(fs.FileSelector(folder if pattern else at, allow_not_found=True))
    prefix = path[: len(path) - len(at)]
    out = sorted(f.path for f in found if f.type == fs.FileType.File and f.base_name[0] not in "_." and (fnmatch.fnmatch(f.base_name, pattern) if pattern else f.extension == "xlsx"))
    if not out and (pattern or info.type == fs.FileType.NotFound):
        raise EngineError("NOT_FOUND", f"no workbook at {path}")
    return [prefix + f for f in out]


@dataclass
class Piece(InputPartition):
    """The rows of a sheet that begin in these bytes of its part."""
    path: str
    sheet: str
    sheet_no: int
    part: str
    start: int
    end: int


@dataclass
class Bounds:
    """What pushed conditions leave: values of a column, or a range of rows."""
    only: dict[str, set] = field(default_factory=dict)
    first: int = 1
    last: int | None = None

    def took(self, f: Filter) -> bool:
        """Whether the condition is taken over; what is not is left to Spark."""
        name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
        if isinstance(f, IsNotNull):
            return name in ("path", "sheet", "sheet_no", "physical_row")
        values = set(f.value) if isinstance(f, In) else {f.value} if isinstance(f, EqualTo) else None
        if name in ("path", "sheet", "sheet_no") and values is not None:
            self.only[name] = self.only.get(name, values) & values
            return True
        if name != "physical_row" or getattr(f, "value", None) is None or isinstance(f, In):
            return False
        low = {EqualTo: 0, GreaterThanOrEqual: 0, GreaterThan: 1}.get(type(f))
        high = {EqualTo: 0, LessThanOrEqual: 0, LessThan: -1}.get(type(f))
        if low is not None:
            self.first = max(self.first, f.value + low)
        if high is not None:
            self.last = f.value + high if self.last is None else min(self.last, f.value + high)
        return low is not None or high is not None

    def allows(self, piece: Piece) -> bool:
        return all(getattr(piece, k) in v for k, v in self.only.items()) and (self.last is None or self.last >= self.first)


#: How many of the last bytes are looked at for the last row of a run: a few first, all if it is not there.
TAILS = (1 << 12, 1 << 16, 1 << 62)


def _rows_in(run: bytes, tail: int) -> list[tuple[int, bytes | None]]:
    """(place, number if it has one) of the rows that begin in the last bytes of a run."""
    return [(m.start(), m[1]) for m in _ROW.finditer(run, max(0, len(run) - tail))]


def _number_after(run: bytes, number: int) -> int:
    """The number of the last row of a run that is passed over; number: of the last row before it."""
    for tail in TAILS:
        found = _rows_in(run, tail)
        for after, (_, own) in enumerate(reversed(found)):
            if own:
                return int(own) + after
    return number + len(found)


def row_runs(stream, at: int = 0) -> Iterator[tuple[int, bytes]]:
    """A part in runs that begin where a row begins (the first: where the stream does, at this place), each with its place."""
    held = b""
    while block := stream.read(BLOCK):
        held += block
        cut = next((found[-1][0] for tail in TAILS if (found := _rows_in(held, tail))), 0)
        if cut:
            yield at, held[:cut]
            held, at = held[cut:], at + cut
    yield at, held


def root_of(run: bytes) -> bytes | None:
    """The tag that opens a sheet, to be followed by rows."""
    return found[0].rstrip(b"/>") + b">" if (found := _ROOT.search(run)) else None


def stretches(stream, start: int, end: int, base: dict[str, str], at: int = 0, root: bytes | None = None) -> Iterator[tuple[bytes, int, bytes]]:
    """(root's tag, number of the row before, whole rows) of the rows that begin from start to before end. base takes up where shared formulas began before.
    at, root: where a stream begins that is not the whole part; its rows are numbered, and no formulas are shared before it."""
    number = 0
    for at, run in row_runs(stream, at):
        root = root or root_of(run)
        if at + len(run) <= start:  # passed over: only its last row's number and shared formulas matter
            number = _number_after(run, number)
            if b'"shared"' in run:
                base.update({m[2].decode(): m[1].decode() for m in _SHARED.finditer(run)})
            continue
        first = last = None
        if at >= start and at + len(run) <= end and (m := _ROW.search(run)):
            first, last = m.start(), len(run)
        else:
            for m in _ROW.finditer(run):
                if at + m.start() < start:
                    number = int(m[1] or number + 1)
                elif at + m.start() < end:
                    first, last = m.start() if first is None else first, len(run)
                else:
                    last = m.start()
                    break
        if b'"shared"' in run and (first is None or first > 0):
            base.update({m[2].decode(): m[1].decode() for m in _SHARED.finditer(run[:first])})
        if first is not None:
            closed = _END.search(run, first, last) if b"sheetData>" in run else None
            rows = run[first:closed.start() if closed else last]
            yield root, number, rows
            number = _number_after(rows, number)
        if at + len(run) >= end:
            return


def elements(root: bytes, number: int, rows: bytes) -> Iterator[tuple[int, ET.Element]]:
    """(number, element) of whole rows."""
    parser = ET.XMLPullParser(["start", "end"])
    parser.feed(root)
    top = next(e for _, e in parser.read_events())
    parser.feed(rows)
    for event, e in parser.read_events():
        if event == "end" and local(e.tag) == "row":
            number = int(e.get("r") or number + 1)
            yield number, e
            e.clear()
            top.clear()


def rows_of(stream, start: int, end: int, base: dict[str, str]) -> Iterator[tuple[int, ET.Element]]:
    """(number, element) of the rows that begin from start to before end. base takes up where shared formulas began before."""
    for found in stretches(stream, start, end, base):
        yield from elements(*found)


class Reader(DataSourceReader):
    def __init__(self, path: str, schema: StructType, split: int) -> None:
        self.path, self.names, self.split, self.bounds = path, schema.names, split, Bounds()
        wrong = [f.name for f in schema if f.name not in FIXED and not re.fullmatch("[A-Z]{1,3}", f.name) or isinstance(f.dataType, ArrayType) != (f.name in ("cells", "formulas"))]
        if wrong:
            raise EngineError("INVALID_ARGS", f"columns of a workbook are {', '.join(FIXED)} and letters, not {', '.join(wrong)}")
        self.schema = schema

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        return [f for f in filters if not self.bounds.took(f)]

    def partitions(self) -> list[Piece]:
        out = []
        for path in files_at(self.path):
            system, at = filesystem(path)
            with system.open_input_file(at) as f:
                pack = Package(f)
                for k, (name, part) in enumerate(xlsx_sheets(pack)[1], 1):
                    size = pack.size(part)
                    pieces = max(1, -(-size // self.split))
                    out += [Piece(path, name, k, part, size * i // pieces, size * (i + 1) // pieces) for i in range(pieces)]
        return [p for p in out if self.bounds.allows(p)] or [Piece("", "", 0, "", 0, 0)]

    def read(self, piece: Piece) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema, bounds = to_arrow_schema(self.schema), self.bounds
        if not piece.path:  # all are excluded
            return
        letters = {n: column_index(n) for n in self.names if n not in FIXED}
        wanted = None if {"cells", "formulas"} & set(self.names) else frozenset(letters.values())
        by_columns = wanted is not None and all(pa.types.is_string(schema.field(n).type) for n in ("path", "sheet", *letters) if n in self.names) and all(pa.types.is_integer(schema.field(n).type) for n in ("sheet_no", "physical_row") if n in self.names)
        system, at = filesystem(piece.path)
        with system.open_input_file(at) as f:
            pack = Package(f)
            meaning, base = Cells(pack, xlsx_sheets(pack)[0]), {}
            with pack.open(piece.part) as head:
                root = root_of(head.read(1 << 12)) if piece.start else None
            stream, place = pack.open_from(piece.part, piece.start if root else 0)
            with stream:
                for found in stretches(stream, piece.start, piece.end, base, place, root):
                    table = plain.columns(found[2], meaning, letters) if by_columns else None
                    if table is None:
                        yield from self._parsed(piece, found, meaning, base, letters, wanted, schema)
                    else:
                        yield from self._taken(piece, *table, schema)
                    if bounds.last is not None and _number_after(found[2], found[1]) > bounds.last:
                        break

    def _taken(self, piece: Piece, number: np.ndarray, cells: dict[str, pa.Array], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """Rows within the bounds, by columns."""
        inside = (number >= self.bounds.first) & (self.bounds.last is None or number <= self.bounds.last)
        if inside.any():
            n, every = int(inside.sum()), inside.all()
            fixed = {"path": piece.path, "sheet": piece.sheet, "sheet_no": piece.sheet_no}
            yield pa.RecordBatch.from_arrays([pa.array(number[inside], f.type) if f.name == "physical_row" else pa.repeat(pa.scalar(fixed[f.name], f.type), n) if f.name in fixed else cells[f.name] if every else cells[f.name].filter(pa.array(inside)) for f in schema], schema=schema)

    def _parsed(self, piece: Piece, found: tuple[bytes, int, bytes], meaning: Cells, base: dict[str, str], letters: dict[str, int], wanted: frozenset[int] | None, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """Rows within the bounds, element by element."""
        held, bounds = [], self.bounds
        for number, row in elements(*found):
            if bounds.last is not None and number > bounds.last:
                break
            if number < bounds.first:
                continue
            cells, formulas = meaning.of(row, base, wanted)
            while cells and not cells[-1] and not formulas[-1]:
                cells.pop()
                formulas.pop()
            if not cells and not (wanted is not None and len(row)):
                continue
            values = {"path": piece.path, "sheet": piece.sheet, "sheet_no": piece.sheet_no, "physical_row": number, "cells": cells, "formulas": formulas}
            held.append([values[n] if n in FIXED else (cells[letters[n]] if letters[n] < len(cells) else "") or None for n in self.names])
            if len(held) >= BATCH:
                yield _batch(held, schema)
                held = []
        if held:
            yield _batch(held, schema)


def _batch(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string() if pa.types.is_string(f.type) else f.type) for i, f in enumerate(schema)], schema=schema)


@dataclass
class Written(WriterCommitMessage):
    """(staged path, rows, columns) of a task's files."""
    files: list[tuple[str, int, int]]


class Writer(DataSourceArrowWriter):
    def __init__(self, path: str, schema: StructType, overwrite: bool, rows_per_file: int, sheet: str) -> None:
        self.path, self.names, self.overwrite, self.rows, self.sheet = path.rstrip("/"), schema.names, overwrite, rows_per_file, sheet
        self.staging = f"{self.path}/_staging-{uuid.uuid4().hex}"
        system, at = filesystem(self.staging)
        system.create_dir(at, recursive=True)  # here, once: a task that outlives an abort finds no folder to write to

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        """A task's files; if it fails, they are gone."""
        files: list[tuple[str, int, int]] = []
        try:
            held, n = [], 0
            for batch in batches:
                while batch.num_rows:
                    part = batch.slice(0, self.rows - n)
                    held.append(part)
                    n, batch = n + part.num_rows, batch.slice(part.num_rows)
                    if n >= self.rows:
                        files.append(self._file(held, n))
                        held, n = [], 0
            if n:
                files.append(self._file(held, n))
        except BaseException:
            for path, _, _ in files:
                system, at = filesystem(path)
                system.delete_file(at)
            raise
        return Written(files)

    def _file(self, batches: list[pa.RecordBatch], n: int) -> tuple[str, int, int]:
        from tabweave.sinks.workbook import Columns, packed, xlsx

        path = f"{self.staging}/part-{uuid.uuid4().hex}.xlsx"
        system, at = filesystem(path)
        with system.open_output_stream(at) as out:
            out.write(packed(xlsx([(self.sheet, [list(self.names), *(Columns(b, _value) for b in pa.Table.from_batches(batches).combine_chunks().to_batches(TOGETHER))])], typed=False), "xlsx"))
        return path, n, len(self.names)

    def commit(self, messages: list[Written | None]) -> None:
        """Names only: staged files become the table's, those of before go if it is overwritten."""
        system, at = filesystem(self.path)
        system.create_dir(at, recursive=True)
        before = [f for f in files_at(self.path)] if self.overwrite else []
        known = [] if self.overwrite else self._listed(system, at)
        for k, (path, n, width) in enumerate(f for m in messages if m for f in m.files):
            name = f"part-{k:05d}-{posixpath.basename(path)[5:13]}.xlsx"
            system.move(filesystem(path)[1], f"{at}/{name}")
            known.append({"file": name, "rows": n, "columns": width})
        for path in before:
            system.delete_file(filesystem(path)[1])
        with system.open_output_stream(f"{at}/_files.json") as out:
            out.write(json.dumps({"columns": self.names, "files": known}).encode())
        self._clear(system)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(filesystem(self.path)[0])

    def _clear(self, system: fs.FileSystem) -> None:
        at = filesystem(self.staging)[1]
        if system.get_file_info(at).type == fs.FileType.Directory:
            system.delete_dir(at)

    @staticmethod
    def _listed(system: fs.FileSystem, at: str) -> list[dict]:
        if system.get_file_info(f"{at}/_files.json").type != fs.FileType.File:
            return []
        with system.open_input_stream(f"{at}/_files.json") as f:
            return json.loads(f.read())["files"]


def _value(v: object) -> object:
    """A value as a cell: days, numbers and truth values as such if the format can hold them, others as they read."""
    if isinstance(v, Decimal):
        return float(v) if Decimal(repr(float(v))) == v else str(v)
    if v is None or isinstance(v, bool | int) or isinstance(v, float) and math.isfinite(v):
        return v
    return v if isinstance(v, date) and not isinstance(v, datetime) and v >= FIRST_DAY else str(v)


class Workbooks(DataSource):
    """path; splitBytes: how much of a sheet's XML a task takes; rowsPerFile and sheet for writing."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> Reader:
        return Reader(self.options["path"], schema, int(self.options.get("splitBytes", SPLIT)))

    def writer(self, schema: StructType, overwrite: bool) -> Writer:
        return Writer(self.options["path"], schema, overwrite, min(int(self.options.get("rowsPerFile", FILE_ROWS)), 1_048_575), self.options.get("sheet", "Sheet1"))


def register(spark: SparkSession) -> None:
    """Makes the format known to a session, with conditions pushed down."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Workbooks)
