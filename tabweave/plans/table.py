"""A table: a DataFrame whose columns have unique internal names, and the names that queries use."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabweave.errors import EngineError
from tabweave.functions.model import column_letter
from tabweave.functions.values import Cell

ROW = "row_no"


def unique_names(raw: list[str | None]) -> list[str]:
    """Trimmed names; letters for blank ones, _2, _3 ... for repeated ones."""
    used: set[str] = set()
    out = []
    for i, name in enumerate(raw):
        base = (name or "").strip() or column_letter(i)
        found, n = base, 2
        while found in used:
            found, n = f"{base}_{n}", n + 1
        used.add(found)
        out.append(found)
    return out


def resolve(names: list[str], wanted: str, what: str = "") -> int:
    """Exact name, else the first that differs in case only."""
    wanted = wanted.strip()
    if wanted in names:
        return names.index(wanted)
    for i, name in enumerate(names):
        if name.lower() == wanted.lower():
            return i
    raise EngineError("UNKNOWN_COLUMN", f"no column {wanted!r} {what}; there are: {', '.join(names)}")


@dataclass(frozen=True)
class Table:
    df: DataFrame  # columns c0 .. cN, and row_no if the source has an order
    names: tuple[str, ...]
    name: str = "table"
    truncated: bool = False
    header_row: int = 1
    notes: tuple[str, ...] = ()

    @classmethod
    def of(cls, df: DataFrame, name: str = "table", order: Column | None = None) -> Table:
        """A DataFrame's own columns, whatever their names. order: a column to tell which row comes first."""
        columns = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)]
        return cls(df.select(*columns, *([order.alias(ROW)] if order is not None else [])), tuple(unique_names(list(df.columns))), name)

    @classmethod
    def from_matrix(cls, sheet: DataFrame, name: str, header_row: int = 1, width: int | None = None, truncated: bool = False) -> Table:
        """sheet: row_no (from 1, blank rows left out) and cells array<string>. One small job reads the header and the width."""
        facts = sheet.agg(F.max(F.size("cells")).alias("width"), F.count("*").alias("rows"), F.max(F.when(F.col(ROW) == header_row, F.col("cells"))).alias("head")).first()
        if header_row > facts["rows"]:
            raise EngineError("INVALID_ARGS", f"headerRow {header_row}: the sheet has {facts['rows']} rows")
        width = max(1, facts["width"] or 1, width or 0)
        head = list(facts["head"] or []) if header_row else []
        names = unique_names([head[i] if i < len(head) else None for i in range(width)])
        cells = [F.when(F.get("cells", F.lit(i)) != "", F.get("cells", F.lit(i))).alias(f"c{i}") for i in range(width)]
        return cls(sheet.where(F.col(ROW) > header_row).select(*cells, ROW), tuple(names), name, truncated, header_row)

    @property
    def ordered(self) -> bool:
        return ROW in self.df.columns

    def index(self, name: str) -> int:
        return resolve(list(self.names), name)

    def cell(self, at: int) -> Cell:
        return Cell(F.col(f"c{at}"), self.df.schema[f"c{at}"].dataType)

    def find(self, name: str) -> Cell:
        return self.cell(self.index(name))

    def where(self, condition: Column | None) -> Table:
        return self if condition is None else replace(self, df=self.df.where(condition))

    def named(self) -> DataFrame:
        """With the names that queries use."""
        return self.df.select(*(F.col(f"c{i}").alias(n) for i, n in enumerate(self.names)))

    def types(self) -> list[T.DataType]:
        return [self.df.schema[f"c{i}"].dataType for i in range(len(self.names))]
