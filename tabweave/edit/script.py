"""Edit scripts composed before they are applied: what a script does to the places of cells is one map of intervals for each axis of each
sheet, what it writes is one set of patches at their last places. Applying it is one projection and one patch, however many steps it has."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Before all places. Stretches up to which comparisons are spelled out.
FIRST, FEW = -(1 << 62), 8


@dataclass
class Axis:
    """Stretches of source places that are kept, in order: first, last (None: all that follow) and how far they have moved."""
    kept: list[tuple[int, int | None, int]] = field(default_factory=lambda: [(FIRST, None, 0)])

    def insert(self, at: int, n: int) -> None:
        self.kept = [(first, last, shift + n * (first + shift >= at)) for first, last, shift in self._cut(at)]

    def delete(self, at: int, n: int) -> None:
        parts = [p for p in self._cut(at, at + n) if not at <= p[0] + p[2] < at + n]
        self.kept = [(first, last, shift - n * (first + shift >= at + n)) for first, last, shift in parts]

    def _cut(self, *places: int) -> list[tuple[int, int | None, int]]:
        """The stretches, none of which goes on across any of these places."""
        parts = self.kept
        for at in places:
            out = []
            for first, last, shift in parts:
                if first + shift < at and (last is None or last + shift >= at):
                    out += [(first, at - shift - 1, shift), (at - shift, last, shift)]
                else:
                    out.append((first, last, shift))
            parts = out
        return parts

    @property
    def moves(self) -> bool:
        return self.kept != [(FIRST, None, 0)]

    def place(self, c: Column) -> Column:
        """Where a source place is now, null if it is gone: the stretch that begins last before it is found by halving, in a sorted literal array if there are many."""
        if len(self.kept) > FEW:
            firsts, lasts, shifts = (F.array(*(F.lit(p[i]).cast("long") for p in self.kept)) for i in range(3))
            steps = F.array(*(F.lit(1 << k) for k in reversed(range(len(self.kept).bit_length()))))
            at = F.aggregate(steps, F.lit(-1), lambda i, step: F.when(F.coalesce(F.get(firsts, i + step) <= c, F.lit(False)), i + step).otherwise(i))
            found = F.transform(F.array(at), lambda i: F.when(F.coalesce(c <= F.get(lasts, i), i >= 0), c + F.get(shifts, i)))
            return F.get(found, F.lit(0))
        out = F.lit(None).cast("long")
        for first, last, shift in self.kept:
            out = F.when((c >= first) if last is None else c.between(first, last), c + F.lit(shift)).otherwise(out)
        return out


@dataclass
class Sheet:
    """source: the sheet that it was, None for a new one. patch: (row, col) to value, formula and style."""
    source: str | None
    row: Axis = field(default_factory=Axis)
    col: Axis = field(default_factory=Axis)
    patch: dict[tuple[int, int], tuple] = field(default_factory=dict)

    def move(self, axis: str, at: int, n: int, insert: bool) -> None:
        (getattr(self, axis).insert if insert else getattr(self, axis).delete)(at, n)
        k = 0 if axis == "row" else 1
        moved = {}
        for place, held in self.patch.items():
            if insert or not at <= place[k] < at + n:
                by = (n if insert else -n) * (place[k] >= at)
                moved[(place[0] + by, place[1]) if k == 0 else (place[0], place[1] + by)] = held
        self.patch = moved

    def put(self, row: int, col: int, value: object, formula: str | None, style: str | None) -> None:
        """A later value takes a cell's place; its style stays unless there is a new one."""
        self.patch[row, col] = (value, formula, style or self.patch.get((row, col), (None, None, None))[2])


class Script:
    def __init__(self, sheets: list[str]) -> None:
        self.before, self.sheets = list(sheets), {s: Sheet(s) for s in sheets}

    @property
    def changes(self) -> bool:
        return self.before != [s.source for s in self.sheets.values()] or any(name != s.source or s.row.moves or s.col.moves or s.patch for name, s in self.sheets.items())

    def add(self, name: str) -> None:
        self.sheets[name] = Sheet(None)

    def rename(self, old: str, new: str) -> None:
        self.sheets = {new if k == old else k: s for k, s in self.sheets.items()}

    def delete(self, name: str) -> None:
        del self.sheets[name]

    def mapped(self, cells: DataFrame) -> DataFrame:
        """Cells at their new places."""
        kept = {s.source: (name, s) for name, s in self.sheets.items() if s.source is not None}
        name, row, col = F.col("sheet"), F.col("row"), F.col("col")
        for source in self.before:
            here = F.col("sheet") == source
            now, sheet = kept.get(source, (None, None))
            if now != source:
                name = F.when(here, F.lit(now)).otherwise(name)
            if sheet and sheet.row.moves:
                row = F.when(here, sheet.row.place(F.col("row"))).otherwise(row)
            if sheet and sheet.col.moves:
                col = F.when(here, sheet.col.place(F.col("col"))).otherwise(col)
        return cells.select(name.alias("sheet"), row.alias("row"), col.alias("col"), "value", "formula", "style").where("sheet IS NOT NULL AND row IS NOT NULL AND col IS NOT NULL")

    def patches(self) -> list[tuple]:
        return [(name, *place, *held) for name, s in self.sheets.items() for place, held in s.patch.items()]
