"""Grouping and the six aggregate functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabweave.errors import EngineError
from tabweave.functions.values import Cell, fmt_number, round12
from tabweave.plans.spec import Measure
from tabweave.plans.table import ROW, Table

GROUP_LIMIT, DISTINCT_LIMIT = 5000, 20_000


def aggregate(cell: Cell, fn: str, approximate: bool = False) -> Column:
    """sum and avg are null without numbers; min and max are of the numbers if there are any, else of days and texts; counts skip blanks."""
    if fn == "count":
        return F.count(F.when(~cell.blank(), 1) if cell.kind == "text" else cell.col)
    if fn == "countDistinct":
        key = cell.joined_key() if cell.kind == "text" else cell.keys()[0]
        return F.approx_count_distinct(key) if approximate else F.count_distinct(key)
    if fn in ("sum", "avg"):
        return round12((F.sum if fn == "sum" else F.avg)(cell.num()).cast("double"))
    best = F.min if fn == "min" else F.max
    if cell.kind != "text":
        return best(cell.day() if cell.kind == "time" else cell.num() if cell.kind == "number" else cell.text())
    n = cell.num()
    return F.coalesce(fmt_number(best(n)), best(F.when(n.isNull(), F.coalesce(cell.day(), cell.text()))))


def skipped(cell: Cell) -> Column:
    """How many cells are neither blank nor numbers."""
    return F.count_if(cell.num().isNull() & ~cell.blank()) if cell.kind == "text" else F.count_if(F.lit(False)) if cell.kind == "number" else F.count(cell.col)


def measure_name(table: Table, m: Measure) -> str:
    return m.name or f"{m.fn}({table.names[table.index(m.col)]})"


def group_columns(table: Table, names: tuple[str, ...]) -> list[tuple[list[Column], Column]]:
    """For each group column its key columns and the label of a group: the cell first seen, or the key itself where the type settles it."""
    out = []
    for name in names:
        cell = table.find(name)
        if cell.kind != "text":
            label = F.first(cell.day() if cell.kind == "time" else cell.col)
        else:
            label = F.min_by(cell.text(), F.col(ROW)) if table.ordered else F.min(cell.text())
        out.append((cell.keys(), label))
    return out


def grouped(table: Table, names: tuple[str, ...], measures: tuple[Measure, ...], extra: dict[str, Column] | None = None, group_limit: int | None = None) -> DataFrame:
    """One row for each group, named as asked; first_row tells their order where the source has one."""
    groups = group_columns(table, names)
    keys = [k.alias(f"k{i}_{j}") for i, (ks, _) in enumerate(groups) for j, k in enumerate(ks)]
    shown = [label.alias(name) for name, (_, label) in zip(names, groups, strict=True)]
    if measures:
        shown += [aggregate(table.find(m.col), m.fn).alias(measure_name(table, m)) for m in measures]
    else:
        shown.append(F.count("*").alias("rows"))
    if table.ordered:
        shown.append(F.min(ROW).alias("first_row"))
    shown += [c.alias(n) for n, c in (extra or {}).items()]
    out = table.df.groupBy(*keys).agg(*shown) if keys else table.df.agg(*shown)
    out = out.select(*(F.col(f"`{c}`") for c in out.columns[len(keys):]))
    if group_limit and out.limit(group_limit + 1).count() > group_limit:
        raise EngineError("TOO_MANY_GROUPS", f"more than {group_limit} groups; filter first, or group by another column")
    return out
