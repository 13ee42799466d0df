"""The thirteen filter operators, compiled by the kind of the literal (and of the column, where its type tells)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabweave.errors import EngineError
from tabweave.functions import model
from tabweave.functions.values import Cell, day_bounds, literal_kind

_COMPARE = {"eq": lambda a, b: a == b, "ne": lambda a, b: a != b, "gt": lambda a, b: a > b, "gte": lambda a, b: a >= b, "lt": lambda a, b: a < b, "lte": lambda a, b: a <= b}


def _never() -> Column:
    return F.lit(False)



def _positive(cell: Cell, op: str, kind: str, value: object) -> Column:
    """A condition that may be null where it does not hold, never a coalesce: so it can reach the scan."""
    compare = _COMPARE[op]
    if kind == "number":
        if cell.kind == "number":
            whole = float(value).is_integer() and abs(value) < 2 ** 53
            return compare(cell.col, F.lit(int(value) if whole else float(value)))
        return compare(cell.num(), F.lit(float(value))) if cell.kind == "text" else _never()
    if kind == "day":
        if cell.kind == "time":
            bounds = day_bounds(value)
            if bounds:
                start, after = (b.cast(cell.dtype) for b in bounds)
                return {"eq": (cell.col >= start) & (cell.col < after), "gt": cell.col >= after, "gte": cell.col >= start, "lt": cell.col < start, "lte": cell.col < after}[op]
        return compare(cell.day(), F.lit(value)) if cell.kind in ("text", "time") else _never()
    if cell.kind == "bool":
        return compare(F.coalesce(F.lower(cell.col.cast("string")), F.lit("")), F.lit(str(value).lower()))
    if cell.kind in ("number", "time"):  # only blanks are text
        return cell.col.isNull() if model.holds("", op, value) else _never()
    if op == "eq":
        return cell.blank() if value == "" else cell.col == F.lit(value)
    text = cell.num().isNull() & cell.day().isNull() & compare(F.coalesce(cell.text(), F.lit("")), F.lit(value))
    return text | cell.blank() if model.holds("", op, value) else text


def _equal(cell: Cell, values: list) -> Column:
    """Whether the cell equals one of the values: one IN list for each kind."""
    kinds: dict[str, list] = {}
    for v in values:
        k, x = literal_kind(v)
        kinds.setdefault(k, []).append(x)
    parts = []
    if (found := kinds.get("number")) and cell.kind in ("number", "text"):
        parts.append((cell.col if cell.kind == "number" else cell.num()).isin(found))
    if found := kinds.get("day"):
        parts += [_positive(cell, "eq", "day", v) for v in found] if cell.kind == "time" else [cell.day().isin(found)] if cell.kind == "text" else []
    if found := kinds.get("text"):
        plain = [v for v in found if v != ""]
        if plain and cell.kind in ("text", "bool"):
            parts.append(cell.col.isin(plain) if cell.kind == "text" else F.lower(cell.col.cast("string")).isin([v.lower() for v in plain]))
        if "" in found:
            parts.append(cell.blank())
    return reduce(lambda a, b: a | b, parts) if parts else _never()


def condition(cell: Cell, op: str = "eq", value: object = None) -> Column:
    op = op or "eq"
    if op not in model.OPERATORS:
        raise EngineError("INVALID_ARGS", f"unknown filter operator {op!r}; there are {', '.join(model.OPERATORS)}")
    if op == "isBlank":
        return cell.blank()
    if op == "notBlank":
        return ~cell.blank() if cell.kind == "text" else cell.col.isNotNull()
    if op in ("in", "notIn"):
        found = _equal(cell, list(value) if isinstance(value, list | tuple) else [value])
        return found if op == "in" else ~F.coalesce(found, _never()) if cell.kind == "text" else cell.col.isNull() & ~_blank_listed(value) | ~found
    if op in ("contains", "startsWith", "endsWith"):
        have, want = F.lower(F.coalesce(cell.text(), F.lit("")) if model.text(value) == "" else cell.text()), model.text(value).lower()
        return {"contains": have.contains, "startsWith": have.startswith, "endsWith": have.endswith}[op](want)
    kind, literal = literal_kind(value)
    if op != "ne":
        return _positive(cell, op, kind, literal)
    if cell.kind == "number" and kind == "number":
        return cell.col.isNull() | (cell.col != literal)
    if cell.kind == "text" and kind == "text" and literal != "":
        return cell.col.isNull() | (cell.col != literal)
    return ~F.coalesce(_positive(cell, "eq", kind, literal), _never())


def _blank_listed(value: object) -> Column:
    items = value if isinstance(value, list | tuple) else [value]
    return F.lit(any(model.text(v) == "" for v in items))


def all_of(conditions: list[Column]) -> Column | None:
    return reduce(lambda a, b: a & b, conditions) if conditions else None
