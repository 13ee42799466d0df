"""Query specifications: plain JSON in, checked dataclasses out."""

from __future__ import annotations

from dataclasses import dataclass, field

from tabweave.errors import EngineError
from tabweave.functions import model

FUNCTIONS = ("sum", "avg", "min", "max", "count", "countDistinct")
JOINS = ("inner", "left", "right", "full")
DEFAULT_ROWS, MOST_ROWS = 200, 2000
_MISSING = object()


def _bad(message: str) -> EngineError:
    return EngineError("INVALID_ARGS", message)


@dataclass(frozen=True)
class Where:
    col: str
    op: str = "eq"
    value: object = None


@dataclass(frozen=True)
class Measure:
    col: str
    fn: str
    name: str | None = None


@dataclass(frozen=True)
class Order:
    col: str
    desc: bool = False


@dataclass(frozen=True)
class Join:
    keys: tuple[tuple[str, str], ...]
    type: str = "inner"
    path: str | None = None
    sheet: object = None
    header_row: int = 1
    suffix: str = "_2"
    label: str = ""


@dataclass(frozen=True)
class Pivot:
    rows: tuple[str, ...]
    column: str
    values: tuple[Measure, ...]
    totals: bool = False


@dataclass(frozen=True)
class Query:
    where: tuple[Where, ...] = ()
    joins: tuple[Join, ...] = ()
    group_by: tuple[str, ...] = ()
    measures: tuple[Measure, ...] = ()
    pivot: Pivot | None = None
    order_by: tuple[Order, ...] = ()
    limit: int = DEFAULT_ROWS
    sheet: object = None
    header_row: int = 1
    options: dict = field(default_factory=dict)

    @property
    def mode(self) -> str:
        return "pivot" if self.pivot else "aggregate" if self.group_by or self.measures else "profile"

    @classmethod
    def from_json(cls, spec: dict) -> Query:
        if not isinstance(spec, dict):
            raise _bad("a query is an object")
        out = cls(
            where=tuple(map(_where, _list(spec, "where"))), joins=joins(spec.get("join")), group_by=tuple(map(model.text, _list(spec, "groupBy"))),
            measures=measures(spec.get("aggregate"), bool(spec.get("groupBy"))), pivot=_pivot(spec["pivot"]) if spec.get("pivot") is not None else None,
            order_by=tuple(Order(model.text(o.get("col")), model.text(o.get("dir")).lower() == "desc") for o in _list(spec, "orderBy")),
            limit=_limit(spec.get("limit")), sheet=spec.get("sheet"), header_row=_header(spec.get("headerRow")))
        if out.mode == "profile" and (spec.get("orderBy") or spec.get("limit") is not None):
            raise _bad("a profile has neither orderBy nor limit; they need groupBy, aggregate or pivot")
        return out


def _list(spec: dict, name: str) -> list:
    value = spec.get(name)
    if value is None:
        return []
    if not isinstance(value, list | tuple):
        raise _bad(f"{name} is an array")
    return list(value)


def _where(item: dict) -> Where:
    op = model.text(item.get("op")) or "eq"
    if op not in model.OPERATORS:
        raise _bad(f"unknown filter operator {op!r}; there are {', '.join(model.OPERATORS)}")
    value = item.get("value", _MISSING)
    if value is _MISSING and op not in ("isBlank", "notBlank"):
        raise _bad(f"{op} needs a value")
    return Where(model.text(item.get("col")), op, None if value is _MISSING else value)


def measures(value: object, grouped: bool = False) -> tuple[Measure, ...]:
    if value is None or value == [] and not grouped:
        return ()
    if not isinstance(value, list | tuple) or not value:
        raise _bad("aggregate is a non-empty array")
    for item in value:
        if model.text(item.get("fn")) not in FUNCTIONS:
            raise _bad(f"unknown aggregate function {item.get('fn')!r}; there are {', '.join(FUNCTIONS)}")
    return tuple(Measure(model.text(x.get("col")), x["fn"], model.text(x.get("as")).strip() or None) for x in value)


def _keys(on: object) -> tuple[tuple[str, str], ...]:
    items = on if isinstance(on, list | tuple) else [on]
    if on is None or on == "" or not items:
        raise _bad("join needs `on`, the columns to match")
    out = []
    for item in items:
        if isinstance(item, str):
            out.append((item, item))
            continue
        left = model.text((item or {}).get("left", (item or {}).get("col"))).strip()
        right = model.text(item.get("right", item.get("col2", left))).strip() if item else ""
        if not left or not right:
            raise _bad("join's `on` holds column names or {left, right}")
        out.append((left, right))
    return tuple(out)


def joins(value: object) -> tuple[Join, ...]:
    out = []
    for item in ([] if value is None else value if isinstance(value, list | tuple) else [value]):
        if not isinstance(item, dict):
            raise _bad("join is an object or an array of them")
        kind = model.text(item.get("type")).strip() or "inner"
        if kind not in JOINS:
            raise _bad(f"join type {kind!r}; there are {', '.join(JOINS)}")
        out.append(Join(_keys(item.get("on")), kind, item.get("path"), item.get("sheet"), _header(item.get("headerRow")), "_2" if item.get("suffix") is None else str(item["suffix"]), str(item.get("as") or "")))
    return tuple(out)


def _pivot(value: object) -> Pivot:
    if not isinstance(value, dict):
        raise _bad("pivot is an object")
    rows = value.get("rows", value.get("row"))
    rows = [r for r in (rows if isinstance(rows, list | tuple) else [rows]) if r not in (None, "")]
    column = model.text(value.get("columns", value.get("column"))).strip()
    if not rows or not column:
        raise _bad("pivot needs rows and columns")
    return Pivot(tuple(map(model.text, rows)), column, measures(value.get("values", value.get("aggregate")), True), value.get("totals") is True)


def _whole(value: object, name: str, least: int) -> int:
    try:
        n = float(value)
    except (TypeError, ValueError):
        n = 0.5
    if not n.is_integer() or n < least:
        raise _bad(f"{name} is a whole number from {least}")
    return int(n)


def _limit(value: object) -> int:
    return DEFAULT_ROWS if value in (None, "") else min(_whole(value, "limit", 1), MOST_ROWS)


def _header(value: object) -> int:
    return 1 if value in (None, "") else _whole(value, "headerRow", 0)
