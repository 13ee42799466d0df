"""Compilation of a query specification: join, filter, then group, pivot or profile, then order and limit."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tabweave.errors import EngineError
from tabweave.operators import aggregate, joins, order, pivot, predicates, profile
from tabweave.plans.spec import Join, Query
from tabweave.plans.table import ROW, Table


@dataclass
class Result:
    df: DataFrame
    kind: str
    columns: list[str]
    source: Table
    matched: Table
    query: Query
    notes: list[str] = field(default_factory=list)
    full: DataFrame | None = None  # before the limit


Loader = Callable[[Join], Table] | Mapping[str, Table]


def _right(load: Loader | None, join: Join, main: Table) -> Table:
    if join.path is None:
        return main
    found = load.get(join.path) if isinstance(load, Mapping) else load(join) if load else None
    if found is None:
        raise EngineError("NOT_FOUND", f"no table {join.path!r} to join")
    return found


def filtered(table: Table, query: Query) -> Table:
    return table.where(predicates.all_of([predicates.condition(table.find(w.col), w.op, w.value) for w in query.where]))


def compiled(table: Table, spec: dict | Query, load: Loader | None = None, checked: bool = False) -> Result:
    """The plan of a query. checked: run the bounded jobs that enforce limits on groups and joined rows."""
    query = spec if isinstance(spec, Query) else Query.from_json(spec)
    whole = table
    for join in query.joins:
        whole = joins.joined(whole, _right(load, join, table), join, joins.ROWS_LIMIT if checked else None)
    rows = filtered(whole, query)
    if query.mode == "profile":
        df = profile.profiled(rows)
        return Result(df.orderBy("position").drop("position"), "profile", df.columns[1:], whole, rows, query)
    if query.mode == "pivot":
        df, _ = pivot.pivoted(rows, query.pivot)
        names = [c for c in df.columns if c not in ("is_total", "first_row")]
        by = order.sort_columns(df, names, query.order_by)
        full = df.orderBy("is_total", *by, *(["first_row"] if "first_row" in df.columns else []))
        return _limited(full, "pivot", names, whole, rows, query)
    df = aggregate.grouped(rows, query.group_by, query.measures, group_limit=aggregate.GROUP_LIMIT if checked else None)
    names = [c for c in df.columns if c != "first_row"]
    by = order.sort_columns(df, names, query.order_by) + ([F.col("first_row").asc()] if "first_row" in df.columns else [])
    return _limited(df.orderBy(*by) if by else df, "aggregate", names, whole, rows, query)


@dataclass
class Measured:
    """A grouping to be run once: the rows to show and one more, and what the same run tells besides."""
    df: DataFrame
    scanned: Observation
    matched: Observation
    groups: Observation


def measured(result: Result) -> Measured:
    """The plan of a grouping with its facts observed on the way, so that the one job that gives its rows counts those scanned and matched, the
    cells that sums leave out, and the groups. Result.source is read once; only columns that the query names are."""
    query, whole = result.query, result.source
    used = sorted({whole.index(n) for n in (*(w.col for w in query.where), *query.group_by, *(m.col for m in query.measures))})
    scanned, matched, groups = (Observation() for _ in range(3))
    narrow = replace(whole, df=whole.df.select(*(f"c{i}" for i in used), *([ROW] if whole.ordered else [])).observe(scanned, F.count(F.lit(1)).alias("n")))
    kept = filtered(narrow, query)
    left_out = [aggregate.skipped(kept.find(m.col)).alias(f"s{i}") for i, m in enumerate(m for m in query.measures if m.fn in ("sum", "avg"))]
    kept = replace(kept, df=kept.df.observe(matched, F.count(F.lit(1)).alias("n"), *left_out))
    full = aggregate.grouped(kept, query.group_by, query.measures).observe(groups, F.count(F.lit(1)).alias("n"))
    names = [c for c in full.columns if c != "first_row"]
    by = order.sort_columns(full, names, query.order_by) + ([F.col("first_row").asc()] if "first_row" in full.columns else [])
    rows = full.orderBy(*(by or [F.col(f"`{n}`") for n in names])).limit(query.limit + 1)  # in some order, so that all groups are made
    return Measured(rows.select(*(F.col(f"`{c}`") for c in names)), scanned, matched, groups)


def _limited(full: DataFrame, kind: str, names: list[str], whole: Table, rows: Table, query: Query) -> Result:
    pick = lambda df: df.select(*(F.col(f"`{c}`") for c in names))
    return Result(pick(full.limit(query.limit)), kind, names, whole, rows, query, full=pick(full))
