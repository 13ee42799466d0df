"""Pivot tables: row dimensions x one column dimension x measures, with totals from the raw rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabweave.errors import EngineError
from tabweave.operators.aggregate import aggregate, measure_name
from tabweave.plans.spec import Pivot
from tabweave.plans.table import ROW, Table

COLUMN_LIMIT, TOTAL = 60, "合计"


def pivoted(table: Table, pivot: Pivot) -> tuple[DataFrame, list[str]]:
    """(result, measure columns). A first job lists the column values, in the order first seen; then one aggregation
    (over grouping sets, with totals) makes all cells, and one reshapes them. is_total marks the total row."""
    column = table.find(pivot.column)
    key = F.coalesce(column.joined_key() if column.kind == "text" else column.keys()[0].cast("string"), F.lit(""))
    rows = [table.find(r) for r in pivot.rows]
    row_keys = [k for c in rows for k in c.keys()]
    keyed = table.df.select("*", key.alias("pivot_key"), *(k.alias(f"row{i}") for i, k in enumerate(row_keys)))
    first = F.min(ROW) if table.ordered else F.min("pivot_key")
    label = F.min_by(column.shown(), F.col(ROW)) if table.ordered else F.min(column.shown())
    values = keyed.groupBy("pivot_key").agg(first.alias("first"), label.alias("label")).orderBy("first").limit(COLUMN_LIMIT + 1).collect()
    if len(values) > COLUMN_LIMIT:
        raise EngineError("INVALID_ARGS", f"the column dimension {pivot.column!r} has more than {COLUMN_LIMIT} values; filter first")
    measures = [(measure_name(table, m), aggregate(table.find(m.col), m.fn).alias(f"m{i}")) for i, m in enumerate(pivot.values)]
    labels = [c.shown() if c.kind == "text" else c.day() if c.kind == "time" else c.col for c in rows]
    shown = [(F.min_by(x, F.col(ROW)) if table.ordered else F.min(x)).alias(f"label{i}") for i, x in enumerate(labels)]
    order = [F.min(ROW).alias("first_row")] if table.ordered else []
    names = [f"row{i}" for i in range(len(row_keys))]
    if pivot.totals:
        sets = [[*names, "pivot_key"], names, ["pivot_key"], []]
        cells = keyed.groupingSets([[F.col(x) for x in s] for s in sets], *names, "pivot_key").agg(
            F.grouping(names[0]).alias("is_total"), F.grouping("pivot_key").alias("of_row"), *shown, *order, *(m for _, m in measures))
    else:
        cells = keyed.groupBy(*names, "pivot_key").agg(F.lit(0).alias("is_total"), F.lit(0).alias("of_row"), *shown, *order, *(m for _, m in measures))
    single = len(measures) == 1
    out, titles = [], []
    for v in [*values, *([None] if pivot.totals else [])]:
        at = (F.col("of_row") == 1) if v is None else (F.col("of_row") == 0) & (F.col("pivot_key") == v["pivot_key"])
        for i, (name, _) in enumerate(measures):
            title = (TOTAL if v is None else v["label"] or "") if single else f"{TOTAL}·{name}" if v is None else f"{name}·{v['label'] or ''}"
            titles.append(title)
            out.append(F.max(F.when(at, F.col(f"m{i}"))).alias(f"x{len(out)}"))
    heads = [F.min_by(f"label{i}", "first_row") if table.ordered else F.min(f"label{i}") for i in range(len(rows))]
    result = cells.groupBy("is_total", *names).agg(*(h.alias(f"head{i}") for i, h in enumerate(heads)), *out, *([F.min("first_row").alias("first_row")] if table.ordered else []))
    head = [(F.when(F.col("is_total") == 1, F.lit(TOTAL)).otherwise(F.col("head0").cast("string")) if i == 0 and pivot.totals else F.when(F.col("is_total") == 0, F.col(f"head{i}"))).alias(r) for i, r in enumerate(pivot.rows)]
    return result.select(*head, *(F.col(f"x{i}").alias(t) for i, t in enumerate(titles)), (F.col("is_total") == 1).alias("is_total"), *(["first_row"] if table.ordered else [])), titles
