"""Ordering by cell semantics (number before day before text, blanks first) and limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabweave.functions.values import Cell
from tabweave.plans.spec import Order
from tabweave.plans.table import resolve


def sort_columns(df: DataFrame, names: list[str], order: tuple[Order, ...], positions: list[str] | None = None) -> list[Column]:
    """Sort expressions on result columns, which are found as columns of a table are."""
    out = []
    for o in order:
        at = resolve(names, o.col)
        name = (positions or names)[at]
        cell = Cell(F.col(f"`{name}`"), df.schema[name].dataType)
        keys = [cell.col] if cell.kind != "text" else [F.when(cell.blank(), 0).when(cell.num().isNotNull(), 1).when(cell.day().isNotNull(), 2).otherwise(3), cell.num(), cell.day(), cell.text()]
        out += [k.desc_nulls_last() if o.desc else k.asc_nulls_first() for k in keys]
    return out
