"""Rectangles that cover sets of cells, by gaps and islands: runs along rows, then equal runs below each other.

No window spans a whole sheet: rows are taken in stretches of `STRETCH`, and what touches across stretches is joined after that."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STRETCH = 4096


def _runs(df: DataFrame, keys: list[str], at: str, first: str, last: str) -> DataFrame:
    """Runs of neighbouring values of `at` among rows of the same keys."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(at))
    return df.withColumn("__island", F.col(at) - place).groupBy(*keys, "__island").agg(F.min(at).alias(first), F.max(at).alias(last)).drop("__island")


def _touching(df: DataFrame, keys: list[str], first: str, last: str) -> DataFrame:
    """Runs that begin where another ends, made one."""
    w = Window.partitionBy(*keys).orderBy(first)
    fresh: Column = F.coalesce((F.lag(last).over(w) + 1 != F.col(first)).cast("int"), F.lit(0))
    return df.withColumn("__fresh", fresh).withColumn("__island", F.sum("__fresh").over(w)).groupBy(*keys, "__island").agg(F.min(first).alias(first), F.max(last).alias(last)).drop("__island")


def rectangles(cells: DataFrame, by: tuple[str, ...] = ("sheet",), stretch: int = STRETCH) -> DataFrame:
    """cells: the columns of by, row and col (from 1). Returns them with first_row, first_col, last_row, last_col. Repeated cells count once, null ones not."""
    keys = list(by)
    places = cells.where("row IS NOT NULL AND col IS NOT NULL").select(*keys, "row", "col").distinct()
    runs = _runs(places, [*keys, "row"], "col", "first_col", "last_col")
    same = [*keys, "first_col", "last_col"]
    blocks = _runs(runs.withColumn("__stretch", F.floor(F.col("row") / stretch)), [*same, "__stretch"], "row", "first_row", "last_row").drop("__stretch")
    return _touching(blocks, same, "first_row", "last_row").select(*keys, "first_row", "first_col", "last_row", "last_col")
