"""Distinct counts that can be kept and united, for those who opt in: a HyperLogLog sketch of normalised keys for each part of the data.

The sketches of parts (days, files) are stored as rows; the count of any union of parts comes from them without the data, and a
new part is one more row. Exact counts stay the default (aggregate.py)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabweave.functions.values import Cell

#: 2 to this power registers; the relative standard error is about 1.04 / sqrt(registers).
PRECISION = 12


def sketched(df: DataFrame, by: list[str], cell: Cell, precision: int = PRECISION) -> DataFrame:
    """A sketch for each part: by and sketch. Cells that mean the same value count once, blanks not."""
    key = cell.joined_key() if cell.kind == "text" else cell.keys()[0].cast("string")
    return df.groupBy(*by).agg(F.hll_sketch_agg(key, precision).alias("sketch"))


def united(sketches: DataFrame, by: list[str]) -> DataFrame:
    """Sketches of larger parts, from those of smaller ones."""
    return sketches.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))


def counted(sketches: DataFrame, name: str = "distinct") -> DataFrame:
    return sketches.withColumn(name, F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0))).drop("sketch")
