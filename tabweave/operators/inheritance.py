"""Formats that styles inherit, and the format that most of a paragraph has, over rows.

A style's value of a property is its own or that of the nearest style it is based on. The chain is followed by pointer
jumping: each round takes over what is known at the far end of the pointer and doubles the pointer, so that four rounds see
the `DEPTH` styles of a chain; what lies further is not looked at, which also ends cycles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEPTH = 12


def inherited(bases: DataFrame, values: DataFrame, depth: int = DEPTH) -> DataFrame:
    """bases: style, based_on (null or unknown: none; of repeated rows the least counts). values: style, property, value (null: not set). Returns style, property,
    value and distance (0: its own) of the nearest of the first `depth` styles of the chain that sets the property; ties within a style go to the least value."""
    pointers = bases.where("style IS NOT NULL AND based_on IS NOT NULL").groupBy("style").agg(F.min("based_on").alias("to"))
    known = values.where("style IS NOT NULL AND value IS NOT NULL").groupBy("style", "property").agg(F.min(F.struct(F.lit(0).alias("distance"), "value")).alias("best"))
    step = 1
    while step < depth:
        far = known.withColumnRenamed("style", "to").join(pointers, "to")
        moved = F.struct((F.col("best.distance") + step).alias("distance"), F.col("best.value").alias("value"))
        known = known.union(far.select("style", "property", moved.alias("best"))).groupBy("style", "property").agg(F.min("best").alias("best"))
        pointers = pointers.alias("a").join(pointers.alias("b"), F.col("a.to") == F.col("b.style")).select(F.col("a.style").alias("style"), F.col("b.to").alias("to"))
        step *= 2
    return known.where(F.col("best.distance") < depth).select("style", "property", F.col("best.value").alias("value"), F.col("best.distance").alias("distance"))


def dominant(runs: DataFrame, by: tuple[str, ...], format_: str, text: str) -> DataFrame:
    """The format of most characters among the runs of each paragraph, and how many: ties go to the least, empty runs count nothing, a paragraph without text has none."""
    sums = runs.groupBy(*by, format_).agg(F.coalesce(F.sum(F.length(text)), F.lit(0)).alias("chars"))
    best = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("chars"), F.asc_nulls_last(format_)))
    shown = F.when(F.col("chars") > 0, F.col(format_))
    return sums.withColumn("__best", best).where("__best = 1").select(*by, shown.alias(format_), "chars")
