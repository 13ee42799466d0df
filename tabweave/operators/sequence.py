"""Ordered rows into which others are inserted: fractional keys, then places counted anew.

A row's key is its place; an inserted one takes the place of its anchor, a side and its number among those inserted there. Places are counted
by stretches of old places: each counts its rows, the few counts add up to offsets, and rows are numbered within their stretch. No
window spans all rows of a document."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

STRETCH = 10_000


def resequenced(rows: DataFrame, by: tuple[str, ...], order: tuple[str, ...], place: str = "place", stretch: int = STRETCH) -> DataFrame:
    """rows with their place counted from 0 within by, in the order of place, then order."""
    w = Window.partitionBy(*by, "__stretch").orderBy(place, *order)
    dealt = rows.withColumn("__stretch", F.floor(F.col(place) / stretch))
    offset = F.coalesce(F.sum("__n").over(Window.partitionBy(*by).orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = dealt.groupBy(*by, "__stretch").agg(F.count("*").alias("__n")).withColumn("__offset", offset)
    counts = counts.select(*(F.col(k).alias(f"__of_{k}") for k in by), F.col("__stretch").alias("__of"), "__offset")
    same = F.col("__stretch") == F.col("__of")
    for k in by:
        same &= F.col(k).eqNullSafe(F.col(f"__of_{k}"))
    numbered = dealt.withColumn("__row", F.row_number().over(w)).join(counts, same)
    return numbered.withColumn(place, F.col("__offset") + F.col("__row") - 1).select(*(F.col(f"`{c}`") for c in rows.columns))


def edited(rows: DataFrame, inserts: DataFrame, deletes: DataFrame, by: tuple[str, ...], content: tuple[str, ...], stretch: int = STRETCH) -> DataFrame:
    """rows: by, place (whole numbers) and content. inserts: by, anchor (a place; null: the end), side (before or after), seq and content.
    deletes: by and place. All anchors are old places; one that is deleted still says where. Returns by, the new place and content."""
    last = F.lit((1 << 62))
    gone = deletes.select(*by, "place").distinct()
    kept = rows.join(gone.withColumn("__gone", F.lit(True)), [*by, "place"], "left").where("__gone IS NULL")
    new = inserts.select(*by, F.coalesce(F.col("anchor").cast("long"), last).alias("place"), F.when(F.col("anchor").isNull() | (F.col("side") == "after"), 1).otherwise(-1).alias("__side"), F.col("seq").cast("long").alias("__seq"), *content)
    both = kept.select(*by, F.col("place").cast("long").alias("place"), F.lit(0).alias("__side"), F.lit(0).cast("long").alias("__seq"), *content).unionByName(new)
    return resequenced(both, by, ("__side", "__seq"), stretch=stretch).drop("__side", "__seq")
