"""Connected components by repeated contraction, without collecting links or components anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabweave.llm.common import released, stored


def components(links: DataFrame) -> DataFrame:
    """links: a, b (longs). Returns node, root: one row per linked node, the same root throughout a component.

    Each round maps every node to the neighbour of the lowest rank (itself, if its own is lower) and
    relabels the links; ranks are ids at first, which settles stars in one round, then new hashes each
    round, so that chains shrink by a constant factor. Every round is written to the shared folder."""
    left = stored(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    roots, turn, steps = None, 0, []
    while True:
        rank = (lambda c: F.col(c)) if turn < 2 else (lambda c, t=turn: F.xxhash64(F.lit(t), c))
        both = left.select("a", "b").union(left.select("b", "a"))
        nearest = both.groupBy("a").agg(F.min(F.struct(rank("b").alias("r"), F.col("b").alias("b"))).alias("m"))
        step = stored(nearest.select(F.col("a").alias("node"), F.when(F.col("m.r") < rank("a"), F.col("m.b")).otherwise(F.col("a")).alias("to")), "roots")
        steps.append(step)
        roots = step.select("node", F.col("to").alias("root")) if roots is None else (
            roots.join(step.select(F.col("node").alias("root"), "to"), "root", "left").select("node", F.coalesce("to", "root").alias("root")))
        moved = left.join(step.select(F.col("node").alias("a"), F.col("to").alias("x")), "a").join(step.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
        before, left = left, stored(moved.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
        released(before)
        turn += 1
        if left.isEmpty():
            released(left)
            return roots
        if turn % 4 == 0:
            roots = stored(roots, "roots")
            released(*steps)
            steps = [roots]
