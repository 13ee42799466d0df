"""Numbers of list paragraphs as a segmented scan: a level counts on, deeper levels begin again.

A list is dealt out in stretches of places. Within one, a level's counter is how many of its paragraphs came so far, less how many had come
when a higher level came last; what a stretch hands on is, for each level, how many came since then and whether a higher
level came at all. These are combined over the few stretches of a list, and each stretch adds what it was handed to the counters that no
higher level has reset. So a list that holds most paragraphs is not one task's work."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LEVELS, STRETCH = 9, 10_000


def numbered(paragraphs: DataFrame, by: tuple[str, ...] = ("list",), place: str = "place", level: str = "level", levels: int = LEVELS, starts: tuple[int, ...] = (), stretch: int = STRETCH) -> DataFrame:
    """paragraphs: the columns of by (a document, a list), a place (whole numbers, in order, each once in a list) and a level from 0.
    Returns them with number ("2.1.3": a higher level that has not come yet counts as its start). Levels that are null or out of
    range get null and count nothing. starts: the first number of each level, 1 if not given."""
    keys, n, at, deep = list(by), range(levels), F.col(place), F.col(level)
    w = Window.partitionBy(*keys, "__stretch").orderBy(place).rowsBetween(Window.unboundedPreceding, 0)
    rows = paragraphs.withColumn("__stretch", F.floor(at / stretch))
    came = rows.select("*", *(F.sum((F.coalesce(deep == k, F.lit(False))).cast("long")).over(w).alias(f"__came{k}") for k in n))
    scanned = came.select("*", *(F.max(F.when((deep >= 0) & (deep < k), F.col(f"__came{k}"))).over(w).alias(f"__reset{k}") for k in n))

    ends = scanned.groupBy(*keys, "__stretch").agg(*(F.max(f"__{x}{k}").alias(f"__{x}{k}") for x in ("came", "reset") for k in n))
    order = Window.partitionBy(*keys).orderBy("__stretch")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    total = ends.select("*", *(F.sum(f"__came{k}").over(upto).alias(f"__total{k}") for k in n))
    base = total.select(*keys, "__stretch", *(f"__total{k}" for k in n), *(F.max(F.when(F.col(f"__reset{k}").isNotNull(), F.col(f"__total{k}") - F.col(f"__came{k}") + F.col(f"__reset{k}"))).over(upto).alias(f"__base{k}") for k in n))
    handed = base.select(*(F.col(k).alias(f"__of_{k}") for k in keys), F.col("__stretch").alias("__of"), *(F.lag(F.col(f"__total{k}") - F.coalesce(f"__base{k}", F.lit(0)), 1, 0).over(order).alias(f"__handed{k}") for k in n))

    same = F.col("__stretch") == F.col("__of")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"__of_{k}"))
    joined = scanned.join(handed, same)
    counts = [F.col(f"__came{k}") - F.coalesce(F.col(f"__reset{k}"), -F.col(f"__handed{k}")) for k in n]
    shown = F.array(*((F.greatest(c, F.lit(1)) + F.lit((starts[k] if k < len(starts) else 1) - 1)).cast("string") for k, c in enumerate(counts)))
    number = F.when((deep >= 0) & (deep < levels), F.array_join(F.slice(shown, F.lit(1), deep.cast("int") + 1), "."))
    return joined.select(*(F.col(f"`{c}`") for c in paragraphs.columns), number.alias("number"))
