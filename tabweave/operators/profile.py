"""Column profiles: type, counts, extremes, sums and the most frequent values, one row for each column."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabweave.functions.values import fmt_number
from tabweave.operators.aggregate import aggregate
from tabweave.plans.table import ROW, Table

# Type labels, shown to users.
EMPTY, NUMBER, DATE, TEXT, MIXED = "空", "数字", "日期", "文本", "混合"
TOP = 3


def profiled(table: Table, top: int = TOP) -> DataFrame:
    """A row for each column: narrow aggregates in one pass, and distinct and frequent values from one count of all cells."""
    out, parts = [], []
    for i, name in enumerate(table.names):
        c = table.cell(i)
        filled = ~c.blank() if c.kind == "text" else c.col.isNotNull()
        n_num = F.count(c.num()) if c.kind in ("number", "text") else F.lit(0)
        n_day = F.count(c.day()) if c.kind in ("time", "text") else F.lit(0)
        least, most = (fmt_number(F.min(c.num())), fmt_number(F.max(c.num()))) if c.kind == "number" else (aggregate(c, "min").cast("string"), aggregate(c, "max").cast("string"))
        facts = {"n": F.count_if(filled), "blank": F.count_if(~filled), "num": n_num, "day": n_day, "min": least, "max": most, "sum": aggregate(c, "sum"), "avg": aggregate(c, "avg")}
        parts += [v.alias(f"{k}{i}") for k, v in facts.items()]
        label = F.when(F.col(f"n{i}") == 0, EMPTY).when(F.col(f"num{i}") == F.col(f"n{i}"), NUMBER).when(F.col(f"day{i}") == F.col(f"n{i}"), DATE).when(F.col(f"num{i}") + F.col(f"day{i}") == 0, TEXT).otherwise(MIXED)
        out.append(F.struct(F.lit(i).alias("position"), F.lit(name).alias("column"), label.alias("type"), F.col(f"n{i}").cast("long").alias("non_null"), F.col(f"blank{i}").cast("long").alias("nulls"),
                            F.col(f"min{i}").alias("min"), F.col(f"max{i}").alias("max"), F.col(f"sum{i}").alias("sum"), F.col(f"avg{i}").alias("avg")))
    wide = table.df.agg(*parts).select(F.inline(F.array(*out)))
    counts = counted(table)
    best = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "shown", "n"))), lambda x: F.concat(x["shown"], F.lit("("), x["n"].cast("string"), F.lit(")"))), " ")
    tops = ranked(counts, top).groupBy("position").agg(best.alias("top"))
    distinct = counts.groupBy("position").agg(F.count("*").alias("distinct"))
    whole = wide.join(distinct, "position", "left").join(tops, "position", "left")
    return whole.select("position", "column", "type", "non_null", "nulls", F.coalesce("distinct", F.lit(0)).cast("long").alias("distinct"), "min", "max", "sum", "avg", "top")


def counted(table: Table) -> DataFrame:
    """position, key, n, first, shown: each value of each column, blanks left out."""
    cells = [F.struct(F.lit(i).alias("position"), (c.joined_key() if c.kind == "text" else c.keys()[0].cast("string")).alias("key"), c.shown().alias("shown")) for i, c in ((i, table.cell(i)) for i in range(len(table.names)))]
    long = table.df.select(*([ROW] if table.ordered else []), F.explode(F.array(*cells)).alias("x")).select("x.*", *([ROW] if table.ordered else [])).where("key IS NOT NULL")
    first = F.min(ROW) if table.ordered else F.min("shown")
    return long.groupBy("position", "key").agg(F.count("*").alias("n"), first.alias("first"), (F.min_by("shown", ROW) if table.ordered else F.min("shown")).alias("shown"))


def ranked(counts: DataFrame, top: int = TOP) -> DataFrame:
    """The most frequent values of each column; the ranks are limited before the exchange."""
    place = F.row_number().over(Window.partitionBy("position").orderBy(F.desc("n"), "first"))
    return counts.withColumn("rank", place).where(F.col("rank") <= top).select("position", "rank", "shown", "n")


def frequent(table: Table, top: int = TOP) -> DataFrame:
    """position, rank, shown, n: the most frequent values of each column, ties by first appearance (by value where rows have no order)."""
    return ranked(counted(table), top)
