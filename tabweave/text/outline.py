"""Outlines, pages and statistics of texts, as DataFrame operations."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabweave.errors import EngineError

#: Characters after which a page may end; the last one beyond this share of the window is taken.
BREAKS, SHARE, MOST = "\n。！？；!?;", 0.6, 90_000


def words(text: Column) -> Column:
    """Han characters and runs of letters and digits."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[\\u4e00-\\u9fff]|[A-Za-z0-9]+")).cast("long")


def paragraphs(text: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), "\n{2,}"), lambda p: F.trim(p) != "")).cast("long")


def truncated(text: Column, most: int) -> Column:
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit("…"), F.lit(f" [cut at {most}]"))).otherwise(text)


def lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, line_no (from 0), line, offset (characters before the line)."""
    long = docs.select(key, F.posexplode(F.split(F.col(text), "\n")).alias("line_no", "line"))
    before = Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    return long.withColumn("offset", F.coalesce(F.sum(F.length("line") + 1).over(before), F.lit(0)).cast("long"))


def outline(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, level, title, offset of the headings of Markdown texts; lines within fences do not count. No exchange: each text is read in order by itself."""
    split = F.split(F.col(text), "\n")
    step = lambda a, line: F.struct(
        (a["offset"] + F.length(line) + 1).alias("offset"), F.when(line.startswith("```"), ~a["fenced"]).otherwise(a["fenced"]).alias("fenced"),
        F.when(~a["fenced"] & line.rlike(r"^#{1,6} +\S"), F.concat(a["found"], F.array(F.struct(F.length(F.regexp_extract(line, "^(#+)", 1)).alias("level"), F.trim(F.regexp_extract(line, r"^#+ +(.*)\z", 1)).alias("title"), a["offset"].alias("offset"))))).otherwise(a["found"]).alias("found"))
    start = F.struct(F.lit(0).alias("offset"), F.lit(False).alias("fenced"), F.array().cast("array<struct<level:int,title:string,offset:int>>").alias("found"))
    return docs.select(key, F.explode(F.aggregate(split, start, step)["found"]).alias("h")).select(key, "h.level", "h.title", F.col("h.offset").cast("long").alias("offset"))


def page_spans(text: str, most: int) -> list[tuple[int, int]]:
    """Windows of `most` characters, each cut after the last break if that keeps enough of it. Their slices are the text."""
    if most < 1:
        raise EngineError("INVALID_ARGS", "a page holds a character at least")
    out, at = [], 0
    while at < len(text):
        end = min(at + most, len(text))
        if end < len(text):
            last = max(text.rfind(b, at, end) for b in BREAKS) + 1
            end = last if last - at >= SHARE * most else end
        out.append((at, end))
        at = end
    return out


def page_pattern(most: int) -> str:
    """A page as page_spans() cuts it: what is left if it fits, else up to the last break that keeps enough, else `most` characters."""
    least = max(1, math.ceil(SHARE * most))
    breaks = "".join(f"\\x{{{ord(b):x}}}" for b in BREAKS)
    return rf"(?s)\G(?:.{{1,{most}}}\z|.{{{least - 1},{most - 1}}}[{breaks}]|.{{{most}}})"


def paged(docs: DataFrame, key: str, text: str, most: int) -> DataFrame:
    """key, page_no (from 1), start, end, slice. Spark's own expressions: no text goes to Python, and a text is held once."""
    most = min(most, MOST)
    if most < 1:
        raise EngineError("INVALID_ARGS", "a page holds a character at least")
    slices = F.regexp_extract_all(F.col(text), F.lit(page_pattern(most)), F.lit(0))
    ends = F.aggregate(F.col("__s"), F.array(F.lit(0)), lambda a, s: F.concat(a, F.array(F.element_at(a, -1) + F.length(s))))
    long = docs.select(key, slices.alias("__s")).select(key, ends.alias("__e"), F.posexplode("__s").alias("page", "slice"))
    return long.select(key, (F.col("page") + 1).alias("page_no"), F.col("__e")[F.col("page")].alias("start"), F.col("__e")[F.col("page") + 1].alias("end"), "slice")
