"""Distributions, mainstream values and outliers of properties, and the formats of documents as rows."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabweave.text.docx import Document

TOP = 5


def distribution(df: DataFrame, properties: list[str], top: int = TOP) -> DataFrame:
    """property, value, n, rank: the most frequent values of each property, ties by value."""
    long = df.select(F.explode(F.array(*(F.struct(F.lit(p).alias("property"), F.col(p).cast("string").alias("value")) for p in properties))).alias("x")).select("x.*")
    counts = long.groupBy("property", "value").agg(F.count("*").alias("n"))
    return counts.withColumn("rank", F.row_number().over(Window.partitionBy("property").orderBy(F.desc("n"), F.asc_nulls_first("value")))).where(F.col("rank") <= top)


def mainstream(df: DataFrame, properties: list[str]) -> DataFrame:
    """The most frequent combination of the properties, and how many rows have it."""
    return df.groupBy(*properties).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *(F.asc_nulls_first(p) for p in properties)).limit(1)


def outliers(df: DataFrame, properties: list[str]) -> DataFrame:
    """Rows that differ from the mainstream in some property."""
    main = mainstream(df, properties).select(*(F.col(p).alias(f"__{p}") for p in properties))
    same = [F.col(p).eqNullSafe(F.col(f"__{p}")) for p in properties]
    on = same[0]
    for s in same[1:]:
        on = on & s
    return df.join(F.broadcast(main), on, "left_anti")  # one row


def dominant(df: DataFrame, key: str, value: str, text: str) -> DataFrame:
    """For each key the value that holds the most characters, ties by value."""
    sums = df.groupBy(key, value).agg(F.sum(F.length(text)).alias("chars"))
    return sums.groupBy(key).agg(F.min_by(value, F.struct(-F.col("chars"), F.col(value))).alias(value), F.max("chars").alias("chars"))


def document_formats(files: DataFrame) -> DataFrame:
    """files: path, content. One row for each paragraph with its effective format."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for p in Document(content).paragraphs():
                    f = p.format
                    rows.append((path, p.index, p.text, p.style, p.level, p.in_table, p.number, f.font, f.east_asian, f.size, bool(f.bold), bool(f.italic), bool(f.underline), f.align or "left", f.line_rule, f.line, f.first_line, f.left))
            names = ["path", "index", "text", "style", "level", "in_table", "number", "font", "east_asian", "size", "bold", "italic", "underline", "align", "line_rule", "line", "first_line", "left"]
            kinds = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.bool_(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.float64()]
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)

    return files.select("path", "content").mapInArrow(run, "path string, index int, text string, style string, level int, in_table boolean, number string, font string, east_asian string, size double, bold boolean, italic boolean, underline boolean, align string, line_rule string, line double, first_line double, left double")
