"""Cell semantics as Column expressions: number, then day, then text.

What a column's Spark type already settles is settled at plan time: a numeric column is compared as
numbers and a timestamp as a range on the raw column, so filters reach the scan."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabweave.functions import model



def number_of_text(c: Column) -> Column:
    """Plain numbers take the short way; others are checked without what is ignored, and read without their commas and percent sign too.

    The expression refers to c six times, as c may be costly itself."""
    ignored = model.IGNORED
    fits = F.regexp_replace(c, ignored, "").rlike(rf"^(?:{model.PLAIN}|{model.GROUPED})%?\z")
    value = F.regexp_replace(c, f"{ignored[:-1]},%]", "").try_cast("double")
    return F.when(c.rlike(rf"^{model.PLAIN}\z"), c.try_cast("double")).when(c.rlike("[0-9]") & fits, value * F.when(c.contains("%"), F.lit(0.01)).otherwise(F.lit(1.0)))


def day_of_text(c: Column) -> Column:
    pattern = rf"^{model.DAY}\z".replace(".*", "[^\\n\\r\\u2028\\u2029]*")
    part = lambda k, n: F.lpad(F.regexp_extract(c, pattern, k), n, "0")
    return F.when(c.rlike(pattern), F.concat_ws("-", part(1, 4), part(2, 2), part(3, 2)))


def round12(c: Column) -> Column:
    """Twelve significant digits."""
    return F.when(c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")), c).otherwise(F.format_string("%.11e", c).cast("double"))


def fmt_number(c: Column) -> Column:
    """A number as shown: no trailing zeros, exponents only beyond 1e21 and below 1e-6.

    Whole numbers of up to twelve digits need no rounding, and numbers far from the limits are rounded once; the rest is looked at rounded."""
    c = c.cast("double")
    n, size, digits = round12(c), F.abs(c), F.format_string("%.11e", c)
    plain = F.regexp_replace(digits.try_cast("decimal(38,18)").cast("string"), r"\.?0+$", "")
    odd = F.regexp_replace(F.regexp_replace(F.regexp_replace(n.cast("string"), r"\.0E", "E"), r"E(\d)", "e+$1"), "E-", "e-")
    rare = F.when((F.abs(n) >= 1e21) | (F.abs(n) < 1e-6), odd).when(F.abs(n) >= 1e15, digits.try_cast("decimal(38,0)").cast("string")).otherwise(plain)
    return F.when((size < 1e12) & (c == F.rint(c)), c.cast("bigint").cast("string")).when((size > 1e-5) & (size < 1e14), plain).otherwise(rare)


def kind_of(dtype: T.DataType) -> str:
    if isinstance(dtype, T.BooleanType):
        return "bool"
    if isinstance(dtype, T.NumericType):
        return "number"
    if isinstance(dtype, T.DateType | T.TimestampType | T.TimestampNTZType):
        return "time"
    return "null" if isinstance(dtype, T.NullType) else "text"


def literal_kind(value: object) -> tuple[str, object]:
    """(number | day | text, normalised value) of a literal in a specification."""
    if (n := model.num(value)) is not None:
        return "number", n
    if (d := model.day(value)) is not None:
        return "day", d
    return "text", model.text(value)


@dataclass(frozen=True)
class Cell:
    """A column and its Spark type."""

    col: Column
    dtype: T.DataType

    @property
    def kind(self) -> str:
        return kind_of(self.dtype)

    def num(self) -> Column:
        if self.kind == "number":
            c = self.col.cast("double")
            return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c) if isinstance(self.dtype, T.FloatType | T.DoubleType) else c
        return number_of_text(self.col) if self.kind == "text" else F.lit(None).cast("double")

    def day(self) -> Column:
        if self.kind == "time":
            return F.date_format(self.col, "yyyy-MM-dd")
        return day_of_text(self.col) if self.kind == "text" else F.lit(None).cast("string")

    def text(self) -> Column:
        """For text comparison and search; null where blank."""
        if self.kind == "text":
            return F.when(self.col != "", self.col)
        return {"number": lambda: fmt_number(self.num()), "time": self.day, "bool": lambda: self.col.cast("string"), "null": lambda: F.lit(None).cast("string")}[self.kind]()

    def shown(self) -> Column:
        if self.kind == "bool":
            return F.upper(self.col.cast("string"))
        return self.text()

    def blank(self) -> Column:
        return self.col.isNull() | (self.col == "") if self.kind == "text" else self.col.isNull()

    def keys(self) -> list[Column]:
        """Columns that are equal for equal cells, all null for blank ones: one if the type settles the kind."""
        if self.kind == "number":
            return [self.col + F.lit(0.0)] if isinstance(self.dtype, T.FloatType | T.DoubleType) else [self.col]
        if self.kind == "time":
            return [F.to_date(self.col)]
        if self.kind in ("bool", "null"):
            return [self.col]
        n, d = self.num() + F.lit(0.0), self.day()
        return [n, F.when(n.isNull(), F.coalesce(d, self.text()))]

    def joined_key(self) -> Column:
        """One text key, null for blank cells."""
        if self.kind == "text":
            n = self.num() + F.lit(0.0)
            return F.when(n.isNotNull(), F.concat(F.lit("n:"), n.cast("string"))).otherwise(F.coalesce(F.concat(F.lit("d:"), self.day()), F.concat(F.lit("s:"), self.text())))
        tag = {"number": "n:", "time": "d:"}.get(self.kind, "s:")
        value = (self.num() + F.lit(0.0)).cast("string") if self.kind == "number" else self.text()
        return F.concat(F.lit(tag), value)


def day_bounds(literal: str) -> tuple[Column, Column] | None:
    """Start of a day and of the next; None if the calendar has no such day."""
    try:
        start = date.fromisoformat(literal)
        return F.lit(start).cast("timestamp_ntz"), F.lit(start + timedelta(days=1)).cast("timestamp_ntz")
    except (ValueError, OverflowError):
        return None
