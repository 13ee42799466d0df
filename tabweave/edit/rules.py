"""Conditional formats and data validation as Columns over data."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabweave.errors import EngineError
from tabweave.functions.values import Cell

# Stops of icon sets by their number of icons.
ICON_STOPS = {3: (0, 33, 67), 4: (0, 25, 50, 75), 5: (0, 20, 40, 60, 80)}
#: Rows that a rank may sort, and ranges that values are counted by.
SORTED, RANGES = 10_000, 1024
COMPARISONS = {
    "greaterThan": lambda c, a, b: c > a, "greaterThanOrEqual": lambda c, a, b: c >= a, "lessThan": lambda c, a, b: c < a, "lessThanOrEqual": lambda c, a, b: c <= a,
    "equal": lambda c, a, b: c == a, "notEqual": lambda c, a, b: c != a, "between": lambda c, a, b: (c >= a) & (c <= b), "notBetween": lambda c, a, b: (c < a) | (c > b),
}


def compare(c: Column, operator: str, a: object, b: object = None) -> Column:
    if operator not in COMPARISONS:
        raise EngineError("INVALID_ARGS", f"unknown comparison {operator!r}; there are {', '.join(COMPARISONS)}")
    if operator in ("between", "notBetween") and b is None:
        raise EngineError("INVALID_ARGS", f"{operator} needs two values")
    return COMPARISONS[operator](c, F.lit(a), F.lit(b))


def cell_is(cell: Cell, a: object, b: object = None, operator: str = "greaterThan") -> Column:
    return F.coalesce(compare(cell.num(), operator, a, b), F.lit(False))


@dataclass(frozen=True)
class Facts:
    """Least and greatest number, mean and count of a column."""

    low: float | None
    high: float | None
    mean: float | None
    n: int


def facts(df: DataFrame, cell: Cell) -> Facts:
    """One aggregate over the data; its row becomes literals in the rules, so no window spans all rows."""
    return Facts(*df.agg(F.min(cell.num()).cast("double"), F.max(cell.num()).cast("double"), F.avg(cell.num()).cast("double"), F.count(cell.num())).first())


def scaled(cell: Cell, of: Facts) -> Column:
    """Position between the least and the greatest value; for data bars and colour scales."""
    if of.low is None or of.high is None:
        return F.lit(None).cast("double")
    return F.when(cell.num().isNotNull(), (cell.num() - F.lit(of.low)) / F.lit(of.high - of.low) if of.high > of.low else F.lit(0.0))


def percentile(df: DataFrame, cell: Cell, percent: float = 50) -> float | None:
    """The number below which so many of 100 lie, between the two nearest ones in proportion; null without numbers."""
    n = df.agg(F.count(cell.num())).first()[0]
    if not n:
        return None
    at = (n - 1) * percent / 100
    low = nth(df, cell, int(at) + 1, bottom=True)
    return low if at == int(at) else low + (nth(df, cell, int(at) + 2, bottom=True) - low) * (at - int(at))


def scaled_by(cell: Cell, of: Facts, middle: float | None) -> Column:
    """Position on a scale of three colours: 0 at the least number, 0.5 at the middle stop, 1 at the greatest."""
    if of.low is None or middle is None:
        return F.lit(None).cast("double")
    part = lambda a, b: (cell.num() - F.lit(a)) / F.lit(2 * (b - a)) if b > a else F.lit(0.0)
    return F.when(cell.num() <= F.lit(middle), part(of.low, middle)).when(cell.num().isNotNull(), F.lit(0.5) + part(middle, of.high))


def icon(cell: Cell, of: Facts, icons: int = 3) -> Column:
    """The number of the icon, from 0."""
    percent = scaled(cell, of) * 100
    return F.when(percent.isNotNull(), sum(((percent >= s).cast("int") for s in ICON_STOPS[icons][1:]), F.lit(0)))


def nth(df: DataFrame, cell: Cell, rank: int = 10, percent: bool = False, bottom: bool = False, most: int = SORTED) -> float | None:
    """The number at a rank (or percentage of all numbers) from the top or bottom; null without numbers.

    Ranks up to `most` take a sort of so many rows; for others counts of value ranges narrow the numbers down first."""
    values = df.select((cell.num() if bottom else -cell.num()).cast("double").alias("v")).where("v IS NOT NULL")
    low, high, n = values.agg(F.min("v"), F.max("v"), F.count("*")).first()
    left = min(n, -(-n * rank // 100) if percent else rank)
    if left < 1:
        return None
    while left > most and low < high:
        at = F.least(F.floor((F.col("v") - F.lit(low)) / F.lit((high - low) / RANGES)), F.lit(RANGES - 1))
        counts = values.groupBy(at.alias("at")).agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).orderBy("at").collect()  # RANGES rows at most
        for r in counts:
            if left <= r["n"]:
                break
            left -= r["n"]
        low, high, values = r["low"], r["high"], values.where(F.col("v").between(r["low"], r["high"]))
    found = values.orderBy("v").limit(left).agg(F.max("v")).first()[0] if low < high else low
    return found if bottom else -found


def top(cell: Cell, cut: float | None, bottom: bool = False) -> Column:
    """Numbers up to the one at the rank, which nth() gives; with ties."""
    if cut is None:
        return F.lit(False)
    return F.coalesce(cell.num() <= F.lit(cut) if bottom else cell.num() >= F.lit(cut), F.lit(False))


def above_average(cell: Cell, of: Facts, above: bool = True) -> Column:
    if of.mean is None:
        return F.lit(False)
    return F.coalesce(cell.num() > F.lit(of.mean) if above else cell.num() < F.lit(of.mean), F.lit(False))


def contains_text(cell: Cell, text: str, operator: str = "containsText") -> Column:
    have, want = F.lower(F.coalesce(cell.text(), F.lit(""))), text.lower()
    return {"containsText": have.contains(want), "notContainsText": ~have.contains(want), "beginsWith": have.startswith(want), "endsWith": have.endswith(want), "containsBlanks": cell.blank(), "notContainsBlanks": ~cell.blank(),
            "containsErrors": have.startswith("#"), "notContainsErrors": ~have.startswith("#")}[operator]


def period(name: str, today: date) -> tuple[date, date]:
    """First day and the day after the last of a period."""
    week, month = today - timedelta(days=(today.weekday() + 1) % 7), today.replace(day=1)
    next_month, last_month = (month + timedelta(days=32)).replace(day=1), (month - timedelta(days=1)).replace(day=1)
    day, seven = timedelta(days=1), timedelta(days=7)
    periods = {"today": (today, today + day), "yesterday": (today - day, today), "tomorrow": (today + day, today + 2 * day), "last7Days": (today - 6 * day, today + day), "thisWeek": (week, week + seven), "lastWeek": (week - seven, week), "nextWeek": (week + seven, week + 2 * seven),
               "thisMonth": (month, next_month), "lastMonth": (last_month, month), "nextMonth": (next_month, (next_month + timedelta(days=32)).replace(day=1))}
    if name not in periods:
        raise EngineError("INVALID_ARGS", f"unknown period {name!r}")
    return periods[name]


def time_period(cell: Cell, name: str = "today", today: date | None = None) -> Column:
    first, after = period(name, today or date.today())
    if cell.kind == "time":
        return F.coalesce((cell.col >= F.lit(first)) & (cell.col < F.lit(after)), F.lit(False))
    return F.coalesce((cell.day() >= first.isoformat()) & (cell.day() < after.isoformat()), F.lit(False))


def valid(cell: Cell, kind: str, operator: str = "between", a: object = None, b: object = None, values: list | None = None, allow_blank: bool = True) -> Column:
    """Whether a cell meets a validation rule: list, whole, decimal, date or textLength."""
    n = cell.num()
    if kind == "list":
        from tabweave.operators.predicates import condition
        ok = F.coalesce(condition(cell, "in", values or []), F.lit(False))
    elif kind == "whole":
        ok = (n == F.floor(n)) & compare(n, operator, a, b)
    elif kind == "decimal":
        ok = compare(n, operator, a, b)
    elif kind == "date":
        ok = compare(cell.day(), operator, a, b)
    elif kind == "textLength":
        ok = compare(F.length(F.coalesce(cell.text(), F.lit(""))), operator, a, b)
    else:
        raise EngineError("INVALID_ARGS", f"unknown validation {kind!r}; formulas are stored, not evaluated")
    return F.when(cell.blank(), F.lit(allow_blank)).otherwise(F.coalesce(ok, F.lit(False)))


def valid_in(df: DataFrame, cell: Cell, source: DataFrame, among: Cell, name: str = "hit", allow_blank: bool = True) -> DataFrame:
    """df with the column `name`: whether a cell is one of those of a source range, compared as the values they mean. Blank cells are valid if
    allowed; blank cells of the range match nothing. The range is joined as a set of keys, so it may be of any length."""
    keys = source.select(among.joined_key().alias("__key")).where("__key IS NOT NULL").distinct()
    marked = df.withColumn("__own", cell.joined_key())
    found = marked.where("__own IS NOT NULL").join(keys.withColumn("__there", F.lit(True)), F.col("__own") == F.col("__key"), "left").withColumn(name, F.col("__there").isNotNull()).drop("__own", "__key", "__there")
    return found.unionByName(marked.where("__own IS NULL").withColumn(name, F.lit(allow_blank)).drop("__own"))
