"""Islands, segmented counters, blank keys of joins, validation by a range, and results with their facts from one run, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from tabweave.edit import rules
from tabweave.edit.workbook import rectangles as brute_rectangles
from tabweave.errors import EngineError
from tabweave.functions.values import Cell
from tabweave.operators import aggregate, counters, islands
from tabweave.operators.render import rendered
from tabweave.plans.query import compiled, measured
from tabweave.plans.table import Table


def test_rectangles(spark):
    rng = random.Random(3)
    cells = [(s, r, c) for s in ("a", "b", None) for r in range(1, 60) for c in range(1, 8) if rng.random() < 0.7]
    cells += [("tall", r, c) for r in range(5, 400) for c in (2, 3)] + cells[:50]
    df = spark.createDataFrame([*cells, ("a", None, 1), ("a", 1, None)], "sheet string, row long, col long").repartition(3)
    for stretch in (4096, 7):
        got = islands.rectangles(df, stretch=stretch).collect()
        for s in {c[0] for c in cells}:
            want = sorted(brute_rectangles([(r, c) for t, r, c in cells if t == s]))
            assert sorted((g.first_row, g.first_col, g.last_row, g.last_col) for g in got if g.sheet == s) == want
    assert islands.rectangles(df.limit(0)).collect() == []


def brute_numbers(levels, starts):
    values, seen, out = {}, set(), []
    for level in levels:
        if level is None or not 0 <= level < 9:
            out.append(None)
            continue
        start = lambda k: starts[k] if k < len(starts) else 1
        values[level] = values[level] + 1 if level in seen else start(level)
        seen = {k for k in seen if k <= level} | {level}
        out.append(".".join(str(values[k] if k in seen else start(k)) for k in range(level + 1)))
    return out


@pytest.mark.parametrize("starts", [(), (5, 1, 3)])
def test_numbers_of_lists(spark, starts):
    rng = random.Random(len(starts))
    lists = {name: [rng.choice([None, 9, -1, *range(9), 0, 1, 1, 2]) for _ in range(n)] for name, n in (("long", 400), ("short", 3), ("flat", 1), (None, 30))}
    lists["deep first"] = [2, 2, 0, 3, 1, 1, 0, 2]
    rows = [(name, i, level, "x") for name, levels in lists.items() for i, level in enumerate(levels)]
    df = spark.createDataFrame(rows, "list string, place int, level int, number_ string").repartition(4)
    for stretch in (10_000, 7):
        got = {(r.list, r.place): r.number for r in counters.numbered(df, starts=starts, stretch=stretch).collect()}
        assert got == {(name, i): n for name, levels in lists.items() for i, n in enumerate(brute_numbers(levels, starts))}
    assert counters.numbered(df.limit(0)).collect() == []


def sides(spark):
    left = spark.createDataFrame([(i, None if i % 2 else f"k{i % 7}") for i in range(40)], "id int, key string")
    right = spark.createDataFrame([(i, None if i % 3 == 0 else f"k{i}") for i in range(9)], "n int, key string")
    return left, right


@pytest.mark.parametrize("kind", ["left", "right", "full", "inner"])
def test_blank_keys_are_not_exchanged(spark, kind):
    left, right = sides(spark)
    out = compiled(Table.of(left), {"join": {"path": "r", "on": "key", "type": kind}, "groupBy": ["id", "key", "n"]}, {"r": Table.of(right)}).source
    got = sorted((tuple(r) for r in out.named().collect()), key=str)
    want = left.join(right, "key", kind).select("id", "key", "n").collect()
    assert got == sorted((tuple(r) for r in want), key=str)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = compiled(Table.of(left), {"join": {"path": "r", "on": "key", "type": kind}, "groupBy": ["id"]}, {"r": Table.of(right)}).source.df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert ("Union" in plan) == (kind != "inner")
    for exchange in plan.split("Exchange hashpartitioning")[1:]:
        assert "isnotnull" in exchange.split("Exchange")[0]  # whatever is exchanged has a key


def test_valid_in_a_range(spark):
    df = spark.createDataFrame([("1,000",), ("2",), ("x",), ("X",), ("",), (None,), ("2025年1月3日",)], "v string")
    source = spark.createDataFrame([("1000",), ("X",), (None,), ("",), ("2025/1/3",), ("X",)], "v string")
    cell = lambda d: Cell(F.col("v"), d.schema["v"].dataType)
    got = {r.v: r.hit for r in rules.valid_in(df, cell(df), source, cell(source)).collect()}
    assert got["1,000"] and got["2025年1月3日"] and not got["2"] and got[""] and got[None] and got["X"]
    assert not {r.v: r.hit for r in rules.valid_in(df, cell(df), source, cell(source), allow_blank=False).collect()}[None]
    assert [r.hit for r in rules.valid_in(df.where("v = '2'"), cell(df), source.limit(0), cell(source)).collect()] == [False]


def test_one_run_tells_all(spark):
    rows = [(i, f"g{i % 13}", "n/a" if i % 10 == 0 else str(i)) for i in range(500)]
    table = Table.of(spark.createDataFrame(rows, "id int, g string, v string").repartition(3), "t")
    result = compiled(table, {"where": [{"col": "id", "op": "gte", "value": 100}], "groupBy": ["g"], "aggregate": [{"col": "v", "fn": "sum", "as": "s"}], "orderBy": [{"col": "s", "dir": "desc"}], "limit": 4})
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    out = rendered(result, checked=True)
    assert store.executionsCount() - before == 1
    assert out["meta"] == {"kind": "aggregate", "columns": ["g", "s"], "shown": 4, "total": 13, "scannedRows": 500, "matchedRows": 400, "truncated": True}
    assert "40 cells of v are no numbers" in out["text"] and "500 rows x 3 columns -> 400 matched" in out["text"]
    scans = measured(result).df._jdf.queryExecution().executedPlan().toString().count("CollectMetrics")
    assert scans == 3
    plain = compiled(table, {"groupBy": ["g"], "limit": 3})
    assert rendered(plain)["meta"]["total"] == 13  # without an order too
    many = Table.of(spark.range(aggregate.GROUP_LIMIT + 1).select(F.col("id").cast("string").alias("k")))
    with pytest.raises(EngineError, match="TOO_MANY_GROUPS"):
        rendered(compiled(many, {"groupBy": ["k"]}), checked=True)
