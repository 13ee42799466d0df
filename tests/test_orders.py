"""Inherited and dominant formats, rows put in and taken out, united sketches and percentile stops, against plain Python."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from tabweave.edit import rules
from tabweave.functions.values import Cell
from tabweave.operators import inheritance, sequence, sketches


def test_inherited(spark):
    rng = random.Random(1)
    bases = {f"s{i}": f"s{rng.randrange(60)}" if i % 9 else None for i in range(60)} | {f"c{i}": f"c{i - 1}" if i else None for i in range(30)} | {"self": "self", "x": "y", "y": "x", "lost": "nowhere"}
    values = {(s, p): f"{s}.{p}" for s in bases for p in ("size", "font") if rng.random() < 0.15} | {("c0", "size"): "top", ("y", "size"): "y", ("self", "font"): "f"}
    want = {}
    for s in bases:
        for p in ("size", "font"):
            at, distance = s, 0
            while at is not None and distance < inheritance.DEPTH:
                if (at, p) in values:
                    want[s, p] = (values[at, p], distance)
                    break
                at, distance = bases.get(at), distance + 1
    got = inheritance.inherited(spark.createDataFrame([*bases.items(), (None, "x"), ("c1", "c0")], "style string, based_on string"), spark.createDataFrame([(*k, v) for k, v in values.items()] + [("c5", "size", None)], "style string, property string, value string"))
    assert {(r.style, r.property): (r.value, r.distance) for r in got.collect()} == want
    assert ("c11", "size") in want and not any(k == ("c29", "size") and v[0] == "top" for k, v in want.items())  # the top of a long chain is out of reach


def test_dominant(spark):
    runs = spark.createDataFrame([(1, "a", "xx"), (1, "b", "xxx"), (1, "a", "yy"), (2, "b", "x"), (2, "a", "y"), (3, "a", ""), (4, None, "x"), (5, "a", None)], "p int, f string, t string")
    assert sorted(tuple(r) for r in inheritance.dominant(runs, ("p",), "f", "t").collect()) == [(1, "a", 4), (2, "a", 1), (3, None, 0), (4, None, 1), (5, None, 0)]


@pytest.mark.parametrize("stretch", [10_000, 6])
def test_rows_put_in_and_taken_out(spark, stretch):
    rng = random.Random(stretch)
    docs = {"a": [f"a{i}" for i in range(50)], "b": ["b0"], None: ["n0", "n1"]}
    inserts = [(d, rng.choice([None, *range(len(lines))]), rng.choice(["before", "after"]), k, f"new{k}") for k in range(40) for d, lines in [rng.choice(list(docs.items()))]]
    deletes = {(d, i) for d, lines in docs.items() if d for i in range(len(lines)) if rng.random() < 0.2}
    want = {}
    for d, lines in docs.items():
        out = []
        for i, line in enumerate(lines):
            out += [x[4] for x in sorted(inserts, key=lambda x: x[3]) if x[0] == d and x[1] == i and x[2] == "before"]
            out += [line] if (d, i) not in deletes else []
            out += [x[4] for x in sorted(inserts, key=lambda x: x[3]) if x[0] == d and x[1] == i and x[2] == "after"]
        want[d] = out + [x[4] for x in sorted(inserts, key=lambda x: x[3]) if x[0] == d and x[1] is None]
    rows = spark.createDataFrame([(d, i, x) for d, lines in docs.items() for i, x in enumerate(lines)], "doc string, place int, line string").repartition(3)
    got = sequence.edited(rows, spark.createDataFrame(inserts, "doc string, anchor int, side string, seq int, line string"), spark.createDataFrame([*deletes, ("a", 999)], "doc string, place int"), ("doc",), ("line",), stretch=stretch).collect()
    for d, lines in want.items():
        assert [(r.place, r.line) for r in sorted((r for r in got if r.doc == d), key=lambda r: r.place)] == list(enumerate(lines))


def test_sketches(spark):
    df = spark.range(60_000).select((F.col("id") % 30).alias("day"), F.concat(F.lit("1,"), F.format_string("%03d", F.col("id") % 1000), F.format_string("%03d", (F.col("id") / 8).cast("int") % 9)).alias("v"))
    cell = Cell(F.col("v"), df.schema["v"].dataType)
    days = sketches.sketched(df, ["day"], cell)
    exact = df.select(F.count_distinct("v")).first()[0]
    whole = sketches.counted(sketches.united(days.withColumn("all", F.lit(1)), ["all"])).first()["distinct"]
    assert abs(whole - exact) <= 5 * 1.04 / 64 * exact
    first = sketches.sketched(df.where("day < 29"), ["day"], cell)  # a day later: one more row, the same result
    later = first.unionByName(sketches.sketched(df.where("day = 29"), ["day"], cell))
    again = sketches.counted(sketches.united(later.withColumn("all", F.lit(1)), ["all"])).first()["distinct"]
    assert abs(again - whole) <= 0.01 * exact  # the order of uniting moves the estimate a little


def test_percentile_stop(spark):
    rng = random.Random(4)
    numbers = [round(rng.gauss(0, 50), 3) for _ in range(401)]
    df = spark.createDataFrame([(str(x),) for x in numbers] + [("none",), (None,)], "v string")
    cell = Cell(F.col("v"), df.schema["v"].dataType)
    assert rules.percentile(df, cell, 50) == pytest.approx(statistics.median(numbers)) and rules.percentile(df, cell, 0) == min(numbers)
    assert rules.percentile(df, cell, 30.1) == pytest.approx(sorted(numbers)[120] + 0.4 * (sorted(numbers)[121] - sorted(numbers)[120]))
    at = {r.v: r.p for r in df.select("v", rules.scaled_by(cell, rules.facts(df, cell), 10.0).alias("p")).collect()}
    assert at[str(min(numbers))] == 0 and at[str(max(numbers))] == 1 and at["none"] is None and all(0 <= p <= 1 for p in at.values() if p is not None)
    assert rules.percentile(df.limit(0), cell) is None
