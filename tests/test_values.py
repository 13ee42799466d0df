from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabweave.functions import model
from tabweave.functions.values import Cell, fmt_number, round12
from tabweave.operators.predicates import condition

NUMBERS = {"1,234.00": 1234.0, "¥2,000": 2000.0, "35%": 35 * 0.01, " 123 ": 123.0, "　123　": 123.0, "1,5": None, "12%3": None, "+3.": 3.0, "1e3": None, ".5": 0.5, "": None, "-": None, "abc": None, "1,234,567.5": 1234567.5, "12,34": None, "€-7": -7.0, "5 %": 5 * 0.01, "Infinity": None}
DAYS = {"2025/1/3": "2025-01-03", "2025-12-31": "2025-12-31", "2025.2.1": "2025-02-01", "2025年1月3日": "2025-01-03", "2025/1/3 10:00": "2025-01-03", "2025-01-03T00:00:00": "2025-01-03", "25/1/3": None, "2025/13/45": "2025-13-45", "2025/1": None}


def test_numbers_and_days(spark):
    assert {k: model.num(k) for k in NUMBERS} == NUMBERS
    assert {k: model.day(k) for k in DAYS} == DAYS
    df = spark.createDataFrame([(k,) for k in {**NUMBERS, **DAYS}], "c string")
    c = Cell(F.col("c"), T.StringType())
    for r in df.select("c", c.num().alias("n"), c.day().alias("d")).collect():
        assert r.n == model.num(r.c), r.c
        assert r.d == model.day(r.c), r.c


cells = st.one_of(st.none(), st.text("0123456789,.%-/年月日¥$ +abT ", max_size=12), st.sampled_from(list(NUMBERS) + list(DAYS)))


@settings(max_examples=12, deadline=None)
@given(st.lists(cells, min_size=30, max_size=60), st.lists(cells, min_size=1, max_size=3))
def test_columns_follow_the_model(spark, values, literals):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    c = Cell(F.col("c"), T.StringType())
    exprs = {}
    for k, literal in enumerate(literals):
        for op in ("eq", "ne", "gt", "gte", "lt", "lte", "contains", "startsWith", "endsWith"):
            exprs[f"{op}_{k}"] = (op, literal)
        exprs[f"in_{k}"], exprs[f"notIn_{k}"] = ("in", literals), ("notIn", literals)
    got = df.select("i", c.num().alias("num"), c.day().alias("day"), *(F.coalesce(condition(c, op, lit), F.lit(False)).alias(n) for n, (op, lit) in exprs.items())).collect()
    for r in got:
        v = values[r.i]
        assert (r.num, r.day) == (model.num(v), model.day(v)), repr(v)
        for n, (op, lit) in exprs.items():
            assert r[n] == model.holds(v, op, lit), (v, op, lit)


def test_formats(spark):
    xs = [0.1 + 0.2, 1 / 3, 2000.0, 1e7, 1e15, 123456789012.5, -0.0, 1e21, 1.5e-7, 0.000001, 12345678901234567.0]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", fmt_number(F.col("x")).alias("s"), round12(F.col("x")).alias("r")).collect()
    assert [r.s for r in got] == [model.fmt(x) for x in xs] == ["0.3", "0.333333333333", "2000", "10000000", "1000000000000000", "123456789013", "0", "1e+21", "1.5e-7", "0.000001", "12345678901200000"]
    assert got[0].r == 0.3
    edge = [7.4125185620149035e-06, 9.159448117309811e20, -5.409738856290388e20, 1e-5, 9.9999999999995e-7, 9.99999999999999e20, 999999999999.6, 1e12, 1e14, 123456.789012345, -2.50, 99999999999999.9]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in edge], "x double").select(fmt_number(F.col("x"))).collect()]
    assert got == [model.fmt(x) for x in edge] == ["0.00000741251856201", "915944811731000000000", "-540973885629000000000", "0.00001", "0.000001", "1e+21", "1000000000000", "1000000000000", "100000000000000", "123456.789012", "-2.5", "100000000000000"]


def test_hostile_cells_take_no_time(spark):
    df = spark.createDataFrame([("9" * 60_000 + "x",), ("1," * 30_000,), ("2025/" * 10_000,)], "c string")
    c = Cell(F.col("c"), T.StringType())
    assert [r[0] for r in df.select(F.coalesce(c.num(), F.lit(-1.0))).collect()] == [-1.0] * 3


def test_typed_filters_reach_the_scan(spark, tmp_path):
    spark.range(100).selectExpr("id", "cast(id as double) as x", "timestamp_ntz'2025-01-01' as t").write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    for name, op, value, pushed in (("x", "gt", 10, "GreaterThan(x"), ("t", "gte", "2025-01-02", "GreaterThanOrEqual(t"), ("x", "ne", 3, "Not(EqualTo(x")):
        plan = df.where(condition(Cell(F.col(name), df.schema[name].dataType), op, value))._jdf.queryExecution().executedPlan().toString()
        assert pushed in plan, plan


def test_letters():
    assert [model.column_letter(i) for i in (0, 25, 26, 701, 702)] == ["A", "Z", "AA", "ZZ", "AAA"]
    assert [model.column_index(x) for x in ("A", "Z", "AA", "ZZ", "AAA")] == [0, 25, 26, 701, 702]
