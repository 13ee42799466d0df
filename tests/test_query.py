import pytest
from pyspark.sql import functions as F

from tabweave.errors import EngineError
from tabweave.operators import joins
from tabweave.operators.render import rendered
from tabweave.plans.query import compiled
from tabweave.plans.spec import Query
from tabweave.plans.spec import joins as join_specs
from tabweave.plans.table import Table, unique_names

HEAD = ["harbour", "cargo", "tons", "docked", "remark"]
ROWS = [["Oslo", "ore", "¥3,400.25", "2023/6/9", "late"], ["Oslo", "salt", "600", "2023/7/14", ""], ["Riga", "ore", "5,000", "2022/11/30", ""], ["Riga", "salt", "50%", "2023/8/2", "late"], ["Turku", "ore", "", "2023/6/9", ""]]


def matrix(spark, rows, header_row=1):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows, 1)], "row_no long, cells array<string>")
    return Table.from_matrix(df, "t", header_row)


@pytest.fixture(scope="module")
def orders(spark):
    return matrix(spark, [HEAD, *ROWS])


def rows(result):
    return [tuple(r) for r in result.df.collect()]


def test_group_and_measures(orders):
    r = compiled(orders, {"groupBy": ["harbour"], "aggregate": [{"col": "tons", "fn": "sum", "as": "total"}, {"col": "tons", "fn": "avg"}, {"col": "cargo", "fn": "countDistinct", "as": "kinds"}]})
    assert r.columns == ["harbour", "total", "avg(tons)", "kinds"]
    assert rows(r) == [("Oslo", 4000.25, 2000.125, 2), ("Riga", 5000.5, 2500.25, 2), ("Turku", None, None, 1)]


def test_global_and_extremes(orders):
    r = compiled(orders, {"aggregate": [{"col": "tons", "fn": "sum"}, {"col": "tons", "fn": "count"}, {"col": "tons", "fn": "min"}, {"col": "tons", "fn": "max"}, {"col": "docked", "fn": "min"}, {"col": "docked", "fn": "max"}]})
    assert rows(r) == [(9000.75, 4, "0.5", "5000", "2022-11-30", "2023-08-02")]


def test_rows_per_group_filter_order_limit(orders):
    assert rows(compiled(orders, {"groupBy": ["cargo"]})) == [("ore", 3), ("salt", 2)]
    r = compiled(orders, {"where": [{"col": "harbour", "op": "in", "value": ["Oslo", "Riga"]}, {"col": "tons", "op": "gt", "value": 1000}], "groupBy": ["harbour"]})
    assert rows(r) == [("Oslo", 1), ("Riga", 1)]
    by = compiled(orders, {"groupBy": ["harbour"], "aggregate": [{"col": "tons", "fn": "sum", "as": "s"}], "orderBy": [{"col": "s", "dir": "desc"}], "limit": 2})
    assert [x[0] for x in rows(by)] == ["Riga", "Oslo"]
    assert [x[0] for x in rows(compiled(orders, {"groupBy": ["docked"], "orderBy": [{"col": "docked"}]}))] == ["2022/11/30", "2023/6/9", "2023/7/14", "2023/8/2"]


def test_profile(orders):
    got = {r["column"]: r for r in compiled(orders, {}).df.collect()}
    assert [got[c]["type"] for c in HEAD] == ["文本", "文本", "数字", "日期", "文本"]
    m = got["tons"]
    assert (m["non_null"], m["nulls"], m["sum"], m["avg"], m["min"], m["max"]) == (4, 1, 9000.75, 2250.1875, "0.5", "5000")
    assert got["remark"]["nulls"] == 3 and got["cargo"]["top"] == "ore(3) salt(2)" and got["harbour"]["top"] == "Oslo(2) Riga(2) Turku(1)" and got["docked"]["distinct"] == 4


def test_rendered_notes(spark, orders):
    out = rendered(compiled(orders, {"groupBy": ["harbour"], "aggregate": [{"col": "remark", "fn": "sum", "as": "s"}], "limit": 3}))
    assert not out["meta"]["truncated"] and out["meta"]["total"] == 3 and "2 cells of remark are no numbers" in out["text"]
    out = rendered(compiled(orders, {"where": [{"col": "cargo", "op": "eq", "value": "ore"}], "groupBy": ["harbour"], "limit": 2}))
    assert out["meta"]["truncated"] and (out["meta"]["shown"], out["meta"]["total"], out["meta"]["matchedRows"]) == (2, 3, 3) and "first 2 of 3 rows" in out["text"] and "-> 3 matched" in out["text"]
    blank = rendered(compiled(matrix(spark, [["a", "b"], ["1", ""]]), {}))
    assert "blank columns: b" in blank["text"]
    joined = compiled(orders, {"join": {"on": "harbour"}, "groupBy": ["cargo"]})
    assert "inner join with itself on harbour" in rendered(joined)["text"]


def test_mixed_and_missing_numbers(spark):
    t = matrix(spark, [["组", "值"], ["x", "100"], ["x", "待定"], ["x", "200"], ["y", "-"]])
    assert rows(compiled(t, {"groupBy": ["组"], "aggregate": [{"col": "值", "fn": "sum"}]})) == [("x", 300.0), ("y", None)]
    d = matrix(spark, [["值"], ["1"], ["1"], ["1.0"], ["x"]])
    assert rows(compiled(d, {"aggregate": [{"col": "值", "fn": "countDistinct"}]})) == [(2,)]


def test_pivot(spark):
    t = matrix(spark, [["team", "month", "hours"], ["north", "May", "12"], ["north", "June", "30"], ["north", "June", "8"], ["south", "May", "9"], ["south", "June", "4"]])
    r = compiled(t, {"pivot": {"rows": "team", "columns": "month", "values": [{"col": "hours", "fn": "sum"}], "totals": True}})
    assert r.columns == ["team", "May", "June", "合计"]
    assert rows(r) == [("north", 12.0, 38.0, 50.0), ("south", 9.0, 4.0, 13.0), ("合计", 21.0, 42.0, 63.0)]
    m = compiled(t, {"where": [{"col": "hours", "op": "ne", "value": 9}], "pivot": {"rows": ["team"], "columns": "month", "values": [{"col": "hours", "fn": "sum"}, {"col": "hours", "fn": "count"}]}, "orderBy": [{"col": "sum(hours)·June", "dir": "desc"}]})
    assert m.columns == ["team", "sum(hours)·May", "count(hours)·May", "sum(hours)·June", "count(hours)·June"]
    assert rows(m) == [("north", 12.0, 1, 38.0, 2), ("south", None, None, 4.0, 1)]
    wide = matrix(spark, [["a", "b", "c"], *[["x", f"v{i}", "1"] for i in range(61)]])
    with pytest.raises(EngineError, match="column dimension"):
        compiled(wide, {"pivot": {"rows": "a", "columns": "b", "values": [{"col": "c", "fn": "sum"}]}})


def test_names():
    assert unique_names(["tide", "tide", " ", "z", "tide"]) == ["tide", "tide_2", "C", "z", "tide_3"]


def test_headers(spark):
    t = matrix(spark, [["1", "2"], ["3", "4"]], 0)
    assert t.names == ("A", "B") and t.df.count() == 2
    ragged = matrix(spark, [["a", "b", "c"], ["1"], ["2", "3", "4", "5"]])
    assert ragged.names == ("a", "b", "c", "D")
    with pytest.raises(EngineError) as e:
        ragged.index("nope")
    assert e.value.code == "UNKNOWN_COLUMN" and ragged.index("B") == 1


BOTH = {("p", "7", "pine"), ("q", "8", "oak")}


@pytest.mark.parametrize(("kind", "want"), [("inner", BOTH), ("left", BOTH | {("s", "5", None)}), ("right", BOTH | {("r", None, "elm")}), ("full", BOTH | {("s", "5", None), ("r", None, "elm")})])
def test_joins(spark, kind, want):
    left, right = matrix(spark, [["plot", "trees"], ["p", "7"], ["q", "8"], ["s", "5"]]), matrix(spark, [["plot", "kind"], ["p", "pine"], ["q", "oak"], ["r", "elm"]])
    out = joins.joined(left, right, join_specs({"on": "plot", "type": kind, "path": "r"})[0])
    assert out.names == ("plot", "trees", "kind") and {tuple(r) for r in out.named().collect()} == want
    stats = joins.match_statistics(left, right, join_specs({"on": "plot", "type": kind, "path": "r"})[0]).first()
    assert tuple(stats) == (2, 1, 1 if kind in ("right", "full") else None)


def test_join_keys_and_names(spark):
    a, b = (matrix(spark, [["row", "seat", "note"], ["4", "a", x], ["4", "b", y], ["", "c", z]]) for x, y, z in (("f", "g", "h"), ("k", "l", "m")))
    out = joins.joined(a, b, join_specs({"on": ["row", "seat"], "path": "r"})[0])
    assert out.names == ("row", "seat", "note", "note_2") and out.df.count() == 2  # blank keys match nothing
    many = joins.joined(matrix(spark, [["no", "x"], ["7", "a"], ["007", "b"]]), matrix(spark, [["no", "y"], ["7", "c"], ["7.0", "d"]]), join_specs({"on": "no", "path": "r"})[0])
    with pytest.raises(EngineError) as e:
        joins.joined(many, many, join_specs({"on": "no", "path": "r"})[0], rows_limit=3)
    assert e.value.code == "TOO_MANY_ROWS"


@pytest.mark.parametrize("spec", [{"where": [{"col": "a", "op": "like", "value": 1}]}, {"where": [{"col": "a", "op": "gt"}]}, {"where": {}}, {"groupBy": "a"}, {"aggregate": [{"col": "a", "fn": "median"}]}, {"groupBy": ["a"], "aggregate": []}, {"limit": 0, "groupBy": ["a"]}, {"limit": 5}, {"join": {"path": "x"}}, {"join": {"path": "x", "on": "a", "type": "outer"}}, {"headerRow": -1}, {"pivot": {"rows": "a"}}, {"pivot": []}])
def test_bad_specs(spec):
    with pytest.raises(EngineError) as e:
        Query.from_json(spec)
    assert e.value.code == "INVALID_ARGS"


def test_group_limit_and_rendering(spark):
    t = Table.of(spark.range(5200).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("id")))
    with pytest.raises(EngineError) as e:
        compiled(t, {"groupBy": ["id"]}, checked=True)
    assert e.value.code == "TOO_MANY_GROUPS"
    out = rendered(compiled(matrix(spark, [["v", "n"], ["a\tb\nc", "0.30000000000000004"]]), {"groupBy": ["v"], "aggregate": [{"col": "n", "fn": "sum", "as": "s"}]}))
    assert "a␉b⏎c\t0.3" in out["text"] and out["meta"]["matchedRows"] == 1
    assert rendered(compiled(matrix(spark, [["a"]]), {}))["meta"]["kind"] == "empty"


def test_stream(spark, tmp_path):
    from tabweave.streaming.query import windowed
    spark.range(20).selectExpr("timestamp'2025-01-01 00:00:00' + make_interval(0,0,0,0,0,0,id*60) as ts", "id % 2 as k", "cast(id as double) as v").write.parquet(str(tmp_path / "s"))
    stream = spark.readStream.schema("ts timestamp, k long, v double").parquet(str(tmp_path / "s"))
    q = windowed(stream, {"where": [{"col": "v", "op": "gte", "value": 2}], "groupBy": ["k"], "aggregate": [{"col": "v", "fn": "sum", "as": "s"}]}, "ts", "10 minutes").writeStream.outputMode("complete").format("memory").queryName("streamed").trigger(availableNow=True).start()
    done = q.awaitTermination(30)
    if not done:
        q.stop()
        pytest.skip("the stream did not end in 30 s")
    assert spark.sql("select sum(s) from streamed").first()[0] == sum(range(2, 20))
