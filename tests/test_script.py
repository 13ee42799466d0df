"""Composed edit scripts against steps on a dictionary of cells."""

import random

import pytest
from pyspark.sql import functions as F

from tabweave.edit.workbook import CELLS, Workbook, edited
from tabweave.functions.model import column_letter


def brute(sheets, script):
    sheets = {k: dict(v) for k, v in sheets.items()}
    for op in script:
        name, kind = op.get("sheet", next(iter(sheets))), op["op"]
        cells = sheets.get(name, {})
        if kind in ("insert_rows", "delete_rows", "insert_cols", "delete_cols"):
            k, at, n, insert = "row" not in kind, op["at"], op["count"], "insert" in kind
            out = {}
            for place, v in cells.items():
                if insert or not at <= place[k] < at + n:
                    to = list(place)
                    to[k] += (n if insert else -n) * (place[k] >= at)
                    out[tuple(to)] = v
            sheets[name] = out
            if op.get("values"):
                for i, line in enumerate(op["values"]):
                    for j, v in enumerate(line):
                        out[at + i, 1 + j] = v
        elif kind == "set_cells":
            for i, line in enumerate(op["values"]):
                for j, v in enumerate(line):
                    place = (op["row"] + i, op["col"] + j)
                    cells[place] = v
                    if v in (None, ""):
                        del cells[place]
        elif kind == "add_sheet":
            sheets[op["name"]] = {}
        elif kind == "rename_sheet":
            sheets = {op["name"] if k == name else k: v for k, v in sheets.items()}
        elif kind == "delete_sheet":
            del sheets[name]
    return {(s, *p): str(v) for s, cells in sheets.items() for p, v in cells.items()}


def script_of(seed, steps):
    rng, names, out = random.Random(seed), ["a", "b"], []
    for i in range(steps):
        name = rng.choice(names)
        kind = rng.choice(["insert_rows", "delete_rows", "insert_cols", "delete_cols", "set_cells", "set_cells", "insert_rows", "delete_rows", "sheets"])
        if kind == "set_cells":
            row, col = rng.randrange(1, 40), rng.randrange(1, 7)
            out.append({"op": kind, "sheet": name, "start": f"{column_letter(col - 1)}{row}", "row": row, "col": col, "values": [[rng.choice([f"n{i}", None, i]) for _ in range(rng.randrange(1, 4))] for _ in range(rng.randrange(1, 3))]})
        elif kind != "sheets":
            out.append({"op": kind, "sheet": name, "at": rng.randrange(1, 40 if "row" in kind else 7), "count": rng.randrange(1, 4), **({"values": [[f"v{i}"]]} if kind == "insert_rows" and rng.random() < 0.3 else {})})
        elif len(names) > 1 and rng.random() < 0.3:
            out.append({"op": "delete_sheet", "sheet": name})
            names.remove(name)
        elif rng.random() < 0.5:
            new = rng.choice([n for n in "abcdefgh" if n not in names])
            out.append({"op": "add_sheet", "name": new})
            names.append(new)
        else:
            new = rng.choice([n for n in "abcdefgh" if n not in names])
            out.append({"op": "rename_sheet", "sheet": name, "name": new})
            names[names.index(name)] = new
    return out


def book(spark, sheets):
    return Workbook(spark.createDataFrame([(s, r, c, v, None, None) for s, cells in sheets.items() for (r, c), v in cells.items()], CELLS), list(sheets))


@pytest.mark.parametrize("seed", range(6))
def test_scripts(spark, seed):
    rng = random.Random(seed)
    sheets = {n: {(r, c): f"{n}{r}.{c}" for r in range(1, 50) for c in range(1, 8) if rng.random() < 0.8} for n in ("a", "b")}
    script = script_of(seed, 60)
    got = {(r.sheet, r.row, r.col): r.value for r in edited(book(spark, sheets), script).cells.collect()}
    assert got == brute(sheets, script)


def test_styles_stay_with_their_cells(spark):
    cells = spark.createDataFrame([("a", 1, 1, "x", None, "bold"), ("a", 2, 1, "y", "=1", None)], CELLS)
    made = edited(Workbook(cells, ["a"]), [{"op": "insert_rows", "at": 1, "count": 2}, {"op": "set_value", "cell": "A3", "value": "new"}, {"op": "set_formula", "cell": "A4", "formula": "A3"}, {"op": "insert_cols", "at": 1, "count": 1}, {"op": "set_value", "cell": "B3", "value": None}])
    assert sorted(tuple(r)[1:] for r in made.cells.collect()) == [(3, 2, None, None, "bold"), (4, 2, None, "=A3", None)]


def test_depth_does_not_grow(spark):
    df = spark.range(100).select(F.lit("a").alias("sheet"), (F.col("id") + 1).alias("row"), F.lit(1).cast("long").alias("col"), F.col("id").cast("string").alias("value"), F.lit(None).cast("string").alias("formula"), F.lit(None).cast("string").alias("style"))
    def nodes(steps):
        script = [{"op": "insert_rows" if i % 2 else "delete_rows", "at": 1 + i * 3 % 90, "count": 1} for i in range(steps - 1)] + [{"op": "set_value", "cell": "B2", "value": "q"}]
        out = edited(Workbook(df, ["a"]), script).cells
        assert out.count() > 0
        return len(out._jdf.queryExecution().optimizedPlan().treeString().split("\n"))
    assert nodes(200) == nodes(5)
