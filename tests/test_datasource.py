"""The workbook data source: planning by ranges of bytes, pushed conditions, columns by letters, writing with commit and abort; and whole sheets on saving."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tabweave import api
from tabweave.errors import EngineError
from tabweave.sinks import workbook as sinks
from tabweave.sources import datasource, workbook
from tabweave.sources.package import Package


@pytest.fixture(scope="module")
def format_(spark):
    datasource.register(spark)
    return datasource.NAME


@pytest.fixture(scope="module")
def book(tmp_path_factory):
    """A sheet of 500,000 rows with a gap and a formula, and a small one."""
    path = str(tmp_path_factory.mktemp("books") / "large.xlsx")
    rows = [["id", "text", "twice"], *([i, f"row {i}", f"=A{i}*2"] if i != 7 else [] for i in range(2, 500_001))]
    with open(path, "wb") as f:
        f.write(sinks.table_bytes([("Large", rows), ("Small", [["a"], [], [None, None, "x & <y>"]])], "xlsx"))
    return path


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_reads_in_pieces(spark, format_, book):
    df = spark.read.format(format_).load(book)
    assert df.rdd.getNumPartitions() > 2
    large = df.where("sheet = 'Large'")
    assert large.count() == 499_999  # all but the blank row
    sums = large.where("physical_row > 1").agg(F.count("*"), F.sum(F.col("cells")[0].cast("long")), F.countDistinct("physical_row"), F.sum((F.col("cells")[0].cast("long") == F.col("physical_row")).cast("int")), F.sum((F.col("formulas")[2] == F.concat(F.lit("=A"), "physical_row", F.lit("*2"))).cast("int"))).first()
    assert tuple(sums) == (499_998, sum(range(2, 500_001)) - 7, 499_998, 499_998, 499_998)
    small = df.where("sheet_no = 2").orderBy("physical_row").collect()
    assert [(r.physical_row, r.cells) for r in small] == [(1, ["a"]), (3, ["", "", "x & <y>"])]


def test_pieces_agree_with_whole(spark, format_, tmp_path):
    """Cut at every few bytes, with shared texts and formulas, rows without numbers and a prefix."""
    ns = 'xmlns:x="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    cells = "".join(f'<x:row{f" r={chr(34)}{2 * i}{chr(34)}" if i % 5 == 0 else ""}><x:c r="A{2 * i if i % 5 == 0 else i}"><x:v>{i}</x:v></x:c>' + (f'<x:c r="B{i}"><x:f t="shared" si="0">{"A1*2" if i == 3 else ""}</x:f><x:v>{i * 2}</x:v></x:c>' if i >= 3 else "") + "</x:row>" for i in range(1, 60))
    raw = sinks.table_bytes([("S", [["q"]])], "xlsx")
    import io
    import zipfile
    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(raw)) as a, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as b:
        for n in a.namelist():
            b.writestr(n, f"<?xml version='1.0'?><x:worksheet {ns}><x:sheetData>{cells}</x:sheetData></x:worksheet>" if n.endswith("sheet1.xml") else a.read(n))
    path = tmp_path / "odd.xlsx"
    path.write_bytes(out.getvalue())
    want = [(number, c, f) for number, c, f in workbook.parse(out.getvalue(), "odd.xlsx")[0].rows]
    for split in (1 << 20, 700, 61):
        got = spark.read.format(format_).option("splitBytes", split).load(str(path)).orderBy("physical_row").collect()
        assert [(r.physical_row, r.cells, r.formulas) for r in got] == want


def test_pushed_conditions(spark, format_, book):
    df = spark.read.format(format_).load(book)
    some = df.where("sheet = 'Large' AND physical_row >= 400000 AND physical_row < 400010 AND size(cells) > 1")
    assert [r.physical_row for r in some.orderBy("physical_row").collect()] == list(range(400_000, 400_010))
    above = plan(some).split("BatchScan")[0]  # what Spark still does itself
    assert "size(cells" in above and "400000" not in above and "Large" not in above
    reader = datasource.Reader(book, df.schema, datasource.SPLIT)
    from pyspark.sql.datasource import EqualTo, GreaterThan, IsNotNull
    assert list(reader.pushFilters([EqualTo(("sheet",), "Small"), GreaterThan(("physical_row",), 2), IsNotNull(("cells",))])) == [IsNotNull(("cells",))]
    assert [p.sheet for p in reader.partitions()] == ["Small"] and reader.bounds.first == 3
    assert df.where("sheet = 'none'").count() == 0 and df.where("sheet_no = 1 AND physical_row > 10 AND physical_row < 5").count() == 0


def test_columns_by_letters(spark, format_, book):
    df = spark.read.format(format_).schema("physical_row long, C string, A string, ZZ string").load(book).where("physical_row <= 3")
    assert [tuple(r) for r in df.where("A IS NOT NULL AND C IS NOT NULL").orderBy("physical_row").collect()] == [(1, "twice", "id", None), (2, "=A2*2", "2", None), (3, "=A3*2", "3", None)]
    with pytest.raises(Exception, match="columns of a workbook"):
        spark.read.format(format_).schema("nonsense string").load(book).collect()


def test_write_and_read_back(spark, format_, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(0, 1000, 1, 3).select("id", (F.col("id") / 8).alias("part"), F.expr("CAST(id AS DECIMAL(12,2)) / 4").alias("dec"), F.expr("date_add(DATE'2024-02-27', CAST(id AS INT))").alias("day"), F.when(F.col("id") % 3 == 0, F.lit("=1+1")).alias("text"), (F.col("id") % 2 == 0).alias("even"))
    df.write.format(format_).option("rowsPerFile", 200).mode("overwrite").save(path)
    assert len(glob.glob(f"{path}/part-*.xlsx")) == 6 and not glob.glob(f"{path}/_staging*")
    back = spark.read.format(format_).schema("physical_row long, A string, B string, C string, D string, E string, F string").load(path).where("physical_row > 1")
    same = back.selectExpr("CAST(A AS LONG) AS id", "CAST(B AS DOUBLE) AS part", "CAST(C AS DECIMAL(12,2)) AS dec", "CAST(D AS DATE) AS day", "E AS text", "F = 'TRUE' AS even")
    want = df.withColumn("dec", F.col("dec").cast("decimal(12,2)"))
    assert same.count() == 1000 and same.exceptAll(want).count() == 0
    df.limit(5).write.format(format_).mode("append").save(path)
    assert spark.read.format(format_).load(path).where("physical_row > 1").count() == 1005
    df.limit(7).coalesce(1).write.format(format_).mode("overwrite").save(path)
    assert spark.read.format(format_).load(path).where("physical_row > 1").count() == 7 and len(os.listdir(path)) == 2


def test_aborted_write_leaves_nothing(spark, format_, tmp_path):
    path = str(tmp_path / "fails")
    bad = spark.range(0, 400, 1, 4).select(F.when(F.col("id") == 350, F.raise_error(F.lit("stop here"))).otherwise(F.col("id").cast("string")).alias("x"))
    with pytest.raises(Exception, match="stop here"):
        bad.write.format(format_).option("rowsPerFile", 10).mode("append").save(path)
    assert [f for _, _, files in os.walk(path) for f in files] == []


def test_nothing_is_lost_on_saving(spark, tmp_path):
    tall, wide = [[str(i), f"n{i}"] for i in range(200_500)], [[f"c{k}" for k in range(250)], [str(k) for k in range(250)]]
    csv, tsv, back = (str(tmp_path / n) for n in ("tall.csv", "tall.tsv", "tall2.csv"))
    with open(csv, "w") as f:
        f.write("\n".join(",".join(r) for r in tall))
    api.convert(csv, tsv)
    api.convert(tsv, back)
    assert [r[1] for r in workbook.parse(open(back, "rb").read(), back)[0].rows] == tall
    for kind in ("xlsx", "ods"):
        source, target = str(tmp_path / f"wide.{kind}"), str(tmp_path / f"wide_{kind}.csv")
        with open(source, "wb") as f:
            f.write(sinks.table_bytes([("S", wide)], kind))
        api.convert(source, target)
        assert [r[1] for r in workbook.parse(open(target, "rb").read(), target)[0].rows] == wide
    xlsx = str(tmp_path / "tall.xlsx")
    api.convert(csv, xlsx)
    assert api.edit_xlsx(spark, xlsx, [{"op": "set_value", "cell": "B2", "value": "new"}]) == []
    rows = workbook.parse(open(xlsx, "rb").read(), xlsx)[0].rows
    assert len(rows) == 200_500 and rows[1][1] == ["1", "new"] and rows[-1][1] == ["200499", "n200499"]
    assert workbook.load_table(spark, xlsx).truncated  # queries keep their limit, and say so
    with pytest.raises(EngineError, match="TOO_LARGE"):
        sinks.xlsx([("S", [["x"] * 16_385])])
    assert Package(open(xlsx, "rb")).size("xl/worksheets/sheet1.xml") > 1 << 20
