"""Sheets written and read by columns: the same bytes, rows and cells as by lists and elements, and no work for each cell."""

import datetime
import io
import random
import zipfile
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tabweave.sinks import workbook as sinks
from tabweave.sinks.presentation import Styles
from tabweave.sources import datasource, package, plain

row_runs = datasource.row_runs

HEAD = '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:x="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>'


def batch(n=300):
    r = random.Random(3)
    held = lambda *of: [r.choice([None, *of]) for _ in range(n)]
    return pa.RecordBatch.from_pydict({
        "whole": pa.array(range(n), pa.int64()), "odd": pa.array(held(0, -5, 2**62), pa.int64()), "double": pa.array(held(0.0, -0.0, 1e300, 1e-7, float("nan"), float("inf"), 17.0), pa.float64()),
        "text": pa.array(held("", " a ", "a<b>&\"'", "=1+1", "x\x01\ty\r\n", "é𝄞", "]]>", "TRUE"), pa.string()), "truth": pa.array(held(True, False)), "day": pa.array(held(datetime.date(2024, 2, 29), datetime.date(1899, 1, 1))),
        "time": pa.array(held(datetime.datetime(2024, 1, 1, 3)), pa.timestamp("us")), "decimal": pa.array(held(Decimal("1.10"), Decimal("12345678901234567890.12")), pa.decimal128(30, 2)), "list": pa.array(held([1, None]), pa.list_(pa.int64())), "none": pa.nulls(n)})


def test_columns_are_written_as_lists(monkeypatch):
    whole = batch()
    lists = lambda b: [[datasource._value(v) for v in row] for row in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    for most in (sinks.MOST_TOGETHER, 5000):
        monkeypatch.setattr(sinks, "MOST_TOGETHER", most)
        for b in (whole, whole.slice(7, 100), whole.slice(5, 1), whole.slice(0, 0)):
            want, got = (b"".join(sinks._sheet("S", [["a", "b"], *rows], False, Styles(), None)) for rows in (lists(b), [sinks.Columns(b, datasource._value)]))
            assert got == want
    with pytest.raises(Exception, match="TOO_LARGE"):
        list(sinks._sheet("S", [sinks.Columns(pa.RecordBatch.from_pydict({"a": pa.nulls(sinks.MOST_ROWS + 1)}), datasource._value)], False, Styles(), None))


def letters(*names):
    return StructType([StructField("physical_row", LongType()), *(StructField(n, StringType()) for n in names)])


def test_a_value_is_looked_at_once(monkeypatch, tmp_path):
    """20,000 rows of few values: cells are neither made nor parsed one at a time."""
    n, made, trees = 20_000, [], []
    monkeypatch.setattr(sinks, "_after", lambda *a, f=sinks._after: made.append(1) or f(*a))
    monkeypatch.setattr(datasource.ET, "XMLPullParser", lambda *a, f=datasource.ET.XMLPullParser: trees.append(1) or f(*a))
    schema = StructType([StructField("id", LongType()), StructField("day", StringType())])
    writer = datasource.Writer(str(tmp_path), schema, False, 8000, "Sheet1")
    days = [datetime.date(2020, 1, 1) + datetime.timedelta(i % 50) for i in range(n)]
    writer.commit([writer.write(pa.RecordBatch.from_pydict({"id": pa.array(range(i, i + 1000)), "day": pa.array(days[i:i + 1000])}) for i in range(0, n, 1000))])
    assert len(made) < 500
    reader = datasource.Reader(str(tmp_path), letters("A", "B"), 200_000)
    pieces = reader.partitions()
    got = pa.Table.from_batches(b for p in pieces for b in reader.read(p)).to_pylist()
    assert len(pieces) > 5 and not [p for p in pieces if not p.path]
    assert sorted((int(r["A"]), r["B"]) for r in got if r["physical_row"] > 1) == [(i, str(d)) for i, d in enumerate(days)] and len(got) == n + 3
    assert len(trees) <= 6  # heads and ends of three files


def test_a_piece_is_unpacked_from_its_point(monkeypatch, tmp_path):
    """Only what a piece needs is unpacked; a sheet that was packed anew is read from its beginning."""
    monkeypatch.setattr(package, "POINT", 1 << 16)
    monkeypatch.setattr(sinks, "STRETCH", 256)
    monkeypatch.setattr(datasource, "BLOCK", 1 << 14)
    schema = StructType([StructField("id", LongType()), StructField("text", StringType())])
    writer = datasource.Writer(str(tmp_path / "a"), schema, False, 50_000, "Sheet1")
    r = random.Random(2)
    writer.commit([writer.write(iter([pa.RecordBatch.from_pydict({"id": pa.array(range(30_000)), "text": pa.array([f"{r.random()}" for _ in range(30_000)])})]))])
    [path] = (tmp_path / "a").glob("*.xlsx")
    assert zipfile.ZipFile(path).testzip() is None
    (tmp_path / "b").mkdir()
    with zipfile.ZipFile(path) as a, zipfile.ZipFile(tmp_path / "b" / "b.xlsx", "w", zipfile.ZIP_DEFLATED) as b:
        for info in a.infolist():  # keeps the field of the index that tells the points, which hold no longer
            b.writestr(info, a.read(info))
    got, unpacked = {}, {}
    for k in "ab":
        size = []
        monkeypatch.setattr(datasource, "row_runs", lambda *a, size=size, f=row_runs: (size.append(len(x[1])) or x for x in f(*a)))
        reader = datasource.Reader(str(tmp_path / k), letters("A", "B"), 100_000)
        pieces = reader.partitions()
        got[k] = [x for p in pieces for b in reader.read(p) for x in b.to_pylist()]
        unpacked[k] = sum(size) / sum(p.end - p.start for p in pieces)
    assert len(pieces) > 20 and got["a"] == got["b"] and [x["A"] for x in got["a"][1:]] == [str(i) for i in range(30_000)]
    assert unpacked["a"] < 2.5 and unpacked["b"] > 8
    big = package.Package(path.read_bytes())
    for start in (0, 70_000, 200_000, 1 << 30):
        stream, at = big.open_from("xl/worksheets/sheet1.xml", start)
        whole, rest = big.read("xl/worksheets/sheet1.xml"), stream.read()
        assert at <= start and min(start, len(whole)) - at < 120_000 and whole[at:] == rest and rest


def book(rows):
    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(sinks.table_bytes([("S", [[datetime.date(2020, 1, 1)]])], "xlsx"))) as a, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as b:
        for name in a.namelist():
            b.writestr(name, f"{HEAD}{rows}</sheetData></worksheet>" if name.endswith("sheet1.xml") else a.read(name))
    return out.getvalue()


PLAIN = ['<c r="{c}{r}"><v>{r}</v></c>', '<c r="{c}{r}"><v>1234567890123.5</v></c>', '<c r="{c}{r}"><v>-0</v></c>', '<c r="{c}{r}" s="1"><v>4{r}</v></c>', '<c r="{c}{r}" t="b"><v>1</v></c>', '<c r="{c}{r}" t="inlineStr"><is><t> a &amp;lt; </t></is></c>',
         '<c r="{c}{r}" t="inlineStr"><is><t xml:space="preserve">é {r}</t></is></c>', '<c r="{c}{r}" t="str"><v>=x</v></c>', '<c r="{c}{r}" t="d"><v>2020-01-01T00:00</v></c>', '<c r="{c}{r}"><v></v></c>', '<c r="{c}{r}" s="0" t="n"><v>007</v></c>', ""]
ODD = ['<c r="{c}{r}"/>', '<c><v>5</v></c>', '<c r="{c}{r}"><f>A1</f><v>5</v></c>', '<c r="{c}{r}"><f>A1</f></c>', '<c r="{c}{r}" t="inlineStr"><is><r><t>a</t></r><r><t>b</t></r></is></c>', '<c r="{c}{r}"><v>1</v></c><c r="{c}{r}"><v>2</v></c>', "<c r='{c}{r}'><v>5</v></c>", '<c r="{c}99"><v>5</v></c>',
       '<!-- <c> --><c r="{c}{r}"><v>5</v></c>', '<c r="{c}{r}" t="inlineStr"><is><t>a > b</t></is></c>', '<c r="{c}{r}" t="inlineStr"><is><t>&#65;</t></is></c>', '<x:c r="{c}{r}"><x:v>5</x:v></x:c>', '\n<c r="{c}{r}"><v>5</v></c>', '<c s="0" r="{c}{r}"><v>5</v></c>', '<c r="{c}{r}" t="inlineStr"><v>5</v></c>', '<c r="{c}{r}"><is><t>5</t></is></c>', '<c r="{c}{r}"><v><![CDATA[5]]></v></c>']


@pytest.mark.parametrize("odd", [None, *ODD])
def test_columns_are_read_as_elements(monkeypatch, tmp_path, odd):
    r = random.Random(5)
    rows, at = [], 0
    for i in range(400):
        at += r.choice((1, 1, 3))
        forms = PLAIN if odd is None or i % 50 else [odd]
        cells = "".join(r.choice(forms).format(c=c, r=at) for c in ("A", "C", "ZZ", "ABC"))
        rows.append(f'<row r="{at}"{r.choice(("", " spans=" + chr(34) + "1:5" + chr(34)))}>{cells}</row>')
    (tmp_path / "b.xlsx").write_bytes(book("".join(rows)))
    taken = []
    monkeypatch.setattr(datasource, "BLOCK", 2000)
    by_columns = lambda *a, f=plain.columns: taken.append(f(*a)) or taken[-1]

    def read(how, first, last):
        monkeypatch.setattr(plain, "columns", how)
        reader = datasource.Reader(str(tmp_path), letters("ZZ", "A", "B", "ABC"), 7000)
        reader.bounds.first, reader.bounds.last = first, last
        return [x for p in reader.partitions() for b in reader.read(p) for x in b.to_pylist()]

    for first, last in ((1, None), (50, 333)):
        want, got = (read(how, first, last) for how in (lambda *a: None, by_columns))
        assert got == want and want
    if odd is None:
        assert sum(t is not None for t in taken) > len(taken) * 0.9
    else:
        assert any(t is None for t in taken)
