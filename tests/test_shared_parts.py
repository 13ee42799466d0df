"""What documents of one template share is worked out once, and what is written by shorter ways is the same."""

from __future__ import annotations

import io
import random
import xml.etree.ElementTree as ET
import zipfile
import zlib

import pytest

from tabweave import catalog_documents as documents
from tabweave.sinks import presentation
from tabweave.sinks import workbook as sinks
from tabweave.sources import datasource
from tabweave.sources import workbook as sources
from tabweave.sources.package import Package, archive, xml_bytes
from tabweave.text import html, outline
from tabweave.text.docx import Document, repacked


def letters(n: int) -> list[tuple]:
    return [(k, f"Customer#{k}", k % 25, "BUILDING & <CO>") for k in range(1, n + 1)]


def test_numbering_is_read_back_once(monkeypatch):
    calls = []
    monkeypatch.setattr(documents.html, "to_markdown", lambda x, f=html.to_markdown: calls.append(1) or f(x))
    assert len(documents._numbered(letters(1)[0])) == 5 and len(calls) == 1


def test_shared_parts_are_parsed_once(monkeypatch):
    files = [documents.letter_file(r) for r in letters(30)]
    calls = []
    monkeypatch.setattr(ET, "fromstring", lambda x, f=ET.fromstring: calls.append(1) or f(x))
    assert [Document(f).paragraphs()[0].text for f in files] == [f"Customer {k}" for k in range(1, 31)]
    assert len(calls) <= 2 * 30 + 5  # the body and its links; before, styles, lists and relations too


def test_styles_of_two_documents_stay_apart():
    row = letters(1)[0]
    (_, small), (_, large) = ((k, documents._styled((k, *row[1:]))) for k in (5, 9))
    assert [r[2] for r in small] == [10.0, 15.0, 10.0] and [r[2] for r in large] == [14.0, 15.0, 14.0]


@pytest.mark.parametrize("xml", [
    '<a xmlns="urn:x" xmlns:q="urn:q" q:k="1&amp;&quot;&lt;&#10;&#9;"><b> x &amp; &lt; </b>tail &gt;<c/></a>', "<a k='ü'>é<b/>t</a>", '<a xml:space="preserve"> <b xmlns:z="urn:z"><z:c/></b></a>',
])
def test_xml_is_as_elementtree_writes_it(xml):
    root = ET.fromstring(xml)
    assert xml_bytes(root) == ET.tostring(root, encoding="UTF-8", xml_declaration=True)


def test_comments_are_written():
    root = ET.Element("a")
    root.append(ET.Comment("c"))
    assert b"<!--c-->" in xml_bytes(root)


def test_archives_are_read_by_others():
    parts = {"a/b.xml": b"x" * 1000, "ü.txt": "ü".encode(), "empty": b"", "large": random.Random(1).randbytes(200_000)}
    with zipfile.ZipFile(io.BytesIO(archive(parts))) as z:
        assert z.testzip() is None and {i: z.read(i) for i in z.namelist()} == parts
    pack = Package(repacked(Package(archive(parts)), {"A/B.xml": b"new", "more": b"m"}))
    assert pack.read("A/B.xml") == b"new" and pack.read("more") == b"m" and pack.read("large") == parts["large"]


def test_broken_parts_are_told():
    data = bytearray(archive({"a": b"hello hello hello"}))
    data[33] ^= 0xFF
    with pytest.raises((zipfile.BadZipFile, zlib.error)):
        Package(bytes(data)).read("a")


def test_plain_tags_build_the_tree_of_the_parser():
    bits = ["<p>", "</p>", "<b>", "<br>", "<br/>", "<hr />", '<a href="x">', "</a>", '<a HREF="x&amp;y">', "text ", "&amp; ", "&lt", "<", ">", '<td a="1" b="2">', "<tr>", "<table>", "</table>", "<script>", "</script>", "<!-- c -->", "<h1>", "</h1>", "<li>", "<ul>", "</ul>", "<P>", "<p/>", "</p/>", "<a disabled>", "\n"]
    pick, fast = random.Random(3), 0
    for _ in range(4000):
        source = "".join(pick.choices(bits, k=pick.randint(0, 12)))
        one, other = html._Builder(), html._Builder()
        end = source.rfind(">") + 1
        if html._fed(one, source[:end]):
            other.feed(source[:end])
            other.close()
            fast += 1
            assert one.root == other.root, source
    assert fast > 400


def test_rows_are_dealt_to_more_tasks_as_there_are_more(spark, monkeypatch):
    monkeypatch.setattr(documents, "TASK_ROWS", 10)
    made = documents.each(spark.range(1000).selectExpr("id"), "id long", lambda row: [row])
    assert made.rdd.getNumPartitions() == 100 and made.distinct().count() == 1000


def test_headings_resolve_what_their_sql_does(spark, tmp_path):
    import duckdb

    from tabweave import catalog
    texts = ["a &amp; b", "cut &amp", "say &quot;x&quot; &lt;y&gt;", "&#39;q&#39;", "nbsp\u00a0kept  here", "&ampx &copy", " &amp;lt; "]
    spark.createDataFrame([(i, f"<html><body><h1>{t}</h1><p>x</p></body></html>") for i, t in enumerate(texts)], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    duckdb.execute(f"create or replace view pages as select * from read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    want = duckdb.sql(catalog.ORACLES["html_headings"]).fetchall()
    assert sorted(map(tuple, catalog.QUERIES["html_headings"](spark, str(tmp_path)).collect())) == sorted(want)
    assert html.headings("<h2>say &quot;x&quot; &amp</h2>") == [(2, 'say "x" &')]


@pytest.mark.parametrize("numbered", [lambda k: True, lambda k: False, lambda k: k % 3000 == 1, lambda k: k < 40])
def test_rows_passed_over_are_counted(numbered, monkeypatch):
    rows = [f'<row{f" r=\"{k + 5}\"" if numbered(k) else ""}><c><v>{k}</v></c></row>' for k in range(1, 4001)]
    body = f'<worksheet><sheetData>{"".join(rows)}</sheetData></worksheet>'.encode()
    monkeypatch.setattr(datasource, "BLOCK", 9000)
    scans = []
    monkeypatch.setattr(datasource, "_rows_in", lambda run, tail, f=datasource._rows_in: scans.append(min(tail, len(run))) or f(run, tail))
    whole = [(n, e[0][0].text) for n, e in datasource.rows_of(io.BytesIO(body), 0, len(body), {})]
    cuts = [0, 30_000, 30_001, 90_000, len(body)]
    assert [x for a, b in zip(cuts, cuts[1:], strict=False) for x in [(n, e[0][0].text) for n, e in datasource.rows_of(io.BytesIO(body), a, b, {})]] == whole and len(whole) == 4000
    assert scans


@pytest.mark.parametrize("most", [1, 2, 5, 7, 33, 1000])
def test_pages_are_cut_without_python(spark, most):
    pick = random.Random(2)
    texts = [None, ""] + ["".join(pick.choices("ab\U0001f600。\n!\r  ;", k=pick.randint(0, 90))) for _ in range(60)]
    pages = outline.paged(spark.createDataFrame(list(enumerate(texts)), "id long, t string"), "id", "t", most)
    want = sorted((i, k, a, b, t[a:b]) for i, t in enumerate(texts) for k, (a, b) in enumerate(outline.page_spans(t or "", most), 1))
    assert sorted(map(tuple, pages.collect())) == want
    assert "Python" not in pages._jdf.queryExecution().toString()


def test_ranges_are_dealt_evenly(spark):
    from pyspark.sql import functions as F

    from tabweave.llm import lm
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = lm.dealt(spark.range(n * lm.RANGES * 3).select((F.col("id") % (n * lm.RANGES)).alias("part"))).groupBy(F.spark_partition_id().alias("at")).agg(F.countDistinct("part").alias("ranges"), F.min("part").alias("first")).collect()
    assert sorted((r["at"], r["ranges"], r["first"]) for r in found) == [(i, lm.RANGES, i * lm.RANGES) for i in range(n)]


def test_shared_parts_of_workbooks_are_parsed_once(monkeypatch):
    calls = []
    monkeypatch.setattr(ET, "fromstring", lambda x, f=ET.fromstring: calls.append(1) or f(x))
    assert [x for k in range(1, 31) for x in documents._dressed((k, "part", k % 50))] == [(k, "S", str(k % 50), 5.0 + k % 20, 25.0, 3, True) for k in range(1, 31)]
    assert len(calls) <= 30 + 10  # the sheet; before, the book, its styles and the sheet by each reader


def test_small_and_large_sheets_of_a_book():
    small, large = [["a", 1], ["b", True]], [[f"row {k}", k] for k in range(3000)]
    data = sinks.table_bytes([("First", small), ("Large", large), ("Last", small)], "xlsx")
    assert zipfile.ZipFile(io.BytesIO(data)).testzip() is None
    first, middle, last = sources.parse(data)
    assert [r[1] for r in first.rows] == [r[1] for r in last.rows] == [["a", "1"], ["b", "TRUE"]]
    assert [r[1] for r in middle.rows] == [[a, str(b)] for a, b in large] and [s.name for s in (first, middle, last)] == ["First", "Large", "Last"]


def test_a_book_is_read_the_same_again():
    shown = {k: [] for k in presentation.KINDS} | {"data_validation": [{"sheet": "S", "range": "B2:B9", "type": "whole", "operator": "greaterThan", "value": 1}]}
    data = sinks.table_bytes([("S", [["a", 1]])], "xlsx", shown=shown)
    assert presentation.read(data)[1]["data_validation"][0]["range"] == "B2:B9" and presentation.read(data) == presentation.read(data)
    assert sinks.built({"sheets": [{"name": "S", "header": True, "headerStyle": {"x": 1}, "rows": [["a"]]}]}) and presentation.read(sinks.built({"sheets": [{"name": "S", "rows": [["a"]]}]}))[2] == []
