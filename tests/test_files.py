import io
import zipfile
import zlib

import pytest

from tabweave.edit import document, rules, workbook
from tabweave.errors import EngineError
from tabweave.functions.values import Cell
from tabweave.sinks import workbook as sinks
from tabweave.sources import workbook as sources
from tabweave.sources.package import Package
from tabweave.sources.sniff import image_size, sniff
from tabweave.text import html, markdown, odt, outline, pdf, rtf, template
from tabweave.text.docx import Document, Writer
from tabweave.text.numbering import counter

SALES = [["产品", "数量", "单价"], ["键盘", 120, 199], ["鼠标", 300, 89.5], ["显示器", 45, 1299]]


def sheet_rows(data, name="x"):
    return [cells for _, cells, _ in sources.parse(data, name)[0].rows]


@pytest.mark.parametrize("kind", ["xlsx", "ods", "csv", "tsv"])
def test_round_trips(kind):
    data = sinks.table_bytes([("销售", SALES)], kind)
    assert sniff(data, f"a.{kind}") == kind
    assert sheet_rows(data, f"a.{kind}") == [["产品", "数量", "单价"], ["键盘", "120", "199"], ["鼠标", "300", "89.5"], ["显示器", "45", "1299"]]


def test_cells_on_writing_and_reading():
    data = sinks.xlsx([("S", [["date:2026-9-9", "num:1,234.5", "percent:12.5", "=SUM(A1:A2)", True, None, "x"]])])
    sheet = sources.parse(data)[0]
    assert sheet.rows[0][1] == ["2026-09-09", "1234.5", "0.125", "=SUM(A1:A2)", "TRUE", "", "x"] and sheet.rows[0][2][3] == "=SUM(A1:A2)"
    csv = "名称,值\na,=1+1\n\nb,\"1,200.50\"\n".encode()
    assert sheet_rows(csv, "a.csv") == [["名称", "值"], ["a", "=1+1"], ["b", "1,200.50"]]
    back = sources.parse(sinks.convert_table(csv, "a.csv", "xlsx"))[0]
    assert back.rows[1][1] == ["a", "=1+1"] and not any(back.rows[1][2])
    with pytest.raises(EngineError, match="XLS_WRITE_UNSUPPORTED"):
        sinks.table_bytes([("S", [])], "xls")


def test_query_over_files(spark, tmp_path):
    (tmp_path / "o.csv").write_text("harbour,tons\nOslo,\"3,400.25\"\nRiga,90\nOslo,600\n", encoding="utf-8")
    from tabweave.api import query
    out = query(spark, str(tmp_path / "o.csv"), {"groupBy": ["harbour"], "aggregate": [{"col": "tons", "fn": "sum", "as": "s"}]})
    assert [tuple(r) for r in out.df.collect()] == [("Oslo", 4000.25), ("Riga", 90.0)]
    lines = sources.window(sources.read_sheets(spark, str(tmp_path / "o.csv")), 2, 3, max_columns=1).collect()
    assert [r.line for r in lines] == ["Oslo", "Riga"]
    assert tuple(sources.summary(sources.read_sheets(spark, str(tmp_path / "o.csv"))).first())[2:] == (4, 2)


def test_containers():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, body in zip(*[iter([x for i in zipfile.ZipFile(io.BytesIO(sinks.xlsx([("S", [[1]])]))).infolist() for x in (i.filename.replace("/", "\\").upper() if "rels" not in i.filename else i.filename.replace("/", "\\"), zipfile.ZipFile(io.BytesIO(sinks.xlsx([("S", [[1]])]))).read(i.filename))])] * 2, strict=True):
            z.writestr(name, body)
    assert sniff(out.getvalue()) == "xlsx" and sheet_rows(out.getvalue()) == [["1"]]
    bomb = io.BytesIO()
    with zipfile.ZipFile(bomb, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("x", b"\0" * (8 << 20))
    with pytest.raises(EngineError, match="ZIP_BOMB"):
        Package(bomb.getvalue())
    assert image_size(b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + (40).to_bytes(4) + (20).to_bytes(4)) == ("png", 40, 20)
    assert image_size(b"GIF89a" + (10).to_bytes(2, "little") + (6).to_bytes(2, "little")) == ("gif", 10, 6)
    for bad in (b"%PDF-1.4", b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1"):
        with pytest.raises(EngineError, match="UNSUPPORTED_FORMAT"):
            sources.parse(bad, "x.xls")


MD = "# 周报\n\n**粗** 和 *斜* 与 [链接](https://e.org)\n\n- 一\n- 二\n  - 三\n\n1. a\n2. b\n\n| h1 | h2 |\n| --- | --- |\n| 1 | 2 |\n\n> 引用\n\n```\ncode # x\n```"


def test_markup():
    assert html.to_markdown(markdown.to_html(MD)) == MD
    assert html.to_markdown("<p>a<script>x</script><b>b</b> <a href='javascript:x'>c</a><p>d<hr>") == "a**b** c\n\nd\n\n---"
    assert html.links("<a href='http://a'>x  y</a><a href='data:z'>q</a>") == [("http://a", "x y")]
    for hostile in ("<" * 100_000, "<a " * 50_000, "<div>" * 50_000):
        html.to_markdown(hostile)


def test_rtf_odt():
    assert rtf.to_text(r"{\rtf1{\fonttbl{\f0 X;}}a\par b\tab c" + "\\u20013?" + r"\'e9{\*\generator g}\~}") == "a\nb\tc中é "
    text = "中文 {x} \\ é\n第二"
    assert rtf.to_text(rtf.from_text(text)) == text
    body = '<text:h text:outline-level="1">T</text:h><text:p>a<text:s text:c="3"/>b</text:p><text:list><text:list-item><text:p>i</text:p></text:list-item></text:list>'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("mimetype", "application/vnd.oasis.opendocument.text")
        z.writestr("content.xml", f'<office:document-content xmlns:office="urn:oasis:names:tc:opendocument:xmlns:office:1.0" xmlns:text="urn:oasis:names:tc:opendocument:xmlns:text:1.0"><office:body><office:text>{body}</office:text></office:body></office:document-content>')
    assert odt.to_html(out.getvalue()) == "<h1>T</h1><p>a   b</p><ul><li>i</li></ul>"


def test_docx_round_trip_and_edits():
    data = Writer(title="题", header="第 {page} 页", toc=2).bytes(markdown.to_html(MD))
    doc = Document(data)
    paras = doc.paragraphs()
    assert [p.text for p in paras if p.level] == ["周报"] and [p.number for p in paras if p.number] == ["•", "•", "•", "1.", "2."]
    assert "**粗** 和 *斜* 与 [链接](https://e.org)" in html.to_markdown(doc.to_html())
    at = next(p.index for p in paras if p.text.startswith("粗"))
    new, report = document.edited(data, [{"op": "replace_text", "find": "粗 和 斜", "replace": "好"}, {"op": "insert_paragraph", "position": "after", "index": at, "text": "新", "heading": 2}, {"op": "set_style", "scope": "headings", "style": {"size": 20, "font": "黑体"}},
                                         {"op": "insert_table_row", "table": 0, "values": ["3", "4"]}, {"op": "insert_table_column", "table": 0, "values": ["h3", "5", "6"]}, {"op": "delete_table_row", "table": 0, "at": 1}, {"op": "merge_table_cells", "table": 0, "range": "A1:B1"}, {"op": "set_numbering", "preset": "decimal"}, {"op": "delete_paragraph", "match": "没有", "optional": True}])
    after = Document(new).paragraphs()
    assert report[0] == {"op": "replace_text", "count": 1} and "skipped" in report[-1]
    heads = [(p.number, p.text, p.format.size, p.format.font) for p in after if p.level]
    assert heads == [("1", "周报", 20.0, "黑体"), ("1.1", "新", 20.0, "黑体")]
    assert [p.text for p in after if p.in_table] == ["h1", "h2", "h3", "3", "4", "6"]
    assert document.edited(new, [{"op": "delete_table", "all": True}, {"op": "set_paragraph", "match": "新", "text": "旧"}])[0] != new
    with pytest.raises(EngineError, match="PARAGRAPH_NOT_FOUND"):
        document.edited(data, [{"op": "set_paragraph", "index": 999, "text": "x"}])
    with pytest.raises(EngineError, match="TABLE_NOT_MERGED"):
        document.edited(data, [{"op": "unmerge_table_cells", "table": 0, "range": "A1:A1"}])


def test_counters():
    want = {("decimal", 7): "7", ("decimalZero", 7): "07", ("upperLetter", 28): "AB", ("chineseCounting", 10005): "一万零五", ("chineseCounting", 20030): "二万零三十", ("chineseCounting", 110): "一百一十", ("chineseCounting", 10): "十", ("lowerLetter", 3): "c", ("upperRoman", 14): "XIV", ("lowerRoman", 9): "ix", ("chineseCounting", 12): "十二", ("chineseCounting", 105): "一百零五", ("ordinal", 22): "22nd", ("cardinalText", 21): "Twenty-one", ("ordinalText", 12): "Twelfth", ("ideographTraditional", 2): "乙"}
    assert {k: counter(k[1], k[0]) for k in want} == want


def test_pages_and_outline(spark):
    text = "第一句。第二句！第三句？" + "x" * 60 + "。末尾"
    for most in (7, 20):
        spans = outline.page_spans(text, most)
        assert "".join(text[a:b] for a, b in spans) == text and all(b - a <= most for a, b in spans)
    assert outline.page_spans(text, 20)[0][1] == 12
    md = "# A\n```\n# no\n```\n####### no\n#no\n### C ###\n###### 六级"
    got = outline.outline(spark.createDataFrame([(1, md)], "id int, t string"), "id", "t").collect()
    assert [(r.level, r.title, r.offset) for r in got] == [(1, "A", 0), (3, "C ###", md.index("### C")), (6, "六级", md.index("###### 六"))]
    paged = outline.paged(spark.createDataFrame([(1, text)], "id int, t string"), "id", "t", 20).orderBy("page_no").collect()
    assert "".join(r.slice for r in paged) == text


def test_templates(spark):
    data = {"项目": {"名称": "P"}, "items": [{"名称": "a", "数量": 1}, {"名称": "b", "数量": 2.5}], "加急": False}
    assert template.fill("{项目.名称}:{#items}{名称}x{数量};{/items}{^加急}普通{/加急}", data) == "P:ax1;bx2.5;普通"
    with pytest.raises(EngineError, match="TEMPLATE_RENDER_FAILED"):
        template.fill("{#items}", data)
    df = spark.createDataFrame([(1, [("a", 1), ("b", 2)])], "id int, items array<struct<n:string,q:int>>")
    assert template.merged(df, "{id}:{#items}{n}={q} {/items}").first().text == "1:a=1 b=2 "
    doc = Writer().bytes("<p>{名}</p><p>{#items}</p><p>- {n}</p><p>{/items}</p>")
    assert [p.text for p in Document(template.fill_docx(doc, {"名": "甲", "items": [{"n": "1"}, {"n": "2"}]})).paragraphs()] == ["甲", "- 1", "- 2"]


def test_pdf():
    stream = zlib.compress(b"BT /F1 12 Tf 72 700 Td (Hello \\(x\\)) Tj 0 -14 Td [(Wo) -20 (rld)] TJ ET")
    raw = b"%%PDF-1.4\n1 0 obj<</Type/Pages/Kids[2 0 R]>>endobj\n2 0 obj<</Type/Page/Contents 3 0 R>>endobj\n3 0 obj<</Filter/FlateDecode/Length %d>>stream\n" % len(stream) + stream + b"\nendstream endobj"
    assert pdf.pages(raw) == ["Hello (x)\nWorld"] and pdf.joined(["a", "b"]) == "## Page 1\n\na\n\n## Page 2\n\nb"
    with pytest.raises(EngineError, match="PDF_ENCRYPTED"):
        pdf.pages(raw + b"/Encrypt 9 0 R")


def test_workbook_edits(spark):
    rows = spark.createDataFrame([("A", 1, 1, ["h1", "h2"], ["", ""]), ("A", 1, 2, ["1", "2"], ["", ""]), ("A", 1, 3, ["3", "4"], ["", "=A3+1"]), ("B", 2, 1, ["b"], [""])], "sheet string, sheet_no int, physical_row long, cells array<string>, formulas array<string>")
    book = workbook.edited(workbook.Workbook.of_sheets(rows), [{"op": "insert_rows", "at": 2}, {"op": "set_value", "cell": "C1", "value": "n"}, {"op": "set_formula", "cell": "C3", "formula": "A3*2"}, {"op": "delete_cols", "at": 2}, {"op": "add_sheet", "name": "C", "values": [["z"]]},
                                                                {"op": "rename_sheet", "sheet": "B", "name": "BB"}, {"op": "merge", "range": "A1:B2"}, {"op": "unmerge", "range": "A1:B2"}, {"op": "delete_sheet", "sheet": "nope", "optional": True}, {"op": "style_range", "range": "A1:A1", "style": {"bold": True}}, {"op": "data_validation", "range": "A1:A9", "type": "list", "values": ["a", "b"]}])
    assert book.sheets == ["A", "BB", "C"] and book.notes and book.shown["merge"] == [] and len(book.shown["data_validation"]) == 1
    assert book.rows("A") == [["h1", "n"], [], ["1", "=A3*2"], ["3"]] and book.rows("C") == [["z"]]
    assert workbook.rectangles([(1, 1), (1, 2), (2, 1), (2, 2), (4, 1)]) == [(1, 1, 2, 2), (4, 1, 4, 1)]
    assert workbook.range_ref("'My s'!B2:A1") == ("My s", 1, 1, 2, 2)
    with pytest.raises(EngineError, match="UNKNOWN_SHEET"):
        workbook.edited(book, [{"op": "set_value", "sheet": "x", "cell": "A1", "value": 1}])


def test_rules(spark):
    df = spark.createDataFrame([("10",), ("20",), ("x",), (None,)], "c string")
    c = Cell(df["c"], df.schema["c"].dataType)
    assert [r[0] for r in df.select(rules.valid(c, "whole", "between", 5, 15)).collect()] == [True, False, False, True]
    assert [r[0] for r in df.select(rules.cell_is(c, 10)).collect()] == [False, True, False, False]
    from datetime import date
    assert rules.period("lastMonth", date(2025, 1, 15)) == (date(2024, 12, 1), date(2025, 1, 1))


def _docx(markdown_text):
    from tabweave.text import markdown
    from tabweave.text.docx import Writer
    return Writer().bytes(markdown.to_html(markdown_text))


def test_table_styles():
    import re

    from tabweave.edit.document import Editor
    from tabweave.text.docx import w
    data = _docx("| a | b |\n| --- | --- |\n| 1 | a much longer cell |\n")
    new, report = document.edited(data, [{"op": "set_table", "table": 0, "borders": "three-line", "headerBold": True, "headerShading": "f2f2f2", "columnWidthMode": "auto", "align": "center", "rowHeightPt": 20, "repeatHeader": True, "cellVerticalAlign": "center", "cellMargins": {"top": 40}}])
    table = Editor(new).tables()[0]
    props = table.find(w("tblPr"))
    assert report == [{"op": "set_table", "count": 1}] and [e.get(w("val")) for e in props.find(w("tblBorders"))] == ["single", "nil", "single", "nil", "nil", "nil"]
    assert props.find(w("jc")).get(w("val")) == "center" and {e.tag.rpartition("}")[2]: e.get(w("w")) for e in props.find(w("tblCellMar"))} == {"top": "40", "left": "108", "bottom": "0", "right": "108"}
    head, body = table.findall(w("tr"))
    assert head.find(f"{w('trPr')}/{w('tblHeader')}") is not None and body.find(f"{w('trPr')}/{w('tblHeader')}") is None
    cells = head.findall(w("tc"))
    assert all(c.find(f"{w('tcPr')}/{w('shd')}").get(w("fill")) == "F2F2F2" for c in cells) and [int(c.find(f"{w('tcPr')}/{w('tcW')}").get(w("w"))) for c in cells] == [50 * 7, 50 * 93]
    assert re.search("vAlign", str([e.tag for e in body.iter()]))
    for bad in ({}, {"borders": "wavy"}, {"columnWidths": [1]}, {"columnWidthMode": "manual"}, {"headerBold": "yes"}):
        with pytest.raises(EngineError, match="INVALID_ARGS"):
            document.edited(data, [{"op": "set_table", "table": 0, **bad}])


def test_column_spans():
    data = _docx("| a | b | c |\n| --- | --- | --- |\n| 1 | 2 | 3 |\n")
    texts = lambda d: [["".join(document.text_of(p) for p in c.iter(document.w("p"))) for c in r.findall(document.w("tc"))] for r in document.Editor(d).tables()[0].findall(document.w("tr"))]
    merged, _ = document.edited(data, [{"op": "merge_table_cells", "table": 0, "range": "A1:B1"}, {"op": "insert_table_column", "table": 0, "at": 1, "values": ["x", "y"]}])
    assert texts(merged) == [["ab", "c"], ["1", "y", "2", "3"]]
    fewer, _ = document.edited(merged, [{"op": "delete_table_column", "table": 0, "at": 2}])
    assert texts(fewer) == [["ab", "c"], ["1", "y", "3"]]


def test_styles_by_scope():
    data = _docx("# one\n\ntext\n\n## two\n\n- item\n\n| h |\n| --- |\n| c |\n")
    looks = lambda d: [(p.text, p.format.size, p.format.align, p.format.line, p.format.first_line) for p in Document(d).paragraphs() if p.text]
    plain = looks(data)
    new, report = document.edited(data, [{"op": "set_style", "scope": "body", "sizePt": 9, "align": "justify", "lineSpacingPt": 20, "firstLineIndentChars": 2}, {"op": "set_style", "scope": "h2", "align": "center"}, {"op": "set_style", "scope": "标题1", "lineSpacingMultiple": 1.5}, {"op": "set_style", "match": "item", "sizePt": 30}])
    assert [r["count"] for r in report] == [5, 1, 1, 1]
    got = looks(new)
    assert got[0][:3] == plain[0][:3] and got[0][3] == 1.5 and got[1][1:] == (9, "both", 20, 18) and got[2][2] == "center" and got[3][1] == 30 and [g[1] for g in got[4:]] == [9, 9]
    for bad, code in (({"scope": "nope", "bold": True}, "INVALID_ARGS"), ({"scope": "body"}, "INVALID_ARGS"), ({"scope": "heading7", "bold": True}, "PARAGRAPH_NOT_FOUND"), ({"scope": "all", "sizePt": 900}, "INVALID_ARGS"), ({"scope": "all", "lineSpacingPt": 9, "lineSpacingMultiple": 1}, "INVALID_ARGS")):
        with pytest.raises(EngineError) as e:
            document.edited(data, [{"op": "set_style", **bad}])
        assert e.value.code == code


def test_numbering_without_a_part():
    import io
    import zipfile
    data, out = _docx("# a\n\n- one\n- two\n\n## b\n\n- three\n\n# c\n"), io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(data)) as src, zipfile.ZipFile(out, "w") as dst:
        for i in src.infolist():
            body = src.read(i)
            if "numbering" in i.filename:
                continue
            if i.filename.endswith("document.xml.rels"):
                body = body[:body.index(b'<Relationship Id="numbering"')] + body[body.index(b"/>", body.index(b'<Relationship Id="numbering"')) + 2:]
            dst.writestr(i.filename, body)
    for source in (data, out.getvalue()):
        for script in ([{"op": "set_numbering"}], [{"op": "set_numbering", "startFrom": 5}, {"op": "set_numbering"}]):
            new, report = document.edited(source, script)
            assert [(p.number, p.text) for p in Document(new).paragraphs() if p.text] == [("1", "a"), ("1.1", "one"), ("1.2", "two"), ("1.3", "b"), ("1.3.1", "three"), ("2", "c")]
            assert report[-1] == {"op": "set_numbering", "headings": 3, "items": 3, "skipped": 0}
    new, report = document.edited(data, [{"op": "set_numbering", "preset": "chinese", "exclude": ["Heading1"]}])
    assert [(p.number, p.text) for p in Document(new).paragraphs() if p.text][3:5] == [("一、", "b"), ("（一）", "three")] and report[-1] == {"op": "set_numbering", "headings": 1, "items": 1, "skipped": 2}


def test_measures_of_styles():
    from tabweave.text import style
    assert [style.length(x, 24) for x in ("12pt", "16px", "2em", "1.5ch", "3", "x", None)] == [240, 240, 480, 360, 60, None, None]
    assert style.column_percents([1, 1, 200]) == [5, 5, 90] and style.column_percents([]) == [100] and style.shares([1, 3]) == [25, 75]
    css = style.declarations("font-family: 'A B', C; font-size:12pt; font-weight:700; COLOR:#abc; text-decoration: underline line-through; margin: 6pt 0 3pt; line-height:1.5; text-align:justify; text-indent:2em")
    assert style.css_run(css) == {"font": "A B", "ascii": "C", "size": 24, "bold": True, "underline": True, "strike": True, "color": "AABBCC"}
    assert style.css_paragraph(css, 24) == {"before": 120, "after": 60, "multiple": 360, "align": "both", "first": 480}
    assert style.fitted(1600, 400) == (600, 150) and style.fitted(40, 20, want_width=80) == (80, 40) and style.fitted(200, 300, want_height=2000) == (600, 900)
    assert [style.shown_bytes(n) for n in (None, 5, 2048, 3 << 20)] == ["", "5 B", "2.0 KB", "3.0 MB"]


def test_large_document_within_budget():
    """10,000 paragraphs: parsing, each edit and saving within the budget of 900 ms."""
    import time
    data = _docx("\n\n".join(f"# head {i}\n\nalpha {i}\n\nbeta {i}\n\ngamma {i}" for i in range(2500)))
    for step in ({"op": "set_style", "scope": "all", "sizePt": 12, "font": "X"}, {"op": "set_numbering"}, {"op": "replace_text", "find": "alpha", "replace": "omega"}):
        began = time.process_time()
        document.edited(data, [step])
        assert time.process_time() - began < 0.9, step["op"]


def test_workbook_edits_survive_saving(spark, tmp_path):
    import zipfile

    from tabweave import api
    from tabweave.sinks import presentation
    path = str(tmp_path / "b.xlsx")
    api.write_xlsx(path, {"sheets": [{"name": "A", "header": True, "rows": [["k", "v", "when"], ["x", 10, "date:2026-01-05"], [{"value": "y", "style": {"italic": True, "fill": "ffff00"}}, 30, None]], "rowHeights": [30]}, {"name": "Empty"}]})
    script = [{"op": "merge", "range": "A5:B6"}, {"op": "freeze", "rows": 1}, {"op": "auto_filter", "range": "A1:C3"}, {"op": "set_col_width", "col": "B", "width": 22}, {"op": "set_row_height", "row": 3, "height": 40},
              {"op": "style_range", "range": "B2:B3", "style": {"bold": True, "numFmt": "0.00"}}, {"op": "conditional_format", "range": "B2:B3", "rules": [{"type": "cellIs", "operator": "between", "value": 5, "value2": 20, "style": {"fill": "FF0000"}}, {"type": "iconSet"}, {"type": "colorScale", "colors": ["F00", "0F0", "00F"]}, {"type": "top10", "rank": 3}]},
              {"op": "data_validation", "range": "A2:A9", "type": "list", "values": ["x", "y"]}, {"op": "set_value", "cell": "B2", "value": "11"}]
    assert api.edit_xlsx(spark, path, script) == []
    assert api.edit_xlsx(spark, path, [{"op": "insert_rows", "at": 1, "count": 2}]) == []  # all of it, read from the file and moved
    names, shown, styled, notes = presentation.read(open(path, "rb").read())
    assert names == ["A", "Empty"] and not notes and [m["range"] for m in shown["merge"]] == ["A7:B8"] and shown["freeze"] == [{"sheet": "A", "rows": 1, "cols": 0}]
    assert shown["auto_filter"][0]["range"] == "A3:C5" and {o["col"]: o["width"] for o in shown["col_width"]}[2] == 22 and {o["row"]: o["height"] for o in shown["row_height"]} == {3: 30, 5: 40}
    assert [len(o["rules"]) for o in shown["conditional_format"]] == [4] and shown["conditional_format"][0]["range"] == "B4:B5" and "FFFF0000" in shown["conditional_format"][0]["rules"][0]["dxf"]
    assert shown["data_validation"][0]["range"] == "A4:A11" and '"x,y"' in shown["data_validation"][0]["raw"].replace("&quot;", '"')
    looks = {(r, c): s for _, r, c, s in styled}
    assert '"b"' in looks[3, 1] and '"0.00"' in looks[4, 2] and '"i"' in looks[5, 1] and "FFFFFF00" in looks[5, 1]
    rows = {n: [r[1] for r in s.rows] for n, s in ((s.name, s) for s in sources.parse(open(path, "rb").read()))}
    assert rows["A"] == [["k", "v", "when"], ["x", "11", "2026-01-05"], ["y", "30"]] and rows["Empty"] == []
    assert zipfile.ZipFile(path).testzip() is None
    for bad in ({"op": "conditional_format", "range": "A1:A2", "type": "nope"}, {"op": "conditional_format", "range": "x", "type": "dataBar"}, {"op": "data_validation", "range": "A1", "type": "list"}, {"op": "style_range", "range": "A1", "style": {"fill": "red"}}):
        with pytest.raises(EngineError, match="INVALID_ARGS"):
            api.edit_xlsx(spark, path, [bad])


def test_moved_ranges():
    from tabweave.sinks.presentation import shifted
    assert [shifted("B2:C5", "row", *x) for x in ((1, 2, True), (3, 1, True), (6, 1, True), (2, 4, False), (4, 9, False), (1, 1, False))] == ["B4:C7", "B2:C6", "B2:C5", None, "B2:C3", "B1:C4"]
    assert shifted("A1 C3", "col", 2, 1, True) == "A1 D3"
