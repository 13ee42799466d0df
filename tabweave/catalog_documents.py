"""Registered queries over real files: documents, workbooks and pages that tasks write from the rows of a table, and read back.

Each query makes a file for every row, runs it through the writers, editors and readers, and returns what they found;
the SQL says the same from the rows themselves."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tabweave.catalog import read, register
from tabweave.edit import document, workbook
from tabweave.operators import aggregate
from tabweave.operators.render import rendered
from tabweave.plans.query import compiled
from tabweave.plans.table import Table
from tabweave.sinks import presentation
from tabweave.sinks import workbook as sinks
from tabweave.sources import workbook as sources
from tabweave.sources.package import normal_name, xml_bytes
from tabweave.sources.sniff import extension, image_size
from tabweave.text import html, markdown, numbering, odt, outline, pdf, rtf, style, template
from tabweave.text.docx import Document, Writer


#: Rows of a task, which take milliseconds each.
TASK_ROWS = 10_000


def each(df: DataFrame, schema: str, of: Callable[[tuple], list[tuple]], slice_rows: int = 256) -> DataFrame:
    """of: the result rows of a row, in tasks. A row takes milliseconds there, so rows are dealt out however few files they come from, and to more tasks as there are more rows."""
    kinds = to_arrow_schema(T._parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, slice_rows):
                rows = [out for row in zip(*(c.slice(i, slice_rows).to_pylist() for c in batch.columns), strict=True) for out in of(row)]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(kinds)], kinds.names)
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // TASK_ROWS))
    return df.repartition(tasks).mapInArrow(run, schema)


def customers(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")


def letter(row: tuple) -> str:
    """A document of a customer in Markdown."""
    key, name, nation, segment = row
    return (f"# Customer {key}\n\nSegment **{segment}** of nation *{nation}*, see [page](https://example.com/{key}).\n\n## Account\n\n- name {name}\n  - nation {nation}\n- segment {segment}\n\n"
            f"| key | value |\n| --- | --- |\n| nation | {nation} |\n| segment | {segment} |\n\n> quoted {key}\n\n```\ncode {key}\n```\n")


def letter_file(row: tuple) -> bytes:
    return Writer().bytes(markdown.to_html(letter(row)))


#: The letter's paragraphs in SQL: index, text, level, in_table, number.
_PARAGRAPHS = (
    ("'Customer ' || c_custkey", 1, False, ""), ("'Segment ' || c_mktsegment || ' of nation ' || c_nationkey || ', see page.'", None, False, ""), ("'Account'", 2, False, ""), ("'name ' || c_name", None, False, "•"), ("'nation ' || c_nationkey", None, False, "•"),
    ("'segment ' || c_mktsegment", None, False, "•"), ("'key'", None, True, ""), ("'value'", None, True, ""), ("'nation'", None, True, ""), ("CAST(c_nationkey AS VARCHAR)", None, True, ""), ("'segment'", None, True, ""), ("c_mktsegment", None, True, ""), ("''", None, False, ""),
    ("'quoted ' || c_custkey", None, False, ""), ("'code ' || c_custkey", None, False, ""),
)


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


_sql_bool = lambda b: "true" if b else "false"
register("docx_paragraphs", lambda s, d: each(customers(s, d), "c_custkey long, index int, text string, level int, in_table boolean, number string",
                                              lambda row: [(row[0], p.index, p.text, p.level, p.in_table, p.number) for p in Document(letter_file(row)).paragraphs()]),
         _union([f"SELECT c_custkey, CAST({i} AS INTEGER) AS index, {t} AS text, CAST({'NULL' if n is None else n} AS INTEGER) AS level, {_sql_bool(inside)} AS in_table, '{number}' AS number FROM customer" for i, (t, n, inside, number) in enumerate(_PARAGRAPHS)]))
register("docx_runs", lambda s, d: each(customers(s, d), "c_custkey long, text string, bold boolean, italic boolean", lambda row: [(row[0], t, bool(f.bold), bool(f.italic)) for t, f, _ in Document(letter_file(row)).paragraphs()[1].runs]),
         _union([f"SELECT c_custkey, {t} AS text, {b} AS bold, {i} AS italic FROM customer" for t, b, i in (("'Segment '", "false", "false"), ("c_mktsegment", "true", "false"), ("' of nation '", "false", "false"), ("CAST(c_nationkey AS VARCHAR)", "false", "true"), ("', see '", "false", "false"), ("'page'", "false", "false"), ("'.'", "false", "false"))]))
_MARKDOWN = ("'# Customer ' || c_custkey || '{n}{n}Segment **' || c_mktsegment || '** of nation *' || c_nationkey || '*, see [page](https://example.com/' || c_custkey || ').{n}{n}## Account{n}{n}- name ' || c_name || '{n}  - nation ' || c_nationkey || '{n}- segment ' || c_mktsegment"
             " || '{n}{n}| key | value |{n}| --- | --- |{n}| nation | ' || c_nationkey || ' |{n}| segment | ' || c_mktsegment || ' |{n}{n}> quoted ' || c_custkey || '{n}{n}```{n}code ' || c_custkey || '{n}```'").replace("{n}", "' || chr(10) || '")
register("markdown_html_markdown", lambda s, d: each(customers(s, d), "c_custkey long, text string", lambda row: [(row[0], html.to_markdown(markdown.to_html(letter(row))))]), f"SELECT c_custkey, {_MARKDOWN} AS text FROM customer")
register("docx_links", lambda s, d: each(customers(s, d), "c_custkey long, href string, text string", lambda row: [(row[0], *x) for x in html.links(Document(letter_file(row)).to_html())]), "SELECT c_custkey, 'https://example.com/' || c_custkey AS href, 'page' AS text FROM customer")
register("docx_outline", lambda s, d: outline.outline(each(customers(s, d), "c_custkey long, text string", lambda row: [(row[0], html.to_markdown(Document(letter_file(row)).to_html()))]), "c_custkey", "text").select("c_custkey", "level", "title"),
         _union([f"SELECT c_custkey, CAST({n} AS INTEGER) AS level, {t} AS title FROM customer" for n, t in ((1, "'Customer ' || c_custkey"), (2, "'Account'"))]))


def _page_setup(row: tuple) -> list[tuple]:
    """Title, size, orientation, fields of header and footer and the field for the contents, as a package has them."""
    data = Writer(title=f"T{row[0]}", landscape=row[0] % 2 == 0, margins_mm=20, header="p {page} of {total}", footer=f"f{row[0]}", toc=2).bytes("<h1>x</h1><p>a<sub>1</sub><u>b</u><a href='javascript:x'>c</a></p><hr>")
    pack = zipfile.ZipFile(io.BytesIO(data))
    body, head, foot = (pack.read(f"word/{n}.xml").decode() for n in ("document", "header1", "footer1"))
    return [(row[0], 'w:orient="landscape"' in body, f'w:top="{int(20 * 56.7)}"' in body, 'TOC \\o "1-2"' in body, "PAGE" in head and "NUMPAGES" in head, f"f{row[0]}" in foot, Document(data).paragraphs()[0].text, "javascript" in body, "subscript" in body and 'w:u w:val="single"' in body)]


register("docx_page_setup", lambda s, d: each(customers(s, d), "c_custkey long, landscape boolean, margin boolean, toc boolean, header boolean, footer boolean, title string, unsafe boolean, marks boolean", _page_setup),
         "SELECT c_custkey, c_custkey % 2 = 0 AS landscape, true AS margin, true AS toc, true AS header, true AS footer, 'T' || c_custkey AS title, false AS unsafe, true AS marks FROM customer")

# Edits of documents.
_EDITS = [{"op": "replace_text", "find": "nation", "replace": "land", "limit": 2}, {"op": "set_paragraph", "index": 2, "text": "Facts"}, {"op": "insert_paragraph", "position": "after", "index": 2, "text": "inserted", "heading": 3}, {"op": "delete_paragraph", "match": "key"},
          {"op": "insert_table_row", "table": 0, "at": 1, "values": ["new", "row"]}, {"op": "insert_table_column", "table": 0, "values": ["c", "1", "2", "3"]}, {"op": "delete_table_row", "table": 0, "at": 3}, {"op": "delete_table_column", "table": 0, "at": 1},
          {"op": "delete_paragraph", "match": "nowhere", "optional": True}]


def _edited(row: tuple) -> list[tuple]:
    file = letter_file(row)
    data, report = document.edited(file, _EDITS)
    kept, _ = document.edited(file, _EDITS, dry_run=True)
    return [(row[0], p.index, p.text, p.level, report[0]["count"], "skipped" in report[-1], kept == file) for p in Document(data).paragraphs()]


_EDITED = (("'Customer ' || c_custkey", 1), ("'Segment ' || c_mktsegment || ' of land ' || c_nationkey || ', see page.'", None), ("'Facts'", 2), ("'inserted'", 3), ("'name ' || c_name", None), ("'land ' || c_nationkey", None), ("'segment ' || c_mktsegment", None),
           ("''", None), ("'c'", None), ("'new'", None), ("'1'", None), ("'nation'", None), ("'2'", None), ("''", None), ("'quoted ' || c_custkey", None), ("'code ' || c_custkey", None))
register("docx_edits", lambda s, d: each(customers(s, d), "c_custkey long, index int, text string, level int, replaced int, skipped boolean, dry boolean", _edited),
         _union([f"SELECT c_custkey, CAST({i} AS INTEGER) AS index, {t} AS text, CAST({'NULL' if n is None else n} AS INTEGER) AS level, CAST(2 AS INTEGER) AS replaced, true AS skipped, true AS dry FROM customer" for i, (t, n) in enumerate(_EDITED)]))


def _styled(row: tuple) -> list[tuple]:
    size = 10 + row[0] % 5
    data, report = document.edited(letter_file(row), [{"op": "set_style", "scope": "body", "sizePt": size, "font": "Liberation", "align": "justify", "lineSpacingPt": 18, "firstLineIndentChars": 2}, {"op": "set_style", "scope": "h2", "color": "#a0b0c0", "underline": True, "spacingBeforePt": 6}])
    return [(row[0], p.index, p.format.size, p.format.font, p.format.align, p.format.line, p.format.first_line, p.format.color, bool(p.format.underline), p.format.before, report[0]["count"], report[1]["count"]) for p in Document(data).paragraphs() if p.index in (1, 2, 6)]


register("docx_styles", lambda s, d: each(customers(s, d), "c_custkey long, index int, size double, font string, align string, line double, first_line double, color string, underline boolean, before double, body int, h2 int", _styled),
         _union([f"SELECT c_custkey, CAST({i} AS INTEGER) AS index, CAST(10 + c_custkey % 5 AS DOUBLE) AS size, 'Liberation' AS font, 'both' AS align, CAST(18 AS DOUBLE) AS line, CAST(2 * (10 + c_custkey % 5) AS DOUBLE) AS first_line, CAST(NULL AS VARCHAR) AS color, false AS underline, CAST(NULL AS DOUBLE) AS before, CAST(13 AS INTEGER) AS body, CAST(1 AS INTEGER) AS h2 FROM customer" for i in (1, 6)]
                + ["SELECT c_custkey, CAST(2 AS INTEGER), CAST(15 AS DOUBLE), 'Calibri', NULL, NULL, NULL, 'A0B0C0', true, CAST(6 AS DOUBLE), CAST(13 AS INTEGER), CAST(1 AS INTEGER) FROM customer"]))


def _tables(row: tuple) -> list[tuple]:
    data, report = document.edited(letter_file(row), [{"op": "set_table", "table": 0, "borders": "three-line", "headerShading": "EEEEEE", "headerBold": True, "columnWidths": [1, 3], "align": "center"}, {"op": "merge_table_cells", "table": 0, "range": "A2:A3"}])
    undone, _ = document.edited(data, [{"op": "unmerge_table_cells", "table": 0, "range": "A2:A3"}])
    none, _ = document.edited(data, [{"op": "delete_table", "all": True}])
    table = document.Editor(data).tables()[0]
    grid = [len(r.findall(document.w("tc"))) for r in table.findall(document.w("tr"))]
    xml = xml_bytes(table).decode()
    return [(row[0], report[0]["count"], len(grid), max(grid), "EEEEEE" in xml, "1250" in xml and "3750" in xml, xml.count("vMerge"), xml_bytes(document.Editor(undone).tables()[0]).count(b"vMerge"), len(document.Editor(none).tables()))]


register("docx_tables", lambda s, d: each(customers(s, d), "c_custkey long, styled int, rows int, cols int, shaded boolean, widths boolean, merged int, undone int, left int", _tables),
         "SELECT c_custkey, CAST(1 AS INTEGER) AS styled, CAST(3 AS INTEGER) AS rows, CAST(2 AS INTEGER) AS cols, true AS shaded, true AS widths, CAST(2 AS INTEGER) AS merged, CAST(0 AS INTEGER) AS undone, CAST(0 AS INTEGER) AS left FROM customer")


def _numbered(row: tuple) -> list[tuple]:
    once, _ = document.edited(letter_file(row), [{"op": "set_numbering", "startFrom": 1 + row[0] % 3}])
    again, _ = document.edited(once, [{"op": "set_numbering", "startFrom": 1 + row[0] % 3}])
    doc = Document(again)
    shown = html.to_markdown(doc.to_html())
    return [(row[0], p.index, p.number, shown.count(f"{p.number} ") > 0) for p in doc.paragraphs() if p.number]


register("docx_numbering", lambda s, d: each(customers(s, d), "c_custkey long, index int, number string, expanded boolean", _numbered),
         _union([f"SELECT c_custkey, CAST({i} AS INTEGER) AS index, {n} AS number, true AS expanded FROM customer" for i, n in ((0, "CAST(1 + c_custkey % 3 AS VARCHAR)"), (2, "(1 + c_custkey % 3) || '.1'"), *((k, f"(1 + c_custkey % 3) || '.1.{j}'") for j, k in enumerate((3, 4, 5), 1)))]))
register("docx_template", lambda s, d: each(customers(s, d), "c_custkey long, index int, text string", lambda row: [(row[0], p.index, p.text) for p in Document(template.fill_docx(Writer().bytes("<p>Dear {name},</p><p>{#items}</p><p>item {no}: {of.seg}</p><p>{/items}</p><p>{^none}no more{/none}</p>"),
                                                                                                         {"name": row[1], "items": [{"no": k, "of": {"seg": row[3]}} for k in range(2)], "none": []})).paragraphs()]),
         _union([f"SELECT c_custkey, CAST({i} AS INTEGER) AS index, {t} AS text FROM customer" for i, t in enumerate(("'Dear ' || c_name || ','", "'item 0: ' || c_mktsegment", "'item 1: ' || c_mktsegment", "'no more'"))]))

# Other formats.
register("rtf_roundtrip", lambda s, d: each(read(s, d, "documents").select("doc_id", "text"), "doc_id long, digest string", lambda row: [(row[0], _digest(rtf.to_text(rtf.from_text(row[1] or ""))))]), "SELECT doc_id, md5(trim(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), chr(10))) AS digest FROM documents")
register("text_html_text", lambda s, d: each(read(s, d, "documents").select("doc_id", "text"), "doc_id long, paragraphs long", lambda row: [(row[0], html.from_text(row[1] or "").count("<p>"))]),
         "SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), '\\n{2,}'), lambda x: regexp_matches(x, '[^\\s]'))) AS BIGINT) AS paragraphs FROM documents")


def _digest(value: str) -> str:
    import hashlib
    return hashlib.md5(value.encode("utf-8", "surrogatepass")).hexdigest()


def odt_file(row: tuple) -> bytes:
    key, name, nation, segment = row
    spaces = " ".join(f'xmlns:{k}="urn:oasis:names:tc:opendocument:xmlns:{v}:1.0"' for k, v in (("office", "office"), ("text", "text"), ("table", "table"))) + ' xmlns:xlink="http://www.w3.org/1999/xlink"'
    body = (f'<text:h text:outline-level="1">Customer {key}</text:h><text:p>Name<text:s text:c="1"/>{escape(name)}<text:note><text:note-body><text:p>gone</text:p></text:note-body></text:note> at <text:a xlink:href="https://example.com/{key}">home</text:a></text:p>'
            f"<text:list><text:list-item><text:p>nation {nation}</text:p></text:list-item></text:list><table:table><table:table-row><table:table-cell><text:p>segment</text:p></table:table-cell><table:table-cell><text:p>{escape(segment)}</text:p></table:table-cell></table:table-row></table:table>")
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("mimetype", "application/vnd.oasis.opendocument.text")
        z.writestr("content.xml", f'<?xml version="1.0" encoding="UTF-8"?><office:document-content {spaces}><office:body><office:text>{body}</office:text></office:body></office:document-content>')
    return out.getvalue()


register("odt_markdown", lambda s, d: each(customers(s, d), "c_custkey long, text string", lambda row: [(row[0], html.to_markdown(odt.to_html(odt_file(row))))]),
         "SELECT c_custkey, '# Customer ' || c_custkey || chr(10) || chr(10) || 'Name ' || c_name || ' at [home](https://example.com/' || c_custkey || ')' || chr(10) || chr(10) || '- nation ' || c_nationkey || chr(10) || chr(10) || '| segment | ' || c_mktsegment || ' |' || chr(10) || '| --- | --- |' AS text FROM customer")


def pdf_file(pages: list[list[str]]) -> bytes:
    """Pages of lines, every other content stream compressed."""
    import zlib

    objects = [b"<< /Type /Catalog /Pages 2 0 R >>", b""]
    kids = []
    for k, lines in enumerate(pages):
        text = b"BT /F1 12 Tf 72 720 Td " + b" 0 -14 Td ".join(b"(" + x.replace("\\", r"\\").replace("(", r"\(").replace(")", r"\)").encode("cp1252", "replace") + b") Tj" for x in lines) + b" ET"
        head = b"/Filter /FlateDecode " if k % 2 else b""
        stream = zlib.compress(text) if k % 2 else text
        kids.append(len(objects) + 1)
        objects += [b"<< /Type /Page /Parent 2 0 R /Contents %d 0 R >>" % (len(objects) + 2), b"<< %s/Length %d >>\nstream\n%s\nendstream" % (head, len(stream), stream)]
    objects[1] = b"<< /Type /Pages /Kids [%s] /Count %d >>" % (b" ".join(b"%d 0 R" % k for k in kids), len(kids))
    return b"%PDF-1.4\n" + b"".join(b"%d 0 obj\n%s\nendobj\n" % (i, o) for i, o in enumerate(objects, 1)) + b"%%EOF\n"


register("pdf_pages", lambda s, d: each(customers(s, d), "c_custkey long, text string", lambda row: [(row[0], pdf.joined(pdf.pages(pdf_file([[f"Customer ({row[0]})", row[1]], [f"Segment {row[3]}"]]))))]),
         "SELECT c_custkey, '## Page 1' || chr(10) || chr(10) || 'Customer (' || c_custkey || ')' || chr(10) || c_name || chr(10) || chr(10) || '## Page 2' || chr(10) || chr(10) || 'Segment ' || c_mktsegment AS text FROM customer")
register("pdf_outline", lambda s, d: outline.outline(each(customers(s, d), "c_custkey long, text string", lambda row: [(row[0], pdf.joined(pdf.pages(pdf_file([["a"], ["b"], ["c"]]))))]), "c_custkey", "text").select("c_custkey", "title"),
         _union([f"SELECT c_custkey, 'Page {n}' AS title FROM customer" for n in (1, 2, 3)]))

# Workbooks.
def _books(spark: SparkSession, d: str) -> DataFrame:
    """A workbook for each nation: a sheet of suppliers with a formula each, and one of its name."""
    rows = read(spark, d, "supplier").groupBy("s_nationkey").agg(F.array_sort(F.collect_list("s_suppkey")).alias("keys"))  # a few hundred at any size tested; a sheet holds them
    return each(rows, "path string, content binary", lambda row: [(f"n{row[0]}.xlsx", sinks.table_bytes([("Suppliers", [["key", "twice"], *([k, f"=A{i}*2"] for i, k in enumerate(row[1], 2))]), ("Name", [["nation"], [f"N{row[0]}"]])], "xlsx"))])


def _first_book(spark: SparkSession, d: str) -> DataFrame:
    first = read(spark, d, "supplier").agg(F.min("s_nationkey")).first()[0]
    return sources.parsed_sheets(_books(spark, d).where(F.col("path") == f"n{first}.xlsx"))


def _cells(mode: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, d: str) -> DataFrame:
        sheets = sources.parsed_sheets(_books(spark, d)).where("sheet = 'Suppliers' AND row_no > 1")
        shown = {"value": F.col("cells")[0], "formula": F.col("formulas")[1], "both": F.concat_ws(" ", F.col("cells")[0], F.col("formulas")[1])}[mode]
        return sheets.select(F.substring_index("path", ".", 1).alias("nation"), "physical_row", shown.alias("shown"))
    return run


_ROWS = "(SELECT s_nationkey, s_suppkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) + 1 AS r FROM supplier)"
for _mode, _sql in (("value", "CAST(s_suppkey AS VARCHAR)"), ("formula", "'=A' || r || '*2'"), ("both", "s_suppkey || ' =A' || r || '*2'")):
    register(f"xlsx_cells_{_mode}", _cells(_mode), f"SELECT 'n' || s_nationkey AS nation, CAST(r AS BIGINT) AS physical_row, {_sql} AS shown FROM {_ROWS}")
register("xlsx_summary", lambda s, d: sources.parsed_sheets(_books(s, d)).groupBy("path", "sheet").agg(F.max("physical_row").alias("rows"), F.max(F.size("cells")).cast("long").alias("cols")),
         "SELECT 'n' || s_nationkey || '.xlsx' AS path, 'Suppliers' AS sheet, count(*) + 1 AS rows, CAST(2 AS BIGINT) AS cols FROM supplier GROUP BY ALL UNION ALL SELECT 'n' || s_nationkey || '.xlsx', 'Name', 2, 1 FROM supplier GROUP BY ALL")
register("xlsx_sheet_picked", lambda s, d: sources.pick(sources.parsed_sheets(_books(s, d)), "Name").where("row_no = 2").select("path", F.col("cells")[0].alias("name")).unionByName(sources.pick(sources.parsed_sheets(_books(s, d)), 2).where("row_no = 1").select("path", F.col("cells")[0].alias("name"))),
         "SELECT 'n' || s_nationkey || '.xlsx' AS path, 'N' || s_nationkey AS name FROM supplier GROUP BY ALL UNION ALL SELECT 'n' || s_nationkey || '.xlsx', 'nation' FROM supplier GROUP BY ALL")
register("sheet_window", lambda s, d: sources.window(_first_book(s, d), 2, 4, max_rows=2, mode="both").select("sheet", "row", "line"),
         "SELECT sheet, row, line FROM (SELECT 1 AS no, 'Suppliers' AS sheet, CAST(r AS BIGINT) AS row, s_suppkey || chr(9) || '=A' || r || '*2' AS line FROM " + _ROWS + " WHERE s_nationkey = (SELECT min(s_nationkey) FROM supplier) AND r BETWEEN 2 AND 4 UNION ALL SELECT 2, 'Name', 2, 'N' || min(s_nationkey) FROM supplier) ORDER BY no, row LIMIT 2")


def _dressed(row: tuple) -> list[tuple]:
    key, name, size = row
    data = sinks.built({"sheets": [{"name": "S", "header": True, "rows": [["k", "v"], [key, {"value": size, "style": {"bold": True, "fill": "FFFF00", "numFmt": "0.0"}}]], "columnWidths": [10, 5 + size % 20], "rowHeights": [25]}]})
    names, shown, styled, _ = presentation.read(data)
    rows = sources.parse(data)[0].rows
    return [(key, names[0], rows[1][1][1], shown["col_width"][1]["width"], shown["row_height"][0]["height"], len(styled), '"0.0"' in styled[-1][3])]


register("xlsx_styles", lambda s, d: each(read(s, d, "part").select("p_partkey", "p_name", "p_size"), "p_partkey long, sheet string, value string, width double, height double, styled int, format boolean", _dressed),
         "SELECT p_partkey, 'S' AS sheet, CAST(p_size AS VARCHAR) AS value, CAST(5 + p_size % 20 AS DOUBLE) AS width, CAST(25 AS DOUBLE) AS height, CAST(3 AS INTEGER) AS styled, true AS format FROM part")


def _part_sheet(spark: SparkSession, d: str) -> workbook.Workbook:
    cell = lambda col, value: F.struct(F.lit("Sheet1").alias("sheet"), F.col("p_partkey").alias("row"), F.lit(col).cast("long").alias("col"), value.cast("string").alias("value"), F.lit(None).cast("string").alias("formula"), F.lit(None).cast("string").alias("style"))
    return workbook.Workbook(read(spark, d, "part").select(F.explode(F.array(cell(1, F.col("p_partkey")), cell(2, F.col("p_name")))).alias("x")).select("x.*"), ["Sheet1"])


_CELLS = "(SELECT 'Sheet1' AS sheet, p_partkey AS row, CAST(1 AS BIGINT) AS col, CAST(p_partkey AS VARCHAR) AS value, CAST(NULL AS VARCHAR) AS formula FROM part UNION ALL SELECT 'Sheet1', p_partkey, 2, p_name, NULL FROM part)"
for _name, _script, _sql in (
    ("edit_set_value", [{"op": "set_value", "cell": "B5", "value": "changed"}, {"op": "set_formula", "cell": "C5", "formula": "A5+1"}], f"SELECT * FROM {_CELLS} WHERE NOT (row = 5 AND col = 2) UNION ALL SELECT 'Sheet1', 5, 2, 'changed', NULL UNION ALL SELECT 'Sheet1', 5, 3, NULL, '=A5+1'"),
    ("edit_sheets", [{"op": "add_sheet", "name": "New", "values": [["a"]]}, {"op": "rename_sheet", "sheet": "Sheet1", "name": "Parts"}, {"op": "add_sheet", "name": "Gone"}, {"op": "delete_sheet", "sheet": "Gone"}], f"SELECT 'Parts' AS sheet, row, col, value, formula FROM {_CELLS} UNION ALL SELECT 'New', 1, 1, 'a', NULL"),
    ("edit_delete_cols", [{"op": "delete_cols", "at": 1}], f"SELECT sheet, row, CAST(1 AS BIGINT) AS col, value, formula FROM {_CELLS} WHERE col = 2"),
):
    register(_name, lambda s, d, script=_script: workbook.edited(_part_sheet(s, d), script).cells.select("sheet", "row", "col", "value", "formula"), _sql)
register("edit_style_range", lambda s, d: workbook.edited(_part_sheet(s, d), [{"op": "style_range", "range": "B3:B6", "style": {"bold": True}}]).cells.where("style IS NOT NULL").select("row", "col", F.get_json_object("style", "$.font.b").alias("bold")),
         f"SELECT row, col, '{{}}' AS bold FROM {_CELLS} WHERE col = 2 AND row BETWEEN 3 AND 6")


def _kept_looks(spark: SparkSession, d: str) -> DataFrame:
    """What a script says on the look of a sheet, after rows were inserted: one row for each kind."""
    script = [{"op": "merge", "range": "A4:B5"}, {"op": "merge", "range": "D1:D2"}, {"op": "unmerge", "range": "D1:D2"}, {"op": "freeze", "rows": 1}, {"op": "auto_filter", "range": "A1:B9"}, {"op": "set_col_width", "col": "B", "width": 30}, {"op": "set_row_height", "row": 2, "height": 20},
              {"op": "conditional_format", "range": "A2:A9", "type": "cellIs", "value": 5}, {"op": "data_validation", "range": "B2:B9", "type": "whole", "operator": "greaterThan", "value": 1}, {"op": "insert_rows", "at": 1, "count": 3}]
    book = workbook.edited(_part_sheet(spark, d), script)
    data = sinks.table_bytes([("Sheet1", [["a", "b"]])], "xlsx", shown=book.shown)
    _, shown, _, _ = presentation.read(data)
    found = [(k, str(op.get("range") or op.get("rows") or op.get("col") or op.get("row")).replace("None", ""), len(ops)) for k, ops in shown.items() for op in ops[:1]]
    return spark.createDataFrame(found, "kind string, place string, n int")


register("edit_looks", _kept_looks, "SELECT * FROM (VALUES ('merge', 'A7:B8', 1), ('col_width', '2', 1), ('row_height', '5', 1), ('freeze', '1', 1), ('auto_filter', 'A4:B12', 1), ('conditional_format', 'A5:A12', 1), ('data_validation', 'B5:B12', 1)) t(kind, place, n)")

# Small functions over rows.
register("list_counters", lambda s, d: each(read(s, d, "part").select("p_partkey", "p_size"), "p_partkey long, zero string, circle string, wide string, upper string, ordinal string", lambda r: [(r[0], *(numbering.counter(r[1], f) for f in ("decimalZero", "decimalEnclosedCircle", "decimalFullWidth", "upperLetter", "ordinal")))]),
         "SELECT p_partkey, lpad(CAST(p_size AS VARCHAR), 2, '0') AS zero, CASE WHEN p_size <= 20 THEN chr(CAST(9311 + p_size AS INTEGER)) ELSE CAST(p_size AS VARCHAR) END AS circle, translate(CAST(p_size AS VARCHAR), '0123456789', '０１２３４５６７８９') AS wide,"
         " CASE WHEN p_size > 26 THEN chr(CAST(64 + (p_size - 1) // 26 AS INTEGER)) ELSE '' END || chr(CAST(65 + (p_size - 1) % 26 AS INTEGER)) AS upper, p_size || CASE WHEN p_size BETWEEN 10 AND 20 THEN 'th' WHEN p_size % 10 = 1 THEN 'st' WHEN p_size % 10 = 2 THEN 'nd' WHEN p_size % 10 = 3 THEN 'rd' ELSE 'th' END AS ordinal FROM part")
register("style_measures", lambda s, d: each(read(s, d, "part").select("p_partkey", "p_size"), "p_partkey long, twips int, px int, em int, color string, wide int, high int, bytes string, ref string",
                                             lambda r: [(r[0], style.length(f"{r[1]}pt"), style.length(f"{4 * r[1]}px"), style.length(f"{r[1]}em", 20), style.hex_color(f"#{r[1] % 10}ab"), *style.fitted(100 * r[1], 50 * r[1]), style.shown_bytes(1024 * r[1]), workbook.column_letter(r[1]) + str(workbook.cell_ref(f"$B${r[1]}")[0]))]),
         "SELECT p_partkey, CAST(20 * p_size AS INTEGER) AS twips, CAST(60 * p_size AS INTEGER) AS px, CAST(200 * p_size AS INTEGER) AS em, (p_size % 10) || (p_size % 10) || 'aabb' AS color, CAST(least(100 * p_size, 600) AS INTEGER) AS wide, CAST(least(50 * p_size, 300) AS INTEGER) AS high, p_size || '.0 KB' AS bytes,"
         " CASE WHEN p_size >= 26 THEN chr(CAST(64 + p_size // 26 AS INTEGER)) ELSE '' END || chr(CAST(65 + p_size % 26 AS INTEGER)) || p_size AS ref FROM part")


def _image(row: tuple) -> list[tuple]:
    wide, high = 10 + row[1], 20 + row[1]
    made = {"png": b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + wide.to_bytes(4) + high.to_bytes(4) + b"\x08\x02\0\0\0", "gif": b"GIF89a" + wide.to_bytes(2, "little") + high.to_bytes(2, "little"),
            "jpeg": b"\xff\xd8\xff\xe0\x00\x04\x00\x00\xff\xc0\x00\x0b\x08" + high.to_bytes(2) + wide.to_bytes(2) + b"\x01\x01\x11\x00\x00", "bmp": b"BM" + b"\0" * 16 + wide.to_bytes(4, "little") + high.to_bytes(4, "little")}
    return [(row[0], kind, *(image_size(data) or (None, None, None))) for kind, data in made.items()]


register("image_sizes", lambda s, d: each(read(s, d, "part").select("p_partkey", "p_size"), "p_partkey long, made string, found string, width int, height int", _image),
         "SELECT p_partkey, k AS made, k AS found, CAST(10 + p_size AS INTEGER) AS width, CAST(20 + p_size AS INTEGER) AS height FROM part, (VALUES ('png'), ('gif'), ('jpeg'), ('bmp')) t(k)")
register("names_of_files", lambda s, d: each(read(s, d, "part").select("p_partkey", "p_brand"), "p_partkey long, entry string, ext string", lambda r: [(r[0], normal_name(f"\\Word\\{r[1]}.XML"), extension(f"/a.b/{r[1]}.DocX"))]),
         "SELECT p_partkey, 'word/' || lower(p_brand) || '.xml' AS entry, 'docx' AS ext FROM part")
register("text_truncated", lambda s, d: read(s, d, "documents").select("doc_id", F.md5(outline.truncated(F.col("text"), 200)).alias("digest")),
         "SELECT doc_id, md5(CASE WHEN length(text) > 200 THEN text[1:200] || '… [cut at 200]' ELSE text END) AS digest FROM documents")


# Tables with headers, and rendered results.
def _matrix(spark: SparkSession, d: str, head: list[str], cells: Callable[[Column, Column], list[Column]], header_row: int = 1) -> Table:
    body = read(spark, d, "nation").select((F.col("n_nationkey") + 2).cast("long").alias("row_no"), F.array(*cells(F.col("n_nationkey").cast("string"), F.col("n_name"))).alias("cells"))
    return Table.from_matrix(spark.createDataFrame([(1, head)], "row_no long, cells array<string>").unionByName(body), "nations", header_row)


register("headers_named", lambda s, d: _matrix(s, d, ["key", "key", "", "x"], lambda k, n: [k, n, k, F.when(F.col("n_nationkey") % 2 == 0, n).otherwise("")]).named(),
         'SELECT CAST(n_nationkey AS VARCHAR) AS key, n_name AS key_2, CAST(n_nationkey AS VARCHAR) AS "C", CASE WHEN n_nationkey % 2 = 0 THEN n_name END AS x FROM nation')
register("headers_none", lambda s, d: _matrix(s, d, ["k", "v"], lambda k, n: [k, n], 0).named(), 'SELECT \'k\' AS "A", \'v\' AS "B" UNION ALL SELECT CAST(n_nationkey AS VARCHAR), n_name FROM nation')
register("headers_ragged", lambda s, d: _ragged(s, d).named(), 'SELECT CAST(n_nationkey AS VARCHAR) AS a, CASE WHEN n_nationkey % 2 = 0 THEN n_name END AS b, CASE WHEN n_nationkey % 2 = 0 THEN \'z\' END AS "C" FROM nation')


def _ragged(spark: SparkSession, d: str) -> Table:
    key = F.col("n_nationkey").cast("string")
    body = read(spark, d, "nation").select((F.col("n_nationkey") + 2).cast("long").alias("row_no"), F.when(F.col("n_nationkey") % 2 == 0, F.array(key, F.col("n_name"), F.lit("z"))).otherwise(F.array(key)).alias("cells"))
    return Table.from_matrix(spark.createDataFrame([(1, ["a", "b"])], "row_no long, cells array<string>").unionByName(body), "t")


def _ordered(spark: SparkSession, d: str) -> Table:
    return Table.of(read(spark, d, "nation").select((24 - F.col("n_nationkey")).cast("string").alias("k"), F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("region"), F.lit("1").alias("one"), "n_nationkey"), "t", order=F.col("n_nationkey"))


register("groups_first_seen", lambda s, d: aggregate.grouped(_ordered(s, d), ("region",), ()).select("region", "rows", (F.row_number().over(Window.orderBy("first_row")) - 1).cast("long").alias("place")), "SELECT region, n AS rows, CAST(row_number() OVER (ORDER BY f) - 1 AS BIGINT) AS place FROM (SELECT 'r' || n_regionkey AS region, count(*) AS n, min(n_nationkey) AS f FROM nation GROUP BY 1)")
register("pivot_first_seen", lambda s, d: s.createDataFrame([(i, c) for i, c in enumerate(compiled(_ordered(s, d), {"pivot": {"rows": ["one"], "columns": "region", "values": [{"col": "k", "fn": "count"}]}}).columns)], "place long, name string"),
         "SELECT CAST(0 AS BIGINT) AS place, 'one' AS name UNION ALL SELECT row_number() OVER (ORDER BY min(n_nationkey)), 'r' || n_regionkey FROM nation GROUP BY n_regionkey")


def _shown(spark: SparkSession, d: str) -> DataFrame:
    out = rendered(compiled(Table.of(read(spark, d, "region"), "region"), {"where": [{"col": "r_regionkey", "op": "lt", "value": 4}], "groupBy": ["r_name"], "aggregate": [{"col": "r_regionkey", "fn": "max", "as": "key"}], "orderBy": [{"col": "key"}], "limit": 3}))
    return spark.createDataFrame([(out["text"], out["meta"]["total"], out["meta"]["truncated"], out["meta"]["matchedRows"])], "text string, total long, truncated boolean, matched long")


register("rendered_result", _shown,
         "SELECT 'region: 5 rows x 2 columns -> 4 matched' || chr(10) || '> the first 3 of 4 rows are shown' || chr(10) || '```tsv' || chr(10) || 'r_name' || chr(9) || 'key' || chr(10) || (SELECT string_agg(r_name || chr(9) || r_regionkey, chr(10) ORDER BY r_regionkey) FROM region WHERE r_regionkey < 3) || chr(10) || '```' AS text, CAST(4 AS BIGINT) AS total, true AS truncated, CAST(4 AS BIGINT) AS matched")
register("skip_notes", lambda s, d: _notes(s, d), "SELECT '1 cells of v are no numbers and left out' AS note UNION ALL SELECT 'inner join with other on k'")


def _notes(spark: SparkSession, d: str) -> DataFrame:
    left = Table.of(read(spark, d, "region").select(F.col("r_regionkey").alias("k"), F.when(F.col("r_regionkey") == 2, "none").otherwise(F.col("r_regionkey").cast("string")).alias("v")), "left")
    out = rendered(compiled(left, {"join": {"path": "other", "on": "k"}, "groupBy": ["r_name"], "aggregate": [{"col": "v", "fn": "sum", "as": "s"}]}, {"other": Table.of(read(spark, d, "region").select(F.col("r_regionkey").alias("k"), "r_name"))}))
    return spark.createDataFrame([(x[2:],) for x in out["text"].split("\n") if x.startswith("> ")], "note string")
