"""The tools: read, query, write and edit documents and workbooks, fill templates, convert. Paths are of the driver's file system
where bytes are written; queries read any path that Spark reads."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tabweave.edit import document, workbook
from tabweave.errors import EngineError
from tabweave.plans.query import Result, compiled
from tabweave.plans.spec import Join, Query
from tabweave.sinks import workbook as sinks
from tabweave.sources import workbook as tables
from tabweave.sources.package import TABLE_BYTES, WORD_BYTES
from tabweave.sources.sniff import checked, extension, sniff
from tabweave.text import html, markdown, odt, outline, pdf, rtf, template
from tabweave.text.docx import Document, Writer

TABLES = ("xlsx", "ods", "csv", "tsv")


def _bytes(path: str, limit: int = WORD_BYTES) -> bytes:
    file = Path(path)
    if not file.exists():
        raise EngineError("NOT_FOUND", f"no file {path}")
    if not file.is_file():
        raise EngineError("NOT_A_FILE", f"{path} is not a file")
    return checked(file.read_bytes(), limit)


def as_html(data: bytes, path: str = "") -> str:
    kind = sniff(data, path)
    if kind == "docx":
        return Document(data).to_html()
    if kind == "odt":
        return odt.to_html(data)
    if kind in ("html", "md"):
        text = data.decode("utf-8-sig", "replace")
        return text if kind == "html" else markdown.to_html(text)
    if kind in ("rtf", "txt", "pdf"):
        return html.from_text(pdf.joined(pdf.pages(data)) if kind == "pdf" else rtf.to_text(data.decode("latin-1")) if kind == "rtf" else data.decode("utf-8-sig", "replace"))
    raise EngineError("UNSUPPORTED_FORMAT", f"{path or 'the file'} is {kind}; documents are read from docx, odt, rtf, html, md, txt and pdf (old binary documents need an external parser)")


def as_markdown(data: bytes, path: str = "") -> str:
    kind = sniff(data, path)
    if kind in ("md", "txt"):
        return data.decode("utf-8-sig", "replace")
    return pdf.joined(pdf.pages(data)) if kind == "pdf" else html.to_markdown(as_html(data, path))


def read(path: str, offset: int = 0, max_chars: int = outline.MOST) -> dict:
    """A page of a document as Markdown, from an offset that an earlier page or the outline gave."""
    text = as_markdown(_bytes(path), path)
    if offset < 0 or offset > len(text):
        raise EngineError("INVALID_ARGS", f"offset is from 0 to {len(text)}")
    end = offset + outline.page_spans(text[offset:offset + max_chars + 1], min(max_chars, outline.MOST))[0][1] if offset < len(text) else offset
    return {"text": text[offset:end], "next": end if end < len(text) else None, "total": len(text)}


def query(spark: SparkSession, path: str, spec: dict, checked_limits: bool = False) -> Result:
    q = Query.from_json(spec)
    load = lambda j: tables.load_table(spark, j.path or path, j.sheet, j.header_row)
    joins = tuple(Join(j.keys, j.type, j.path or path, j.sheet, j.header_row, j.suffix, j.label) for j in q.joins)
    return compiled(tables.load_table(spark, path, q.sheet, q.header_row), Query(q.where, joins, q.group_by, q.measures, q.pivot, q.order_by, q.limit, q.sheet, q.header_row), load, checked_limits)


def write_docx(path: str, source: str, kind: str = "markdown", **options) -> None:
    body = {"markdown": markdown.to_html, "html": lambda x: x, "text": html.from_text}[kind](source)
    Path(path).write_bytes(sinks.packed(Writer(**options).bytes(body), "docx"))


def edit_docx(path: str, script: list[dict], output: str | None = None, dry_run: bool = False) -> list[dict]:
    data, report = document.edited(_bytes(path), script, dry_run)
    if not dry_run:
        Path(output or path).write_bytes(sinks.packed(data, "docx"))
    return report


def write_xlsx(path: str, sheets: list[tuple[str, list[list] | DataFrame]] | dict) -> None:
    """sheets: (name, rows or DataFrame), or a specification with headers, styles, widths and heights."""
    if isinstance(sheets, dict):
        Path(path).write_bytes(sinks.built(sheets))
        return
    made = [(n, sinks.matrix(rows) if isinstance(rows, DataFrame) else rows) for n, rows in sheets]
    Path(path).write_bytes(sinks.table_bytes(made, "xlsx"))


def edit_xlsx(spark: SparkSession, path: str, script: list[dict], output: str | None = None) -> list[str]:
    if extension(path) != "xlsx":
        raise EngineError("NEED_CONVERT", "only xlsx workbooks are edited; convert first")
    book = workbook.edited(workbook.Workbook.of_file(tables.read_sheets(spark, path), _bytes(path, TABLE_BYTES)), script)
    book.notes += [f"{kind} steps are kept, not drawn" for kind in ("image", "chart") if book.shown[kind]]

    def cell(held: tuple | None) -> object:
        value, look = held or (None, None)
        value = sinks._typed(value) if isinstance(value, str) and not value.startswith("=") else value
        return sinks.Styled(value, look) if look else value

    made = [(s, [[cell(v) for v in r] for r in book.rows(s, styled=True)]) for s in book.sheets]
    Path(output or path).write_bytes(sinks.table_bytes(made, "xlsx", shown=book.shown))
    return book.notes


def fill_template(template_path: str, output: str, data: dict) -> None:
    Path(output).write_bytes(sinks.packed(template.fill_docx(_bytes(template_path), data), "docx"))


def convert(source: str, target: str) -> None:
    data, kind = _bytes(source), extension(target)
    found = sniff(data, source)
    if found == kind:
        out = data
    elif found in TABLES:
        out = sinks.convert_table(data, source, kind)
    elif kind in ("xlsx", "xls", "xlsb", "ods", "csv", "tsv"):
        raise EngineError("UNSUPPORTED_CONVERSION", f"a document ({found}) is not made a table ({kind})")
    elif kind == "docx":
        out = Writer().bytes(as_html(data, source))
    elif kind in ("md", "txt"):
        out = as_markdown(data, source).encode()
    elif kind == "html":
        out = f'<!DOCTYPE html><html><head><meta charset="utf-8"></head><body>{as_html(data, source)}</body></html>'.encode()
    elif kind == "rtf":
        out = rtf.from_text(as_markdown(data, source)).encode("ascii")
    else:
        raise EngineError("UNSUPPORTED_CONVERSION", f"{found} is not converted to {kind} without an external converter")
    Path(target).write_bytes(out)


def capabilities() -> dict[str, bool]:
    """What works here without external parsers and converters."""
    return {**{f"read {k}": True for k in (*TABLES, "docx", "odt", "rtf", "html", "md", "txt", "pdf")}, **{f"read {k}": False for k in ("doc", "xls", "xlsb")}, **{f"write {k}": True for k in (*TABLES, "docx", "html", "md", "txt", "rtf")}, **{f"write {k}": False for k in ("doc", "odt", "pdf", "xls", "xlsb")}}
