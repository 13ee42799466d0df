"""Writers of workbooks and tables: xlsx, ods, csv, tsv and html, made of the rows of a DataFrame as they arrive."""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from datetime import date
from itertools import chain
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tabweave.errors import EngineError
from tabweave.functions import model
from tabweave.functions.model import column_letter, fmt
from tabweave.sinks.presentation import KINDS, Look, Styles, cell_style, laid_over, look_of
from tabweave.sources.package import SMALL, Deflated, archive

SHEET_NAME = 31
# The largest sheet that the format allows.
MOST_ROWS, MOST_COLUMNS = 1_048_576, 16_384
#: Bytes of XML that are made of columns at once, and how many rows of these are packed at once.
MOST_TOGETHER, STRETCH = 1 << 26, 2048


def coerced(value: object, typed: bool = True) -> tuple[str, object]:
    """(kind, value) of a cell to write: formula, date, number, boolean or text. Untyped sources stay text."""
    if value is None or value == "":
        return "blank", None
    if isinstance(value, bool):
        return "bool", value
    if isinstance(value, int | float):
        return "number", value
    if isinstance(value, date):
        return "date", value.isoformat()
    text = str(value)
    if not typed:
        return "text", text
    if text.startswith("=") and len(text) > 1:
        return "formula", text[1:]
    if text.startswith("date:") and (d := model.day(text[5:].strip())):
        return "date", d
    for lead in ("num:", "percent:"):
        if text.startswith(lead) and (n := model.num(text[len(lead):] + ("%" if lead == "percent:" and not text.endswith("%") else ""))) is not None:
            return "percent" if lead == "percent:" else "number", n
    return "text", text


def _serial(day: str) -> int:
    return (date.fromisoformat(day) - date(1899, 12, 30)).days


@dataclass(frozen=True)
class Styled:
    """A value with the style of its cell, as stored in the long form of cells."""

    value: object
    style: str | None


def _cell(at: str, value: object, typed: bool, styles: Styles) -> str:
    after = _after(value, typed, styles)
    return f'<c r="{at}"{after}' if after else ""


def _after(value: object, typed: bool, styles: Styles) -> str:
    """What follows the place of a cell in its XML; nothing if there is no cell."""
    style = value.style if isinstance(value, Styled) else None
    kind, v = coerced(value.value if isinstance(value, Styled) else value, typed)
    number = styles.number(style, {"percent": 2, "date": 1}.get(kind, 0))
    head = f' s="{number}"' if number else ""
    if kind == "blank":
        return f"{head}/>" if number else ""
    if kind in ("number", "percent"):
        return f"{head}><v>{v!r}</v></c>"
    if kind == "date":
        return f"{head}><v>{_serial(v)}</v></c>"
    if kind == "bool":
        return f'{head} t="b"><v>{int(v)}</v></c>'
    if kind == "formula":
        return f"{head}><f>{escape(v)}</f></c>"
    return f'{head} t="inlineStr"><is><t xml:space="preserve">{escape(_safe(v))}</t></is></c>'


def _safe(text: str) -> str:
    return "".join(c for c in text if c >= " " or c in "\t\n\r")


@dataclass(frozen=True)
class Columns:
    """Rows by columns, written as the same rows in lists would be. value: what a value of a column is as a cell."""

    batch: pa.RecordBatch
    value: Callable[[object], object]


def _afters(values: pa.Array, of: Callable[[object], str]) -> pa.Array:
    """of(value), null for no cell. Values that are repeated are looked at once, whole numbers not at all."""
    kind = values.type
    if pa.types.is_integer(kind):
        return pc.binary_join_element_wise("><v>", values.cast(pa.string()), "</v></c>", "")
    bits = {pa.float64(): pa.int64(), pa.float32(): pa.int32()}.get(kind)  # as bits: 0.0 is not -0.0
    try:
        coded = (values.view(bits) if bits else values).dictionary_encode()
    except pa.ArrowNotImplementedError:  # lists and the like
        return pa.array([of(v) or None for v in values.to_pylist()], pa.string())
    held = coded.dictionary.view(kind) if bits else coded.dictionary
    return pa.array([of(v) or None for v in held.to_pylist()], pa.string()).take(coded.indices)


def _parts_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows that take up to MOST_TOGETHER bytes at once, or one."""
    n = batch.num_rows
    if n > 1 and 6 * batch.nbytes + 80 * n * batch.num_columns > MOST_TOGETHER:  # an escaped character takes up to six
        yield from _parts_of(batch.slice(0, n // 2))
        yield from _parts_of(batch.slice(n // 2))
    elif n:
        yield batch


def _row_blocks(columns: Columns, first: int, typed: bool, styles: Styles) -> Iterator[memoryview]:
    """The XML of rows, the first of them with this number, in pieces."""
    n = columns.batch.num_rows
    number, nothing = pa.array(range(first, first + n), pa.int64()).cast(pa.string()), pa.scalar("")
    parts = ['<row r="', number, '">']
    for k, values in enumerate(columns.batch.columns):
        after, head = _afters(values, lambda v: _after(columns.value(v), typed, styles)), f'<c r="{column_letter(k)}'
        if after.null_count:
            parts.append(pc.coalesce(pc.binary_join_element_wise(head, number, '"', after, ""), nothing))
        else:
            parts += [head, number, '"', after]
    rows = pc.binary_join_element_wise(*parts, "</row>", "")
    at = memoryview(rows.buffers()[1]).cast("i")
    for i in range(0, n, STRETCH):
        yield memoryview(rows.buffers()[2])[at[rows.offset + i]:at[rows.offset + min(n, i + STRETCH)]]


def _sheet(name: str, rows: Iterable[list | Columns], typed: bool, styles: Styles, shown: dict[str, list] | None) -> Iterator[bytes | memoryview]:
    """The XML of a sheet, in pieces as its rows come."""
    look = look_of(shown, name, styles) if shown else Look()
    yield f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">{look.before}<sheetData>'.encode()
    last = 0
    for row in rows:
        if isinstance(row, Columns):
            if last + row.batch.num_rows > MOST_ROWS or row.batch.num_columns > MOST_COLUMNS:
                raise EngineError("TOO_LARGE", f"{name}: a sheet of this format has at most {MOST_ROWS} rows and {MOST_COLUMNS} columns")
            for part in _parts_of(row.batch):
                yield from _row_blocks(Columns(part, row.value), last + 1, typed, styles)
                last += part.num_rows
            continue
        last += 1
        if last > MOST_ROWS or len(row) > MOST_COLUMNS:
            raise EngineError("TOO_LARGE", f"{name}: a sheet of this format has at most {MOST_ROWS} rows and {MOST_COLUMNS} columns")
        height = f' ht="{look.heights[last]}" customHeight="1"' if last in look.heights else ""
        yield f'<row r="{last}"{height}>{"".join(_cell(f"{column_letter(k)}{last}", v, typed, styles) for k, v in enumerate(row))}</row>'.encode()
    for i in sorted(k for k in look.heights if k > last):
        yield f'<row r="{i}" ht="{look.heights[i]}" customHeight="1"/>'.encode()
    yield f"</sheetData>{look.after}</worksheet>".encode()


def xlsx(sheets: Iterable[tuple[str, Iterable[list | Columns]]], typed: bool = True, shown: dict[str, list] | None = None) -> bytes:
    """sheets: (name, rows). A sheet is written as its rows come, unless the book is small: then its parts are put together at once. shown: what sheets look like, by kind of step."""
    styles = Styles()
    main, rel, pack = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships", "http://schemas.openxmlformats.org/package/2006"
    names, parts, size = [], {}, 0
    for name, rows in sheets:
        names.append((name or f"Sheet{len(names) + 1}")[:SHEET_NAME])
        part, held = f"xl/worksheets/sheet{len(names)}.xml", []
        pieces = _sheet(name, rows, typed, styles, shown)
        for piece in pieces:
            held.append(piece)
            size += len(piece)
            if size > SMALL:
                parts[part] = Deflated()
                for x in chain(held, pieces):
                    parts[part].add(x)
                parts[part].done()
                break
        else:
            parts[part] = b"".join(held)
    if not names:
        raise EngineError("INVALID_ARGS", "a workbook needs a sheet")
    parts["[Content_Types].xml"] = (f'<?xml version="1.0" encoding="UTF-8"?><Types xmlns="{pack}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>'
               + "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in range(1, len(names) + 1)) + "</Types>").encode()
    parts["_rels/.rels"] = (f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{pack}/relationships"><Relationship Id="rId1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>').encode()
    parts["xl/workbook.xml"] = (f'<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="{main}" xmlns:r="{rel}"><sheets>' + "".join(f'<sheet name={quoteattr(n)} sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(names, 1)) + "</sheets></workbook>").encode()
    parts["xl/_rels/workbook.xml.rels"] = (f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{pack}/relationships">' + "".join(f'<Relationship Id="rId{i}" Type="{rel}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(names) + 1)) + f'<Relationship Id="rId{len(names) + 1}" Type="{rel}/styles" Target="styles.xml"/></Relationships>').encode()
    parts["xl/styles.xml"] = styles.xml().encode()
    return archive(parts)


# Fixed value: the look of header rows where a specification asks for one and names none.
HEADER = {"bold": True, "fill": "D9E2F3", "align": "center"}


def built(spec: dict) -> bytes:
    """A new workbook: {"sheets": [{"name", "rows", "header", "headerStyle", "columnWidths", "rowHeights"}]}. Cells may be {"value", "style"}."""
    if not isinstance(spec.get("sheets"), list) or not spec["sheets"]:
        raise EngineError("INVALID_ARGS", "a workbook needs sheets")
    sheets, shown = [], {k: [] for k in KINDS}
    for i, of in enumerate(spec["sheets"], 1):
        name, rows = str(of.get("name") or f"Sheet{i}")[:SHEET_NAME], of.get("rows") or []
        if not all(isinstance(r, list) for r in rows):
            raise EngineError("INVALID_ARGS", f"rows of {name} are an array of arrays")
        head = cell_style(of.get("headerStyle") or HEADER) if of.get("header") and of.get("headerStyle") is not False else None
        head = laid_over(None, head) if head else None

        def cell(v: object, first: bool, head: str | None = head) -> object:
            own = cell_style(v["style"]) if isinstance(v, dict) and v.get("style") else {}
            value = v.get("value") if isinstance(v, dict) else v
            base = head if first else None
            look = laid_over(base, own) if own else base
            return Styled(value, look) if look else value

        sheets.append((name, [[cell(v, k == 0) for v in r] for k, r in enumerate(rows)]))
        widths = of.get("columnWidths")
        if not isinstance(widths, list):  # wide enough for what they hold, within 10 and 50
            width = max((len(r) for r in rows), default=0)
            widths = [max(10, min(50, max((len(str(r[k].get("value") if isinstance(r[k], dict) else r[k] if r[k] is not None else "")) + 2 for r in rows if k < len(r)), default=8))) for k in range(width)]
        shown["col_width"] += [{"sheet": name, "col": k, "width": x} for k, x in enumerate(widths, 1) if isinstance(x, int | float) and 0 < x <= 255]
        shown["row_height"] += [{"sheet": name, "row": k, "height": x} for k, x in enumerate(of.get("rowHeights") or [], 1) if isinstance(x, int | float) and x > 0]
    return packed(xlsx(sheets, shown=shown), "xlsx")


def ods(sheets: Iterable[tuple[str, Iterable[list]]], typed: bool = True) -> bytes:
    names = {"office": "urn:oasis:names:tc:opendocument:xmlns:office:1.0", "table": "urn:oasis:names:tc:opendocument:xmlns:table:1.0", "text": "urn:oasis:names:tc:opendocument:xmlns:text:1.0"}
    body = []
    for name, rows in sheets:
        body.append(f"<table:table table:name={quoteattr(name)}>")
        for row in rows:
            cells = []
            for value in row:
                kind, v = coerced(value, typed)
                shown = escape(_safe(fmt(v) if kind in ("number", "percent") else str(v) if v is not None else ""))
                attr = {"number": f' office:value-type="float" office:value="{v}"', "percent": f' office:value-type="percentage" office:value="{v}"', "date": f' office:value-type="date" office:date-value="{v}"', "bool": f' office:value-type="boolean" office:boolean-value="{str(v).lower()}"',
                        "formula": f" table:formula={quoteattr('of:=' + str(v))}", "text": ' office:value-type="string"'}.get(kind, "")
                cells.append(f"<table:table-cell{attr}>{f'<text:p>{shown}</text:p>' if shown and kind != 'formula' else ''}</table:table-cell>")
            body.append(f"<table:table-row>{''.join(cells)}</table:table-row>")
        body.append("</table:table>")
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(zipfile.ZipInfo("mimetype"), "application/vnd.oasis.opendocument.spreadsheet")
        z.writestr("content.xml", '<?xml version="1.0" encoding="UTF-8"?><office:document-content ' + " ".join(f'xmlns:{k}="{v}"' for k, v in names.items()) + f'><office:body><office:spreadsheet>{"".join(body)}</office:spreadsheet></office:body></office:document-content>')
        z.writestr("META-INF/manifest.xml", '<?xml version="1.0" encoding="UTF-8"?><manifest:manifest xmlns:manifest="urn:oasis:names:tc:opendocument:xmlns:manifest:1.0"><manifest:file-entry manifest:full-path="/" manifest:media-type="application/vnd.oasis.opendocument.spreadsheet"/></manifest:manifest>')
    return out.getvalue()


def delimited(rows: Iterable[list], separator: str = ",") -> bytes:
    out = io.StringIO()
    csv.writer(out, delimiter=separator, lineterminator="\n").writerows([fmt(v) if not isinstance(v, str) else v for v in row] for row in rows)
    return out.getvalue().encode()


def html(sheets: Iterable[tuple[str, Iterable[list]]]) -> bytes:
    body = [f"<h2>{escape(name)}</h2><table>" + "".join("<tr>" + "".join(f"<td>{escape(fmt(v) if not isinstance(v, str) else v)}</td>" for v in row) + "</tr>" for row in rows) + "</table>" for name, rows in sheets]
    return f'<!DOCTYPE html><html><head><meta charset="utf-8"></head><body>{"".join(body)}</body></html>'.encode()


def matrix(df: DataFrame, header: bool = True) -> Iterable[list]:
    """Rows of a DataFrame, one partition at a time."""
    if header:
        yield list(df.columns)
    for row in df.toLocalIterator():
        yield [v if v is None or isinstance(v, bool | int | float | str) else v.strftime("%Y-%m-%d") if hasattr(v, "strftime") else str(v) for v in row]


def packed(data: bytes, kind: str) -> bytes:
    """Guards what is written: office files are zip archives."""
    if kind in ("xlsx", "docx", "ods", "odt") and data[:2] != b"PK":
        raise EngineError("BAD_OUTPUT_FORMAT", f"not a {kind} file")
    return data


def table_bytes(sheets: list[tuple[str, Iterable[list]]], kind: str, typed: bool = True, shown: dict[str, list] | None = None) -> bytes:
    if kind == "xlsx":
        return packed(xlsx(sheets, typed, shown), kind)
    if kind == "ods":
        return packed(ods(sheets, typed), kind)
    if kind in ("csv", "tsv"):
        return delimited(sheets[0][1], "," if kind == "csv" else "\t")
    if kind == "html":
        return html(sheets)
    raise EngineError("XLS_WRITE_UNSUPPORTED" if kind in ("xls", "xlsb") else "UNSUPPORTED_CONVERSION", f"tables are not written as {kind}")


def convert_table(data: bytes, source: str, target_kind: str) -> bytes:
    """A workbook or delimited file in another format. Cells of text sources stay text, whatever they start with."""
    from tabweave.sources.sniff import sniff
    from tabweave.sources.workbook import parse

    kind = sniff(data, source)
    if kind == target_kind:
        return data
    sheets = []
    for s in parse(data, source):
        rows, at = [], 0
        for number, cells, formulas in s.rows:
            rows += [[] for _ in range(number - at - 1)]
            rows.append([f if f and kind in ("xlsx", "ods") else _typed(c) if kind in ("xlsx", "ods") else c for c, f in zip(cells, formulas, strict=True)])
            at = number
        sheets.append((s.name, rows))
    return table_bytes(sheets, target_kind, typed=kind in ("xlsx", "ods"))


def _typed(cell: str) -> object:
    if cell in ("TRUE", "FALSE"):
        return cell == "TRUE"
    n = model.num(cell) if not cell.endswith("%") and "," not in cell else None
    return n if n is not None and fmt(n) == cell else f"date:{cell}" if model.day(cell) == cell else cell
