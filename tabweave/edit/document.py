"""Document edit scripts: ordered steps on the paragraphs and tables of a word document, one document at a time."""

from __future__ import annotations

import copy
import re
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from tabweave.errors import EngineError
from tabweave.sources.package import parse_xml, remembered, xml_bytes
from tabweave.text import style
from tabweave.text.docx import W, Document, repacked, w

OPS = 200
PACKAGE = "http://schemas.openxmlformats.org/package/2006"
SCOPES: dict[str, Callable[[bool, int | None], bool]] = {"all": lambda inside, level: True, "body": lambda inside, level: level is None, "headings": lambda inside, level: level is not None, "table": lambda inside, level: inside}
_LEVEL = re.compile(r"(?:heading|h|标题)?([1-9])")
# Number formats and patterns of the two presets, and the order of properties that the schema asks for.
NUMBERINGS = {
    "decimal": [("decimal", ".".join(f"%{k + 1}" for k in range(n + 1))) for n in range(9)],
    "chinese": [("chineseCounting", "%1、"), ("chineseCounting", "（%2）"), ("decimal", "%3."), ("decimal", "（%4）"), *(("decimal", f"%{n + 1})") for n in range(4, 9))],
}
PARAGRAPH_ORDER = ("pStyle", "keepNext", "keepLines", "pageBreakBefore", "numPr", "pBdr", "shd", "tabs", "spacing", "ind", "jc", "outlineLvl", "rPr", "sectPr")
RUN_ORDER = ("rStyle", "rFonts", "b", "bCs", "i", "iCs", "strike", "color", "sz", "szCs", "u", "shd", "vertAlign")
TABLE_ORDER = ("tblStyle", "tblW", "jc", "tblInd", "tblBorders", "shd", "tblLayout", "tblCellMar", "tblLook")
ROW_ORDER = ("cantSplit", "trHeight", "tblHeader", "jc")
CELL_ORDER = ("tcW", "gridSpan", "vMerge", "tcBorders", "shd", "noWrap", "tcMar", "vAlign")
_SPACE = "{http://www.w3.org/XML/1998/namespace}space"


#: What elements of a run stand for; the text itself where that is none.
_SIGNS = {w("t"): "", w("br"): "\n", w("cr"): "\n", w("tab"): "\t"}


def text_of(p: ET.Element) -> str:
    return "".join([_SIGNS[e.tag] or e.text or "" for r in p.iter(w("r")) for e in r if e.tag in _SIGNS])


def set_text(p: ET.Element, text: str) -> None:
    """The text in the first run's format; other runs go."""
    runs = list(p.iter(w("r")))
    look = next((copy.deepcopy(r.find(w("rPr"))) for r in runs if r.find(w("rPr")) is not None), None)
    for e in list(p):
        if e.tag != w("pPr"):
            p.remove(e)
    run = ET.SubElement(p, w("r"))
    if look is not None:
        run.append(look)
    for k, line in enumerate(text.split("\n")):
        if k:
            ET.SubElement(run, w("br"))
        ET.SubElement(run, w("t"), {_SPACE: "preserve"}).text = line


@lru_cache(maxsize=256)
def _fragments(xml: str) -> list[ET.Element]:
    """Properties to be put in; they are copied there, never changed."""
    return list(ET.fromstring(f'<x xmlns:w="{W}">{xml}</x>')) if xml else []


@lru_cache(maxsize=16)
def _ranks(order: tuple[str, ...]) -> dict[str, int]:
    return {w(name): k for k, name in enumerate(order)}


def _merged(holder: ET.Element, tag: str, new: list[ET.Element], order: tuple[str, ...]) -> None:
    """Puts properties into a holder's property element: attributes of spacing, indents and fonts are added to, other elements replaced."""
    if not new:
        return
    props = holder.find(w(tag))
    if props is None:
        props = ET.Element(w(tag))
        holder.insert(1 if tag == "trPr" and len(holder) and holder[0].tag == w("tblPrEx") else 0, props)
    ranks = _ranks(order)
    for e in new:
        old = props.find(e.tag)
        if old is not None and e.tag in (w("spacing"), w("ind"), w("rFonts")):
            old.attrib.update(e.attrib)
            continue
        if old is not None:
            props.remove(old)
        rank = ranks.get(e.tag, len(order))
        at = next((k for k, x in enumerate(props) if ranks.get(x.tag, -1) > rank), len(props))
        props.insert(at, copy.deepcopy(e) if len(e) else ET.Element(e.tag, e.attrib))


def _span(cell: ET.Element) -> int:
    found = cell.find(f"{w('tcPr')}/{w('gridSpan')}")
    return int(found.get(w("val"), "1")) if found is not None else 1


def _placed(row: ET.Element) -> list[tuple[int, ET.Element]]:
    """(grid column, cell) of a row."""
    out, at = [], 0
    for cell in row.findall(w("tc")):
        out.append((at, cell))
        at += _span(cell)
    return out


def _list_number(preset: str) -> str:
    return str(900 + list(NUMBERINGS).index(preset))


@remembered
def _with_list(part: bytes, preset: str, start: int) -> bytes:
    """A numbering part (empty: a new one) with the list of a preset, made or updated."""
    root = parse_xml(part) if part else ET.Element(w("numbering"))
    number = _list_number(preset)
    for old in [e for e in root if e.get(w("abstractNumId")) == number or e.get(w("numId")) == number]:
        root.remove(old)
    abstract = ET.Element(w("abstractNum"), {w("abstractNumId"): number})
    ET.SubElement(abstract, w("multiLevelType"), {w("val"): "multilevel"})
    for k, (form, pattern) in enumerate(NUMBERINGS[preset]):
        level = ET.SubElement(abstract, w("lvl"), {w("ilvl"): str(k)})
        for tag, value in (("start", str(start if k == 0 else 1)), ("numFmt", form), ("lvlText", pattern)):
            ET.SubElement(level, w(tag), {w("val"): value})
    root.insert(len(root.findall(w("abstractNum"))), abstract)
    ET.SubElement(ET.SubElement(root, w("num"), {w("numId"): number}), w("abstractNumId"), {w("val"): number})
    ET.register_namespace("w", W)
    return xml_bytes(root)


class Editor:
    def __init__(self, data: bytes) -> None:
        self.data, self.doc, self.report = data, Document(data), []
        self.parents: dict[ET.Element, ET.Element] = {}
        self.added: dict[str, bytes] = {}

    def paragraphs(self) -> list[tuple[ET.Element, bool, int | None]]:
        """(element, in a table, heading level); formats are not worked out."""
        return [(e, inside, self.doc.level_of(e)) for e, inside in self.doc.elements()]

    def parent(self, child: ET.Element) -> ET.Element:
        """Of a map of the tree, which is made anew when the tree has changed since."""
        if child not in self.parents or child not in set(self.parents[child]):
            self.parents = {c: p for p in self.doc.root.iter() for c in p}
        return self.parents[child]

    def located(self, op: dict) -> int:
        """By index from 0, by paragraph from 1, or by the one paragraph whose trimmed text matches."""
        found = self.doc.elements()
        if op.get("index") is None and op.get("paragraph") is not None:
            op = {**op, "index": int(op["paragraph"]) - 1}
        if op.get("index") is not None:
            if not 0 <= int(op["index"]) < len(found):
                raise EngineError("PARAGRAPH_NOT_FOUND", f"no paragraph {op['index']}; there are {len(found)}")
            return int(op["index"])
        match = str(op.get("match", "")).strip()
        hits = [i for i, (e, _) in enumerate(found) if text_of(e).strip() == match]
        if not hits:
            raise EngineError("PARAGRAPH_NOT_FOUND", f"no paragraph reads {match!r}")
        if len(hits) > 1:
            raise EngineError("AMBIGUOUS_MATCH", f"paragraphs {hits[:10]} read {match!r}")
        return hits[0]

    def tables(self) -> list[ET.Element]:
        return list(self.doc.body.iter(w("tbl")))

    def table(self, op: dict) -> ET.Element:
        found, at = self.tables(), int(op.get("table", 0))
        if not 0 <= at < len(found):
            raise EngineError("TABLE_NOT_FOUND", f"no table {at}; there are {len(found)}")
        return found[at]

    # Paragraphs.
    def replace_text(self, op: dict) -> None:
        """Across runs: the replacement takes the place of the first character's run."""
        find, to, left = str(op.get("find", "")), str(op.get("replace", "")), int(op.get("limit") or 1 << 60)
        if not find:
            raise EngineError("INVALID_ARGS", "replace_text needs find")
        count = 0
        for p, _ in self.doc.elements():
            cells = list(p.iter(w("t")))
            whole = "".join([t.text or "" for t in cells])
            if find not in whole:
                continue
            at = 0
            spots = []
            while left and (at := whole.find(find, at)) >= 0:
                spots.append(at)
                at += len(find)
                left -= 1
            for spot in reversed(spots):
                start = 0
                for t in cells:
                    own = t.text or ""
                    a, b = max(0, spot - start), min(len(own), spot + len(find) - start)
                    if a < b or start <= spot < start + len(own):
                        t.text = own[:a] + (to if start <= spot < start + len(own) else "") + own[b:]
                        t.set(_SPACE, "preserve")
                    start += len(own)
            count += len(spots)
        self.report.append({"op": "replace_text", "count": count})

    def set_paragraph(self, op: dict) -> None:
        set_text(self.doc.elements()[self.located(op)][0], str(op.get("text", "")))

    def insert_paragraph(self, op: dict) -> None:
        new = ET.Element(w("p"))
        if op.get("heading"):
            if not 1 <= int(op["heading"]) <= 9:
                raise EngineError("INVALID_ARGS", "heading is from 1 to 9")
            ET.SubElement(ET.SubElement(new, w("pPr")), w("pStyle"), {w("val"): f"Heading{op['heading']}"})
        run = ET.SubElement(new, w("r"))
        ET.SubElement(run, w("t"), {_SPACE: "preserve"}).text = str(op.get("text", ""))
        where, body = op.get("position", "end"), self.doc.body
        if where == "start":
            body.insert(0, new)
        elif where == "end":
            body.insert(len(body) - (len(body) > 0 and body[-1].tag == w("sectPr")), new)
        else:
            target = self.doc.elements()[self.located(op)][0]
            holder = self.parent(target)
            holder.insert(list(holder).index(target) + (where == "after"), new)

    def delete_paragraph(self, op: dict) -> None:
        target = self.doc.elements()[self.located(op)][0]
        holder = self.parent(target)
        if holder.tag == w("tc") and len(holder.findall(w("p"))) == 1:
            set_text(target, "")
        else:
            holder.remove(target)

    def chosen(self, op: dict) -> list[tuple[ET.Element, bool, int | None]]:
        """The paragraphs of a step: from and to (from 1, both included) and a scope, or one located paragraph."""
        found, scope = self.paragraphs(), str(op.get("scope") or "").strip().lower().replace(" ", "")
        level = _LEVEL.fullmatch(scope)
        if scope and not level and scope not in SCOPES:
            raise EngineError("INVALID_ARGS", f"unknown scope {op['scope']!r}; there are {', '.join(SCOPES)} and heading1 to heading9")
        if not scope and op.get("from") is None and op.get("to") is None:
            return [found[self.located(op)]] if any(op.get(k) is not None for k in ("index", "paragraph", "match")) else found
        first, last = int(op.get("from") or 1), int(op.get("to") or len(found))
        if not 1 <= first <= last:
            raise EngineError("INVALID_ARGS", f"from ({first}) and to ({last}) count from 1, in this order")
        fits = SCOPES.get(scope) or (lambda inside, own: level is None or own == int(level[1]))
        out = [x for x in found[first - 1:last] if fits(x[1], x[2])]
        if not out:
            raise EngineError("PARAGRAPH_NOT_FOUND", f"no paragraph of scope {scope or 'all'!r} from {first} to {last}; there are {len(found)}, {sum(x[2] is not None for x in found)} of them headings")
        return out

    def set_style(self, op: dict) -> None:
        """Direct formats of paragraphs and their runs; what the style does not name stays."""
        look = style.paragraph_style({**(op.get("style") or {}), **{k: v for k, v in op.items() if k in style.RUN or k in style.PARAGRAPH}})
        chosen = self.chosen(op)
        runs, whole = _fragments(style.run_xml(look)), _fragments(style.paragraph_xml(look))
        for p, _, _ in chosen:
            _merged(p, "pPr", whole, PARAGRAPH_ORDER)
            for r in p.iter(w("r")) if runs else ():
                _merged(r, "rPr", runs, RUN_ORDER)
        self.report.append({"op": "set_style", "count": len(chosen)})

    @staticmethod
    def _put(holder: ET.Element, tag: str, value: str | None, **attrs: str) -> None:
        if value is None and not attrs:
            return
        e = holder.find(w(tag))
        if e is None:
            e = ET.SubElement(holder, w(tag))
        for k, v in ({"val": value} if value is not None else attrs).items():
            e.set(w(k), v)

    # Tables.
    def rows(self, table: ET.Element) -> list[ET.Element]:
        return table.findall(w("tr"))

    def set_table(self, op: dict) -> None:
        """The look of a table, or of all: borders, header, widths, margins, alignment."""
        look = style.table_style({**(op.get("style") or {}), **{k: v for k, v in op.items() if k in style.TABLE or k in ("cellMargins", "columnWidths")}})
        chosen = self.tables() if op.get("scope") == "all" or op.get("all") else [self.table(op)]
        for table in chosen:
            self._look(table, look)
        self.report.append({"op": "set_table", "count": len(chosen)})

    def _look(self, table: ET.Element, look: dict) -> None:
        rows = self.rows(table)
        width = max((sum(_span(c) for c in r.findall(w("tc"))) for r in rows), default=1)
        percents = look.get("percents")
        if look.get("mode") == "auto":
            lengths = [0] * width
            for at, cell in (x for r in rows for x in _placed(r)):
                if _span(cell) == 1:
                    lengths[at] = max(lengths[at], max((len(text_of(p)) for p in cell.iter(w("p"))), default=0))
            percents = style.column_percents(lengths)
        if percents and len(percents) != width:
            raise EngineError("INVALID_ARGS", f"the table has {width} columns, columnWidths {len(percents)}")
        edge = lambda side, size: f'<w:{side} w:val="{"single" if size else "nil"}"' + (f' w:sz="{size}" w:space="0" w:color="auto"' if size else "") + "/>"
        kind, props = look.get("borders"), ""
        if kind:
            heavy = {"all": (4, 4, 4, 4, 4, 4), "none": (0, 0, 0, 0, 0, 0), "outline": (4, 4, 4, 4, 0, 0), "three-line": (12, 0, 12, 0, 0, 0)}[kind]
            props += "<w:tblBorders>" + "".join(edge(s, n) for s, n in zip(("top", "left", "bottom", "right", "insideH", "insideV"), heavy, strict=True)) + "</w:tblBorders>"
        props += f'<w:jc w:val="{look["align"]}"/>' if "align" in look else ""
        props += "<w:tblCellMar>" + "".join(f'<w:{k} w:w="{v}" w:type="dxa"/>' for k, v in look["margins"].items()) + "</w:tblCellMar>" if "margins" in look else ""
        props += '<w:tblW w:w="5000" w:type="pct"/><w:tblLayout w:type="fixed"/>' if percents else ""
        _merged(table, "tblPr", _fragments(props), TABLE_ORDER)
        for k, row in enumerate(rows):
            own = ('<w:tblHeader/>' if look.get("repeat") and not k else "") + ("<w:cantSplit/>" if look.get("whole") else "") + (f'<w:trHeight w:val="{look["height"]}" w:hRule="atLeast"/>' if look.get("height") else "")
            _merged(row, "trPr", _fragments(own), ROW_ORDER)
            for at, cell in _placed(row):
                part = f'<w:tcW w:w="{round(50 * sum(percents[at:at + _span(cell)]))}" w:type="pct"/>' if percents else ""
                part += f'<w:vAlign w:val="{look["vertical"]}"/>' if "vertical" in look else ""
                if not k:
                    part += f"<w:tcBorders>{edge('bottom', 6)}</w:tcBorders>" if kind == "three-line" else ""
                    part += f'<w:shd w:val="clear" w:color="auto" w:fill="{look["shading"]}"/>' if look.get("shading") else ""
                    if "shading" in look and look["shading"] is None and (old := cell.find(f"{w('tcPr')}/{w('shd')}")) is not None:
                        cell.find(w("tcPr")).remove(old)
                _merged(cell, "tcPr", _fragments(part), CELL_ORDER)
                for r in cell.iter(w("r")) if not k and "bold" in look else ():
                    _merged(r, "rPr", _fragments(style.run_xml({"bold": look["bold"]})), RUN_ORDER)

    def insert_table_row(self, op: dict) -> None:
        table, at = self.table(op), int(op.get("at", len(self.rows(self.table(op)))))
        rows = self.rows(table)
        new = copy.deepcopy(rows[min(at, len(rows) - 1)])
        for k, cell in enumerate(new.findall(w("tc"))):
            for extra in cell.findall(w("p"))[1:]:
                cell.remove(extra)
            values = op.get("values") or []
            set_text(cell.find(w("p")), str(values[k]) if k < len(values) else "")
        table.insert(list(table).index(rows[at]) if at < len(rows) else len(table), new)

    def delete_table_row(self, op: dict) -> None:
        table, rows = self.table(op), self.rows(self.table(op))
        if not 0 <= int(op.get("at", 0)) < len(rows):
            raise EngineError("INVALID_ARGS", f"the table has {len(rows)} rows")
        table.remove(rows[int(op.get("at", 0))])

    def insert_table_column(self, op: dict) -> None:
        """A column before the grid column `at`; a cell that spans this place grows by one."""
        for i, row in enumerate(self.rows(self.table(op))):
            placed = _placed(row)
            width = sum(_span(c) for _, c in placed)
            at = min(int(op.get("at", width)), width)
            over = next((c for start, c in placed if start < at < start + _span(c)), None)
            if over is not None:
                self._put(over.find(w("tcPr")), "gridSpan", str(_span(over) + 1))
                continue
            behind = next((c for start, c in placed if start == at), None)
            new = copy.deepcopy(behind if behind is not None else placed[-1][1])
            if (span := new.find(f"{w('tcPr')}/{w('gridSpan')}")) is not None:
                new.find(w("tcPr")).remove(span)
            for extra in new.findall(w("p"))[1:]:
                new.remove(extra)
            values = op.get("values") or []
            set_text(new.find(w("p")), str(values[i]) if i < len(values) else "")
            row.insert(list(row).index(behind) if behind is not None else len(row), new)

    def delete_table_column(self, op: dict) -> None:
        """The grid column `at`; a cell that spans more columns shrinks by one."""
        at = int(op.get("at", 0))
        for row in self.rows(self.table(op)):
            placed = _placed(row)
            cell = next((c for start, c in placed if start <= at < start + _span(c)), None)
            if cell is not None and _span(cell) > 1:
                self._put(cell.find(w("tcPr")), "gridSpan", str(_span(cell) - 1))
            elif cell is not None and len(placed) > 1:
                row.remove(cell)

    def _spanned(self, op: dict) -> tuple[list[ET.Element], int, int, int, int]:
        from tabweave.edit.workbook import range_ref
        _, r1, c1, r2, c2 = range_ref(op.get("range", ""))
        rows = self.rows(self.table(op))
        if r2 > len(rows):
            raise EngineError("INVALID_ARGS", f"the table has {len(rows)} rows")
        return rows[r1 - 1:r2], c1 - 1, c2 - 1, r1, r2

    def merge_table_cells(self, op: dict) -> None:
        rows, c1, c2, _, _ = self._spanned(op)
        for i, row in enumerate(rows):
            cells = row.findall(w("tc"))
            props = cells[c1].find(w("tcPr"))
            if props is None:
                props = ET.Element(w("tcPr"))
                cells[c1].insert(0, props)
            if c2 > c1:
                self._put(props, "gridSpan", str(c2 - c1 + 1))
                for cell in cells[c1 + 1:c2 + 1]:
                    for p in cell.findall(w("p")):
                        if text_of(p).strip():
                            cells[c1].append(p)
                    row.remove(cell)
            if len(rows) > 1:
                self._put(props, "vMerge", "continue" if i else "restart")

    def unmerge_table_cells(self, op: dict) -> None:
        rows, c1, _, _, _ = self._spanned(op)
        undone = 0
        for row in rows:
            cell = row.findall(w("tc"))[c1]
            props = cell.find(w("tcPr"))
            span, tall = (props.find(w("gridSpan")), props.find(w("vMerge"))) if props is not None else (None, None)
            for e in (span, tall):
                if e is not None:
                    props.remove(e)
                    undone += 1
            if span is not None:
                for _ in range(int(span.get(w("val"), "1")) - 1):
                    new = ET.Element(w("tc"))
                    ET.SubElement(new, w("p"))
                    row.insert(list(row).index(cell) + 1, new)
        if not undone:
            raise EngineError("TABLE_NOT_MERGED", f"{op.get('range')} is not merged")

    def delete_table(self, op: dict) -> None:
        chosen = self.tables() if op.get("all") or op.get("onlyEmpty") else [self.table(op)]
        if op.get("onlyEmpty"):
            chosen = [t for t in chosen if not any(text_of(p).strip() for p in t.iter(w("p")))]
        for t in chosen:
            holder = self.parent(t)
            holder.remove(t)
            if holder.tag in (w("tc"), w("body")) and not holder.findall(w("p")):
                holder.insert(len(holder) - (len(holder) > 0 and holder[-1].tag == w("sectPr")), ET.Element(w("p")))
        self.report.append({"op": "delete_table", "count": len(chosen)})

    def set_numbering(self, op: dict) -> None:
        """Multi-level numbers on headings, and on list items of the body one level below the heading they follow.

        exclude names levels (Heading1, h2), texts or indices that take no number; startFrom is the first number.
        The list is the document's own; a document without a numbering part gets one, and a second call replaces the first."""
        preset, start = str(op.get("preset") or op.get("style") or "decimal"), int(op.get("startFrom") or 1)
        if preset not in NUMBERINGS:
            raise EngineError("INVALID_ARGS", f"unknown numbering {preset!r}; there are {', '.join(NUMBERINGS)}")
        skip = op.get("exclude") or []
        if not isinstance(skip, list):
            raise EngineError("INVALID_ARGS", 'exclude is an array such as ["Heading1"]')
        out = {int(m[1]) for x in skip if (m := _LEVEL.fullmatch(str(x).strip().lower().replace(" ", ""))) and not isinstance(x, int)}
        levels = [n for n in range(1, 10) if n not in out]  # heading level at each level of the list
        number = self._list(preset, start)
        wanted = {id(e) for e, _, _ in self.chosen(op)} if any(op.get(k) is not None for k in ("scope", "from", "to", "paragraph", "match", "index")) else None
        at, headings, items, skipped = None, 0, 0, 0
        for k, (p, inside, level) in enumerate(self.paragraphs()):
            if level is not None:
                at = levels.index(level) if level in levels and not inside and not (skip and (k in skip or text_of(p).strip() in skip)) else None
            if wanted is not None and id(p) not in wanted:
                continue
            listed = p.find(f"{w('pPr')}/{w('numPr')}") is not None
            if level is None and not listed:
                continue
            if at is None:
                skipped += level is None
                continue
            depth = at if level is not None else min(8, at + 1)
            headings, items = headings + (level is not None), items + (level is None)
            _merged(p, "pPr", _fragments(f'<w:numPr><w:ilvl w:val="{depth}"/><w:numId w:val="{number}"/></w:numPr>'), PARAGRAPH_ORDER)
        if not headings and not items:
            raise EngineError("PARAGRAPH_NOT_FOUND", "set_numbering: no heading or list item to number")
        self.report.append({"op": "set_numbering", "headings": headings, "items": items, "skipped": skipped})

    def _list(self, preset: str, start: int) -> str:
        """The number of the list of a preset, which is made (with the numbering part, where there is none) or updated."""
        part = next((t for k, t in self.doc.relations.values() if k == "numbering"), None)
        held = getattr(self, "numbering", None)
        if held is None:
            held = self.doc.pack.read(part) if part and self.doc.pack.has(part) else b""
        if part is None:
            part = "word/numbering.xml"
            self._related(part, "numbering", "application/vnd.openxmlformats-officedocument.wordprocessingml.numbering+xml")
        self.numbering, self.numbering_part = _with_list(held, preset, start), part
        return _list_number(preset)

    def _related(self, part: str, kind: str, content_type: str) -> None:
        """Adds a part to the package's relations and content types."""
        rels = f"{self.doc.part.rpartition('/')[0]}/_rels/{self.doc.part.rpartition('/')[2]}.rels"
        tree = self.doc.pack.xml(rels) if self.doc.pack.has(rels) else ET.Element(f"{{{PACKAGE}/relationships}}Relationships")
        ET.SubElement(tree, f"{{{PACKAGE}/relationships}}Relationship", {"Id": f"{kind}900", "Type": f"http://schemas.openxmlformats.org/officeDocument/2006/relationships/{kind}", "Target": part.rpartition("/")[2]})
        types = self.doc.pack.xml("[Content_Types].xml")
        ET.SubElement(types, f"{{{PACKAGE}/content-types}}Override", {"PartName": f"/{part}", "ContentType": content_type})
        for name, root, space in ((rels, tree, "relationships"), ("[Content_Types].xml", types, "content-types")):
            ET.register_namespace("", f"{PACKAGE}/{space}")
            self.added[name] = xml_bytes(root)
        self.doc.relations[f"{kind}900"] = (kind, part)

    def bytes(self) -> bytes:
        ET.register_namespace("w", "http://schemas.openxmlformats.org/wordprocessingml/2006/main")
        ET.register_namespace("r", "http://schemas.openxmlformats.org/officeDocument/2006/relationships")
        parts = self.added | {self.doc.part: xml_bytes(self.doc.root)}
        if hasattr(self, "numbering"):
            parts[self.numbering_part] = self.numbering
        return repacked(self.doc.pack, parts)


OPERATIONS = ("replace_text", "set_paragraph", "set_style", "insert_paragraph", "delete_paragraph", "set_table", "insert_table_row", "delete_table_row", "insert_table_column", "delete_table_column", "merge_table_cells", "unmerge_table_cells", "delete_table", "set_numbering")


def edited(data: bytes, script: list[dict], dry_run: bool = False) -> tuple[bytes, list[dict]]:
    """(document, report); with dry_run the document as it was."""
    if len(script) > OPS:
        raise EngineError("INVALID_ARGS", f"at most {OPS} steps")
    editor = Editor(data)
    for i, op in enumerate(script):
        if op.get("op") not in OPERATIONS:
            raise EngineError("INVALID_ARGS", f"unknown step {op.get('op')!r}; there are {', '.join(OPERATIONS)}")
        run: Callable[[dict], None] = getattr(editor, op["op"])
        try:
            run(op)
        except EngineError as e:
            if not op.get("optional"):
                raise
            editor.report.append({"op": op["op"], "step": i + 1, "skipped": str(e)})
    return (data if dry_run else editor.bytes()), editor.report


def edited_files(files: DataFrame, script: list[dict]) -> DataFrame:
    """files: path, content; the same script on every document, one at a time in parallel."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([edited(c, script)[0] for c in batch.column(1).to_pylist()], pa.binary())], ["path", "content"])

    return files.select("path", "content").mapInArrow(run, "path string, content binary")
