"""What sheets look like: widths, heights, merges, panes, filters, cell styles, conditional formats and validations.

Steps of edit scripts and what a workbook already has are kept in one form, lists of steps by kind; this module reads
them from the parts of a workbook and writes them as parts."""

from __future__ import annotations

import json
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import lru_cache
from xml.sax.saxutils import escape, quoteattr

from tabweave.edit.rules import COMPARISONS, ICON_STOPS, period
from tabweave.errors import EngineError
from tabweave.functions.model import column_index, column_letter
from tabweave.sources.package import local, opened, parse_xml, remembered, sheet_entries
from tabweave.text.style import hex_color

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
RANGE = re.compile(r"\$?[A-Z]+\$?\d+(?::\$?[A-Z]+\$?\d+)?")
# Kinds of rules and what the format calls them.
TEXT_RULES = {"containsText": "containsText", "notContains": "notContainsText", "beginsWith": "beginsWith", "endsWith": "endsWith", "containsBlanks": "containsBlanks", "notContainsBlanks": "notContainsBlanks", "containsErrors": "containsErrors", "notContainsErrors": "notContainsErrors"}
VALIDATIONS = ("list", "whole", "decimal", "date", "textLength", "custom")


def _wrong(message: str) -> EngineError:
    return EngineError("INVALID_ARGS", message)


# Cell styles: {"font": {tag: attributes}, "fill": attributes of the colour, "border": xml, "numFmt": code, "alignment": attributes}.

def cell_style(spec: dict) -> dict:
    """Of a step's style: bold, italic, underline, fontSize, font, color, fill, numFmt, align, valign, wrap, border, borderColor."""
    if not isinstance(spec, dict):
        raise _wrong("a style is an object such as {\"bold\": true}")
    rgb = lambda key: {"rgb": "FF" + (hex_color(spec[key]) or _bad(key)).upper()}
    font = {tag: {} for key, tag in (("bold", "b"), ("italic", "i"), ("underline", "u")) if spec.get(key)}
    font |= {"sz": {"val": str(spec.get("fontSize") or spec.get("size"))}} if spec.get("fontSize") or spec.get("size") else {}
    font |= {"color": rgb("color")} if spec.get("color") else {}
    font |= {"name": {"val": str(spec["font"])}} if spec.get("font") else {}
    out: dict = {"font": font} if font else {}
    out |= {"fill": rgb("fill")} if spec.get("fill") else {}
    out |= {"numFmt": str(spec["numFmt"])} if spec.get("numFmt") else {}
    place = {name: str(spec[key]) for key, name in (("align", "horizontal"), ("valign", "vertical")) if spec.get(key)} | ({"wrapText": "1"} if spec.get("wrap") else {})
    out |= {"alignment": place} if place else {}
    if spec.get("border"):
        line = f'<color rgb="FF{(hex_color(spec.get("borderColor") or "000000") or _bad("borderColor")).upper()}"/>'
        out["border"] = "<border>" + "".join(f'<{s} style="thin">{line}</{s}>' for s in ("left", "right", "top", "bottom")) + "</border>"
    return out


def _bad(key: str) -> str:
    raise _wrong(f"{key} is a colour as RRGGBB")


def laid_over(old: str | None, new: dict) -> str:
    """A stored style with a new one over it."""
    out = json.loads(old) if old else {}
    for key, value in new.items():
        out[key] = {**out.get(key, {}), **value} if isinstance(value, dict) and key != "fill" else value
    return json.dumps(out, sort_keys=True)


def _tag(name: str, attrs: dict) -> str:
    return f"<{name}{''.join(f' {k}={quoteattr(str(v))}' for k, v in attrs.items())}/>"


def _font(font: dict) -> str:
    order = ("b", "i", "strike", "u", "vertAlign", "sz", "color", "name", "family", "charset", "scheme")
    return "<font>" + "".join(_tag(t, font[t]) for t in order if t in font) + "</font>"


@lru_cache(maxsize=1024)
def _parts(style: str) -> tuple:
    """Of a stored style: its number format, and the XML of its font, border, fill and alignment."""
    of = json.loads(style)
    fill = f'<fill><patternFill patternType="solid">{_tag("fgColor", of["fill"])}</patternFill></fill>' if of.get("fill") else ""
    return of.get("numFmt"), _font(of["font"]) if "font" in of else "", of.get("border") or "", fill, _tag("alignment", of["alignment"]) if of.get("alignment") else ""


class Styles:
    """The style part of a workbook: registers styles as they are used."""

    def __init__(self) -> None:
        self.numbers: dict[tuple[str, int], int] = {}
        self.fonts, self.fills, self.borders, self.formats, self.xfs, self.dxfs = ["<font/>"], ["<fill/>", '<fill><patternFill patternType="gray125"/></fill>'], ["<border/>"], {}, [], []
        for built_in in (0, 14, 10):  # general, date, percentage: what the writer of cells counts on
            self.xfs.append(f'<xf numFmtId="{built_in}" fontId="0" fillId="0" borderId="0"{" applyNumberFormat=\"1\"" if built_in else ""}/>')

    @staticmethod
    def _at(held: list[str], xml: str) -> int:
        if xml not in held:
            held.append(xml)
        return held.index(xml)

    def number(self, style: str | None, base: int = 0) -> int:
        """The number of a cell's style; base: that of its kind of value, which gives the number format if the style has none."""
        if not style:
            return base
        if (style, base) not in self.numbers:
            self.numbers[style, base] = self._number(style, base)
        return self.numbers[style, base]

    def _number(self, style: str, base: int) -> int:
        code, *looks, place = _parts(style)
        code_id = (0, 14, 10)[base] if code is None else code if isinstance(code, int) else self.formats.setdefault(code, 164 + len(self.formats))
        font, border, fill = (self._at(held, xml) if xml else 0 for held, xml in zip((self.fonts, self.borders, self.fills), looks, strict=True))
        return self._at(self.xfs, f'<xf numFmtId="{code_id}" fontId="{font}" fillId="{fill}" borderId="{border}" applyNumberFormat="1" applyFont="1" applyFill="1" applyBorder="1"{" applyAlignment=\"1\"" if place else ""}>{place}</xf>')

    def difference(self, xml: str) -> int:
        return self._at(self.dxfs, xml)

    def xml(self) -> str:
        held = lambda name, items: f'<{name} count="{len(items)}">{"".join(items)}</{name}>' if items else ""
        formats = [f"<numFmt numFmtId=\"{n}\" formatCode={quoteattr(code)}/>" for code, n in self.formats.items()]
        return (f'<?xml version="1.0" encoding="UTF-8"?><styleSheet xmlns="{MAIN}">{held("numFmts", formats)}{held("fonts", self.fonts)}{held("fills", self.fills)}{held("borders", self.borders)}'
                f'<cellStyleXfs count="1"><xf/></cellStyleXfs>{held("cellXfs", self.xfs)}{held("dxfs", self.dxfs)}</styleSheet>')


def difference_xml(spec: dict | None) -> str | None:
    """The format of a rule: fills go by the background colour there."""
    of = cell_style(spec) if spec else {}
    if not of:
        return None
    fill = f'<fill><patternFill patternType="solid">{_tag("bgColor", of["fill"])}</patternFill></fill>' if "fill" in of else ""
    code = f'<numFmt numFmtId="164" formatCode={quoteattr(of["numFmt"])}/>' if "numFmt" in of else ""
    return f"<dxf>{_font(of['font']) if 'font' in of else ''}{code}{fill}{of.get('border', '')}</dxf>"


# Rules.

def rule_xml(rule: dict, ref: str) -> str:
    """A conditional format without its difference style."""
    kind, first = rule.get("type"), ref.partition(":")[0].replace("$", "")
    values = [str(v) for v in (rule["values"] if isinstance(rule.get("values"), list) else [rule.get("value"), rule.get("value2")]) if v is not None]
    formulas = lambda items: "".join(f"<formula>{escape(str(x))}</formula>" for x in items)
    rgb = lambda c: f'<color rgb="FF{(hex_color(c) or _bad("color")).upper()}"/>'
    if kind == "cellIs":
        operator = rule.get("operator") or "greaterThan"
        if operator not in COMPARISONS or len(values) < (2 if "etween" in operator else 1):
            raise _wrong(f"cellIs: an operator of {', '.join(COMPARISONS)}, with one value, or two for between and notBetween")
        return f'type="cellIs" operator="{operator}">{formulas(values[:2 if "etween" in operator else 1])}'
    if kind == "expression":
        text = str(rule.get("formula") or rule.get("value") or "").lstrip("=")
        if not text:
            raise _wrong("expression needs a formula")
        return f'type="expression">{formulas([text])}'
    if kind == "colorScale":
        colors = rule.get("colors") or ["FFFFFF", "638EC6"]
        if len(colors) not in (2, 3):
            raise _wrong("colorScale takes two or three colors")
        stops = '<cfvo type="min"/>' + ('<cfvo type="percentile" val="50"/>' if len(colors) == 3 else "") + '<cfvo type="max"/>'
        return f'type="colorScale"><colorScale>{stops}{"".join(map(rgb, colors))}</colorScale>'
    if kind == "dataBar":
        return f'type="dataBar"><dataBar><cfvo type="min"/><cfvo type="max"/>{rgb(rule.get("color") or "638EC6")}</dataBar>'
    if kind == "iconSet":
        name = str(rule.get("iconSet") or "3TrafficLights1")
        stops = ICON_STOPS.get(int(name[0]) if name[0].isdigit() else 3, ICON_STOPS[3])
        hidden = ' showValue="0"' if rule.get("showValue") is False else ""
        return f'type="iconSet"><iconSet iconSet={quoteattr(name)}{hidden}>{"".join(f"<cfvo type=\"percent\" val=\"{s}\"/>" for s in stops)}</iconSet>'
    if kind == "top10":
        return f'type="top10" rank="{int(rule.get("rank") or 10)}"{" percent=\"1\"" if rule.get("percent") else ""}{" bottom=\"1\"" if rule.get("bottom") else ""}>'
    if kind == "aboveAverage":
        return f'type="aboveAverage"{" aboveAverage=\"0\"" if rule.get("aboveAverage") is False else ""}>'
    if kind == "containsText":
        operator, text = rule.get("operator") or "containsText", str(rule.get("text") or "")
        if operator not in TEXT_RULES or not text and not operator.lower().endswith(("blanks", "errors")):
            raise _wrong(f"containsText: an operator of {', '.join(TEXT_RULES)} and a text")
        said = '"' + text.replace('"', '""') + '"'
        check = {"containsText": f"NOT(ISERROR(SEARCH({said},{first})))", "notContains": f"ISERROR(SEARCH({said},{first}))", "beginsWith": f"LEFT({first},{len(text)})={said}", "endsWith": f"RIGHT({first},{len(text)})={said}", "containsBlanks": f"LEN(TRIM({first}))=0",
                 "notContainsBlanks": f"LEN(TRIM({first}))>0", "containsErrors": f"ISERROR({first})", "notContainsErrors": f"NOT(ISERROR({first}))"}[operator]
        named = f" operator=\"{'notContains' if operator == 'notContains' else operator}\" text={quoteattr(text)}" if text else ""
        return f'type="{TEXT_RULES[operator]}"{named}>{formulas([check])}'
    if kind == "timePeriod":
        from datetime import date
        name = rule.get("timePeriod") or "today"
        period(name, date(2000, 1, 1))  # raises for unknown names
        return f'type="timePeriod" timePeriod="{name}">{formulas([f"FLOOR({first},1)=TODAY()"])}'
    raise _wrong(f"unknown conditional format {kind!r}")


def validation_xml(op: dict) -> str:
    rule = op["rule"] if isinstance(op.get("rule"), dict) else op
    kind = rule.get("type") or "list"
    if kind not in VALIDATIONS:
        raise _wrong(f"unknown validation {kind!r}; there are {', '.join(VALIDATIONS)}")
    if kind == "list":
        if rule.get("values"):
            formulas = ['"' + ",".join(str(v).replace('"', "") for v in rule["values"]) + '"']
        elif rule.get("source"):
            formulas = [str(rule["source"]).lstrip("=")]
        else:
            raise _wrong("a list needs values or a source")
    else:
        formulas = [str(v) for v in (rule["values"] if isinstance(rule.get("values"), list) else [rule.get("value", rule.get("formula")), rule.get("value2")]) if v is not None]
        if not formulas:
            raise _wrong("a validation needs value, values or formula")
    operator = rule.get("operator") or "between"
    if kind not in ("list", "custom") and operator not in COMPARISONS:
        raise _wrong(f"unknown comparison {operator!r}")
    attrs = {"type": kind} | ({} if kind in ("list", "custom") else {"operator": operator}) | {"allowBlank": str(int(rule.get("allowBlank") is not False)), "showErrorMessage": str(int(rule.get("error") is not None or bool(rule.get("showErrorMessage")))), "showInputMessage": str(int(rule.get("prompt") is not None))}
    attrs |= {k: str(rule[k]) for k in ("errorTitle", "error", "errorStyle", "promptTitle", "prompt") if rule.get(k) is not None} | {"sqref": op["range"]}
    return f"<dataValidation{''.join(f' {k}={quoteattr(v)}' for k, v in attrs.items())}>" + "".join(f"<formula{i}>{escape(x)}</formula{i}>" for i, x in enumerate(formulas[:2], 1)) + "</dataValidation>"


# Sheets.

@dataclass
class Look:
    """The XML around a sheet's rows, and the heights of rows."""

    before: str = ""
    after: str = ""
    heights: dict[int, float] = field(default_factory=dict)


def column_number(value: object) -> int:
    return int(value) if isinstance(value, int) or str(value).isdigit() else column_index(str(value)) + 1


def look_of(shown: dict[str, list], sheet: str, styles: Styles) -> Look:
    """Of the steps of a sheet; later ones win where there can be one only."""
    own = {kind: [op for op in ops if op["sheet"] == sheet] for kind, ops in shown.items()}
    pane, widths = next(iter(own["freeze"][-1:]), None), {column_number(op["col"]): float(op["width"]) for op in own["col_width"]}
    before = ""
    if pane and (int(pane.get("rows") or 0) or int(pane.get("cols") or 0)):
        rows, cols = int(pane.get("rows") or 0), int(pane.get("cols") or 0)
        corner = {(True, True): "bottomRight", (True, False): "bottomLeft", (False, True): "topRight"}[bool(rows), bool(cols)]
        split = (f' xSplit="{cols}"' if cols else "") + (f' ySplit="{rows}"' if rows else "")
        before += f'<sheetViews><sheetView workbookViewId="0"><pane{split} topLeftCell="{column_letter(cols)}{rows + 1}" activePane="{corner}" state="frozen"/></sheetView></sheetViews>'
    if widths:
        before += "<cols>" + "".join(f'<col min="{c}" max="{c}" width="{x}" customWidth="1"/>' for c, x in sorted(widths.items())) + "</cols>"
    after = f'<autoFilter ref="{own["auto_filter"][-1]["range"]}"/>' if own["auto_filter"] else ""
    merges = list(dict.fromkeys(op["range"] for op in own["merge"]))
    after += f'<mergeCells count="{len(merges)}">' + "".join(f'<mergeCell ref="{m}"/>' for m in merges) + "</mergeCells>" if merges else ""
    priority = 0
    for op in own["conditional_format"]:
        items = op["rules"] if isinstance(op.get("rules"), list) else [op["rule"] if isinstance(op.get("rule"), dict) else op]
        made = ""
        for rule in items:
            priority += 1
            look = rule.get("dxf") or difference_xml(rule.get("style"))
            number = f' dxfId="{styles.difference(look)}"' if look else ""
            made += f'<cfRule priority="{priority}"{number} {rule["raw"] if "raw" in rule else rule_xml(rule, op["range"])}</cfRule>'
        after += f'<conditionalFormatting sqref="{op["range"]}">{made}</conditionalFormatting>'
    if own["data_validation"]:
        after += f'<dataValidations count="{len(own["data_validation"])}">' + "".join(op["raw"].replace("\0", op["range"]) if "raw" in op else validation_xml(op) for op in own["data_validation"]) + "</dataValidations>"
    return Look(before, after, {int(op["row"]): float(op["height"]) for op in own["row_height"]})


# Reading.

def _plain(e: ET.Element, inner: bool = True, **other: str) -> str:
    """An element as XML without namespaces. other: attributes that it gets in place of its own."""
    name = local(e.tag)
    attrs = "".join(f" {local(k)}={quoteattr(v)}" for k, v in (e.attrib | other).items())
    body = escape(e.text or "") + "".join(_plain(c) for c in e) if inner else ""
    return f"<{name}{attrs}>{body}</{name}>"


@remembered
def _read_styles(data: bytes) -> tuple[list[str | None], list[str]]:
    part = {local(e.tag): list(e) for e in parse_xml(data)}
    codes = {f.get("numFmtId"): f.get("formatCode", "") for f in part.get("numFmts", [])}
    out: list[str | None] = []
    for xf in part.get("cellXfs", []):
        of: dict = {}
        code = xf.get("numFmtId", "0")
        if code != "0":
            of["numFmt"] = codes.get(code, int(code))
        pick = lambda name, key: next(iter(part.get(name, [])[int(xf.get(key) or 0):][:1]), None)
        if int(xf.get("fontId") or 0) and (font := pick("fonts", "fontId")) is not None:
            of["font"] = {local(c.tag): dict(c.attrib) for c in font}
        if int(xf.get("fillId") or 0) > 1 and (fill := pick("fills", "fillId")) is not None:
            color = next((c for c in fill.iter() if local(c.tag) == "fgColor"), None)
            of |= {"fill": dict(color.attrib)} if color is not None else {}
        if int(xf.get("borderId") or 0) and (border := pick("borders", "borderId")) is not None:
            of["border"] = _plain(border)
        place = next((c for c in xf if local(c.tag) == "alignment"), None)
        of |= {"alignment": dict(place.attrib)} if place is not None else {}
        out.append(json.dumps(of, sort_keys=True) if of else None)
    return out, [_plain(d) for d in part.get("dxfs", [])]


def read(data: bytes) -> tuple[list[str], dict[str, list], list[tuple[str, int, int, str]], list[str]]:
    """Of a workbook: sheet names, steps by kind, (sheet, row, col, style) of styled cells, and notes on what is not kept."""
    pack = opened(data)
    _, main = pack.main_part()
    rels = pack.relations(main)
    look = next((t for k, t in rels.values() if k == "styles"), None)
    styles, differences = _read_styles(pack.read(look)) if look and pack.has(look) else ([], [])
    names, shown, cells, notes = [], {k: [] for k in KINDS}, [], []
    for name, at in sheet_entries(pack.read(main)):
        names.append(name)
        for e in pack.tree(rels[at][1]):
            tag = local(e.tag)
            if tag == "cols":
                shown["col_width"] += [{"sheet": name, "col": c, "width": float(x.get("width") or 9)} for x in e for c in range(int(x.get("min", 1)), min(int(x.get("max", 1)), 200) + 1)]
            elif tag == "sheetViews":
                for pane in (x for x in e.iter() if local(x.tag) == "pane" and x.get("state") == "frozen"):
                    shown["freeze"].append({"sheet": name, "rows": int(float(pane.get("ySplit") or 0)), "cols": int(float(pane.get("xSplit") or 0))})
            elif tag == "autoFilter":
                shown["auto_filter"].append({"sheet": name, "range": e.get("ref", "")})
            elif tag == "mergeCells":
                shown["merge"] += [{"sheet": name, "range": x.get("ref", "")} for x in e]
            elif tag == "conditionalFormatting":
                rules = []
                for x in e:
                    attrs = "".join(f" {k}={quoteattr(v)}" for k, v in x.attrib.items() if k not in ("priority", "dxfId"))
                    at = x.get("dxfId")
                    rules.append({"raw": f"{attrs.strip()}>{''.join(_plain(c) for c in x)}", "dxf": differences[int(at)] if at and int(at) < len(differences) else None})
                shown["conditional_format"].append({"sheet": name, "range": e.get("sqref", ""), "rules": rules})
            elif tag == "dataValidations":
                for x in e:
                    shown["data_validation"].append({"sheet": name, "range": x.get("sqref", ""), "raw": _plain(x, sqref="\0")})
            elif tag in ("drawing", "legacyDrawing", "picture"):
                notes.append(f"{name}: drawings are not kept")
            elif tag == "sheetData":
                for row in e:
                    if row.get("ht") and row.get("customHeight") in ("1", "true"):
                        shown["row_height"].append({"sheet": name, "row": int(row.get("r") or 0), "height": float(row.get("ht"))})
                    for c in row:
                        style = styles[int(c.get("s") or 0)] if int(c.get("s") or 0) < len(styles) else None
                        m = re.fullmatch(r"([A-Z]+)(\d+)", c.get("r") or "")
                        if style and m:
                            cells.append((name, int(m[2]), column_index(m[1]) + 1, style))
    return names, shown, cells, notes


KINDS = ("merge", "col_width", "row_height", "freeze", "auto_filter", "image", "chart", "conditional_format", "data_validation")


def shifted(ref: str, axis: str, at: int, n: int, insert: bool) -> str | None:
    """A range (or several, blank-separated) after rows or columns were put in or taken out; null if nothing is left."""
    out = []
    for part in ref.split():
        found = [re.fullmatch(r"\$?([A-Z]+)\$?(\d+)", x) for x in part.split(":")]
        if not all(found):
            out.append(part)
            continue
        ends = [[int(m[2]), column_index(m[1]) + 1] for m in (found[0], found[-1])]
        k = 0 if axis == "row" else 1
        low, high = ends[0][k], ends[1][k]
        if insert:
            low, high = low + n * (low >= at), high + n * (high >= at)
        else:
            gone = lambda x: min(max(x - at, 0), n)
            low, high = low - gone(low), high - gone(high + 1)
            if high < low:
                continue
        ends[0][k], ends[1][k] = low, high
        names = [f"{column_letter(c - 1)}{r}" for r, c in ends]
        out.append(names[0] if names[0] == names[1] and ":" not in part else ":".join(names))
    return " ".join(out) or None


def moved(shown: dict[str, list], sheet: str, axis: str, at: int, n: int, insert: bool) -> None:
    """Moves what is kept of a sheet along with its rows or columns."""
    for ops in shown.values():
        for op in [o for o in ops if o["sheet"] == sheet]:
            if op.get("range"):
                op["range"] = shifted(op["range"], axis, at, n, insert)
                if op["range"] is None:
                    ops.remove(op)
    kind, key = ("row_height", "row") if axis == "row" else ("col_width", "col")
    kept: list[dict] = []
    for op in shown[kind]:
        place = column_number(op[key])
        if op["sheet"] == sheet and not insert and at <= place < at + n:
            continue
        kept.append({**op, key: place + (n if insert else -n) * (place >= at)} if op["sheet"] == sheet else op)
    shown[kind] = kept


def all_ranges(ops: Iterable[dict]) -> None:
    for op in ops:
        if not RANGE.fullmatch(str(op.get("range") or "")):
            raise _wrong(f"range is like A1:A20, not {op.get('range')!r}")
