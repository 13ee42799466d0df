"""Word documents: paragraphs with effective formats, numbering made text, HTML of them, and a writer."""

from __future__ import annotations

import html
import re
import xml.etree.ElementTree as ET
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from xml.sax.saxutils import escape

from tabweave.errors import EngineError
from tabweave.sources.package import Package, archive, local, parse_xml, remembered
from tabweave.text.html import HEADINGS, Node, safe_link, tree
from tabweave.text.numbering import Counters

W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
R = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_HEADING = re.compile(r"^(?:heading|标题)\s*([1-9])$", re.I)
CHAIN = 12


@lru_cache(maxsize=1024)
def w(name: str) -> str:
    return f"{{{W}}}{name}"


@dataclass(frozen=True, slots=True)
class Format:
    """What a run or paragraph looks like; None where nothing in the chain of styles says."""

    font: str | None = None
    east_asian: str | None = None
    size: float | None = None
    bold: bool | None = None
    italic: bool | None = None
    underline: bool | None = None
    color: str | None = None
    align: str | None = None
    line_rule: str | None = None
    line: float | None = None
    first_line: float | None = None
    left: float | None = None
    before: float | None = None
    after: float | None = None

    def under(self, other: Format) -> Format:
        """other's values where it has them, else one's own."""
        return self if other is PLAIN else _over(self, other)


@lru_cache(maxsize=4096)
def _over(one: Format, other: Format) -> Format:
    return Format(**{k: v if (v := getattr(other, k)) is not None else getattr(one, k) for k in Format.__dataclass_fields__})


PLAIN = Format()


@dataclass
class Paragraph:
    index: int
    text: str
    style: str | None
    level: int | None
    in_table: bool
    number: str
    format: Format
    runs: list[tuple[str, Format, str | None]] = field(default_factory=list)


def _on(e: ET.Element | None) -> bool | None:
    return None if e is None else e.get(w("val"), "1") not in ("0", "false", "none", "off")


def _value(e: ET.Element | None, name: str = "val") -> str | None:
    return None if e is None else e.get(w(name))


def _points(value: str | None, per: float = 20) -> float | None:
    return float(value) / per if value and re.fullmatch(r"-?\d+(\.\d+)?", value) else None


_SHAPES = {w("spacing"), w("ind"), w("jc")}


def run_format(props: ET.Element | None, themes: dict[str, str]) -> Format:
    if props is None:
        return PLAIN
    fonts = props.find(w("rFonts"))
    pick = lambda *keys: next((fonts.get(w(k)) if "Theme" not in k else themes.get(fonts.get(w(k)) or "") for k in keys if fonts is not None and fonts.get(w(k))), None)
    return Format(font=pick("ascii", "hAnsi", "asciiTheme"), east_asian=pick("eastAsia", "eastAsiaTheme"), size=_points(_value(props.find(w("sz"))), 2), bold=_on(props.find(w("b"))), italic=_on(props.find(w("i"))), underline=_on(props.find(w("u"))), color=_value(props.find(w("color"))))


def paragraph_format(props: ET.Element | None) -> Format:
    if props is None or not {c.tag for c in props} & _SHAPES:
        return PLAIN
    space, indent = props.find(w("spacing")), props.find(w("ind"))
    rule = _value(space, "lineRule") or ("auto" if _value(space, "line") else None)
    return Format(align=_value(props.find(w("jc"))), line_rule=rule, line=_points(_value(space, "line"), 240 if rule == "auto" else 20), first_line=_points(_value(indent, "firstLine")), left=_points(_value(indent, "left") or _value(indent, "start")), before=_points(_value(space, "before")), after=_points(_value(space, "after")))


@remembered
def _themes(data: bytes) -> dict[str, str]:
    out = {}
    for kind in ("major", "minor"):
        for e in parse_xml(data).iter() if data else ():
            if local(e.tag) == f"{kind}Font":
                for f in e:
                    if local(f.tag) in ("latin", "ea") and f.get("typeface"):
                        for name in (("Ascii", "HAnsi") if local(f.tag) == "latin" else ("EastAsia",)):
                            out[f"{kind}{name}"] = f.get("typeface")
    return out


class Styles:
    """The styles of a document; what follows from a chain of them is worked out once."""

    def __init__(self, root: ET.Element | None, themes: dict[str, str]) -> None:
        self.styles: dict[str, tuple[str, str | None, Format, int | None, ET.Element | None]] = {}
        self.defaults, self.normal = PLAIN, None
        self.formats: dict[str | None, Format] = {}
        self.levels: dict[str | None, int | None] = {}
        self.numbers: dict[str | None, tuple[str, int] | None] = {}
        if root is None:
            return
        for kind, name in ((run_format, "rPrDefault"), (paragraph_format, "pPrDefault")):
            e = root.find(f"{w('docDefaults')}/{w(name)}/{w(name[:3])}")
            self.defaults = self.defaults.under(kind(e, themes) if kind is run_format else kind(e))
        for s in root.findall(w("style")):
            name, ppr = _value(s.find(w("name"))) or "", s.find(w("pPr"))
            level = _HEADING.match(name) or _HEADING.match(s.get(w("styleId"), ""))
            outline = _value(ppr.find(w("outlineLvl"))) if ppr is not None else None
            self.styles[s.get(w("styleId"), "")] = (name, _value(s.find(w("basedOn"))), paragraph_format(ppr).under(run_format(s.find(w("rPr")), themes)), int(level[1]) if level else int(outline) + 1 if outline and int(outline) < 9 else None, ppr)
            if s.get(w("default")) in ("1", "true") and s.get(w("type")) == "paragraph":
                self.normal = s.get(w("styleId"))

    def chain(self, style: str | None) -> list[str]:
        """A style and what it is based on, the nearest first; cycles and overlong chains end."""
        out: list[str] = []
        while style in self.styles and style not in out and len(out) < CHAIN:
            out.append(style)
            style = self.styles[style][1]
        return out

    def _known(self, style: str | None) -> str | None:
        return style if style in self.styles else None  # what is remembered does not grow with styles that are not there

    def styled(self, style: str | None) -> Format:
        style = self._known(style or self.normal)
        if style not in self.formats:
            out = self.defaults
            for s in reversed(self.chain(style)):
                out = out.under(self.styles[s][2])
            self.formats[style] = out
        return self.formats[style]

    def level(self, style: str | None) -> int | None:
        style = self._known(style)
        if style not in self.levels:
            self.levels[style] = next((self.styles[s][3] for s in self.chain(style) if self.styles[s][3]), None)
        return self.levels[style]

    def numbered(self, style: str | None) -> tuple[str, int] | None:
        style = self._known(style)
        if style not in self.numbers:
            self.numbers[style] = next((found for s in self.chain(style) if (found := _number(self.styles[s][4]))), None)
        return self.numbers[style]


def _number(props: ET.Element | None) -> tuple[str, int] | None:
    """(list, level) that properties name; list 0 is none."""
    num = props.find(w("numPr")) if props is not None else None
    if num is not None and (found := _value(num.find(w("numId")))):
        return found, int(_value(num.find(w("ilvl"))) or 0) if found != "0" else 0
    return None


@remembered
def _styles(data: bytes, themes: tuple[tuple[str, str], ...]) -> Styles:
    return Styles(parse_xml(data) if data else None, dict(themes))


Levels = tuple[dict[int, int], dict[int, str], dict[int, str]]


@remembered
def _lists(data: bytes) -> dict[str, Levels]:
    """Of each list, by level: starts, forms and patterns."""
    out: dict[str, Levels] = {}
    if not data:
        return out
    root = parse_xml(data)
    level = lambda e: (int(e.get(w("ilvl"), "0")), (int(_value(e.find(w("start"))) or 1), _value(e.find(w("numFmt"))) or "decimal", _value(e.find(w("lvlText"))) or ""))
    abstract = {a.get(w("abstractNumId")): dict(level(x) for x in a.findall(w("lvl"))) for a in root.findall(w("abstractNum"))}
    for n in root.findall(w("num")):
        levels = dict(abstract.get(_value(n.find(w("abstractNumId"))), {}))
        for o in n.findall(w("lvlOverride")):
            k = int(o.get(w("ilvl"), "0"))
            if o.find(w("lvl")) is not None:
                levels[k] = level(o.find(w("lvl")))[1]
            elif o.find(w("startOverride")) is not None and k in levels:
                levels[k] = (int(_value(o.find(w("startOverride"))) or 1), *levels[k][1:])
        out[n.get(w("numId"), "")] = tuple({k: v[i] for k, v in levels.items()} for i in range(3))
    return out


class Document:
    def __init__(self, data: bytes) -> None:
        self.pack = Package(data)
        family, self.part = self.pack.main_part()
        if family != "docx":
            raise EngineError("BAD_DOCX", "not a word document")
        self.root = self.pack.xml(self.part)
        self.body = self.root.find(w("body"))
        self.relations = self.pack.relations(self.part)
        parts = {k: self.pack.read(t) for k, t in self.relations.values() if k in ("styles", "numbering", "theme") and self.pack.has(t)}
        self.themes = _themes(parts.get("theme", b""))
        self.styles = _styles(parts.get("styles", b""), tuple(self.themes.items()))
        self.lists = _lists(parts.get("numbering", b""))

    def numbering_of(self, props: ET.Element | None, style: str | None) -> tuple[str, int] | None:
        found = _number(props) or self.styles.numbered(style)
        return None if found is None or found[0] == "0" else found

    def elements(self) -> list[tuple[ET.Element, bool]]:
        """(paragraph, in a table) in document order."""
        out: list[tuple[ET.Element, bool]] = []
        paragraph, table = w("p"), w("tbl")

        def walk(e: ET.Element, inside: bool) -> None:
            for c in e:
                tag = c.tag
                if tag == paragraph:
                    out.append((c, inside))
                elif len(c) and local(tag) != "txbxContent":
                    walk(c, inside or tag == table)
        if self.body is not None:
            walk(self.body, False)
        return out

    def level_of(self, p: ET.Element) -> int | None:
        """Heading level of a paragraph, by its style and what that is based on."""
        props = p.find(w("pPr"))
        return self.styles.level(_value(props.find(w("pStyle"))) if props is not None else None)

    def heads(self) -> Iterator[tuple[ET.Element, bool, ET.Element | None, str | None, int | None, str]]:
        """(paragraph, in a table, properties, style, level, number) in order; formats are not worked out."""
        counters = Counters()
        for p, inside in self.elements():
            props = p.find(w("pPr"))
            style = _value(props.find(w("pStyle"))) if props is not None else None
            number, found = "", self.numbering_of(props, style)
            if found and (levels := self.lists.get(found[0])) and found[1] in levels[0]:
                starts, forms, patterns = levels
                number = counters.next(found[0], found[1], starts, forms, patterns[found[1]])
                number = "•" if forms[found[1]] == "bullet" else number
            yield p, inside, props, style, self.styles.level(style), number

    def paragraphs(self) -> list[Paragraph]:
        out, run, rich, text_, tab, ends = [], w("r"), w("rPr"), w("t"), w("tab"), (w("br"), w("cr"))
        for index, (p, inside, props, style, level, number) in enumerate(self.heads()):
            base = self.styles.styled(style).under(paragraph_format(props))
            runs = []
            for r in p.iter(run):
                text = "".join([(t.text or "") if t.tag == text_ else "\t" if t.tag == tab else "\n" if t.tag in ends else "" for t in r])
                if text:
                    rpr, look = r.find(rich), base
                    if rpr is not None:
                        for s in reversed(self.styles.chain(_value(rpr.find(w("rStyle"))))):
                            look = look.under(self.styles.styles[s][2])
                        look = look.under(run_format(rpr, self.themes))
                    runs.append((text, look, None))
            dominant = runs[0][1] if runs else base
            if any(look is not dominant for _, look, _ in runs):
                sizes: Counter = Counter()
                for text, look, _ in runs:
                    sizes[look] += len(text)
                dominant = sizes.most_common(1)[0][0]
            out.append(Paragraph(index, "".join([r[0] for r in runs]), style, level, inside, number, dominant, runs))
        return out

    def to_html(self, numbers: bool = True) -> str:
        held = self.heads()

        def inline(e: ET.Element) -> str:
            text = ""
            for c in e:
                if c.tag == w("hyperlink"):
                    href = safe_link(self.relations.get(c.get(f"{{{R}}}id", ""), ("", ""))[1])
                    text += f'<a href="{html.escape(href)}">{inline(c)}</a>' if href else inline(c)
                elif c.tag == w("r"):
                    body = "".join(html.escape(t.text or "") if t.tag == w("t") else "\t" if t.tag == w("tab") else "<br>" if t.tag in (w("br"), w("cr")) else "" for t in c)
                    props = c.find(w("rPr"))
                    for name, tag in (("b", "strong"), ("i", "em"), ("strike", "del")):
                        body = f"<{tag}>{body}</{tag}>" if body and props is not None and _on(props.find(w(name))) else body
                    text += body
                elif local(c.tag) in ("ins", "smartTag", "sdt", "sdtContent", "fldSimple"):
                    text += inline(c)
            return text

        def blocks(e: ET.Element) -> str:
            out = []
            for c in e:
                if c.tag == w("p"):
                    *_, level, number = next(held)
                    lead = f"{html.escape(number)} " if numbers and number else ""
                    tag = f"h{min(6, level)}" if level else "p"
                    body = inline(c)
                    out.append(f"<{tag}>{lead}{body}</{tag}>" if body or lead else "")
                elif c.tag == w("tbl"):
                    out.append("<table>" + "".join("<tr>" + "".join(f"<td>{re.sub('</p><p>', '<br>', blocks(d))}</td>" for d in r.findall(w("tc"))) + "</tr>" for r in c.findall(w("tr"))) + "</table>")
                elif local(c.tag) in ("sdt", "sdtContent"):
                    out.append(blocks(c))
            return "".join(out)

        return blocks(self.body) if self.body is not None else ""


def repacked(pack: Package, parts: dict[str, bytes]) -> bytes:
    """The archive with some parts replaced (or added)."""
    left = {name.lower(): (name, body) for name, body in parts.items()}
    out: dict[str, bytes] = {}
    for i in pack.zip.infolist():
        name = i.filename.replace("\\", "/")
        out[name] = left.pop(name.lower())[1] if name.lower() in left else pack.unpacked(i)
    return archive(out | dict(left.values()))


# Writing.

_BLANKS = re.compile(r"[ \t\r\n]+")
_MARK_XML = {"b": "<w:b/>", "i": "<w:i/>", "u": '<w:u w:val="single"/>', "s": "<w:strike/>", "code": '<w:rFonts w:ascii="Consolas" w:hAnsi="Consolas"/>', "sub": '<w:vertAlign w:val="subscript"/>', "sup": '<w:vertAlign w:val="superscript"/>'}


def _run(text: str, marks: frozenset[str]) -> str:
    props = "".join([_MARK_XML[m] for m in sorted(marks)]) if marks else ""
    body = "<w:br/>".join([f'<w:t xml:space="preserve">{escape(p)}</w:t>' for p in text.split("\n")])
    return f"<w:r>{f'<w:rPr>{props}</w:rPr>' if props else ''}{body}</w:r>"


# The parts that all written documents share.
_styles_xml = "".join(f'<w:style w:type="paragraph" w:styleId="{i}"><w:name w:val="{n}"/><w:basedOn w:val="Normal"/>{f"<w:pPr><w:outlineLvl w:val=\"{o}\"/></w:pPr>" if o is not None else ""}<w:rPr><w:b/><w:sz w:val="{s}"/></w:rPr></w:style>' for i, n, o, s in [("Title", "Title", None, 44), *((f"Heading{k}", f"heading {k}", k - 1, 38 - 4 * k) for k in range(1, 7))])
_levels_xml = lambda form, text: "".join(f'<w:lvl w:ilvl="{k}"><w:start w:val="1"/><w:numFmt w:val="{form}"/><w:lvlText w:val="{text(k)}"/><w:pPr><w:ind w:left="{720 * (k + 1)}" w:hanging="360"/></w:pPr></w:lvl>' for k in range(9))
_STYLES_PART = f'<?xml version="1.0" encoding="UTF-8"?><w:styles xmlns:w="{W}"><w:docDefaults><w:rPrDefault><w:rPr><w:rFonts w:ascii="Calibri" w:hAnsi="Calibri" w:eastAsia="宋体"/><w:sz w:val="22"/></w:rPr></w:rPrDefault></w:docDefaults><w:style w:type="paragraph" w:default="1" w:styleId="Normal"><w:name w:val="Normal"/></w:style>{_styles_xml}</w:styles>'
_LISTS_PART = f'<?xml version="1.0" encoding="UTF-8"?><w:numbering xmlns:w="{W}"><w:abstractNum w:abstractNumId="0">{_levels_xml("bullet", lambda k: "•")}</w:abstractNum><w:abstractNum w:abstractNumId="1">{_levels_xml("decimal", lambda k: f"%{k + 1}.")}</w:abstractNum><w:num w:numId="1"><w:abstractNumId w:val="0"/></w:num><w:num w:numId="2"><w:abstractNumId w:val="1"/></w:num></w:numbering>'
_MARKS = {"strong": "b", "b": "b", "em": "i", "i": "i", "u": "u", "ins": "u", "del": "s", "s": "s", "strike": "s", "code": "code", "sub": "sub", "sup": "sup"}


class Writer:
    """HTML trees to the parts of a document."""

    def __init__(self, title: str | None = None, landscape: bool = False, margins_mm: float = 25.4, header: str | None = None, footer: str | None = None, toc: int | None = None) -> None:
        self.title, self.landscape, self.margins, self.header, self.footer, self.toc = title, landscape, margins_mm, header, footer, toc
        self.links: list[str] = []

    def inline(self, node: Node | str, marks: frozenset[str] = frozenset()) -> str:
        if isinstance(node, str):
            text = _BLANKS.sub(" ", node) if "code" not in marks else node
            return _run(text, marks) if text else ""
        if node.tag == "br":
            return "<w:r><w:br/></w:r>"
        own = marks | {_MARKS[node.tag]} if node.tag in _MARKS else marks
        body = "".join(self.inline(c, own) for c in node.children)
        href = safe_link(node.attrs.get("href")) if node.tag == "a" else None
        if href:
            self.links.append(href)
            return f'<w:hyperlink r:id="link{len(self.links)}">{body}</w:hyperlink>'
        return body

    @staticmethod
    def paragraph(runs: str, style: str | None = None, extra: str = "") -> str:
        props = (f'<w:pStyle w:val="{style}"/>' if style else "") + extra
        return f"<w:p>{f'<w:pPr>{props}</w:pPr>' if props else ''}{runs}</w:p>"

    def listing(self, node: Node, depth: int) -> str:
        out = []
        for item in (c for c in node.children if isinstance(c, Node)):
            subs = [c for c in item.children if isinstance(c, Node) and c.tag in ("ul", "ol")]
            runs = "".join(self.inline(c) for c in item.children if c not in subs)
            number = f'<w:numPr><w:ilvl w:val="{min(depth, 8)}"/><w:numId w:val="{2 if node.tag == "ol" else 1}"/></w:numPr>'
            out.append(self.paragraph(runs, None, number) + "".join(self.listing(s, depth + 1) for s in subs))
        return "".join(out)

    def table(self, node: Node) -> str:
        edge = "".join(f'<w:{s} w:val="single" w:sz="4" w:space="0" w:color="auto"/>' for s in ("top", "left", "bottom", "right", "insideH", "insideV"))
        rows = []
        for tr in node.find("tr"):
            cells = [c for c in tr.children if isinstance(c, Node) and c.tag in ("td", "th")]
            rows.append("<w:tr>" + "".join(f"<w:tc><w:tcPr>{'<w:shd w:val=\"clear\" w:fill=\"D9E2F3\"/>' if c.tag == 'th' else ''}</w:tcPr>{self.paragraph(self.inline(c, frozenset(['b']) if c.tag == 'th' else frozenset()))}</w:tc>" for c in cells) + "</w:tr>")
        return f"<w:tbl><w:tblPr><w:tblBorders>{edge}</w:tblBorders></w:tblPr>{''.join(rows)}</w:tbl>" + self.paragraph("")

    def blocks(self, node: Node) -> str:
        out, run = [], []

        def flush() -> None:
            if any(x.strip() if isinstance(x, str) else True for x in run):
                out.append(self.paragraph("".join(self.inline(x) for x in run)))
            run.clear()

        for c in node.children:
            if isinstance(c, str) or c.tag in _MARKS or c.tag in ("a", "br", "span", "img"):
                run.append(c)
                continue
            flush()
            if c.tag in HEADINGS:
                out.append(self.paragraph(self.inline(c), f"Heading{c.tag[1]}"))
            elif c.tag in ("ul", "ol"):
                out.append(self.listing(c, 0))
            elif c.tag == "table":
                out.append(self.table(c))
            elif c.tag == "pre":
                out.append(self.paragraph(_run(c.text().strip("\n"), frozenset(["code"]))))
            elif c.tag == "hr":
                out.append(self.paragraph("", None, '<w:pBdr><w:bottom w:val="single" w:sz="6" w:space="1" w:color="auto"/></w:pBdr>'))
            elif c.tag == "blockquote":
                out.append(self.blocks(c).replace("<w:p><w:r>", '<w:p><w:pPr><w:ind w:left="720"/></w:pPr><w:r>'))
            elif c.tag == "p":
                out.append(self.paragraph(self.inline(c)))
            elif c.tag not in ("head", "style", "script", "title"):
                out.append(self.blocks(c))
        flush()
        return "".join(out)

    @staticmethod
    def fielded(text: str) -> str:
        """{page} and {total} become fields."""
        out = []
        for part in re.split(r"(\{page\}|\{total\})", text):
            name = {"{page}": "PAGE", "{total}": "NUMPAGES"}.get(part)
            out.append(f'<w:fldSimple w:instr="{name}"><w:r><w:t>1</w:t></w:r></w:fldSimple>' if name else _run(part, frozenset()) if part else "")
        return "".join(out)

    def bytes(self, source: str) -> bytes:
        body = self.blocks(tree(source))
        if self.toc:
            body = self.paragraph(f'<w:r><w:fldChar w:fldCharType="begin"/></w:r><w:r><w:instrText xml:space="preserve"> TOC \\o "1-{self.toc}" \\h </w:instrText></w:r><w:r><w:fldChar w:fldCharType="end"/></w:r>') + body
        if self.title:
            body = self.paragraph(_run(self.title, frozenset()), "Title") + body
        wide, high, edge = (16838, 11906, int(self.margins * 56.7)) if self.landscape else (11906, 16838, int(self.margins * 56.7))
        rels, refs, parts = [], "", {}
        for kind, text in (("header", self.header), ("footer", self.footer)):
            if text:
                parts[f"word/{kind}1.xml"] = f'<?xml version="1.0" encoding="UTF-8"?><w:{"hdr" if kind == "header" else "ftr"} xmlns:w="{W}">{self.paragraph(self.fielded(text))}</w:{"hdr" if kind == "header" else "ftr"}>'
                rels.append(f'<Relationship Id="{kind}" Type="{R}/{kind}" Target="{kind}1.xml"/>')
                refs += f'<w:{kind}Reference w:type="default" r:id="{kind}"/>'
        section = f'<w:sectPr>{refs}<w:pgSz w:w="{wide}" w:h="{high}"{" w:orient=\"landscape\"" if self.landscape else ""}/><w:pgMar w:top="{edge}" w:right="{edge}" w:bottom="{edge}" w:left="{edge}"/></w:sectPr>'
        rels += [f'<Relationship Id="styles" Type="{R}/styles" Target="styles.xml"/>', f'<Relationship Id="numbering" Type="{R}/numbering" Target="numbering.xml"/>']
        rels += [f'<Relationship Id="link{i}" Type="{R}/hyperlink" Target="{html.escape(h)}" TargetMode="External"/>' for i, h in enumerate(self.links, 1)]
        parts |= {
            "[Content_Types].xml": '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/word/document.xml" ContentType="application/vnd.openxmlformats-officedocument.wordprocessingml.document.main+xml"/><Override PartName="/word/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.wordprocessingml.styles+xml"/><Override PartName="/word/numbering.xml" ContentType="application/vnd.openxmlformats-officedocument.wordprocessingml.numbering+xml"/>'
            + "".join(f'<Override PartName="/word/{k}1.xml" ContentType="application/vnd.openxmlformats-officedocument.wordprocessingml.{k}+xml"/>' for k in ("header", "footer") if f"word/{k}1.xml" in parts) + "</Types>",
            "_rels/.rels": f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="{R}/officeDocument" Target="word/document.xml"/></Relationships>',
            "word/document.xml": f'<?xml version="1.0" encoding="UTF-8"?><w:document xmlns:w="{W}" xmlns:r="{R}"><w:body>{body}{section}</w:body></w:document>',
            "word/styles.xml": _STYLES_PART,
            "word/numbering.xml": _LISTS_PART,
            "word/_rels/document.xml.rels": f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{"".join(rels)}</Relationships>',
        }
        return archive({name: text.encode() for name, text in parts.items()})
