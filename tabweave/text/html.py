"""HTML: a tolerant tree in one pass, Markdown from it, and plain text to HTML."""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset(["head", "style", "script", "title", "template", "noscript"])
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
MARKS = {"strong": "**", "b": "**", "em": "*", "i": "*", "del": "~~", "s": "~~", "strike": "~~", "code": "`"}
_BLANKS = re.compile(r"[ \t\r\n\f]+")
BLOCKS = frozenset("address article aside blockquote body center dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section table ul".split())
UNSAFE = re.compile(r"^\s*(javascript|data|vbscript|file):", re.I)


#: Start tags that end an open element: by what the search for it stops, and which elements they end.
_IMPLIED = {t: (BLOCKS - {t}, (t,)) for t in ("p", "dt", "dd", "option")} | {"li": (("ul", "ol"), ("li",)), "td": (("tr",), ("td", "th")), "th": (("tr",), ("td", "th")), "tr": (("table", "tbody", "thead", "tfoot"), ("tr",))}


@dataclass(slots=True)
class Node:
    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    children: list[Node | str] = field(default_factory=list)

    def text(self) -> str:
        return "".join(c if isinstance(c, str) else c.text() for c in self.children)

    def find(self, *tags: str) -> list[Node]:
        out, stack = [], [self]
        while stack:
            node = stack.pop()
            if node.tag in tags:
                out.append(node)
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))
        return out


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("#root")
        self.open = [self.root]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _IMPLIED:
            self._close_implied(tag)
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in VOID and len(self.open) < 400:
            self.open.append(node)

    def _close_implied(self, tag: str) -> None:
        stop, ends = _IMPLIED[tag]
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in stop:
                return
            if self.open[i].tag in ends:
                del self.open[i:]
                return

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.open[-1].children.append(Node(tag, {k: v or "" for k, v in attrs}))

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)


#: A tag as writers put it: attributes in double quotes, without references.
_TAG = re.compile(r'<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\r\n]+[a-zA-Z][a-zA-Z-]*="[^"<>&]*")*)[ \t\r\n]*(/?)>')
_ATTRIBUTE = re.compile(r'([a-zA-Z-]+)="([^"]*)"')
#: Elements in which tags are no tags, or not all.
_RAW = frozenset("script style title textarea xmp iframe noembed noframes plaintext".split())


def _fed(builder: _Builder, source: str) -> bool:
    """Builds the tree of a source that has only tags as writers put them; others are left to the parser (False), before anything is built."""
    parts = _TAG.split(source)
    if any("<" in t for t in parts[::5]) or any(t.lower() in _RAW for t in parts[2::5]) or any(slash and (attrs or close) for slash, attrs, close in zip(parts[1::5], parts[3::5], parts[4::5], strict=True)):
        return False
    for k in range(0, len(parts), 5):
        if text := parts[k]:
            builder.handle_data(entities.unescape(text) if "&" in text else text)
        if k + 1 < len(parts):
            slash, tag, attrs, close = parts[k + 1:k + 5]
            if slash:
                builder.handle_endtag(tag.lower())
            else:
                (builder.handle_startendtag if close else builder.handle_starttag)(tag.lower(), [(a.lower(), v) for a, v in _ATTRIBUTE.findall(attrs)] if attrs else [])
    return True


def tree(source: str | None) -> Node:
    source = source or ""
    end = source.rfind(">") + 1  # no tag ends after it
    builder = _Builder()
    if not _fed(builder, source[:end]):
        builder.feed(source[:end])
        builder.close()
    if source[end:]:
        builder.handle_data(entities.unescape(source[end:]))
    return builder.root


def safe_link(href: str | None) -> str | None:
    return None if not href or UNSAFE.match(href) else href.strip()


def _inline(node: Node | str, raw: bool = False) -> str:
    if isinstance(node, str):
        return node if raw else _BLANKS.sub(" ", node)
    if node.tag in DROPPED:
        return ""
    inner = "".join(_inline(c, raw or node.tag in ("pre", "code")) for c in node.children)
    bare = inner.strip()
    if node.tag == "br":
        return "\n"
    if node.tag == "img":
        return f"![{node.attrs.get('alt', '')}]({node.attrs.get('src', '')})"
    if node.tag == "a":
        href = safe_link(node.attrs.get("href"))
        return f"[{bare}]({href})" if href and bare else inner
    if node.tag in MARKS and bare:
        m = MARKS[node.tag]
        return inner[:len(inner) - len(inner.lstrip())] + m + bare + m + inner[len(inner.rstrip()):]
    return inner


def _lines(text: str) -> str:
    return "\n".join([x.strip() for x in text.split("\n")]).strip() if "\n" in text else text.strip()


def _list(node: Node, depth: int) -> list[str]:
    out, n = [], int(node.attrs.get("start", "1")) if node.attrs.get("start", "1").isdigit() else 1
    for item in (c for c in node.children if isinstance(c, Node)):
        if item.tag in ("ul", "ol"):
            out += _list(item, depth + 1)
            continue
        own = _lines("".join(_inline(c) for c in item.children if isinstance(c, str) or c.tag not in ("ul", "ol")))
        out.append("  " * depth + (f"{n}. " if node.tag == "ol" else "- ") + own.replace("\n", "\n" + "  " * (depth + 1)))
        n += 1
        for sub in (c for c in item.children if isinstance(c, Node) and c.tag in ("ul", "ol")):
            out += _list(sub, depth + 1)
    return out


def _table(node: Node) -> str:
    rows = [[_lines(_inline(c)).replace("\n", "<br>").replace("|", "\\|") for c in tr.children if isinstance(c, Node) and c.tag in ("td", "th")] for tr in node.find("tr")]
    rows = [r for r in rows if r]
    if not rows:
        return ""
    width = max(map(len, rows))
    rows = [r + [""] * (width - len(r)) for r in rows]
    return "\n".join("| " + " | ".join(r) + " |" for r in [rows[0], ["---"] * width, *rows[1:]])


def _blocks(node: Node) -> list[str]:
    out: list[str] = []
    run: list[str] = []

    def flush() -> None:
        text = _lines("".join(run))
        run.clear()
        if text:
            out.append(text)

    for c in node.children:
        if isinstance(c, str) or c.tag not in BLOCKS and c.tag not in ("tbody", "tr"):
            run.append("" if isinstance(c, Node) and c.tag in DROPPED else _inline(c))
            continue
        flush()
        if c.tag in HEADINGS:
            text = _lines(_inline(c)).replace("\n", " ")
            out += [f"{'#' * int(c.tag[1])} {text}"] if text else []
        elif c.tag in ("ul", "ol"):
            out.append("\n".join(_list(c, 0)))
        elif c.tag == "table":
            out.append(_table(c))
        elif c.tag == "blockquote":
            out.append("\n".join(f"> {x}".rstrip() for x in "\n\n".join(_blocks(c)).split("\n")))
        elif c.tag == "pre":
            out.append("```\n" + c.text().strip("\n") + "\n```")
        elif c.tag == "hr":
            out.append("---")
        elif c.tag == "head":
            continue
        else:
            out += _blocks(c)
    flush()
    return [b for b in out if b]


def to_markdown(source: str | None) -> str:
    return "\n\n".join(_blocks(tree(source)))


def links(source: str | None) -> list[tuple[str, str]]:
    """(href, text) of safe links."""
    return [(h, " ".join(a.text().split())) for a in tree(source).find("a") if (h := safe_link(a.attrs.get("href")))]


def headings(source: str | None, references: frozenset[str] | None = None) -> list[tuple[int, str]]:
    """(level, text), white space of HTML made one space. references: the only ones that are resolved (with their semicolon), others stay as written; none given: all of HTML."""
    if references is not None:
        source = re.sub(rf"&(?!(?:{'|'.join(map(re.escape, sorted(references)))});)", "&amp;", source or "")
    return [(int(h.tag[1]), _BLANKS.sub(" ", h.text()).strip(" ")) for h in tree(source).find(*sorted(HEADINGS))]


def from_text(text: str) -> str:
    """Paragraphs between blank lines; single line ends become breaks."""
    return "".join(f"<p>{'<br>'.join(map(entities.escape, p.split(chr(10))))}</p>" for p in re.split(r"\n{2,}", text.replace("\r\n", "\n")) if p.strip())
