"""ODT text documents as HTML."""

from __future__ import annotations

import html
import xml.etree.ElementTree as ET

from tabweave.errors import EngineError
from tabweave.sources.package import Package, local
from tabweave.text.html import safe_link


def _attr(e: ET.Element, name: str) -> str | None:
    return next((v for k, v in e.attrib.items() if local(k) == name), None)


def _inline(e: ET.Element) -> str:
    out = [html.escape(e.text or "")]
    for c in e:
        tag = local(c.tag)
        if tag == "s":
            out.append(" " * int(_attr(c, "c") or 1))
        elif tag == "tab":
            out.append("\t")
        elif tag == "line-break":
            out.append("<br>")
        elif tag == "a":
            href = safe_link(_attr(c, "href"))
            out.append(f'<a href="{html.escape(href)}">{_inline(c)}</a>' if href else _inline(c))
        elif tag not in ("note", "annotation", "tracked-changes"):
            out.append(_inline(c))
        out.append(html.escape(c.tail or ""))
    return "".join(out)


def _blocks(e: ET.Element) -> str:
    out = []
    for c in e:
        tag = local(c.tag)
        if tag == "h":
            level = min(6, max(1, int(_attr(c, "outline-level") or 1)))
            out.append(f"<h{level}>{_inline(c)}</h{level}>")
        elif tag == "p":
            out.append(f"<p>{_inline(c)}</p>")
        elif tag == "list":
            out.append("<ul>" + "".join(f"<li>{_blocks(i).replace('<p>', '').replace('</p>', '')}</li>" for i in c if local(i.tag) in ("list-item", "list-header")) + "</ul>")
        elif tag == "table":
            out.append("<table>" + "".join("<tr>" + "".join(f"<td>{'<br>'.join(_inline(p) for p in d if local(p.tag) in ('p', 'h'))}</td>" for d in r if local(d.tag) == "table-cell") + "</tr>" for r in c.iter() if local(r.tag) == "table-row") + "</table>")
        elif tag in ("section", "text", "body", "index-body", "table-of-content"):
            out.append(_blocks(c))
    return "".join(out)


def to_html(data: bytes) -> str:
    pack = Package(data)
    family, part = pack.main_part()
    body = next((e for e in pack.xml(part).iter() if local(e.tag) == "text" and e.tag.startswith("{urn:oasis:names:tc:opendocument:xmlns:office")), None)
    if family != "odt" or body is None:
        raise EngineError("BAD_ODT", "not a text document")
    return _blocks(body)
