"""Templates: {name} with dotted paths, {#list} ... {/list} loops and truthy sections, {^name} ... {/name} inverted ones."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabweave.errors import EngineError
from tabweave.functions.model import fmt
from tabweave.sources.package import xml_bytes
from tabweave.text.docx import Document, repacked, w

_TAG = re.compile(r"\{([#^/]?)\s*([^{}#^/]*?)\s*\}")


def parsed(template: str) -> list:
    """Nested lists of text, ("value", path), ("loop" | "unless", path, children)."""
    root: list = []
    stack: list[tuple[str, list]] = [("", root)]
    at = 0
    for m in _TAG.finditer(template):
        stack[-1][1].append(template[at:m.start()])
        at = m.end()
        sign, path = m.groups()
        if sign in "#^" and sign:
            children: list = []
            stack[-1][1].append(("loop" if sign == "#" else "unless", path, children))
            stack.append((path, children))
        elif sign == "/":
            if len(stack) == 1 or path and stack[-1][0] != path:
                raise EngineError("TEMPLATE_RENDER_FAILED", f"{{/{path}}} closes nothing that is open")
            stack.pop()
        else:
            stack[-1][1].append(("value", path))
    if len(stack) > 1:
        raise EngineError("TEMPLATE_RENDER_FAILED", f"{{#{stack[-1][0]}}} is not closed")
    root.append(template[at:])
    return root


def lookup(scopes: list, path: str) -> object:
    if path == ".":
        return scopes[-1]
    for scope in reversed(scopes):
        value, found = scope, True
        for part in path.split("."):
            if not isinstance(value, dict) or part not in value:
                found = False
                break
            value = value[part]
        if found:
            return value
    return None


def rendered(nodes: list, scopes: list) -> str:
    out = []
    for n in nodes:
        if isinstance(n, str):
            out.append(n)
        elif n[0] == "value":
            value = lookup(scopes, n[1])
            out.append(value if isinstance(value, str) else fmt(value))
        else:
            value = lookup(scopes, n[1])
            if n[0] == "unless":
                out.append("" if value else rendered(n[2], scopes))
            elif isinstance(value, list | tuple):
                out += [rendered(n[2], [*scopes, item]) for item in value]
            elif value:
                out.append(rendered(n[2], [*scopes, value] if isinstance(value, dict) else scopes))
    return "".join(out)


def fill(template: str, data: dict) -> str:
    return rendered(parsed(template), [data])


def merged(df: DataFrame, template: str, name: str = "text") -> DataFrame:
    """Mail merge: one text for each row, of its columns. Plain values, structs and loops over arrays are Column expressions."""
    return df.withColumn(name, _column(parsed(template), [lambda p: F.col(p)], [set(df.columns)]))


def _column(nodes: list, scopes: list, names: list[set]) -> Column:
    def value(path: str) -> Column:
        if path == ".":
            return scopes[-1](None)
        for scope, known in zip(reversed(scopes), reversed(names), strict=True):
            if not known or path.split(".")[0] in known:
                return scope(path)
        return F.lit(None)

    parts = []
    for n in nodes:
        if isinstance(n, str):
            parts.append(F.lit(n))
        elif n[0] == "value":
            parts.append(F.coalesce(value(n[1]).cast("string"), F.lit("")))
        elif n[0] == "unless":
            v = value(n[1])
            parts.append(F.when(F.coalesce(v.cast("string").isin("", "false", "0", "[]"), F.lit(True)), _column(n[2], scopes, names)).otherwise(F.lit("")))
        else:
            inner = lambda x, n=n: _column(n[2], [*scopes, lambda p: x if p is None else _field(x, p)], [*names, set()])
            parts.append(F.coalesce(F.array_join(F.transform(value(n[1]), _one(inner)), ""), F.lit("")))
    return F.concat(*parts) if parts else F.lit("")


def _one(f):  # transform() counts a lambda's parameters
    return lambda x: f(x)


def _field(x: Column, path: str) -> Column:
    for part in path.split("."):
        x = x[part]
    return x


def fill_docx(data: bytes, values: dict) -> bytes:
    """A document with its tags filled: a tag may span runs; a paragraph that holds only a loop's ends loops over what is between."""
    doc = Document(data)
    import copy
    import xml.etree.ElementTree as ET

    def text_of(p: ET.Element) -> str:
        return "".join(t.text or "" for t in p.iter(w("t")))

    def put(p: ET.Element, text: str) -> None:
        cells = list(p.iter(w("t")))
        for k, t in enumerate(cells):
            t.text = text if k == 0 else ""
            t.set("{http://www.w3.org/XML/1998/namespace}space", "preserve")
        if cells and "\n" in text:
            run = next(r for r in p.iter(w("r")) if cells[0] in list(r))
            at = list(run).index(cells[0])
            run.remove(cells[0])
            for k, line in enumerate(text.split("\n")):
                if k:
                    run.insert(at, ET.Element(w("br")))
                    at += 1
                e = ET.Element(w("t"), {"{http://www.w3.org/XML/1998/namespace}space": "preserve"})
                e.text = line
                run.insert(at, e)
                at += 1

    def expand(parent: ET.Element, scopes: list) -> None:
        children, i = list(parent), 0
        while i < len(children):
            e = children[i]
            whole = re.fullmatch(r"\s*\{([#^])\s*([^{}]+?)\s*\}\s*", text_of(e)) if e.tag == w("p") else None
            if whole:
                end = next((k for k in range(i + 1, len(children)) if children[k].tag == w("p") and re.fullmatch(rf"\s*\{{/\s*{re.escape(whole[2])}?\s*\}}\s*", text_of(children[k]))), None)
                if end is None:
                    raise EngineError("TEMPLATE_RENDER_FAILED", f"{{{whole[1]}{whole[2]}}} is not closed")
                value = lookup(scopes, whole[2])
                items = ([] if value else [None]) if whole[1] == "^" else list(value) if isinstance(value, list | tuple) else [value] if value else []
                place = list(parent).index(e)
                made = []
                for item in items:
                    box = ET.Element("box")
                    box.extend(copy.deepcopy(children[i + 1:end]))
                    expand(box, [*scopes, item] if isinstance(item, dict) else scopes)
                    made += list(box)
                for x in children[i:end + 1]:
                    parent.remove(x)
                for k, x in enumerate(made):
                    parent.insert(place + k, x)
                i = end + 1
                continue
            if e.tag == w("p"):
                if "{" in text_of(e):
                    put(e, rendered(parsed(text_of(e)), scopes))
            elif e.tag == w("tr") and (m := re.search(r"\{#\s*([^{}]+?)\s*\}", text_of(e))) and f"{{/{m[1]}}}" in text_of(e).replace(" ", ""):
                place, value = list(parent).index(e), lookup(scopes, m[1])
                parent.remove(e)
                for k, item in enumerate(value if isinstance(value, list | tuple) else []):
                    row = copy.deepcopy(e)
                    for p in row.iter(w("p")):
                        put(p, re.sub(rf"\{{[#/]\s*{re.escape(m[1])}\s*\}}", "", text_of(p)))
                    expand(row, [*scopes, item])
                    parent.insert(place + k, row)
            else:
                expand(e, scopes)
            i += 1

    expand(doc.body, [values])
    ET.register_namespace("w", "http://schemas.openxmlformats.org/wordprocessingml/2006/main")
    return repacked(doc.pack, {doc.part: xml_bytes(doc.root)})
