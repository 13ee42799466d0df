"""Markdown to HTML: headings, paragraphs, nested lists, tables, quotes, fences, rules and inline marks."""

from __future__ import annotations

import html
import re


_MARKED = re.compile("[`!\\[*~&<>\0\n]")
_LINE_MARKS = [(re.compile(rf"{mark}([^*~\n]+){mark}"), rf"<{tag}>\1</{tag}>") for mark, tag in ((r"\*\*", "strong"), (r"~~", "del"), (r"\*", "em"))]


def _inline(text: str) -> str:
    if not _MARKED.search(text):
        return text
    held: list[str] = []

    def keep(m: re.Match) -> str:
        held.append(f"<code>{html.escape(m[1])}</code>")
        return f"\0{len(held) - 1}\0"

    text = html.escape(re.sub(r"`([^`]+)`", keep, text), quote=False)
    text = re.sub(r"!\[([^\]]*)\]\(([^)\s]*)\)", lambda m: f'<img alt="{m[1]}" src="{m[2]}">', text)
    text = re.sub(r"\[([^\]]*)\]\(([^)\s]*)\)", lambda m: f'<a href="{m[2]}">{m[1]}</a>', text)
    for mark, shown in _LINE_MARKS:
        text = mark.sub(shown, text)
    return re.sub("\0(\\d+)\0", lambda m: held[int(m[1])], text).replace("  \n", "<br>")


def _items(lines: list[str]) -> str:
    """Nested lists by indentation."""
    out, stack = [], []
    for line in lines:
        m = re.match(r"( *)([-*+]|\d+[.)]) +(.*)", line)
        if not m:
            out.append(" " + _inline(line.strip()))
            continue
        depth, tag = len(m[1]) // 2, "ol" if m[2][0].isdigit() else "ul"
        while len(stack) > depth + 1:
            out.append(f"</li></{stack.pop()}>")
        if len(stack) == depth + 1:
            out.append("</li>")
            if stack[-1] != tag:
                out.append(f"</{stack.pop()}>")
        while len(stack) <= depth:
            stack.append(tag)
            out.append(f"<{tag}>")
        out.append(f"<li>{_inline(m[3])}")
    while stack:
        out.append(f"</li></{stack.pop()}>")
    return "".join(out)


def to_html(source: str) -> str:
    lines, out, i = source.replace("\r\n", "\n").split("\n"), [], 0
    item = re.compile(r" *([-*+]|\d+[.)]) +")
    cells = lambda line: [c.strip().replace("\\|", "|") for c in re.split(r"(?<!\\)\|", line.strip().strip("|"))]
    while i < len(lines):
        line = lines[i]
        if not line.strip():
            i += 1
        elif line.startswith("```"):
            end = next((k for k in range(i + 1, len(lines)) if lines[k].startswith("```")), len(lines))
            out.append(f"<pre><code>{html.escape(chr(10).join(lines[i + 1:end]))}</code></pre>")
            i = end + 1
        elif m := re.match(r"(#{1,6}) +(.*?) *#*$", line):
            out.append(f"<h{len(m[1])}>{_inline(m[2])}</h{len(m[1])}>")
            i += 1
        elif re.fullmatch(r" *([-*_])( *\1){2,} *", line):
            out.append("<hr>")
            i += 1
        elif line.startswith(">"):
            end = i
            while end < len(lines) and lines[end].startswith(">"):
                end += 1
            out.append(f"<blockquote>{to_html(chr(10).join(re.sub('^> ?', '', x) for x in lines[i:end]))}</blockquote>")
            i = end
        elif "|" in line and i + 1 < len(lines) and re.fullmatch(r"[ |:-]*-[ |:-]*", lines[i + 1]):
            end = i + 2
            while end < len(lines) and "|" in lines[end]:
                end += 1
            row = lambda x, t: "<tr>" + "".join(f"<{t}>{_inline(c)}</{t}>" for c in cells(x)) + "</tr>"
            out.append("<table>" + row(line, "th") + "".join(row(x, "td") for x in lines[i + 2:end]) + "</table>")
            i = end
        elif item.match(line):
            end = i
            while end < len(lines) and lines[end].strip():
                end += 1
            out.append(_items(lines[i:end]))
            i = end
        else:
            end = i
            while end < len(lines) and lines[end].strip() and not re.match(r"(#{1,6} |>|```)", lines[end]):
                end += 1
            end = max(end, i + 1)
            out.append(f"<p>{_inline(chr(10).join(lines[i:end]))}</p>")
            i = end
    return "".join(out)
