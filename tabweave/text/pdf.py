"""The text layer of simple PDF files: page by page, from uncompressed and Flate content streams."""

from __future__ import annotations

import re
import zlib

from tabweave.errors import EngineError

PAGES, CHARS = 5000, 1 << 20
_SHOW = re.compile(rb"\((?:\\.|[^\\()])*\)|<[0-9A-Fa-f\s]*>|\[|\]|-?\d*\.?\d+|[A-Za-z'\"*]+", re.S)
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"", b"f": b""}


def _literal(token: bytes) -> str:
    if token[:1] == b"<":
        digits = re.sub(rb"\s", b"", token[1:-1])
        data = bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
        return data[2:].decode("utf-16-be", "replace") if data[:2] == b"\xfe\xff" else data.decode("cp1252", "replace")
    body = re.sub(rb"\\([0-7]{1,3}|.)", lambda m: bytes([int(m[1], 8) & 255]) if m[1][:1].isdigit() else _ESCAPES.get(m[1], m[1]), token[1:-1], flags=re.S)
    return body.decode("cp1252", "replace")


def stream_text(content: bytes) -> str:
    out: list[str] = []
    stack: list[bytes] = []
    for m in _SHOW.finditer(content):
        token = m[0]
        if token in (b"Tj", b"'", b'"'):
            out.append("".join(_literal(t) for t in stack if t[:1] in b"(<"))
        elif token == b"TJ":
            out.append("".join(_literal(t) if t[:1] in b"(<" else " " if re.fullmatch(rb"-\d{3,}\.?\d*", t) else "" for t in stack))
        elif token in (b"Td", b"TD", b"T*", b"Tm", b"ET"):
            vertical = token in (b"T*", b"Tm", b"ET") or len(stack) > 1 and stack[-1] not in (b"0", b"-0")
            if vertical and out and out[-1] != "\n":
                out.append("\n")
        if token[:1].isalpha() or token in (b"'", b'"', b"T*"):
            stack = []
        else:
            stack.append(token)
    return "".join(out)


def normalized(text: str) -> str:
    text = re.sub(r"[ \t]+\n", "\n", text.replace("\r\n", "\n").replace("\r", "\n"))
    return re.sub(r"\n{3,}", "\n\n", text).strip()


def pages(data: bytes) -> list[str]:
    if b"%PDF-" not in data[:1024]:
        raise EngineError("BAD_PDF", "not a PDF file")
    if re.search(rb"/Encrypt\s+\d+", data):
        raise EngineError("PDF_ENCRYPTED", "the file is encrypted")
    objects = {int(m[1]): m[2] for m in re.finditer(rb"(\d+)\s+\d+\s+obj\b(.*?)\bendobj", data, re.S)}
    kids = [n for n, body in sorted(objects.items()) if re.search(rb"/Type\s*/Page\b(?!s)", body)]
    out = []
    for n in kids[:PAGES]:
        found = re.search(rb"/Contents\s*(\[[^\]]*\]|\d+\s+\d+\s+R)", objects[n])
        text = ""
        for ref in re.findall(rb"(\d+)\s+\d+\s+R", found[1]) if found else ():
            body = objects.get(int(ref), b"")
            stream = re.search(rb"stream\r?\n(.*?)\r?\n?endstream", body, re.S)
            if stream:
                content = stream[1]
                if b"FlateDecode" in body:
                    try:
                        content = zlib.decompressobj().decompress(content, 64 << 20)
                    except zlib.error as e:
                        raise EngineError("PDF_READ_FAILED", f"page {len(out) + 1}: {e}") from e
                text += stream_text(content) + "\n"
        out.append(normalized(text))
    if not out:
        raise EngineError("BAD_PDF", "no pages found")
    return out


def joined(texts: list[str]) -> str:
    """Pages under markers, clipped at a limit."""
    return "\n\n".join(f"## Page {i}\n\n{t}".rstrip() for i, t in enumerate(texts, 1))[:CHARS]
