"""Formats told by content, not by extension."""

from __future__ import annotations

from tabweave.errors import EngineError
from tabweave.sources.package import opened

HEAD = 64 << 10
TEXT = ("csv", "tsv", "txt", "md", "html")


def extension(path: str) -> str:
    name = path.replace("\\", "/").rsplit("/", 1)[-1]
    return name.rsplit(".", 1)[-1].lower() if "." in name else ""


def sniff(data: bytes, path: str = "") -> str:
    """xlsx, docx, ods, odt, pdf, rtf, doc or xls (old binary), html, tsv or csv, else the extension or txt."""
    ext = extension(path)
    if data[:8] == b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1":
        return "xls" if ext.startswith("xl") else "doc"
    if b"%PDF-" in data[:1024]:
        return "pdf"
    if data[:2] == b"PK":
        return opened(data).main_part()[0]
    if data.lstrip()[:5] == b"{\\rtf":
        return "rtf"
    if ext in ("md", "html", "htm", "txt"):
        return "html" if ext == "htm" else ext
    head = data[:HEAD].decode("utf-8", "replace")
    if head.lstrip()[:15].lower().startswith(("<!doctype html", "<html")):
        return "html"
    tabs, commas = head.count("\t"), head.count(",")
    if tabs or commas:
        return "tsv" if tabs > commas else "csv"
    return ext if ext in TEXT else "txt"


def checked(data: bytes, limit: int) -> bytes:
    if len(data) > limit:
        raise EngineError("OFFICE_TOO_LARGE", f"{len(data)} bytes; the limit is {limit}")
    return data


def image_size(data: bytes) -> tuple[str, int, int] | None:
    """(type, width, height) of PNG, JPEG, GIF and BMP."""
    if data[:8] == b"\x89PNG\r\n\x1a\n":
        return "png", int.from_bytes(data[16:20]), int.from_bytes(data[20:24])
    if data[:4] == b"GIF8":
        return "gif", int.from_bytes(data[6:8], "little"), int.from_bytes(data[8:10], "little")
    if data[:2] == b"BM":
        return "bmp", int.from_bytes(data[18:22], "little"), abs(int.from_bytes(data[22:26], "little", signed=True))
    if data[:2] == b"\xff\xd8":
        at = 2
        while at + 9 < len(data) and data[at] == 0xFF:
            kind, size = data[at + 1], int.from_bytes(data[at + 2:at + 4])
            if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
                return "jpeg", int.from_bytes(data[at + 7:at + 9]), int.from_bytes(data[at + 5:at + 7])
            at += 2 + size
    return None
