"""Zip containers of office files: names made uniform, main parts, and limits on what they unpack to."""

from __future__ import annotations

import io
import posixpath
import struct
import xml.etree.ElementTree as ET
import zipfile
import zlib
from collections.abc import Callable
from functools import lru_cache, wraps

from tabweave.errors import EngineError

MOST_BYTES, MOST_RATIO = 1 << 30, 150
TABLE_BYTES, WORD_BYTES = 60 << 20, 40 << 20
#: Bytes of a part whose reading is remembered, and of an archive that is put together at once.
SMALL, AT_ONCE = 1 << 16, 1 << 24
#: Of large parts: how hard they are packed, and bytes between the points at which unpacking can begin. The field of the archive's index that tells them, how many it holds, and what is packed last before a point.
LEVEL, POINT, POINTS, MOST_POINTS, FLUSHED = 4, 2 << 20, 0x7774, 8000, b"\0\0\xff\xff"


def remembered(of: Callable) -> Callable:
    """of(data, ...), for small data worked out once in a process: files of one template share most of their parts. What it returns is only read."""
    held = lru_cache(maxsize=256)(of)
    return wraps(of)(lambda data, *more: (held if len(data) <= SMALL else of)(data, *more))


class Package:
    """Parts by lower-case name with forward slashes, whatever the archive spells."""

    def __init__(self, data: bytes | io.IOBase) -> None:
        """data: the bytes, or a file that can seek, of which only what is asked for is read."""
        try:
            self.file = io.BytesIO(data) if isinstance(data, bytes) else data
            self.zip = zipfile.ZipFile(self.file)
        except (zipfile.BadZipFile, ValueError, OSError) as e:
            raise EngineError("BAD_ZIP", f"not a zip archive: {e}") from e
        self.data = data if isinstance(data, bytes) else None
        self.main: tuple[str, str] | None = None
        self.held: dict[str, bytes] | None = {} if self.data and len(self.data) <= SMALL else None  # small parts of a small archive, unpacked
        infos = self.zip.infolist()
        total, packed = sum(i.file_size for i in infos), max(1, sum(i.compress_size for i in infos))
        if total > MOST_BYTES or total > 1 << 20 and total / packed > MOST_RATIO:
            raise EngineError("ZIP_BOMB_SUSPECTED", f"unpacks to {total} bytes from {packed}")
        self.names = {normal_name(i.filename): i for i in infos}

    def read(self, name: str) -> bytes:
        if self.held and name in self.held:
            return self.held[name]
        info = self.names.get(normal_name(name))
        if info is None:
            raise EngineError("BAD_CONTAINER", f"no part {name!r}")
        out = self.unpacked(info)
        if self.held is not None and len(out) <= SMALL:
            self.held[name] = out
        return out

    def unpacked(self, info: zipfile.ZipInfo) -> bytes:
        if self.data and info.compress_type == zipfile.ZIP_DEFLATED and info.file_size <= SMALL and info.compress_size <= SMALL and not info.flag_bits & 1:
            at = info.header_offset
            start = at + 30 + sum(struct.unpack_from("<2H", self.data, at + 26))
            if (found := _inflated(self.data[start:start + info.compress_size], info.file_size, info.CRC)) is not None:
                return found
        return self.zip.read(info)

    def open(self, name: str) -> io.IOBase:
        """A part as a stream."""
        return self.zip.open(self.names[normal_name(name)])

    def open_from(self, name: str, start: int) -> tuple[io.IOBase, int]:
        """A part as a stream from the last point at or before a place, and where that is: the part's beginning if no points are known."""
        info = self.names[normal_name(name)]
        if point := max((p for p in _points(info) if p[1] <= start), default=None):
            self.file.seek(info.header_offset)
            at = info.header_offset + 30 + sum(struct.unpack_from("<2H", self.file.read(30), 26)) + point[0]
            self.file.seek(at - len(FLUSHED))
            if self.file.read(len(FLUSHED)) == FLUSHED:
                return _Rest(self.file, at, info.compress_size - point[0], info.file_size - point[1]), point[1]
        return self.zip.open(info), 0

    def size(self, name: str) -> int:
        return self.names[normal_name(name)].file_size

    def xml(self, name: str) -> ET.Element:
        return parse_xml(self.read(name))

    def tree(self, name: str) -> ET.Element:
        """The XML of a part, to be read only: the last few small ones are parsed once."""
        data = self.read(name)
        return _tree(data) if len(data) <= SMALL else parse_xml(data)

    def has(self, name: str) -> bool:
        return normal_name(name) in self.names

    def relations(self, part: str) -> dict[str, tuple[str, str]]:
        """id -> (type, target resolved against the part's folder)."""
        folder, rels = _relations_part(part)
        return dict(_relations(self.read(rels), folder)) if self.has(rels) else {}

    def main_part(self) -> tuple[str, str]:
        """(family, part): docx, xlsx, ods or odt."""
        self.main = self.main or self._main_part()
        return self.main

    def _main_part(self) -> tuple[str, str]:
        if self.has("mimetype"):
            kind = self.read("mimetype").decode("ascii", "replace").strip()
            if "opendocument" in kind:
                return ("ods" if "spreadsheet" in kind else "odt"), "content.xml"
        target = next((t for k, t in self.relations("").values() if k == "officeDocument"), None)
        for name in [target, "word/document.xml", "xl/workbook.xml", *sorted(self.names)]:
            if name and self.has(name) and (family := "docx" if name.lower().endswith("document.xml") else "xlsx" if name.lower().endswith("workbook.xml") else ""):
                return family, normal_name(name)
        if self.has("content.xml"):
            return ("ods" if b"office:spreadsheet" in self.read("content.xml") else "odt"), "content.xml"
        raise EngineError("BAD_CONTAINER", "no main part of a document or workbook")


def opened(data: bytes | io.IOBase) -> Package:
    """A package to be read only. The last few small ones stay open: several readers take different things from the same file."""
    return _opened(data) if isinstance(data, bytes) and len(data) <= SMALL else Package(data)


@lru_cache(maxsize=4)
def _opened(data: bytes) -> Package:
    return Package(data)


@remembered
def sheet_entries(data: bytes) -> list[tuple[str, str]]:
    """Of the main part of a workbook: (name, id of the relation) of its sheets in order."""
    return [(s.get("name", ""), next(v for k, v in s.attrib.items() if local(k) == "id")) for e in parse_xml(data) if local(e.tag) == "sheets" for s in e]


@lru_cache(maxsize=4096)
def _relations_part(part: str) -> tuple[str, str]:
    folder, file = posixpath.split(part)
    return folder, posixpath.join(folder, "_rels", f"{file}.rels")


@remembered
def _relations(data: bytes, folder: str) -> dict[str, tuple[str, str]]:
    return {r.get("Id", ""): (r.get("Type", "").rsplit("/", 1)[-1], r.get("Target", "") if r.get("TargetMode") == "External" else posixpath.normpath(posixpath.join(folder, r.get("Target", "").replace("\\", "/"))) if not r.get("Target", "").startswith("/") else r.get("Target", "")[1:]) for r in parse_xml(data)}


@lru_cache(maxsize=4096)
def normal_name(name: str) -> str:
    return posixpath.normpath(name.replace("\\", "/")).lstrip("/").lower()


def parse_xml(data: bytes) -> ET.Element:
    if b"<!DOCTYPE" in data[:4096] or b"<!ENTITY" in data:
        raise EngineError("BAD_CONTAINER", "document types and entities are not read")
    try:
        return ET.fromstring(data)
    except ET.ParseError as e:
        raise EngineError("BAD_CONTAINER", f"broken XML: {e}") from e


@lru_cache(maxsize=8)
def _tree(data: bytes) -> ET.Element:
    return parse_xml(data)


def xml_bytes(root: ET.Element) -> bytes:
    """What ET.tostring() gives in UTF-8 with a declaration. Each name is put together once, not once for each element."""
    names: dict[str, str] = {}
    spaces = {"http://www.w3.org/XML/1998/namespace": "xml"}
    out: list[str] = []

    def named(tag: str) -> str:
        if tag[:1] == "{":
            uri, name = tag[1:].rsplit("}", 1)
            if uri not in spaces:
                known = ET._namespace_map.get(uri)
                spaces[uri] = f"ns{len(spaces) - 1}" if known is None else known
            names[tag] = f"{spaces[uri]}:{name}" if spaces[uri] else name
        else:
            names[tag] = tag
        return names[tag]

    def text(x: str) -> str:
        return x.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;") if "&" in x or "<" in x or ">" in x else x

    def value(x: str) -> str:
        return text(x).replace('"', "&quot;").replace("\r", "&#13;").replace("\n", "&#10;").replace("\t", "&#09;")

    def put(e: ET.Element) -> None:
        own = e.text
        tag = names.get(e.tag) or named(e.tag)
        head = f"<{tag}"
        for k, v in e.items():
            head += f' {names.get(k) or named(k)}="{v if v.isalnum() else value(v)}"'
        if own or len(e):
            out.append(f"{head}>{text(own)}" if own else head + ">")
            for c in e:
                put(c)
            out.append(f"</{tag}>")
        else:
            out.append(head + " />")
        if e.tail:
            out.append(text(e.tail))

    try:
        put(root)
    except (AttributeError, TypeError, RecursionError):  # comments, instructions, very deep trees
        return ET.tostring(root, encoding="UTF-8", xml_declaration=True)
    top = names[root.tag]
    spaces.pop("http://www.w3.org/XML/1998/namespace")
    declared = "".join(f' xmlns{":" if p else ""}{p}="{value(u)}"' for u, p in sorted(spaces.items(), key=lambda x: x[1]))
    out[0] = f"<{top}{declared}{out[0][1 + len(top):]}"
    return ("<?xml version='1.0' encoding='UTF-8'?>\n" + "".join(out)).encode("utf-8", "xmlcharrefreplace")


@remembered
def _inflated(packed: bytes, size: int, crc: int) -> bytes | None:
    """None if it is not what the archive says: zipfile then says what is wrong."""
    try:
        out = zlib.decompressobj(-15).decompress(packed, size + 1)
    except zlib.error:
        return None
    return out if len(out) == size and zlib.crc32(out) == crc else None


@remembered
def _deflated(data: bytes) -> tuple[int, bytes]:
    return zlib.crc32(data), zlib.compress(data, 6, -15)


class Deflated:
    """A part packed as its pieces come. Every POINT bytes, where a piece begins, unpacking can begin too; the archive's index tells where."""

    def __init__(self) -> None:
        self.chunks: list[bytes] = []
        self.points: list[tuple[int, int]] = []
        self.crc = self.size = self.packed = 0
        self.packer = zlib.compressobj(LEVEL, zlib.DEFLATED, -15)

    def add(self, piece: bytes | memoryview) -> None:
        if self.size - (self.points[-1][1] if self.points else 0) >= POINT:
            self._keep(self.packer.flush(zlib.Z_FULL_FLUSH))
            self.points.append((self.packed, self.size))
        self.crc = zlib.crc32(piece, self.crc)
        self.size += len(piece)
        self._keep(self.packer.compress(piece))

    def done(self) -> None:
        self._keep(self.packer.flush())
        if self.size >= 1 << 32:
            raise EngineError("TOO_LARGE", "a part of an archive has less than 4 GB")

    def whole(self) -> bytes:
        return zlib.decompress(b"".join(self.chunks), -15)

    def _keep(self, chunk: bytes) -> None:
        if chunk:
            self.chunks.append(chunk)
            self.packed += len(chunk)

    def extra(self) -> bytes:
        """The points, with what tells that the part is still as it was packed."""
        kept = self.points[:MOST_POINTS]
        return struct.pack(f"<2H2L{2 * len(kept)}L", POINTS, 8 + 8 * len(kept), self.crc, self.packed, *(n for p in kept for n in p)) if kept else b""


def _points(info: zipfile.ZipInfo) -> list[tuple[int, int]]:
    """(place in the packed part, place in the part) of the points at which a part can be unpacked, if it is as Deflated left it."""
    at, extra = 0, info.extra
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<2H", extra, at)
        if kind == POINTS and size % 8 == 0 and size > 8 and at + 4 + size <= len(extra) and info.compress_type == zipfile.ZIP_DEFLATED and not info.flag_bits & 1:
            crc, packed, *places = struct.unpack_from(f"<{size // 4}L", extra, at + 4)
            if (crc, packed) == (info.CRC, info.compress_size):
                return [(a, b) for a, b in zip(places[::2], places[1::2], strict=True) if len(FLUSHED) <= a < packed and b < info.file_size]
        at += 4 + size
    return []


class _Rest(io.RawIOBase):
    """What follows a point of a part."""

    def __init__(self, file: io.IOBase, at: int, packed: int, size: int) -> None:
        self.file, self.at, self.end, self.size, self.unpacker = file, at, at + packed, size, zlib.decompressobj(-15)

    def read(self, n: int = -1) -> bytes:
        out, want = [], self.size if n < 0 else min(n, self.size)
        while want and not self.unpacker.eof:
            data = self.unpacker.unconsumed_tail
            if not data:
                self.file.seek(self.at)
                if not (data := self.file.read(min(SMALL, self.end - self.at))):
                    break
                self.at += len(data)
            out.append(self.unpacker.decompress(data, want))
            want -= len(out[-1])
            self.size -= len(out[-1])
        return b"".join(out)


def archive(parts: dict[str, bytes | Deflated]) -> bytes:
    """An archive of parts. Parts that many archives share are packed once."""
    deflated = sum(d.packed for d in parts.values() if isinstance(d, Deflated))
    if sum(len(d) for d in parts.values() if not isinstance(d, Deflated)) > AT_ONCE or len(parts) > 60_000 or deflated > 3 << 30:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for name, data in parts.items():
                z.writestr(name, data.whole() if isinstance(data, Deflated) else data)
        return out.getvalue()
    body, index, at = [], [], 0
    for name, data in parts.items():
        crc, chunks, size, extra = (data.crc, data.chunks, data.size, data.extra()) if isinstance(data, Deflated) else (*(lambda crc, packed: (crc, [packed]))(*_deflated(data)), len(data), b"")
        packed, file = sum(map(len, chunks)), name.encode()
        facts = [20, 0 if name.isascii() else 0x800, 8, 0, 33, crc, packed, size, len(file)]
        body += [b"PK\3\4", struct.pack("<5H3L2H", *facts, 0), file, *chunks]
        index += [b"PK\1\2\x14\0", struct.pack("<5H3L2H", *facts, len(extra)), struct.pack("<3H2L", 0, 0, 0, 0o600 << 16, at), file, extra]
        at += 30 + len(file) + packed
    table = b"".join(index)
    return b"".join([*body, table, b"PK\5\6", struct.pack("<4H2LH", 0, 0, len(parts), len(parts), len(table), at, 0)])


def local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]
