"""Rows of a sheet's XML read by columns, without a tree of elements: rows and cells that are numbered, in order, and hold a value or a text of their own.

What is not of this plain form, as formulas, rich texts, prefixes, comments or cells without a value, is left to the parser of XML."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tabweave.sources.workbook import Cells

_ROW, _ROW_END, _C, _C_END, _V, _V_END, _IS, _IS_END, _T, _T_END = range(1, 11)
#: The first two bytes of tags, with the length of those that are always the same.
_TAGS = {b"ro": (_ROW, 0), b"/r": (_ROW_END, 5), b"c ": (_C, 0), b"/c": (_C_END, 3), b"v>": (_V, 2), b"/v": (_V_END, 3), b"is": (_IS, 3), b"/i": (_IS_END, 4), b"t>": (_T, 2), b"t ": (_T, 0), b"/t": (_T_END, 3)}
_KIND, _LENGTH = np.zeros(1 << 16, np.uint8), np.zeros(11, np.int64)
for _name, (_kind, _length) in _TAGS.items():
    _KIND[_name[0] << 8 | _name[1]] = _kind
    _LENGTH[_kind] = 0 if _kind == _T else _length
_NEXT = np.zeros(11 * 16, bool)
for _this, _that in ((_ROW, _C), (_ROW, _ROW_END), (_ROW_END, _ROW), (_C, _V), (_C, _IS), (_C_END, _C), (_C_END, _ROW_END), (_V, _V_END), (_V_END, _C_END), (_IS, _T), (_T, _T_END), (_T_END, _IS_END), (_IS_END, _C_END)):
    _NEXT[_this << 4 | _that] = True
_ATTRIBUTES = re.compile(r'(?: [A-Za-z][\w.]*="[^"<&]*")*')
_ENTITY = re.compile(rb"&(?!(?:lt|gt|quot|apos|amp);)")
#: Rows have up to seven digits, columns up to three letters. Of each kind of cell, values that are remembered.
DIGITS, MOST_KNOWN = 7, 1 << 15


def _texts(data: pa.Buffer, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Stretches of the data, which are in order."""
    offsets = np.empty(2 * len(starts), np.int32)
    offsets[::2], offsets[1::2] = starts, ends
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), data).take(pa.array(np.arange(0, len(offsets), 2)))


def _mapped(values: pa.Array, of: Callable[[pa.Array], pa.Array]) -> pa.Array:
    """of(values), asked for each value once."""
    coded = values.dictionary_encode()
    return of(coded.dictionary).take(coded.indices)


def _tails(data: pa.Buffer, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[dict[str, str]]] | None:
    """The other attributes of tags: which, of those there are."""
    coded = _texts(data, starts, ends).dictionary_encode()
    found = coded.dictionary.to_pylist()
    if any(not _ATTRIBUTES.fullmatch(x) for x in found):
        return None
    pairs = [re.findall(r'(\S+)="([^"]*)"', x) for x in found]
    return (coded.indices.to_numpy(), [dict(p) for p in pairs]) if all(len({"r", *(k for k, _ in p)}) == len(p) + 1 for p in pairs) else None


def _numbers(values: pa.Array, meaning: Cells, style: str | None) -> pa.Array:
    """Numbers as they show. Whole ones of up to twelve digits read as they are written."""
    if int(style or 0) < len(meaning.dates) and meaning.dates[int(style or 0)]:
        return _one_by_one(values, meaning, "n", style)
    whole = pc.match_substring_regex(values, "^(?:0|-?[1-9][0-9]{0,11})$")
    return values if pc.all(whole).as_py() else pc.replace_with_mask(values, pc.invert(whole), _one_by_one(values.filter(pc.invert(whole)), meaning, "n", style))


def _one_by_one(values: pa.Array, meaning: Cells, kind: str, style: str | None) -> pa.Array:
    known = meaning.known.setdefault((kind, style), {})
    if len(known) > MOST_KNOWN:
        known.clear()
    out = []
    for v in values.to_pylist():
        if (shown := known.get(v)) is None:
            shown = known[v] = (v if kind == "inlineStr" else meaning.shown(kind, v or None, style)).strip()
        out.append(shown)
    return pa.array(out, pa.string())


def columns(run: bytes, meaning: Cells, letters: dict[str, int]) -> tuple[np.ndarray, dict[str, pa.Array]] | None:
    """Of whole rows: numbers, and cells by letters (name -> column from 0), blank ones null; rows without cells are left out. None if they are not plain."""
    if not run.startswith(b"<row ") or not run.endswith(b"</row>") or b"&" in run and _ENTITY.search(run):
        return None
    try:
        run.isascii() or run.decode()
    except UnicodeDecodeError:
        return None
    data, x, most = pa.py_buffer(run), np.frombuffer(run, np.uint8), len(run) - 1
    start, end = np.flatnonzero(x == ord("<")).astype(np.int32), np.flatnonzero(x == ord(">")).astype(np.int32)
    if x.min() < 32 or len(start) != len(end) or (start > end).any() or (end[:-1] > start[1:]).any():
        return None
    kind = _KIND[x[start + 1].astype(np.uint16) << 8 | x[start + 2]]
    if not kind.all() or kind[0] != _ROW or kind[-1] != _ROW_END or not _NEXT[kind[:-1] << 4 | kind[1:]].all():
        return None
    valued = (kind == _V) | (kind == _T)
    length = _LENGTH[kind]
    if ((end - start != length) & (length > 0)).any() or ((start[1:] - end[:-1] != 1) & ~valued[:-1]).any():
        return None

    def reads(at: np.ndarray, text: bytes) -> bool:
        return all((x[np.minimum(at + k, most)] == c).all() for k, c in enumerate(text))

    rows, cells, values, inner = np.flatnonzero(kind == _ROW), np.flatnonzero(kind == _C), np.flatnonzero(valued), start[kind == _T]
    if not reads(start[rows], b'<row r="') or not reads(start[kind == _ROW_END], b"</row>") or not reads(start[cells], b'<c r="') or not reads(start[kind == _IS_END], b"</is>"):
        return None
    plain = end[kind == _T] - inner == 2
    if not reads(inner[~plain], b'<t xml:space="preserve">'):
        return None
    # the digits of rows
    at, number, width, more = start[rows] + 8, np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int32), np.ones(len(rows), bool)
    for k in range(DIGITS + 1):
        digit = x[np.minimum(at + k, most)]
        more &= (digit >= 48) & (digit <= 57)
        number, width = np.where(more, number * 10 + digit - 48, number), width + more
    if (width == 0).any() or (width > DIGITS).any() or not reads(at + width, b'"') or _tails(data, at + width + 1, end[rows]) is None:
        return None
    if not len(cells):
        return number[:0], {n: pa.nulls(0, pa.string()) for n in letters}
    # the letters of cells, and the digits of their rows
    of, at = (np.cumsum(kind == _ROW) - 1)[cells], start[cells] + 6
    column, size, more = np.zeros(len(cells), np.int32), np.zeros(len(cells), np.int32), np.ones(len(cells), bool)
    for k in range(4):
        letter = x[np.minimum(at + k, most)]
        more &= (letter >= 65) & (letter <= 90)
        column, size = np.where(more, column * 26 + letter - 64, column), size + more
    closed = at + size + width[of]
    if (size == 0).any() or (size > 3).any() or not reads(closed, b'"') or (closed >= end[cells]).any():
        return None
    for k in range(int(width.max())):
        digit = x[np.minimum(at + size + k, most)]
        if ((digit < 48) | (digit > 57))[width[of] > k].any():
            return None
    if ((of[1:] == of[:-1]) & (column[1:] <= column[:-1])).any() or (tails := _tails(data, closed + 1, end[cells])) is None:
        return None
    which, attributes = tails
    own = kind[values] == _T
    if any(((a.get("t") == "inlineStr") != own[which == k]).any() for k, a in enumerate(attributes)):
        return None
    texts = _texts(data, end[values] + 1, start[values + 1])
    if b"&" in run:
        for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("amp", "&")):
            texts = pc.replace_substring(texts, f"&{name};", char)
    filled = np.flatnonzero(np.bincount(of, minlength=len(rows)))
    place = np.zeros(len(rows), np.int64)
    place[filled] = np.arange(len(filled))
    return number[filled], {n: _column(np.flatnonzero(column == k + 1), place[of], len(filled), texts, which, attributes, meaning) for n, k in letters.items()}


def _column(cells: np.ndarray, row: np.ndarray, n: int, texts: pa.Array, which: np.ndarray, attributes: list[dict[str, str]], meaning: Cells) -> pa.Array:
    """The cells of a column at their rows, of which each has one at most."""
    made, at, held = [], np.full(n, -1, np.int64), 0
    for k in np.unique(which[cells]):
        here, kind, style = cells[which[cells] == k], attributes[k].get("t", "n"), attributes[k].get("s")
        made.append(_mapped(texts.take(pa.array(here)), lambda v, kind=kind, style=style: _numbers(v, meaning, style) if kind == "n" else _one_by_one(v, meaning, kind, style)))
        at[row[here]] = np.arange(held, held + len(here))
        held += len(here)
    if not made:
        return pa.nulls(n, pa.string())
    shown = pa.concat_arrays(made) if len(made) > 1 else made[0]
    if held < n or len(made) > 1:
        shown = shown.take(pa.array(at, mask=at < 0))
    return pc.if_else(pc.equal(shown, ""), None, shown)
