"""Value semantics of a single cell in plain Python: the specification that the Column builders are tested against,
and what is used on the driver for literals."""

from __future__ import annotations

import math
import re
from decimal import ROUND_HALF_UP, Context, Decimal

# Characters ignored in numbers, and the shapes of numbers and days.
_SPACES = "".join(map(chr, (0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF)))
IGNORED = rf"[¥￥$€£\x09-\x0d\x20{_SPACES}]"
PLAIN = r"[-+]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)"
GROUPED = r"[-+]?[0-9]{1,3}(?:,[0-9]{3})+(?:\.[0-9]+)?"
DAY = r"([0-9]{4})[-/.年]([0-9]{1,2})[-/.月]([0-9]{1,2})日?(?:[ T].*)?"

_IGNORED, _PLAIN, _GROUPED, _DAY = re.compile(IGNORED), re.compile(PLAIN), re.compile(GROUPED), re.compile(DAY)


def num(value: object) -> float | None:
    if isinstance(value, bool) or value is None:
        return None
    if isinstance(value, int | float):
        return float(value) if math.isfinite(value) else None
    text = _IGNORED.sub("", str(value))
    scale = 1.0
    if text.endswith("%"):
        text, scale = text[:-1], 0.01
    if "," in text:
        if not _GROUPED.fullmatch(text):
            return None
        text = text.replace(",", "")
    return float(text) * scale if _PLAIN.fullmatch(text) else None


def day(value: object) -> str | None:
    found = _DAY.fullmatch(value) if isinstance(value, str) else None
    return f"{found[1]}-{found[2]:0>2}-{found[3]:0>2}" if found else None


def text(value: object) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return "true" if value else "false"
    return fmt(value) if isinstance(value, int | float) else str(value)


def key(value: object) -> tuple:
    if (n := num(value)) is not None:
        return ("n", n + 0.0)
    if (d := day(value)) is not None:
        return ("d", d)
    return ("s", text(value))


def compare(a: object, b: object) -> int | None:
    """-1, 0 or 1; None if the values are of kinds that do not compare."""
    x, y = key(a), key(b)
    if x[0] != y[0]:
        return None
    return (x[1] > y[1]) - (x[1] < y[1])


def round12(value: float) -> float:
    """Twelve significant digits, halves away from zero."""
    if not value or not math.isfinite(value):
        return value
    exact = Decimal(value)
    return float(exact.quantize(Decimal(1).scaleb(exact.adjusted() - 11), rounding=ROUND_HALF_UP, context=Context(prec=40)))


def fmt(value: object) -> str:
    """As shown: 12 significant digits without trailing zeros, TRUE and FALSE, nothing for blanks."""
    if value is None:
        return ""
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, int | float):
        n = round12(float(value))
        if n == 0:
            return "0"
        if 1e-6 <= abs(n) < 1e21:
            shown = format(Decimal(repr(n)), "f")
            return shown.rstrip("0").rstrip(".") if "." in shown else shown
        mantissa, exponent = repr(n).split("e") if "e" in repr(n) else (repr(n), "0")
        return f"{mantissa.removesuffix('.0')}e{'+' if int(exponent) > 0 else ''}{int(exponent)}"
    return str(value)


OPERATORS = ("eq", "ne", "gt", "gte", "lt", "lte", "contains", "startsWith", "endsWith", "in", "notIn", "isBlank", "notBlank")


def holds(cell: object, op: str, value: object = None) -> bool:
    blank = cell is None or cell == ""
    if op in ("isBlank", "notBlank"):
        return blank == (op == "isBlank")
    if op in ("in", "notIn"):
        items = value if isinstance(value, list | tuple) else [value]
        return any(compare(cell, v) == 0 for v in items) == (op == "in")
    if op in ("contains", "startsWith", "endsWith"):
        have, want = text(cell).lower(), text(value).lower()
        return want in have if op == "contains" else have.startswith(want) if op == "startsWith" else have.endswith(want)
    c = compare(cell, value)
    if c is None:
        return op == "ne"
    return {"eq": c == 0, "ne": c != 0, "gt": c > 0, "gte": c >= 0, "lt": c < 0, "lte": c <= 0}[op]


def column_letter(index: int) -> str:
    out, index = "", index + 1
    while index:
        index, rest = divmod(index - 1, 26)
        out = chr(65 + rest) + out
    return out


def column_index(letters: str) -> int:
    n = 0
    for c in letters.upper():
        n = n * 26 + ord(c) - 64
    return n - 1
