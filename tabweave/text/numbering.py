"""List numbers: counter formats and multi-level counters."""

from __future__ import annotations

import re
from collections.abc import Callable

# Digits and words of counters.
CHINESE, UNITS = "零一二三四五六七八九", ("", "十", "百", "千")
GROUPS = ("", "万", "亿", "兆")
ROMAN = ((1000, "M"), (900, "CM"), (500, "D"), (400, "CD"), (100, "C"), (90, "XC"), (50, "L"), (40, "XL"), (10, "X"), (9, "IX"), (5, "V"), (4, "IV"), (1, "I"))
SMALL = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split()
TENS = "zero ten twenty thirty forty fifty sixty seventy eighty ninety".split()
ORDINALS = {"one": "first", "two": "second", "three": "third", "five": "fifth", "eight": "eighth", "nine": "ninth", "twelve": "twelfth"}
_PLACE = re.compile("%([1-9])")
STEMS, BRANCHES = "甲乙丙丁戊己庚辛壬癸", "子丑寅卯辰巳午未申酉戌亥"


def roman(n: int) -> str:
    out = ""
    for value, sign in ROMAN:
        out += sign * (n // value)
        n %= value
    return out


def letters(n: int) -> str:
    """A .. Z, AA, AB ..: numbers of base 26 without a zero."""
    out = ""
    while n:
        n, digit = divmod(n - 1, 26)
        out = chr(65 + digit) + out
    return out


def chinese(n: int) -> str:
    """Groups of four digits, each written by itself: 一万零五, 十二, 二千零三十."""
    def group(number: int) -> str:
        digits = f"{number:04d}"
        signs = "".join(CHINESE[int(d)] + (unit if d != "0" else "") for d, unit in zip(digits, reversed(UNITS), strict=True))
        return re.sub("零+", "零", signs).rstrip("零")

    whole, groups = n, []
    while whole:
        whole, low = divmod(whole, 10_000)
        groups.append(low)
    out = "".join(group(g) + (GROUPS[k] if g else "零") for k, g in reversed(list(enumerate(groups))))
    out = re.sub("零+", "零", out).strip("零")
    return (out[1:] if out.startswith("一十") else out) or CHINESE[0]


def cardinal(n: int) -> str:
    if n < 20:
        return SMALL[n]
    if n < 100:
        return TENS[n // 10] + (f"-{SMALL[n % 10]}" if n % 10 else "")
    if n < 1000:
        return f"{SMALL[n // 100]} hundred" + (f" {cardinal(n % 100)}" if n % 100 else "")
    return f"{cardinal(n // 1000)} thousand" + (f" {cardinal(n % 1000)}" if n % 1000 else "")


def ordinal_word(n: int) -> str:
    head, sep, last = cardinal(n).rpartition("-") if "-" in cardinal(n) else cardinal(n).rpartition(" ")
    return head + sep + (ORDINALS.get(last) or (last[:-1] + "ieth" if last.endswith("y") else last + "th"))


def _ordinal(n: int) -> str:
    return f"{n}{'th' if 10 <= n % 100 <= 20 else {1: 'st', 2: 'nd', 3: 'rd'}.get(n % 10, 'th')}"


FORMS: dict[str, Callable[[int], str]] = {
    "decimal": str, "decimalZero": lambda n: f"{n:02d}", "upperLetter": letters, "lowerLetter": lambda n: letters(n).lower(), "upperRoman": roman, "lowerRoman": lambda n: roman(n).lower(),
    "chineseCounting": chinese, "chineseCountingThousand": chinese, "ideographDigital": lambda n: "".join(CHINESE[int(d)] for d in str(n)).replace("零", "〇"), "japaneseCounting": chinese, "taiwaneseCountingThousand": chinese,
    "cardinalText": lambda n: cardinal(n).capitalize(), "ordinalText": lambda n: ordinal_word(n).capitalize(), "ordinal": _ordinal, "decimalEnclosedCircle": lambda n: chr(0x245F + n) if 1 <= n <= 20 else str(n),
    "decimalFullWidth": lambda n: "".join(chr(0xFEE0 + ord(d)) for d in str(n)), "ideographTraditional": lambda n: STEMS[(n - 1) % 10], "ideographZodiac": lambda n: BRANCHES[(n - 1) % 12], "none": lambda n: "", "bullet": lambda n: "•",
}


def counter(n: int, form: str = "decimal") -> str:
    return FORMS.get(form, str)(n) if n > 0 or form in ("none", "bullet", "decimal") else str(n)


class Counters:
    """Counters of nine levels: a level counts on, deeper ones start again; a higher one that has not come yet is shown as its start."""

    def __init__(self) -> None:
        self.values: dict[tuple[str, int], int] = {}

    def next(self, list_id: str, level: int, starts: dict[int, int], forms: dict[int, str], pattern: str) -> str:
        """The number of the next paragraph of a list at a level; %1 .. %9 in the pattern stand for the levels' counters."""
        for deeper in range(level + 1, 9):
            self.values.pop((list_id, deeper), None)
        self.values[list_id, level] = self.values.get((list_id, level), starts.get(level, 1) - 1) + 1
        return _PLACE.sub(lambda m: counter(self.values.get((list_id, k := int(m[1]) - 1), starts.get(k, 1)), forms.get(k, "decimal")), pattern)
