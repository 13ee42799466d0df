"""RTF to text in one pass, and text to RTF."""

from __future__ import annotations

import re

# Destinations of RTF that hold no text of the document.
SKIPPED = frozenset("fonttbl colortbl stylesheet info pict header footer headerl headerr footerl footerr footnote generator object themedata listtable listoverridetable rsidtbl xmlnstbl".split())
_TOKEN = re.compile(r"\\([a-zA-Z]+)(-?\d+)? ?|\\'([0-9a-fA-F]{2})|\\([^a-zA-Z'])|([{}])|[\r\n]+|([^\\{}\r\n]+)")


def to_text(source: str) -> str:
    out, stack, skip, after, wide = [], [], False, 1, 0
    first = False
    for m in _TOKEN.finditer(source):
        word, number, hexed, symbol, brace, plain = m.groups()
        if brace == "{":
            stack.append((skip, after))
            first = True
            continue
        if brace == "}":
            skip, after = stack.pop() if stack else (False, 1)
            first = False
            continue
        if symbol == "*" and first:
            skip = True
        elif word:
            if first and word in SKIPPED:
                skip = True
            elif not skip:
                if word in ("par", "line", "page", "row"):
                    out.append("\n")
                elif word in ("tab", "cell"):
                    out.append("\t")
                elif word == "uc":
                    after = int(number or 1)
                elif word == "u" and number:
                    out.append(chr(int(number) % 65536))
                    wide = after
        elif not skip:
            if hexed:
                if wide:
                    wide -= 1
                else:
                    out.append(bytes([int(hexed, 16)]).decode("cp1252", "replace"))
            elif symbol:
                out.append({"~": " ", "_": "-", "-": ""}.get(symbol, symbol if symbol in "\\{}" else ""))
            elif plain:
                out.append(plain[wide:])
                wide = max(0, wide - len(plain))
        first = False
    text = "".join(out).encode("utf-16", "surrogatepass").decode("utf-16", "replace")
    return text.strip("\n")


def from_text(text: str) -> str:
    def char(c: str) -> str:
        if c in "\\{}":
            return "\\" + c
        if c in "\n\t":
            return "\\par\n" if c == "\n" else "\\tab "
        if ord(c) < 128:
            return c
        units = c.encode("utf-16-le")
        return "".join(f"\\u{int.from_bytes(units[i:i + 2], 'little', signed=True)}?" for i in range(0, len(units), 2))

    return "{\\rtf1\\ansi\\deff0{\\fonttbl{\\f0 Calibri;}}\n" + "".join(map(char, text.replace("\r\n", "\n"))) + "}"
