"""Character tables behind the text functions.

The accent tables are derived from the Unicode character database that ships
with Python; the emoji and whitespace sets are short fixed lists.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

# Every character Python's str.strip()/split() treats as space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)
# The same set as the inside of a regex character class.
WHITESPACE_CLASS = (
    r"\x09\x0a\x0b\x0c\x0d\x1c\x1d\x1e\x1f\x20\x85\xa0\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
# One whitespace character, tried cheaply: almost all text fails both tests at once.
WHITESPACE_PATTERN = (
    r"(?:[\x09\x0a\x0b\x0c\x0d\x1c\x1d\x1e\x1f\x20\x85\xa0]"
    r"|(?=[\x{1680}-\x{3000}])[\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}])"
)

# Code points with the Unicode property Emoji=Yes, without the
# ASCII digits, "#", "*" (only emoji inside a keycap) and the regional
# indicators (only emoji in pairs).
EMOJI_RANGES = """
00A9 00AE 203C 2049 2122 2139 2194-2199 21A9-21AA 231A-231B 2328 23CF
23E9-23F3 23F8-23FA 24C2 25AA-25AB 25B6 25C0 25FB-25FE 2600-2604 260E 2611
2614-2615 2618 261D 2620 2622-2623 2626 262A 262E-262F 2638-263A 2640 2642
2648-2653 265F-2660 2663 2665-2666 2668 267B 267E-267F 2692-2697 2699
269B-269C 26A0-26A1 26A7 26AA-26AB 26B0-26B1 26BD-26BE 26C4-26C5 26C8
26CE-26CF 26D1 26D3-26D4 26E9-26EA 26F0-26F5 26F7-26FA 26FD 2702 2705
2708-270D 270F 2712 2714 2716 271D 2721 2728 2733-2734 2744 2747 274C 274E
2753-2755 2757 2763-2764 2795-2797 27A1 27B0 27BF 2934-2935 2B05-2B07
2B1B-2B1C 2B50 2B55 3030 303D 3297 3299
1F004 1F0CF 1F170-1F171 1F17E-1F17F 1F18E 1F191-1F19A 1F201-1F202 1F21A
1F22F 1F232-1F23A 1F250-1F251 1F300-1F321 1F324-1F393 1F396-1F397
1F399-1F39B 1F39E-1F3F0 1F3F3-1F3F5 1F3F7-1F4FD 1F4FF-1F53D 1F549-1F54E
1F550-1F567 1F56F-1F570 1F573-1F57A 1F587 1F58A-1F58D 1F590 1F595-1F596
1F5A4-1F5A5 1F5A8 1F5B1-1F5B2 1F5BC 1F5C2-1F5C4 1F5D1-1F5D3 1F5DC-1F5DE
1F5E1 1F5E3 1F5E8 1F5EF 1F5F3 1F5FA-1F64F 1F680-1F6C5 1F6CB-1F6D2
1F6D5-1F6D7 1F6DC-1F6E5 1F6E9 1F6EB-1F6EC 1F6F0 1F6F3-1F6FC 1F7E0-1F7EB
1F7F0 1F90C-1F93A 1F93C-1F945 1F947-1F9FF 1FA70-1FA7C 1FA80-1FA88
1FA90-1FABD 1FABF-1FAC5 1FACE-1FADB 1FAE0-1FAE8 1FAF0-1FAF8
"""


def _class_body(ranges: str) -> str:
    parts = []
    for item in ranges.split():
        first, _, last = item.partition("-")
        parts.append(f"\\x{{{first}}}" + (f"-\\x{{{last}}}" if last else ""))
    return "".join(parts)


@lru_cache(maxsize=1)
def emoji_pattern() -> str:
    """Regex for one whole emoji sequence; Java and RE2 read it alike.

    A sequence is a flag pair, a keycap, or a base character with an optional
    variation selector / skin tone / tag run, joined to more by U+200D.
    """
    base = f"[{_class_body(EMOJI_RANGES)}]"
    modifier = r"(?:\x{FE0F}|[\x{1F3FB}-\x{1F3FF}])?(?:[\x{E0020}-\x{E007E}]+\x{E007F})?"
    element = base + modifier
    flag = r"[\x{1F1E6}-\x{1F1FF}]{2}"
    keycap = r"[0-9#*]\x{FE0F}?\x{20E3}"
    return f"{flag}|{keycap}|{element}(?:\\x{{200D}}{element})*"


@lru_cache(maxsize=1)
def accent_tables() -> tuple[str, str, dict[str, str]]:
    """(FROM, TO) for ``translate`` and the few expansions it cannot express.

    NFD followed by dropping nonspacing marks maps most characters to exactly
    one other; those go into FROM/TO. Marks themselves come last in FROM, past
    the end of TO, which makes ``translate`` delete them. Characters that turn
    into several (other than Hangul, which is arithmetic) are returned apart.
    """
    source, target, marks, expansions = [], [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        if 0xAC00 <= code <= 0xD7A3 or 0xD800 <= code <= 0xDFFF:
            continue
        char = chr(code)
        if unicodedata.category(char) == "Mn":
            marks.append(char)
            continue
        if unicodedata.is_normalized("NFD", char):
            continue
        plain = "".join(
            c for c in unicodedata.normalize("NFD", char) if unicodedata.category(c) != "Mn"
        )
        if len(plain) == 1:
            source.append(char)
            target.append(plain)
        else:
            expansions[char] = plain
    return "".join(source + marks), "".join(target), expansions
