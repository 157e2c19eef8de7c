"""Text normalisation as column expressions (``Column -> Column``).

Each function reads its argument once, so that chaining them does not make
Spark evaluate earlier steps again.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from claimloom.functions.unicode_tables import (
    WHITESPACE,
    WHITESPACE_PATTERN,
    accent_tables,
    emoji_pattern,
)

_HANGUL_FIRST = 0xAC00
_HANGUL_LAST = 0xD7A3


def strip(c: Column) -> Column:
    """Trim Unicode whitespace on both sides (``trim`` alone knows only " ")."""
    return F.btrim(c, F.lit(WHITESPACE))


def remove_outer_quotes(c: Column) -> Column:
    """Strip, then drop one pair of outer quotes; the two may differ in kind."""
    return F.regexp_replace(strip(c), r"""^["']([^\n]*)["']\z""", "$1")


def remove_emojis(c: Column) -> Column:
    """Delete emoji sequences; plain digits, ``#`` and ``*`` survive."""
    # The lookahead rejects ordinary letters before the long class is tried.
    gate = r"(?=[0-9#*\x{A9}\x{AE}\x{203C}-\x{1FAF8}])"
    return F.regexp_replace(c, f"{gate}(?:{emoji_pattern()})", "")


def normalize_spaces(c: Column) -> Column:
    """Every whitespace run becomes one space; none at the ends."""
    return F.trim(F.regexp_replace(c, f"{WHITESPACE_PATTERN}+", " "))


def _fold_single(c: Column) -> Column:
    source, target, _ = accent_tables()
    return F.translate(c, source, target)


def _expanding() -> str:
    """Regex for one character that becomes several; the lookahead spares the rest."""
    expansions = accent_tables()[2]
    low, high = ord(min(expansions)), ord(max(expansions))
    members = f"\\x{{AC00}}-\\x{{D7A3}}{''.join(expansions)}"
    return f"(?:(?=[\\x{{{low:X}}}-\\x{{{high:X}}}])[{members}])"


def _needs_expansion(c: Column) -> Column:
    return c.rlike(_expanding())


def _expand(c: Column) -> Column:
    """Decompose the characters whose canonical form is longer than one."""
    _, _, expansions = accent_tables()
    pairs = ", ".join(f"'{char}', '{plain}'" for char, plain in expansions.items())
    table = F.expr(f"map({pairs})")
    leads = F.lit("".join(map(chr, range(0x1100, 0x1113))))
    vowels = F.lit("".join(map(chr, range(0x1161, 0x1176))))
    tails = F.lit("".join(map(chr, range(0x11A8, 0x11C3))))

    def jamo(syllable: Column) -> Column:
        index = F.ascii(syllable) - F.lit(_HANGUL_FIRST)
        tail = (index % 28).cast("int")
        return F.concat(
            F.substring(leads, F.floor(index / 588).cast("int") + 1, F.lit(1)),
            F.substring(vowels, F.floor((index % 588) / 28).cast("int") + 1, F.lit(1)),
            F.when(tail == 0, F.lit("")).otherwise(F.substring(tails, tail, F.lit(1))),
        )

    def plain(piece: Column) -> Column:
        syllable = (F.length(piece) == 1) & piece.between(chr(_HANGUL_FIRST), chr(_HANGUL_LAST))
        return F.coalesce(F.try_element_at(table, piece), F.when(syllable, jamo(piece)).otherwise(piece))

    # Cut the text around every such character; the pieces between stay whole.
    cut = f"(?={_expanding()})|(?<={_expanding()})"
    return F.array_join(F.transform(F.split(c, cut), plain), "")


def normalize_accents(c: Column) -> Column:
    """Canonical decomposition without nonspacing marks: ``ação`` -> ``acao``."""
    return F.when(_needs_expansion(c), _fold_single(_expand(c))).otherwise(_fold_single(c))


def clean_text(c: Column) -> Column:
    """strip, emoji, outer quotes, accents, lower case, spaces; null stays null."""
    bare = remove_outer_quotes(remove_emojis(strip(c)))
    # Both tests read the raw column, so that no step is evaluated twice. Plain
    # ASCII has neither emoji nor accents and takes the short way.
    return (
        F.when(F.octet_length(c) == F.length(c), normalize_spaces(F.lower(remove_outer_quotes(c))))
        .when(_needs_expansion(c), normalize_spaces(F.lower(_fold_single(_expand(bare)))))
        .otherwise(normalize_spaces(F.lower(_fold_single(bare))))
    )


def token_count(c: Column) -> Column:
    """Number of whitespace-separated tokens of a space-normalised text."""
    return F.when(c == "", F.lit(0)).otherwise(F.size(F.split(c, " ")))


def text_digest(c: Column) -> Column:
    """sha256 of the text in hex: a short key that stands for the whole text."""
    return F.sha2(c, 256)


def query_text(c: Column, max_chars: int = 512) -> Column:
    """The first ``max_chars`` characters, which is what a claim lookup sends."""
    return F.substring(c, 1, max_chars)


def has_text(c: Column) -> Column:
    """False for null and blank texts, which are never looked up."""
    return F.coalesce(strip(c) != "", F.lit(False))
