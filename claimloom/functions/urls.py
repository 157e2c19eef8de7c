"""URL recognition, removal and plausibility as column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from claimloom.functions.suffixes import SuffixRules, as_rules
from claimloom.functions.text import strip
from claimloom.functions.unicode_tables import WHITESPACE_CLASS

_WORD = r"\p{L}\p{N}_"
_STOP = WHITESPACE_CLASS + "\"<>;"
# A path never ends in sentence punctuation or a closing bracket.
_TAIL = f"[^{_STOP}]*[^{_STOP}.,!?:)\\]}}']"

# The pattern of a first URL inside a raw text.
FIRST_URL_PATTERN = (
    f"(?i)(?<![{_WORD}])(?:https?://|www\\.)(?:[a-zA-Z0-9-]+\\.)+"
    f"(?:[a-zA-Z]{{2,63}})(?:/[^{WHITESPACE_CLASS}]*)?"
)
# Where the id sits in a status URL; failing that, any long number.
STATUS_URL_PATTERN = r"twitter\.com/[^\n]*/status/(\p{Nd}+)"
LONG_NUMBER_PATTERN = r"(\p{Nd}{8,})"
# Fixed value: a whole value that is only a number.
PLAIN_NUMBER_PATTERN = r"^[0-9]+([.,][0-9]+)?\z"


def url_pattern() -> str:
    """What may be a URL in running text: with a scheme, with ``www.``, or a dotted host alone.

    E-mail addresses are not URLs: a bare host may not touch an ``@``.
    """
    labels = r"(?:[\p{L}\p{N}-]++\.)+"
    local = f"localhost(?![{_WORD}.@-])"
    # An address with a scheme needs no known suffix, only a dotted host or this machine's name.
    full = f"(?:https?|ftp)://(?:[^{_STOP}/?#@]+@)?(?:(?:[{_WORD}-]++\\.)+[\\p{{L}}\\p{{N}}-]+|{local})"
    bare = f"(?:www\\.{labels}[a-z]{{2,63}}|{labels}[\\p{{L}}\\p{{N}}-]+)(?![{_WORD}@-])|{local}(?=:[0-9]|/)"
    rest = f"(?::[0-9]+)?(?:[/?#](?:{_TAIL})?)?"
    return f"(?i)(?<![{_WORD}@.-])(?:{full}|{bare}){rest}"


def is_number_like(c: Column) -> Column:
    """True for numbers in disguise such as ``50.OOO`` (letter o for zero)."""
    return F.replace(F.lower(strip(c)), F.lit("o"), F.lit("0")).rlike(PLAIN_NUMBER_PATTERN)


def find_urls(c: Column, rules: SuffixRules | DataFrame | Iterable[str] | None = None) -> Column:
    """All URLs of a text in order, repeated ones included; null text gives [].

    A host without scheme and ``www.`` counts as far as it ends in a public
    suffix by ``rules`` (a table, lines, or the list that Spark carries).
    """
    known = as_rules(rules).known

    def recognised(url: Column) -> Column:
        host = F.regexp_extract(url, "^[^:/?#]+", 0)
        sure = url.rlike(r"(?i)^(?:https?|ftp)://|^www\.(?:[^.:/?#]+\.)+[a-z]{2,63}(?:[:/?#]|\z)|^localhost[:/]")
        # what stands behind the last known suffix belongs to the next sentence: exemplo.com.Ontem
        shorter = F.transform(
            F.sequence(F.lit(2), F.size(F.split(host, r"\."))), lambda n: F.call_function("substring_index", host, F.lit("."), n)
        )
        return F.when(sure | known(host), url).otherwise(F.try_element_at(F.filter(shorter, known), F.lit(-1)))

    # Without a scheme, www. and a dot that a letter follows there is no URL.
    likely = c.rlike(r"(?i)://|\.[\p{L}]|localhost[:/]|\.[\p{N}-]+\p{L}")
    candidates = F.regexp_extract_all(c, F.lit(url_pattern()), F.lit(0))
    found = F.transform(F.filter(candidates, lambda u: ~is_number_like(u)), recognised)
    return F.when(likely, F.filter(found, lambda u: u.isNotNull())).otherwise(F.array().cast("array<string>"))


def drop_urls(c: Column, urls: Column) -> Column:
    """Remove each listed URL wherever it stands, in list order, then strip."""
    return strip(F.aggregate(urls, c, lambda text, url: F.replace(text, url, F.lit(""))))


def first_url(c: Column) -> Column:
    """First ``http(s)://`` or ``www.`` URL, given a scheme if it has none."""
    url = F.nullif(F.regexp_extract(c, FIRST_URL_PATTERN, 0), F.lit(""))
    return F.regexp_replace(url, r"^(?i)(?=www\.)", "http://")


def tweet_id(c: Column) -> Column:
    """Status id of a tweet URL, else the first run of eight or more digits."""
    return F.coalesce(
        F.nullif(F.regexp_extract(c, STATUS_URL_PATTERN, 1), F.lit("")),
        F.nullif(F.regexp_extract(c, LONG_NUMBER_PATTERN, 1), F.lit("")),
    )


def is_probably_url(c: Column) -> Column:
    """Not a number, and its host part has a dot (a missing scheme is fine)."""
    host = F.regexp_extract(strip(c), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://)?([^/?#]*)", 1)
    return ~strip(c).rlike(PLAIN_NUMBER_PATTERN) & host.contains(".")


def plausible_url(c: Column) -> Column:
    """The stripped URL where it is plausible, else null."""
    return F.when(is_probably_url(c), strip(c))
