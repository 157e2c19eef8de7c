"""Dates in many spellings to one ISO date."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from claimloom.functions.text import strip

_TIME = r"(?:[01]?[0-9]|2[0-3]):[0-5]?[0-9](?::[0-5]?[0-9](?:\.[0-9]+)?)?"
_ZONE = r"(?: ?(?:Z|UTC|[+-][0-9]{2}:?[0-9]{2}))?"
# English names and the words that say nothing in a date.
_MONTHS = (
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
)
_DAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
_FILLERS = ("of", "at", "on", "and", "ad", "t", "st", "nd", "rd", "th")
_ZONE_NAMES = ("z", "utc", "gmt", "est", "edt", "cst", "cdt", "mst", "mdt", "pst", "pdt", "brt", "bst", "cet", "cest")
# Two-digit years from here on belong to the last century.
PIVOT_YEAR = 69
# No date is longer.
MAX_DATE_CHARS = 100


def _rearranged(c: Column, pattern: str, order: str) -> Column:
    """``c`` rewritten as year-month-day where it matches, as a date if it is one."""
    return F.when(c.rlike(rf"^{pattern}\z"), F.regexp_replace(c, rf"^{pattern}\z", order).try_cast("date"))


def _names(full: tuple[str, ...]) -> str:
    """The names, as whole words, and their first three letters."""
    return "|".join([*full, *(name[:3] for name in full), *(["sept"] if "september" in full else [])])


_CLOCK = r"(?:[01]?[0-9]|2[0-3]):[0-5]?[0-9](?::[0-5]?[0-9](?:[.,][0-9]+)?)?"
_HALF = r"[ap]\.?m\.?(?![a-z])"
_OFFSET = r"[+-][0-9]{1,2}(?::?[0-9]{2})?"
_ZONES = "|".join(sorted(_ZONE_NAMES, key=len, reverse=True))
# A time of day, and the zone that may follow it.
TIME_OF_DAY = (
    rf"(?<![0-9:])(?:{_CLOCK}(?: ?{_HALF})?|[01]?[0-9] ?{_HALF}|(?<=[0-9]t)[0-9]{{4}}(?:[0-9]{{2}})?)"
    rf"(?: ?(?:{_ZONES})(?![a-z]))?(?: ?{_OFFSET}(?![0-9]))?(?: ?\((?:{_ZONES})\))?(?![0-9:])"
)


def free_form_date(c: Column) -> Column:
    """Day of a date in words and numbers, in any order that leaves no doubt.

    The time of day goes first; what is left must be numbers, one month name at
    most, weekday names, ordinal endings and filler words. The numbers then fill
    the slots that are free: a number of three or more digits, or above 31, is
    the year; beside a month name the other one is the day; without one they are
    month, day, year (day first where the first is above 12). Missing days and
    months are the first; without a year there is no date.
    """
    words = f"{_names(_MONTHS)}|{_names(_DAYS)}|{'|'.join(_FILLERS)}"
    starts = "".join(name[:3] for name in _MONTHS)

    def tokens_of(text: Column) -> Column:
        one_time = (F.length(text) <= MAX_DATE_CHARS) & (F.regexp_count(text, F.lit(TIME_OF_DAY)) <= 1)
        return F.when(one_time, F.regexp_replace(text, TIME_OF_DAY, " "))

    def parts_of(day_part: Column) -> Column:
        clear = day_part.rlike(rf"^(?:[0-9]+|(?<![a-z])(?:{words})(?![a-z])|[ ,./;'-])+\z")
        tokens = F.when(clear, F.regexp_extract_all(day_part, F.lit("[0-9]+|[a-z]+"), F.lit(0)))
        return F.struct(
            F.filter(tokens, lambda t: t.rlike(f"^(?:{_names(_MONTHS)})\\z")).alias("months"),
            F.filter(tokens, lambda t: t.rlike("^[0-9]")).alias("numbers"),
        )

    def slots_of(parts: Column) -> Column:
        months, numbers = parts["months"], parts["numbers"]
        number = lambda i: F.get(numbers, F.lit(i))
        n, first, second, third = F.size(numbers), number(0), number(1), number(2)
        small = lambda t: (F.length(t) <= 2) & (t.cast("int") <= 31)
        day_first = small(first) & (first.cast("int") > 12)
        month = ((F.instr(F.lit(starts), F.substring(F.get(months, F.lit(0)), 1, 3)) + 2) / 3).cast("int").cast("string")
        one = F.lit("1")
        slots = lambda *ymd: F.struct(*[c.alias(name) for c, name in zip(ymd, ("year", "month", "day"))])
        named = (
            F.when((n == 1) & (F.length(first) == 4), slots(first, month, one))
            .when((n == 2) & small(first), slots(second, month, first))
            .when((n == 2) & small(second), slots(first, month, second))
        )
        compact = first.rlike("^(?:[0-9]{8}|[0-9]{12}|[0-9]{14})\\z")
        bare = (
            F.when((n == 3) & ~small(first), slots(first, second, third))
            .when((n == 3) & small(second) & day_first, slots(third, second, first))
            .when((n == 3) & small(second), slots(third, first, second))
            .when((n == 2) & ~small(first), slots(first, second, one))
            .when((n == 2) & ~small(second), slots(second, first, one))
            .when((n == 1) & compact, slots(F.substring(first, 1, 4), F.substring(first, 5, 2), F.substring(first, 7, 2)))
            .when((n == 1) & (F.length(first) == 4), slots(first, one, one))
        )
        return F.when(F.size(months) == 1, named).when(F.size(months) == 0, bare)

    def date_of(ymd: Column) -> Column:
        year = ymd["year"]
        century = F.when(year.cast("int") >= PIVOT_YEAR, "19").otherwise("20")
        full = F.when(F.length(year) == 4, year).when(F.length(year) <= 2, F.concat(century, F.lpad(year, 2, "0")))
        return F.concat(full, F.lit("-"), ymd["month"], F.lit("-"), ymd["day"]).try_cast("date")

    # each step names its result once, however often the next one mentions it
    found = F.array(F.lower(strip(c)))
    for step in (tokens_of, parts_of, slots_of, date_of):
        found = F.transform(found, step)
    return found[0]


def parse_date(c: Column) -> Column:
    """Day of a date string. Order: year first, day first, then month first.

    Also read: ISO date-times, ``yyyyMMdd``, a bare year or year-month, and
    whatever ``free_form_date`` makes out. Everything else is null.
    """
    s = strip(c.cast("string"))
    year_first = F.coalesce(
        _rearranged(s, rf"([0-9]{{4}})([-/])([0-9]{{1,2}})\2([0-9]{{1,2}})(?:[ T]{_TIME}{_ZONE})?", "$1-$3-$4"),
        _rearranged(s, r"([0-9]{4})([0-9]{2})([0-9]{2})", "$1-$2-$3"),
        _rearranged(s, r"([0-9]{4})-([0-9]{1,2})", "$1-$2"),
        _rearranged(s, r"([0-9]{4})", "$1"),
    )
    numeric = r"([0-9]{1,2})([-/])([0-9]{1,2})\2([0-9]{4})"
    year_last = F.coalesce(
        _rearranged(s, numeric, "$4-$3-$1"),
        _rearranged(s, rf"{numeric}(?: {_TIME})?", "$4-$1-$3"),
        _rearranged(s, rf"{numeric} {_TIME}", "$4-$3-$1"),
    )
    # The beginning tells the order, so few patterns are tried per value.
    exact = F.when(s.rlike("^[0-9]{4}"), year_first).when(s.rlike("^[0-9]{1,2}[-/]"), year_last)
    return F.coalesce(exact, free_form_date(s))


def iso_date(c: Column, data_type: T.DataType | None = None) -> Column:
    """``yyyy-MM-dd`` string; a typed date or timestamp needs no parsing."""
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd")
    return F.date_format(parse_date(c), "yyyy-MM-dd")
