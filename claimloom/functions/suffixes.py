"""Which hosts end in a public suffix, by a table of rules.

Rules are written as in the public suffix list: ``com`` (a plain suffix),
``*.ck`` (any label in front of ``ck`` is a suffix) and ``!www.ck`` (but this
one is not). The list that Spark's HTTP client carries is the default; a table
or file of rules can be given instead.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Where the list lies among the resources of Spark's own jars.
SHIPPED_LIST = "mozilla/public-suffix-list.txt"
# Sections of that list are closed by such lines; suffixes of private companies follow the official ones.
PRIVATE_SECTION = "===BEGIN PRIVATE DOMAINS==="
# A rule table is read by the driver and becomes part of the plan.
MAX_RULES = 100_000


def _ascii(rule: str) -> str:
    """The rule with every label that is not ASCII in its encoded form."""
    return ".".join(p if p.isascii() else "xn--" + p.encode("punycode").decode() for p in rule.split("."))


def _ends(host: str) -> list[str]:
    """``host`` and everything behind one of its dots, longest first."""
    labels = host.split(".")
    return [".".join(labels[i:]) for i in range(len(labels))]


@dataclass(frozen=True)
class SuffixRules:
    """The rules that decide: one behind a plain suffix changes nothing and is left out."""

    plain: frozenset[str]
    wildcard: frozenset[str]  # without the ``*.``
    exceptions: frozenset[str]  # without the ``!``

    @classmethod
    def of(cls, lines: Iterable[str]) -> SuffixRules:
        """From lines of a rule list: comments and blank lines do not count, case does not matter."""
        rules = {line.split()[0].lower() for line in lines if line.strip() and not line.lstrip().startswith("//")}
        rules |= {_ascii(rule) for rule in rules}
        plain = {rule for rule in rules if rule[0] not in "*!"}
        open_ = lambda host: not any(end in plain for end in _ends(host)[1:])
        wildcard = {rule[2:] for rule in rules if rule.startswith("*.")}
        return cls(
            frozenset(rule for rule in plain if open_(rule)),
            frozenset(rule for rule in wildcard if rule not in plain and open_(rule)),
            frozenset(rule[1:] for rule in rules if rule[0] == "!" and open_(rule[1:])),
        )

    @classmethod
    def from_table(cls, table: DataFrame, column: str = "rule") -> SuffixRules:
        """From a table with one rule a row, at most ``MAX_RULES``."""
        rows = table.select(F.col(column).cast("string")).where(F.col(column).isNotNull()).limit(MAX_RULES + 1).collect()
        if len(rows) > MAX_RULES:
            raise ValueError(f"more than {MAX_RULES} suffix rules")
        return cls.of(row[0] for row in rows)

    def knows(self, host: str) -> bool:
        """Whether ``host`` is more than a public suffix: some name stands in front of one."""
        ends = _ends(host.lower())
        return (
            any(end in self.plain for end in ends[1:])
            or any(end in self.wildcard for end in ends[2:])
            or any(end in self.exceptions for end in ends)
        )

    def known(self, host: Column) -> Column:
        """``knows`` as a column: the last 1, 2, ... labels are looked up."""
        lower = F.lower(host)
        labels = F.size(F.split(lower, r"\.", -1))
        tests = [
            (labels >= depth + more) & F.array_contains(_words(rules), F.substring_index(lower, ".", -depth))
            for listed, more in ((self.plain, 1), (self.wildcard, 2), (self.exceptions, 0))
            for depth, rules in _by_depth(listed).items()
        ]
        found = F.lit(False)
        for test in tests:
            found = found | test
        return found


def _by_depth(rules: Iterable[str]) -> dict[int, list[str]]:
    depths: dict[int, list[str]] = {}
    for rule in sorted(rules):
        depths.setdefault(rule.count(".") + 1, []).append(rule)
    return depths


def _words(rules: list[str]) -> Column:
    """One literal, however many rules; the optimiser splits it once."""
    return F.split(F.lit(" ".join(rules)), " ")


@lru_cache(maxsize=1)
def shipped_rules() -> SuffixRules:
    """The official part of the list among the resources of Spark's jars."""
    jvm = SparkSession.active()._jvm
    stream = jvm.java.lang.Thread.currentThread().getContextClassLoader().getResourceAsStream(SHIPPED_LIST)
    if stream is None:
        raise ValueError("this Spark carries no public suffix list; pass rules of your own")
    lines = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").splitlines()
    private = next((i for i, line in enumerate(lines) if PRIVATE_SECTION in line), len(lines))
    return SuffixRules.of(lines[:private])


def as_rules(rules: SuffixRules | DataFrame | Iterable[str] | None) -> SuffixRules:
    if rules is None:
        return shipped_rules()
    if isinstance(rules, SuffixRules):
        return rules
    return SuffixRules.from_table(rules) if isinstance(rules, DataFrame) else SuffixRules.of(rules)
