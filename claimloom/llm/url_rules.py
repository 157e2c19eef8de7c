"""URL rules by a bit-parallel wildcard automaton.

Every rule becomes globs over ``host + path``. All globs lie side by side in
one long bit mask, one bit per state; reading a byte moves all of them at once:
states step on where their next byte is the one read (Shift-And), and states
with a wildcard behind them also stay where they are. Many URLs are read
together as arrays of 64-bit words; a few long ones as big integers.

Globs: ``*`` stands for any bytes but ``/``, ``**`` for any bytes at all; every
other character stands for itself.

Defined cases: a null URL or one without ``://`` has an empty host and path and
fits no rule; empty tables give no rows; very long URLs are read to the end, or
until no rule is open any more; repeated rows are judged one by one. With
several fitting rules the longest wins, then the first listed.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# Bytes of URLs laid out together, and how many rows make that worth while.
CELLS = 1 << 20
FEW_ROWS = 8
# Steps between two looks at which URLs are decided.
STRIDE = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``name`` is host and path, as ``example.net/en/``; it fits the host and its subdomains."""

    name: str
    verdict: str

    def globs(self) -> tuple[str, str]:
        return f"{self.name}**", f"*.{self.name}**"


class GlobAutomaton:
    """All globs as one automaton; ``states`` reads a text, ``accepts`` tells the globs that fit it."""

    def __init__(self, globs: Sequence[str]) -> None:
        self.start, any_loop, segment_loop, at = 0, 0, 0, 0
        steps = [0] * 256
        self.ends: list[int] = []
        for glob in globs:
            self.start |= 1 << at
            data, i = glob.encode(), 0
            while i < len(data):
                if data[i : i + 2] == b"**":
                    any_loop |= 1 << at
                    i += 2
                elif data[i : i + 1] == b"*":
                    segment_loop |= 1 << at
                    i += 1
                else:
                    at += 1
                    steps[data[i]] |= 1 << at
                    i += 1
            self.ends.append(at)
            at += 1
        self.steps = steps
        self.loops = [any_loop | (0 if byte == ord("/") else segment_loop) for byte in range(256)]
        # the end of a glob that closes with ** stays whatever follows
        self.settled = any_loop & sum(1 << end for end in set(self.ends))
        words = max(1, -(-at // 64))
        as_words = lambda mask: np.frombuffer(mask.to_bytes(words * 8, "little"), np.uint64)
        self._start, self._open = as_words(self.start), ~as_words(self.settled)
        self._steps = np.stack([as_words(m) for m in self.steps])
        self._loops = np.stack([as_words(m) for m in self.loops])
        self._word = np.array([end // 64 for end in self.ends], np.int64)
        self._bit = np.array([end % 64 for end in self.ends], np.uint64)

    def read(self, text: bytes) -> int:
        """The states after ``text``, as one big integer."""
        state, steps, loops, settled = self.start, self.steps, self.loops, self.settled
        for byte in text:
            state = (state << 1 & steps[byte]) | (state & loops[byte])
            if not state & ~settled:
                break
        return state

    def _read_together(self, data: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The states after many texts (lengths ascending), as rows of 64-bit words."""
        out = np.broadcast_to(self._start, (len(lengths), len(self._start))).copy()
        rows = np.flatnonzero(lengths > 0)
        state = out[rows]
        for at in range(int(lengths[-1]) if len(lengths) else 0):
            byte = data[begins[rows] + at]
            moved = state << np.uint64(1)
            moved[:, 1:] |= state[:, :-1] >> np.uint64(63)
            state = (moved & self._steps[byte]) | (state & self._loops[byte])
            ended = lengths[rows] == at + 1
            if at % STRIDE == STRIDE - 1:
                ended |= ~(state & self._open).any(axis=1)
            if ended.any():
                out[rows[ended]] = state[ended]
                rows, state = rows[~ended], state[~ended]
                if len(rows) == 0:
                    break
        return out

    def accepts(self, texts: pa.Array) -> Iterable[tuple[np.ndarray, np.ndarray]]:
        """(rows, fits): which globs fit which of ``texts`` (binary, no nulls), some rows at a time."""
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        lengths = np.diff(offsets)
        order = np.argsort(lengths, kind="stable")
        done = 0
        while done < len(order):
            # as many as fit, for the longest of them
            wide = lengths[order[done:]] * np.arange(1, len(order) - done + 1)
            rows = order[done : done + max(1, int(np.searchsorted(wide, CELLS, "right")))]
            done += len(rows)
            if len(rows) < FEW_ROWS:
                read = [self.read(data[offsets[r] : offsets[r + 1]].tobytes()) for r in rows]
                fits = np.array([[s >> end & 1 for end in self.ends] for s in read], bool)
            else:
                states = self._read_together(data, offsets[rows], lengths[rows])
                fits = (states[:, self._word] >> self._bit & np.uint64(1)).astype(bool)
            yield rows, fits


class RuleSet:
    """Rules in order of precedence, over one automaton."""

    def __init__(self, rules: Sequence[Rule], otherwise: str) -> None:
        self.otherwise = otherwise
        self.rules = sorted(rules, key=lambda rule: -len(rule.name))  # stable: the first listed of equal length
        self._automaton = GlobAutomaton([glob for rule in self.rules for glob in rule.globs()])

    def judge(self, canonical: pa.Array) -> pa.Array:
        """(rule, verdict) for every ``host + path``."""
        best = np.full(len(canonical), len(self.rules))
        for rows, fits in self._automaton.accepts(canonical.cast(pa.binary())):
            fits = fits.reshape(len(rows), len(self.rules), 2).any(axis=2)  # two globs a rule
            if self.rules:
                best[rows] = np.where(fits.any(axis=1), fits.argmax(axis=1), len(self.rules))
        names = pa.array([*(rule.name for rule in self.rules), None], pa.string())
        verdicts = pa.array([*(rule.verdict for rule in self.rules), self.otherwise], pa.string())
        index = pa.array(best)
        return pa.StructArray.from_arrays([names.take(index), verdicts.take(index)], names=["rule", "verdict"])


def _behind_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host_of(url: Column) -> Column:
    """What stands between ``://`` and the path, A-Z in lower case; empty without ``://``."""
    host = F.regexp_extract(F.coalesce(_behind_scheme(url), F.lit("")), "^[^/?#]*", 0)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From there to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(_behind_scheme(url), F.lit("")), "^[^/?#]*([^?#]*)", 1)


def judge_urls(
    pages: DataFrame, url: str, rules: Sequence[Rule], keep: Mapping[str, Column], otherwise: str = "allow"
) -> DataFrame:
    """(columns of ``keep``, host, path, rule, verdict) per row; ``otherwise`` where no rule fits."""
    rule_set = RuleSet(rules, otherwise)

    @F.arrow_udf("rule string, verdict string")
    def judged(canonical: pa.Array) -> pa.Array:
        return rule_set.judge(canonical)

    kept = {f"_k{i}": c for i, c in enumerate(keep.values())}
    parts = pages.select(
        *[c.alias(name) for name, c in kept.items()], host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")
    )
    found = parts.withColumn("_found", judged(F.concat("host", "path")))
    return found.select(
        *[F.col(name).alias(c) for name, c in zip(kept, keep)], "host", "path", "_found.rule", "_found.verdict"
    )
