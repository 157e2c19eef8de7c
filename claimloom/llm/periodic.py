"""Periodic runs of words: Lyndon roots from Baier's grouping, extended through LCE.

A run is a stretch of words with smallest period q that cannot be made longer
on either side. Every run has a Lyndon word of length q as a root under one of
the two orders of the alphabet, and it is the longest Lyndon word that starts
there. So: group the suffixes as the first phase of Baier's suffix sorting does
(that gives the longest Lyndon prefix of every suffix, no sorting needed), once
under each order; extend each root to both sides by the longest common
extension of the places one period apart; keep what is long enough.

Before that, words that cannot lie in a run of four or more periods are left
out: in such a run of six or more words every three successive words occur
three times or more, so stretches without such triples are cut away. That
removes nothing that could be part of a result. Common extensions are read off
exact names of all stretches of 2^k words; no hash decides.

Defined cases: null and blank texts have no words and no runs; very long texts
are worked on whole, by themselves; repeated rows and ids get a row each; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from claimloom.llm.batches import pieces

MIN_LENGTH = 6
MIN_PERIODS = 4
# Words worked on together; a longer document is worked on alone.
CHUNK_WORDS = 60_000
# Rounds of cutting away; each is exact, more of them only leave less.
ROUNDS = 3

Run = tuple[int, int, int]


def lyndon_lengths(word: Sequence[int]) -> list[int]:
    """Length of the longest Lyndon word that starts at each place (the end is least).

    Groups hold the suffixes with one prefix. They are taken from the greatest
    down; a group taken is final. Each of its suffixes prolongs the prefix of
    the nearest place to the left that lies in a smaller group; places prolonged
    equally often leave their group for a new one just above it.
    """
    n = len(word)
    first: dict[int, list[int]] = {}
    for place, symbol in enumerate(word):
        first.setdefault(symbol, []).append(place)
    members = [first[symbol] for symbol in sorted(first)]
    of, lengths = [0] * n, [1] * len(members)
    for number, places in enumerate(members):
        for place in places:
            of[place] = number
    below, above = list(range(-1, len(members) - 1)), list(range(1, len(members) + 1))
    # nearest[i + 1]: where to look for the nearest place at or before i whose group is not taken yet
    nearest, result = list(range(n + 1)), [0] * n
    group = len(members) - 1
    while group >= 0:
        length = lengths[group]
        taken = [place for place in members[group] if of[place] == group]
        for place in taken:
            result[place] = length
            nearest[place + 1] = place
        often: dict[int, int] = {}
        for place in taken:
            at = place
            while (up := nearest[at]) != at:
                nearest[at] = nearest[up]
                at = nearest[up]
            if at:
                often[at - 1] = often.get(at - 1, 0) + 1
        parts: dict[tuple[int, int], list[int]] = {}
        for place, times in often.items():
            parts.setdefault((times, of[place]), []).append(place)
        # the most prolonged are the greatest: inserted first, then pushed up by the others
        for times, old in sorted(parts, reverse=True):
            new = len(members)
            members.append(parts[times, old])
            lengths.append(lengths[old] + times * length)
            for place in members[new]:
                of[place] = new
            higher = above[old]
            below.append(old)
            above.append(higher)
            above[old] = below[higher] = new
        group = below[group]
    return result


def block_names(word: np.ndarray, longest: int) -> list[np.ndarray]:
    """names[k][i] tells the 2^k symbols from i: equal names, equal symbols."""
    names, size = [np.unique(word, return_inverse=True)[1]], 1
    while 2 * size <= min(longest, len(word)):
        last = names[-1]
        pairs = last[:-size] * (int(last.max()) + 1) + last[size:]
        names.append(np.unique(pairs, return_inverse=True)[1])
        size *= 2
    return names


def _after(names: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many symbols from ``a`` and from ``b`` on are equal, for all pairs a < b."""
    out, n = np.zeros(len(a), np.int64), len(names[0])
    for k in range(len(names) - 1, -1, -1):
        size = 1 << k
        fits = np.flatnonzero(b + out + size <= n)
        equal = fits[names[k][a[fits] + out[fits]] == names[k][b[fits] + out[fits]]]
        out[equal] += size
    return out


def _before(names: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The same going left from ``a - 1`` and ``b - 1``."""
    out = np.zeros(len(a), np.int64)
    for k in range(len(names) - 1, -1, -1):
        size = 1 << k
        fits = np.flatnonzero(a - out - size >= 0)
        equal = fits[names[k][a[fits] - out[fits] - size] == names[k][b[fits] - out[fits] - size]]
        out[equal] += size
    return out


def _stretches(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the stretches of true values."""
    edges = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def _covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps[:n]) > 0


def _possible(word: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Where a run may lie: places of stretches whose triples all occur three times in the stretch."""
    n = len(word)
    if n < MIN_LENGTH:
        return np.zeros(n, bool)
    pairs = np.unique(word[:-1] * (int(word.max()) + 1) + word[1:], return_inverse=True)[1]
    triples = np.unique(pairs[:-1] * (int(word.max()) + 1) + word[2:], return_inverse=True)[1]
    kinds = int(triples.max()) + 1
    for _ in range(ROUNDS):
        starts, _ends = _stretches(inside)
        if len(starts) == 0:
            return inside
        whole = np.flatnonzero(inside[:-2] & inside[1:-1] & inside[2:])
        own = np.searchsorted(starts, whole, "right") * kinds + triples[whole]
        _, which, counts = np.unique(own, return_inverse=True, return_counts=True)
        often = np.zeros(n, bool)
        often[whole[counts[which] >= 3]] = True
        starts, ends = _stretches(often)
        long = ends - starts >= MIN_LENGTH - 2
        left = _covered(n, starts[long], ends[long] + 2)
        if left.sum() == inside.sum():
            break
        inside = left
    return inside


def _runs(word: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of all runs of ``word`` within the stretches ``inside``."""
    starts, ends = _stretches(inside)
    none = np.empty((0, 3), np.int64)
    if len(starts) == 0:
        return none
    # the stretches one after the other, a symbol of its own behind each
    sizes = ends - starts
    at = np.concatenate([np.arange(a, b + 1) for a, b in zip(starts, ends)])
    stretch = np.repeat(np.arange(len(starts)), sizes + 1)
    cuts = np.cumsum(sizes + 1) - 1
    seq = word[np.minimum(at, len(word) - 1)]
    seq[cuts] = int(word.max()) + 1 + np.arange(len(cuts))
    names = block_names(seq, int(sizes.max()))
    low = names[0]
    found = []
    for lengths in (lyndon_lengths(low.tolist()), lyndon_lengths((-low).tolist())):
        period = np.array(lengths, np.int64)
        place = np.flatnonzero(period * MIN_PERIODS <= sizes[stretch])
        place = place[(place + period[place] < len(seq)) & (at[place] < ends[stretch[place]])]
        q = period[place]
        left = _before(names, place, place + q)
        length = left + q + _after(names, place, place + q)
        good = length >= np.maximum(MIN_LENGTH, MIN_PERIODS * q)
        found.append(np.stack([at[(place - left)[good]], length[good], q[good]], axis=1))
    return np.unique(np.concatenate(found), axis=0)


def runs_of(documents: Sequence[Sequence]) -> list[list[Run]]:
    """(start, length, period) of every run of each document, by start, then period."""
    ids: dict = {}
    # a separate symbol behind each document, so that no run crosses an end
    words = np.fromiter(
        (ids.setdefault(w, len(ids)) for d, document in enumerate(documents) for w in (*document, (d,))),
        np.int64,
    )
    ends = np.cumsum([len(document) + 1 for document in documents], dtype=np.int64)
    inside = np.ones(len(words), bool)
    inside[ends - 1] = False
    out: list[list[Run]] = [[] for _ in documents]
    rows = _runs(words, _possible(words, inside))
    own = np.searchsorted(ends, rows[:, 0], "right")
    begins = np.concatenate([[0], ends])
    for d, (start, length, period) in zip(own.tolist(), rows.tolist()):
        out[d].append((start - int(begins[d]), length, period))
    return [sorted(r, key=lambda run: (run[0], run[2])) for r in out]


def collapsed(words: Sequence[bytes], runs: Sequence[Run]) -> bytes:
    """The words left when each run keeps its first period only, joined by one space."""
    if not runs:
        return b" ".join(words)
    starts = np.array([start + period for start, _, period in runs])
    ends = np.array([start + length for start, length, _ in runs])
    return b" ".join(words[i] for i in np.flatnonzero(~_covered(len(words), starts, ends)).tolist())


def find_runs(docs: DataFrame, text: str | Column, keep: Mapping[str, Column]) -> DataFrame:
    """(columns of ``keep``, n_words, runs, collapsed) per row.

    ``runs`` lists (start, length, period) in words by start, then period;
    ``collapsed`` is the text with every run cut down to its first period.
    Words are what stands between ASCII blanks.
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def answered(piece: pa.RecordBatch, first: int, held: list[list[bytes]]) -> pa.RecordBatch:
        runs = runs_of(held)
        kept = piece.slice(first, len(held))
        listed = pa.array([[dict(zip(("start", "length", "period"), r)) for r in own] for own in runs], kind)
        left = pa.array([collapsed(w, r) for w, r in zip(held, runs)], pa.binary())
        return pa.RecordBatch.from_arrays(
            [*kept.columns[1:], pa.array([len(w) for w in held], pa.int64()), listed, left],
            names=[*kept.schema.names[1:], "n_words", "runs", "collapsed"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            first, held, size = 0, [], 0
            for row, value in enumerate(piece.column(0)):
                words = (value.as_py() or b"").split()  # bytes split at exactly the ASCII blanks
                if held and size + len(words) > CHUNK_WORDS:
                    yield answered(piece, first, held)
                    first, held, size = row, [], 0
                held.append(words)
                size += len(words)
            if held:
                yield answered(piece, first, held)

    column = F.col(text) if isinstance(text, str) else text
    rows = docs.select(column.cast("binary").alias("_text"), *[c.alias(name) for name, c in keep.items()])
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[1:])
    found = rows.mapInArrow(
        run, f"{kept}n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"
    )
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period; ties to the smaller start, then period. Null without runs."""

    def stronger(best: Column, run: Column) -> Column:
        # exact, by cross products; the list is in order of start and period, so the earlier wins ties
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)

    kind = "struct<start: bigint, length: bigint, period: bigint>"
    return F.aggregate(runs, F.lit(None).cast(kind), stronger)


def listed(runs: Column) -> Column:
    """``start,length,period`` and a line feed for every run."""
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    return F.array_join(F.transform(runs, lambda r: F.concat(line(r), F.lit("\n"))), "")
