"""Packing documents of similar length into batches of a token budget.

A global histogram of lengths (rounded up to ``multiple``) is cut into buckets
by dynamic programming, so that padding every document to its bucket's bound
wastes the fewest tokens. Inside a bucket of bound b, batches take
``token_budget // b`` documents each (at least one), in order of document id.

Only the histogram, one row per rounded length, reaches the driver. Documents
are numbered inside their bucket by a range sort and per-partition offsets, so
that a bucket with a third of all rows is still many tasks' work.

A document's length is its words (runs without white space) and an end mark,
so empty and null texts have length 1. Ties go to the smaller bounds. Rows
without an id come first in their bucket; rows with equal ids follow each other
in no fixed order. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from claimloom.operators.numbering import number_by_key
from claimloom.staging import stage

BUCKETS = 8
TOKEN_BUDGET = 32_768
MULTIPLE = 16


def text_tokens(text: Column) -> Column:
    """Words and an end mark: the length a document is packed by."""
    return (F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")) + 1).cast("long")


def optimal_bounds(lengths: Sequence[int], counts: Sequence[int], buckets: int = BUCKETS) -> list[int]:
    """Upper bounds (ascending) of at most ``buckets`` buckets with the least total padding.

    Divide and conquer: the best place of the last cut never moves left as the
    lengths go on, which makes a round O(n log n).
    """
    order = np.argsort(lengths)
    length = np.asarray(lengths, np.int64)[order]
    n = len(length)
    if not n:
        return []
    before = np.concatenate([[0], np.cumsum(np.asarray(counts, np.int64)[order])])
    # tokens after padding: a bucket of lengths i..j-1 costs length[j-1] * documents;
    # what the documents hold themselves is the same for every cut
    cost = np.concatenate([[0], length * before[1:]])  # one bucket
    cuts: list[np.ndarray] = []
    for _ in range(min(buckets, n) - 1):
        new, cut = cost.copy(), np.zeros(n + 1, np.int64)
        new[1:], work = np.iinfo(np.int64).max, [(1, n, 0, n - 1)]
        while work:
            lo, hi, first, last = work.pop()
            if lo > hi:
                continue
            j = (lo + hi) // 2
            i = np.arange(first, min(j - 1, last) + 1)
            total = cost[i] + length[j - 1] * (before[j] - before[i])
            best = int(np.argmin(total))  # the first of equals: the smaller bound
            new[j], cut[j] = total[best], i[best]
            work += [(lo, j - 1, first, int(i[best])), (j + 1, hi, int(i[best]), last)]
        cost = new
        cuts.append(cut)
    bounds, j = [int(length[-1])], n
    for cut in reversed(cuts):
        j = int(cut[j])
        if j == 0:
            break
        bounds.append(int(length[j - 1]))
    return bounds[::-1]


def rounded(n_tokens: Column, multiple: int) -> Column:
    return (F.ceil(n_tokens / F.lit(multiple)) * multiple).cast("long")


def pack(
    docs: DataFrame,
    id: str = "doc_id",
    length: Column | None = None,
    text: str = "text",
    buckets: int = BUCKETS,
    token_budget: int = TOKEN_BUDGET,
    multiple: int = MULTIPLE,
) -> DataFrame:
    """(doc_id, n_tokens, bucket, bound, batch, slot) per row of ``docs``.

    ``bound`` is what the document is padded to, ``batch`` its batch in the
    bucket and ``slot`` its place there, both from 0.
    """
    measured = docs.select(
        F.col(id).alias("doc_id"), (text_tokens(F.col(text)) if length is None else length).alias("n_tokens")
    )
    rows = stage(measured.withColumn("rounded", rounded(F.col("n_tokens"), multiple)), "lengths")
    histogram = rows.groupBy("rounded").agg(F.count("*").alias("n")).collect()
    bounds = optimal_bounds([r.rounded for r in histogram], [r.n for r in histogram], buckets)
    if not bounds:
        bounds = [multiple]
    bucket = sum((F.when(F.col("rounded") > b, 1).otherwise(0) for b in bounds[:-1]), F.lit(0)).cast("int")
    placed = rows.withColumn("bucket", bucket)
    numbered = number_by_key(placed, ["doc_id"], "number", start=0, within=["bucket"])
    bound = F.element_at(F.array(*map(F.lit, bounds)), F.col("bucket") + 1).cast("long")
    per_batch = F.greatest(F.lit(1), F.floor(F.lit(token_budget) / bound)).cast("long")
    return numbered.select(
        "doc_id", "n_tokens", "bucket", bound.alias("bound"),
        F.floor(F.col("number") / per_batch).cast("long").alias("batch"),
        (F.col("number") % per_batch).cast("long").alias("slot"),
    )
