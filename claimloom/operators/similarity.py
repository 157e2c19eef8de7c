"""Exact set similarity of texts that share a group.

A group may hold any number of texts, so it is never one task's work. Its texts
are put in classes by the size of their shingle sets: two sets whose Jaccard
similarity is t or more differ in size by a factor of 1/t at most, so only
texts of one class or of neighbouring classes are compared (the size filter).
Classes are numbered in order of size and cut into tiles of bounded size; two
tiles make a cell, and a cell is one small piece of work that names its pairs.

Within a cell the sets become rows of a 0/1 matrix over the shingles that occur
more than once in it; one matrix product counts all intersections. Two texts
may meet in several groups: the pair is told by the first group of both only.
Groups with the same members are one group from the start.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from claimloom.functions.shingles import shingle_names
from claimloom.operators.numbering import number_by_key
from claimloom.operators.skew import ROWS_PER_TASK, broadcast_if_small, hot_keys, salted_left_join
from claimloom.staging import stage

# A tile holds as many texts, or fewer if they are long: shingles of all texts together.
TILE_TEXTS = 32
TILE_SHINGLES = 1 << 17
# Columns of the matrix that are multiplied at a time: 64 rows are 4 MB.
COLUMNS = 1 << 14


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections of sets of distinct numbers."""
    n = len(sets)
    counts = np.zeros((n, n), np.int64)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = often > 1
    place = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], place[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for start in range(0, int(shared.sum()), COLUMNS):
        low, high = np.searchsorted(column, [start, start + COLUMNS])
        matrix = np.zeros((n, COLUMNS), np.float32)  # counts stay far below 2^24, so they are exact
        matrix[owner[low:high], column[low:high] - start] = 1
        counts += (matrix @ matrix.T).astype(np.int64)
    return counts


def similar_pairs(sets: list[np.ndarray], threshold: float) -> list[tuple[int, int, float]]:
    """(i, j, jaccard) with i < j and jaccard >= threshold."""
    counts = common_counts(sets)
    sizes = np.array([len(s) for s in sets])
    jaccard = counts / (sizes[:, None] + sizes[None, :] - counts)
    i, j = np.nonzero(np.triu(jaccard >= threshold, 1))
    return list(zip(i.tolist(), j.tolist(), jaccard[i, j].tolist()))


def _distinct_groups(groups: DataFrame, rows_per_task: int) -> DataFrame:
    """(text_id, groups): each text's groups, those with the same members counted once."""
    named = groups.select("text_id", F.concat_ws(":", "band", "least").alias("group"))
    shapes = stage(
        named.groupBy("group").agg(
            F.count("*").alias("n"),
            F.bit_xor(F.xxhash64("text_id")).alias("x"),
            F.bit_xor(F.xxhash64("text_id", F.lit("again"))).alias("y"),
        ),
        "group-shapes",
    )
    kept = shapes.groupBy("n", "x", "y").agg(F.min("group").alias("group")).select("group")
    hot = hot_keys(shapes, "group", rows_per_task=rows_per_task, weight="n")
    members = salted_left_join(named, kept, "group", row_id="text_id", how="inner", hot=hot)
    return members.groupBy("text_id").agg(F.array_sort(F.collect_list("group")).alias("groups"))


def verified_pairs(
    texts: DataFrame, groups: DataFrame, threshold: float, ngram: int, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """(id_a, id_b, jaccard): pairs of texts with a group in common and at least that similarity.

    ``texts(text_id, text)`` may hold more texts than there are in ``groups(text_id, band, least)``.
    """
    width = math.log(1 / threshold) + 0.01  # wider than the filter needs, so that rounding loses no pair

    @F.pandas_udf("long")
    def set_size(values):
        return values.map(lambda value: len(shingle_names(value, ngram)))

    lists = stage(_distinct_groups(groups, rows_per_task), "text-groups")
    members = texts.join(broadcast_if_small(lists), "text_id").withColumn("n", set_size("text"))
    members = stage(members, "near-texts")
    places = members.select(
        "text_id", "n", F.floor(F.log("n") / F.lit(width)).alias("class"), F.explode("groups").alias("group")
    )
    ranked = stage(number_by_key(places, ["n", "text_id"], "rank", start=0, within=["group", "class"]), "group-places")
    largest = F.exp((F.col("class") + 1) * F.lit(width))  # no set of the class is larger
    per_tile = F.greatest(F.lit(1), F.least(F.lit(TILE_TEXTS), F.floor(F.lit(TILE_SHINGLES) / largest)))
    tiled = ranked.select(
        "text_id", "group", "class", F.floor(F.col("rank") / per_tile).alias("tile"),
        F.concat_ws("|", "group", "class").alias("key"),
    )
    sizes = stage(tiled.groupBy("key", "group", "class").agg((F.max("tile") + 1).alias("own"), F.count("*").alias("n")), "class-sizes")
    along = Window.partitionBy("group").orderBy("class")  # a few classes per group

    def beside(step: int):
        close = F.lead("class", step).over(along) if step > 0 else F.lag("class", -step).over(along)
        tiles = F.lead("own", step).over(along) if step > 0 else F.lag("own", -step).over(along)
        return F.when(close == F.col("class") + step, tiles).otherwise(0)

    shapes = sizes.select("key", "own", beside(1).alias("above"), beside(-1).alias("below"))
    hot = hot_keys(sizes, "key", rows_per_task=rows_per_task, weight="n")
    placed = salted_left_join(tiled, shapes, "key", row_id="text_id", how="inner", hot=hot)

    def cells(count, cell):
        return F.transform(F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<bigint>")), cell)

    own, tile = F.col("class"), F.col("tile")

    def cell(class_a, tile_a, class_b, tile_b, first):
        return F.struct(
            class_a.alias("class_a"), tile_a.alias("tile_a"), class_b.alias("class_b"), tile_b.alias("tile_b"), first.alias("first")
        )

    work = F.concat(
        cells(F.col("own"), lambda t: cell(own, F.least(t, tile), own, F.greatest(t, tile), tile <= t)),
        cells(F.col("above"), lambda t: cell(own, tile, own + 1, t, F.lit(True))),
        cells(F.col("below"), lambda t: cell(own - 1, t, own, tile, F.lit(False))),
    )
    pieces = placed.select("text_id", "group", F.explode(work).alias("cell")).select("text_id", "group", "cell.*")
    joined = pieces.join(members.select("text_id", "text", "groups"), "text_id")
    kind = texts.schema["text_id"].dataType

    def compared(table: pa.Table) -> pa.Table:
        ids, firsts = table.column("text_id").to_pylist(), table.column("first").to_pylist()
        group = table.column("group")[0].as_py()
        listed = table.column("groups").to_pylist()
        within = table.column("class_a")[0] == table.column("class_b")[0] and table.column("tile_a")[0] == table.column("tile_b")[0]
        pairs = []
        if within or len(set(firsts)) == 2:
            sets = [shingle_names(text.as_py(), ngram) for text in table.column("text")]
            for i, j, jaccard in similar_pairs(sets, threshold):
                # tiles compare their own texts in a cell of their own
                if (within or firsts[i] != firsts[j]) and min(set(listed[i]) & set(listed[j])) == group:
                    pairs.append((ids[i], ids[j], jaccard))
        columns = list(zip(*pairs)) or [(), (), ()]
        types = [table.schema.field("text_id").type] * 2 + [pa.float64()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=["a", "b", "jaccard"])

    found = joined.groupBy("group", "class_a", "tile_a", "class_b", "tile_b").applyInArrow(
        compared, f"a {kind.simpleString()}, b {kind.simpleString()}, jaccard double"
    )
    return found.select(F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b"), "jaccard")
