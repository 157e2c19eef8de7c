"""Sequential row numbers without sorting everything into one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from claimloom.sources.scan import POSITION
from claimloom.staging import stage

_ROW_BITS = (1 << 33) - 1
_PLACE = ["_frame", "_file", "_block", "_row"]


def number_by_key(
    df: DataFrame, order_by: Sequence[str], column: str, start: int = 1, within: Sequence[str] = ()
) -> DataFrame:
    """Number the rows from ``start`` in key order, per value of ``within`` if given.

    A range sort, staged, then the offset of each partition: numbers and rows
    must come from the very same partitions, also after an executor was lost.
    """
    # The hash keeps rows with equal keys from ending up in one partition.
    keys = [*within, *order_by, F.xxhash64(*df.columns)]
    placed = stage(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumns(
            {
                "_part": F.spark_partition_id(),
                "_row": F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)),
            }
        ),
        "numbered",
    )
    group = [F.col(name).alias(f"_own_{name}") for name in within]
    sizes = placed.groupBy(F.col("_part").alias("_own_part"), *group).agg(
        F.count("*").alias("_rows"), F.min("_row").alias("_first")
    )
    before = (
        Window.partitionBy(*[f"_own_{name}" for name in within])
        .orderBy("_own_part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sizes.withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    same = reduce(
        lambda a, b: a & b,
        [F.col(name).eqNullSafe(F.col(f"_own_{name}")) for name in within],
        F.col("_part") == F.col("_own_part"),
    )
    number = (F.col("_offset") + F.col("_row") - F.col("_first") + F.lit(start)).cast("long")
    return placed.join(offsets, same).select(*df.columns, number.alias(column))


def number_frames(
    frames: Sequence[DataFrame],
    order_by: Sequence[str] | None = None,
    column: str = "uid",
    start: int = 1,
) -> DataFrame:
    """The union of all frames with its rows numbered, frame after frame, no gaps.

    Rows read by ``claimloom.sources`` know their place in their file. Where the
    frames still hold every row of their files, rows are not moved: one
    aggregate over the union gives the files' sizes, one join adds the offsets.
    Filtered or joined frames are numbered by a range sort over the place.
    Frames without places need ``order_by``.
    """
    if order_by is None and not all(POSITION in frame.columns for frame in frames):
        raise ValueError("frames without file positions need order_by")
    placed = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [_with_place(frame, i) for i, frame in enumerate(frames)],
    )
    if order_by is not None:
        return number_by_key(placed, ["_frame", *order_by], column, start).drop(*_PLACE)
    if any(_in_blocks(frame) for frame in frames):
        # where a file is cut may change from scan to scan, so sizes and rows come from one scan
        placed = stage(placed, "placed")
    row = F.col("_row").cast("decimal(38,0)")
    sizes = stage(
        placed.groupBy("_frame", "_file", "_block").agg(
            F.count("*").alias("_rows"),
            F.min("_row").alias("_first"),
            F.max("_row").alias("_last"),
            # with the count, these tell a whole file from one with missing or repeated rows
            F.sum(row).alias("_sum"),
            F.sum(row * row).alias("_squares"),
        ),
        "file-sizes",
    )
    n, first = F.col("_rows").cast("decimal(38,0)"), F.col("_first").cast("decimal(38,0)")
    whole = (
        (F.col("_rows") == F.col("_last") - F.col("_first") + 1)
        & (2 * F.col("_sum") == n * (2 * first + n - 1))
        & (6 * F.col("_squares") == 6 * n * first * first + 6 * first * n * (n - 1) + (n - 1) * n * (2 * n - 1))
    )
    if not sizes.where(~whole).isEmpty():
        return number_by_key(placed, _PLACE, column, start).drop(*_PLACE)
    part = ["_frame", "_file", "_block"]
    before = Window.orderBy(*part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*part, "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    number = (F.col("_offset") + F.col("_row") - F.col("_first") + F.lit(start)).cast("long")
    return placed.join(offsets, part).withColumn(column, number).drop(*_PLACE, "_first", "_offset")


def _in_blocks(frame: DataFrame) -> bool:
    return "block" in frame.schema[POSITION].dataType.names


def _with_place(frame: DataFrame, number: int) -> DataFrame:
    """``frame`` with its rows' places as the columns ``_PLACE``; null where it has none."""
    if POSITION in frame.columns:
        at = F.col(POSITION)
        file, block, row = at["file"], at["block"] if _in_blocks(frame) else F.lit(0), at["row"]
    else:
        file = block = row = F.lit(None)
    place = (F.lit(number), file.cast("string"), block.cast("long"), row.cast("long"))
    return frame.withColumns(dict(zip(_PLACE, place))).drop(POSITION)


def assign_uids(
    frames: Sequence[DataFrame],
    order_by: Sequence[str] | None = None,
    column: str = "uid",
    start: int = 1,
) -> list[DataFrame]:
    """``number_frames``, given back frame by frame."""
    if not frames:
        return []
    marked = [frame.withColumn("_of", F.lit(i)) for i, frame in enumerate(frames)]
    numbered = number_frames(marked, order_by, column, start)
    return [
        numbered.where(F.col("_of") == i).select(*[c for c in frame.columns if c != POSITION], column)
        for i, frame in enumerate(frames)
    ]


def with_row_ids(df: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """0-based ``rid`` in file order (or by key)."""
    return number_frames([df], order_by, column="rid", start=0)
