"""Left lookup join that stays even when one key holds much of the left side."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from claimloom.staging import stage

# What one task should take of a single key, however large the data. A key is hot beyond this.
ROWS_PER_TASK = 1_000_000
# Rows without a key match nothing; they are spread over so many salts.
NULL_PIECES = 1 << 20


# Rows of a few narrow columns: some tens of megabytes in every executor.
MAX_BROADCAST_ROWS = 500_000


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows, else as it is.

    For narrow tables that are read from storage: the rows are counted here.
    Beyond the bound the join shuffles both sides; its result is the same.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def hot_keys(
    df: DataFrame,
    key: str,
    rows_per_task: int = ROWS_PER_TASK,
    weight: str | None = None,
) -> DataFrame:
    """(key, _pieces): the hot keys and into how many pieces each is to be cut; counted in one pass, staged.

    Pieces follow a key's rows (or its ``sum(weight)``), so none is larger than
    ``rows_per_task``, and there are fewer hot keys than rows / ``rows_per_task``.
    """
    amount = F.count("*") if weight is None else F.sum(weight)
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(amount.alias("_n"))
    pieces = F.ceil(F.col("_n") / F.lit(rows_per_task)).cast("int").alias("_pieces")
    return stage(counts.where(F.col("_n") > rows_per_task).select(key, pieces), "hot-keys")


def salted_left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    row_id: str,
    how: str = "left",
    rows_per_task: int = ROWS_PER_TASK,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join ``left`` to ``right``, whose ``key`` is unique, on one key column.

    Rows of a hot key are spread over its pieces by their id, and only the
    matching rows of ``right`` are repeated that often. Null keys match
    nothing and are spread too. All other keys are joined as usual.
    """
    hot = hot_keys(left, key, rows_per_task) if hot is None else hot
    marks = broadcast_if_small(hot.select(key, "_pieces"), MAX_BROADCAST_ROWS)
    pieces = F.when(F.col(key).isNull(), F.lit(NULL_PIECES)).otherwise(F.coalesce("_pieces", F.lit(1)))
    left_salted = (
        left.join(marks, key, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(row_id), pieces).cast("int"))
        .drop("_pieces")
    )
    right_salted = (
        right.join(marks, key, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1)))
        .drop("_pieces")
    )
    return left_salted.join(right_salted, [key, "_salt"], how).drop("_salt")
