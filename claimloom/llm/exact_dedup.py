"""Exact duplicates by progressive refinement.

Texts are grouped by length, the groups that are left by a hash of their
prefix, and only what is left then is read in full and hashed in full.

The text itself is never shuffled. A second scan skips the rows whose (length,
prefix hash) cannot be shared: those pairs are folded into a bounded set of
slots that is broadcast, and the full hash is taken before the shuffle. Rows
let through by a shared slot are told apart by the exact grouping.

Null texts count as empty. Texts are equal when identical after lower-casing
A-Z. The row with the largest id stays; where that id itself is repeated, all
rows carrying it stay; rows without an id never stand for a group that has a
row with one. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from claimloom.operators.skew import ROWS_PER_TASK, broadcast_if_small, hot_keys, salted_left_join
from claimloom.staging import stage

PREFIX_CHARS = 64
SLOTS = 1 << 20  # bound of the broadcast


def normalised(text: Column) -> Column:
    """A-Z lower-cased, null as empty. Texts of ASCII alone take the faster way."""
    filled = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(filled) == F.char_length(filled)
    return F.when(ascii_only, F.lower(filled)).otherwise(
        F.translate(filled, string.ascii_uppercase, string.ascii_lowercase)
    )


def text_length(text: Column) -> Column:
    return F.octet_length(F.coalesce(text, F.lit(""))).cast("long")


def prefix_hash(text: Column, prefix_chars: int = PREFIX_CHARS) -> Column:
    return F.xxhash64(normalised(F.substring(text, 1, prefix_chars)))


def full_hash(text: Column) -> Column:
    """Lowercase hex SHA-256 of the normalised text."""
    return F.sha2(normalised(text), 256)


def duplicate_groups(
    docs: DataFrame, id: str, text: str, prefix_chars: int = PREFIX_CHARS, slots: int = SLOTS
) -> DataFrame:
    """(text_sha256, keep_id, group_size) for every text that occurs more than once."""
    body = F.col(text)
    length, prefix = text_length(body), prefix_hash(body, prefix_chars)

    # 1. lengths that more than one row has; 2. of those, prefixes that more than one row has.
    by_length = docs.groupBy(length.alias("length")).agg(F.count("*").alias("n"))
    lengths = by_length.where(F.col("n") > 1).select("length")
    by_prefix = docs.groupBy(length.alias("length"), prefix.alias("prefix")).agg(F.count("*").alias("n"))
    shared = by_prefix.where(F.col("n") > 1).join(lengths, "length", "left_semi").select("length", "prefix")

    # 3. the full hash, only where the first two steps leave a choice.
    def slot(*of: Column | str) -> Column:
        return F.pmod(F.xxhash64(*of), F.lit(slots)).cast("int")

    open_slots = stage(shared.select(slot("length", "prefix").alias("slot")).distinct(), "dedup-slots")
    left = docs.select(F.col(id).alias("id"), body.alias("body"), slot(length, prefix).alias("slot")).join(
        F.broadcast(open_slots), "slot", "left_semi"  # at most `slots` rows
    )
    return (
        left.select("id", full_hash(F.col("body")).alias("text_sha256"))
        .groupBy("text_sha256")
        .agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
        .where(F.col("group_size") > 1)
    )


def flag_duplicates(
    docs: DataFrame, id: str, text: str, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256), one row per row of ``docs``."""
    groups = stage(duplicate_groups(docs, id, text), "dedup-groups")
    rows = docs.select(F.col(id).alias("id"), full_hash(F.col(text)).alias("text_sha256"))
    hot = hot_keys(groups, "text_sha256", rows_per_task, weight="group_size")
    found = salted_left_join(rows, groups, "text_sha256", "id", hot=hot)
    alone = F.col("group_size").isNull()
    keep_id = F.when(alone, F.col("id")).otherwise(F.col("keep_id"))
    return found.select(
        "id",
        keep_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(keep_id).alias("kept"),
        "text_sha256",
    )


def drop_duplicates(docs: DataFrame, id: str, text: str) -> DataFrame:
    """The rows of ``docs`` that stay, all columns kept.

    The rows themselves stay where they are, unless the list of dropped
    (id, hash) is too long to be broadcast.
    """
    flagged = flag_duplicates(docs, id, text).where(~F.col("kept"))
    row = flagged.select(F.col("id").alias("_dropped"), F.xxhash64("text_sha256").alias("_hash"))
    dropped = stage(row, "dedup-dropped")
    same = docs[id].eqNullSafe(dropped["_dropped"]) & (F.xxhash64(full_hash(docs[text])) == dropped["_hash"])
    return docs.join(broadcast_if_small(dropped), same, "left_anti")
