"""Exact duplicates and quality flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from claimloom.functions.labels import cleaning_label, is_kept_label
from claimloom.functions.text import clean_text, text_digest, token_count
from claimloom.functions.urls import drop_urls, find_urls
from claimloom.operators.skew import MAX_BROADCAST_ROWS
from claimloom.staging import stage


def _copy_group(df: DataFrame, text: str, within: str | None) -> list[Column]:
    """Rows with equal values here are copies of each other; the digest stands for the text."""
    return [text_digest(F.col(text)).alias("_digest"), *([F.col(within).alias("_within")] if within in df.columns else [])]


def copy_groups(df: DataFrame, text: str, within: str | None) -> DataFrame:
    """One row per distinct text (per ``within`` if given): its digest, not the text."""
    return df.select(*_copy_group(df, text, within)).distinct()


def first_copies(df: DataFrame, key: str, text: str, within: str | None) -> DataFrame:
    """Key of the first row of every distinct text (per ``within`` if given).

    A plain minimum per digest: copies are combined before the shuffle, so a
    text that makes up a third of all rows costs no more than any other.
    """
    return df.groupBy(*_copy_group(df, text, within)).agg(F.min(key).alias(key)).select(key)


def keep_first_copies(
    df: DataFrame, key: str, text: str, within: str | None, max_dropped: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """The whole first row of every distinct text. ``key`` is unique.

    The rows are staged, so that their text is made once. Which rows are first
    is found from key and digest alone; the other columns are read only then,
    and move only where too many rows are dropped to broadcast their keys.
    """
    group = _copy_group(df, text, within)
    staged = stage(df.select("*", *group), "copies")
    names = [n for n in ("_digest", "_within") if n in staged.columns]
    first = stage(staged.groupBy(*names).agg(F.min(key).alias(key)).select(key), "first-copies")
    rows = staged.select(*df.columns)
    # both counts come from the files' footers
    if staged.count() - first.count() <= max_dropped:
        dropped = staged.select(key).join(first, key, "left_anti")
        return rows.join(F.broadcast(dropped), key, "left_anti")
    return rows.join(first.hint("shuffle_hash"), key, "left_semi")


def mark_duplicates(df: DataFrame, first: DataFrame, key: str = "uid") -> DataFrame:
    """``is_duplicated``: false for the rows whose key is in ``first``, else true.

    Rows find their flag over the unique key, not over the text, so no task
    ever receives all copies of one text.
    """
    marked = df.join(first.withColumn("_first", F.lit(True)), key, "left")
    return marked.withColumn("is_duplicated", F.col("_first").isNull()).drop("_first")


def flag_duplicates(
    df: DataFrame, key: str = "uid", text: str = "text_clean", within: str | None = "dataset_name"
) -> DataFrame:
    """Mark every occurrence of a text but the first. Nulls count as equal."""
    return mark_duplicates(df, first_copies(df, key, text, within), key)


def with_clean_text(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``text_no_url``, ``extracted_urls`` and ``text_clean``.

    The last step is an explode of a one-element array: filters on
    ``text_clean`` then stay above it. Pushed below a plain projection they
    would repeat the whole cleaning chain, once per mention of the column.
    """
    return (
        df.withColumn("extracted_urls", find_urls(F.col(text)))
        .withColumn("text_no_url", drop_urls(F.col(text), F.col("extracted_urls")))
        .withColumn("text_clean", F.explode(F.array(clean_text(F.col("text_no_url")))))
    )


def with_quality_flags(df: DataFrame, min_tokens: int = 3, text: str = "text_clean") -> DataFrame:
    """Add ``is_null`` and ``too_short`` (fewer than ``min_tokens``; null counts as short)."""
    return df.withColumns(
        {
            "is_null": F.col(text).isNull(),
            "too_short": F.coalesce(token_count(F.col(text)) < min_tokens, F.lit(True)),
        }
    )


def keep_labelled(df: DataFrame) -> DataFrame:
    """Normalise labels and keep only ``fake`` and ``true``."""
    return df.withColumn("label", cleaning_label(F.col("label"))).where(is_kept_label(F.col("label")))
