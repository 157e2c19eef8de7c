"""Claim-review lookup as a join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from claimloom.functions.reviews import REVIEW_COLUMNS, review_fields
from claimloom.functions.text import has_text, query_text, text_digest
from claimloom.operators.skew import ROWS_PER_TASK, hot_keys, salted_left_join
from claimloom.staging import stage


def lookup_key(text: Column, max_query_chars: int | None = None) -> Column:
    """Digest of the text, or of its first ``max_query_chars``; null for texts that are not looked up."""
    return F.when(has_text(text), text_digest(text if max_query_chars is None else query_text(text, max_query_chars)))


def parsed_reviews(responses: DataFrame) -> DataFrame:
    """One row of review columns per query digest (the smallest response if several)."""
    one = responses.groupBy(text_digest(F.col("query")).alias("_query")).agg(
        F.min("response_json").alias("response_json")
    )
    return one.select("_query", review_fields(F.col("response_json")).alias("r")).select("_query", "r.*")


def review_index(responses: DataFrame) -> DataFrame:
    """The parsed responses as a staged table, for lookups that come again and again."""
    return stage(parsed_reviews(responses), "reviews")


def enrich_with_reviews(
    df: DataFrame,
    responses: DataFrame,
    key: str = "uid",
    text: str = "text",
    max_query_chars: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Left join with ``responses(query, response_json)``: every row is kept once.

    Blank texts get a key of their own, so that they neither match nor meet
    in one task; texts repeated very often are salted. The whole text is the
    key, unless ``max_query_chars`` names the prefix that the queries were cut to.
    """
    return enrich_from_index(df, parsed_reviews(responses), key, text, max_query_chars, rows_per_task)


def enrich_from_index(
    df: DataFrame,
    index: DataFrame,
    key: str = "uid",
    text: str = "text",
    max_query_chars: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """The same from a ``review_index``; no response is parsed again."""
    own = F.concat(F.lit("none:"), F.col(key).cast("string"))
    looked_up = lookup_key(F.col(text), max_query_chars)
    # texts that are looked up are counted by their digest alone; the others have keys of one row each
    hot = hot_keys(df.select(looked_up.alias("_query")), "_query", rows_per_task)
    keyed = df.withColumn("_query", F.coalesce(looked_up, own))
    joined = salted_left_join(keyed, index, "_query", key, rows_per_task=rows_per_task, hot=hot)
    return joined.select(*df.columns, *REVIEW_COLUMNS)
