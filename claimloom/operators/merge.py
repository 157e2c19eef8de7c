"""Union of mapped corpora into one table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from claimloom.functions.urls import plausible_url, tweet_id
from claimloom.operators.mapping import MERGED_ORDER, ensure_schema, reorder
from claimloom.operators.numbering import number_frames
from claimloom.sources.scan import POSITION, Corpus

# Fixed value: the datasets whose claim URLs are tweets.
TWEET_DATASETS = ("FakeTweetBr",)


def normalize_corpus(corpus: Corpus, tweet_datasets: Sequence[str] = TWEET_DATASETS) -> DataFrame:
    """Canonical rows of one corpus, with implausible claim URLs nulled."""
    rows = ensure_schema(corpus.frame, corpus.name, corpus.source_type, corpus.source_description)
    rows = rows.withColumn("url_claim", plausible_url(F.col("url_claim")))
    if corpus.name in tweet_datasets:
        rows = rows.withColumn("tweet_id", tweet_id(F.col("url_claim")))
    return rows


def union_corpora(
    corpora: Sequence[Corpus],
    order_by: Sequence[str] | None = None,
    tweet_datasets: Sequence[str] = TWEET_DATASETS,
) -> DataFrame:
    """All normalised rows with their uid, rows without text included."""
    return number_frames([normalize_corpus(corpus, tweet_datasets) for corpus in corpora], order_by)


def unnumbered_corpora(
    corpora: Sequence[Corpus], tweet_datasets: Sequence[str] = TWEET_DATASETS
) -> DataFrame:
    """The same rows without uid, for counts: nothing is numbered or joined."""
    return _stacked([normalize_corpus(corpus, tweet_datasets) for corpus in corpora])


def mapped_corpora(corpora: Sequence[Corpus]) -> DataFrame:
    """Canonical rows with the claim URLs as they came, without uid."""
    return _stacked([ensure_schema(c.frame, c.name, c.source_type, c.source_description) for c in corpora])


def _stacked(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [f.drop(POSITION) for f in frames])


def drop_null_texts(df: DataFrame) -> DataFrame:
    """Runs after numbering, so the uids of dropped rows stay unused."""
    return reorder(df.where(F.col("text").isNotNull()), MERGED_ORDER)


def describe_datasets(df: DataFrame, dimension: DataFrame) -> DataFrame:
    """Look up (source_type, source_description) by dataset name, with defaults.

    A plain left join: the dimension is small, and the engine broadcasts it
    after its own size check.
    """
    joined = df.join(dimension, "dataset_name", "left")
    return joined.withColumns(
        {
            "source_type": F.coalesce("source_type", F.lit("news")),
            "source_description": F.coalesce(
                "source_description", F.concat(F.lit("Dataset "), F.col("dataset_name"))
            ),
        }
    )
