"""Newly landed rows: the stateless steps on a stream, lookups batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from claimloom.operators.duplicates import keep_labelled, with_clean_text, with_quality_flags
from claimloom.operators.enrich import enrich_from_index, review_index
from claimloom.operators.mapping import ensure_schema


def clean_stream(
    stream: DataFrame,
    dataset_name: str,
    source_type: str = "news",
    source_description: str | None = None,
    min_tokens: int = 3,
) -> DataFrame:
    """Mapping, label filter, text cleaning and quality flags of a raw stream.

    These steps hold no state. Numbering and duplicate flags compare rows of
    the whole table and belong to the batch job.
    """
    mapped = ensure_schema(stream, dataset_name, source_type, source_description, probe=False)
    return with_quality_flags(with_clean_text(keep_labelled(mapped)), min_tokens)


def enrich_incrementally(
    stream: DataFrame,
    responses: DataFrame,
    out_dir: str,
    checkpoint_dir: str,
    key: str = "uid",
    text: str = "text",
) -> StreamingQuery:
    """Look up whatever has landed since the last run and write it, exactly once.

    Each micro-batch overwrites its own folder, so a batch repeated after a
    failure leaves the same rows. The responses are parsed once, not per batch.
    """
    index = review_index(responses)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        enriched = enrich_from_index(batch, index, key, text)
        enriched.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
