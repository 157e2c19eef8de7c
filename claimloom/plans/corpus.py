"""The jobs a user runs: merge, clean, find near-duplicates, enrich."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from claimloom.functions.urls import drop_urls
from claimloom.operators.audit import StageCounts
from claimloom.operators.duplicates import (
    copy_groups,
    first_copies,
    keep_first_copies,
    keep_labelled,
    mark_duplicates,
    with_clean_text,
    with_quality_flags,
)
from claimloom.operators.enrich import enrich_with_reviews
from claimloom.operators.mapping import CLEAN_ORDER, reorder, unify_urls
from claimloom.operators.merge import TWEET_DATASETS, drop_null_texts, union_corpora
from claimloom.operators.near_duplicates import NearDuplicateSettings, find_near_duplicates, with_near_duplicates
from claimloom.sources.scan import Corpus, share_out
from claimloom.sources.sinks import (
    as_text_columns,
    sized_files,
    write_counts,
    write_csv,
    write_manifest,
    write_parquet,
)
from claimloom.staging import stage


def merge_corpora(
    corpora: Sequence[Corpus],
    order_by: Sequence[str] | None = None,
    tweet_datasets: Sequence[str] = TWEET_DATASETS,
) -> DataFrame:
    """Raw corpora to one canonical table with uids, rows without text dropped."""
    return drop_null_texts(union_corpora(corpora, order_by, tweet_datasets))


def _cleaned(df: DataFrame, min_tokens: int) -> DataFrame:
    return with_quality_flags(with_clean_text(df), min_tokens)


def flag_corpus(df: DataFrame, min_tokens: int = 3, key: str = "uid") -> DataFrame:
    """Labelled rows with cleaned text and all three quality flags, none dropped."""
    cleaned = stage(_cleaned(keep_labelled(share_out(df, key)), min_tokens), "cleaned")
    first = first_copies(cleaned, key, "text_clean", "dataset_name")
    flags = [name for name in cleaned.columns if name not in ("is_null", "too_short")]
    return mark_duplicates(cleaned, first, key).select(*flags, "is_duplicated", "is_null", "too_short")


def _long_enough(df: DataFrame, min_tokens: int) -> DataFrame:
    """Labelled, cleaned rows that are neither null nor short.

    Copies of a text are all short or all long, so these rows may go before
    the duplicate check.
    """
    return _cleaned(keep_labelled(df), min_tokens).where(~F.col("is_null") & ~F.col("too_short"))


def surviving_texts(df: DataFrame, min_tokens: int = 3) -> DataFrame:
    """One row per row of ``clean_corpus``, its digest and dataset: for counts, no key and no text is shuffled."""
    return copy_groups(_long_enough(df, min_tokens), "text_clean", "dataset_name")


def clean_corpus(df: DataFrame, min_tokens: int = 3, key: str = "uid") -> DataFrame:
    """Labelled rows with cleaned text, without null, short and duplicate ones.

    Each text is cleaned once and staged; which rows stay is found from their
    digests. The form without URLs is cut again from the URLs found, which is cheap.
    """
    good = _long_enough(share_out(df, key), min_tokens).drop("text_no_url")
    clean = keep_first_copies(good, key, "text_clean", "dataset_name").withColumns(
        {
            "text_no_url": drop_urls(F.col("text"), F.col("extracted_urls")),
            "is_duplicated": F.lit(False),
        }
    )
    added = ["text_no_url", "extracted_urls", "is_duplicated", "is_null", "too_short"]
    kept = [name for name in df.columns if name != "language"] + ["text_clean"]
    return reorder(clean.select(*kept, *added), CLEAN_ORDER)


@dataclass(frozen=True)
class CorpusResult:
    """Tables of every stage; write or preview the ones you need."""

    normalized: DataFrame
    merged: DataFrame
    clean: DataFrame
    final: DataFrame


def run(
    corpora: Sequence[Corpus],
    responses: DataFrame | None = None,
    near_duplicates: NearDuplicateSettings | None = None,
    min_tokens: int = 3,
    order_by: Sequence[str] | None = None,
) -> CorpusResult:
    """The whole job: merge, clean, and the optional stages.

    The clean table is read several times by the optional stages, so it is
    staged in front of them. With ``responses`` the final rows come in the order
    of ``uid``, which is dropped there.
    """
    normalized = union_corpora(corpora, order_by)
    merged = drop_null_texts(normalized)
    clean = clean_corpus(merged, min_tokens)
    if near_duplicates is not None or responses is not None:
        clean = stage(clean, "clean")
    final = clean
    if responses is not None:
        final = enrich_with_reviews(final, responses)
    if near_duplicates is not None:
        final = final.join(find_near_duplicates(clean, "uid", "text_clean", near_duplicates), "uid", "left")
    if responses is not None:
        final = unify_urls(final.orderBy("uid"))
    return CorpusResult(normalized, merged, clean, final)


def run_to(
    out_dir: str,
    corpora: Sequence[Corpus],
    responses: DataFrame | None = None,
    near_duplicates: NearDuplicateSettings | None = None,
    min_tokens: int = 3,
    order_by: Sequence[str] | None = None,
    csv: bool = True,
) -> dict[str, str]:
    """The whole job with every stage written below ``out_dir``, and a manifest; path by table.

    Each stage reads the table written before it, so a lost executor never
    costs more than the current stage. Counts by dataset and by stage are taken
    while the tables are written; the corpora are read once.
    """
    base = out_dir.rstrip("/")
    paths: dict[str, str] = {}

    def written(name: str, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        paths[f"{name}_parquet"] = f"{base}/{name}.parquet"
        # the rows of a partitioned table are dealt before they are counted
        write_parquet(df, paths[f"{name}_parquet"], partition_by, sized=False)
        # with the written schema: a dataset named 001 must not come back as the number 1
        schema = as_text_columns(df).schema
        stored = df.sparkSession.read.schema(schema).parquet(paths[f"{name}_parquet"]).select(*df.columns)
        if csv:
            paths[f"{name}_csv"] = f"{base}/{name}.csv"
            write_csv(stored, paths[f"{name}_csv"])
        return stored

    counts = StageCounts(corpora)
    normalized = counts.normalized(sized_files(union_corpora(corpora, order_by), "dataset_name"))
    merged = written("merged", drop_null_texts(normalized), "dataset_name")
    clean = counts.clean(sized_files(clean_corpus(merged, min_tokens), "dataset_name"))
    clean = written("clean", clean, "dataset_name")
    for name, table in (("dataset_stats", counts.dataset_stats), ("stage_audit", counts.stage_audit)):
        paths[name] = f"{base}/{name}.json"
        write_counts(table(clean.sparkSession), paths[name])
    final = clean
    if near_duplicates is not None:
        final = written("near_duplicates", with_near_duplicates(final, "uid", "text_clean", near_duplicates))
    if responses is not None:
        # the key is dropped here, so the rows are put in its order first
        written("factchecked", unify_urls(enrich_with_reviews(final, responses).orderBy("uid")))
    paths["manifest"] = f"{base}/manifest.json"
    write_manifest(clean.sparkSession, base, paths["manifest"])
    return paths


def preview(df: DataFrame, key: str = "uid", n: int = 5) -> DataFrame:
    """The first ``n`` rows by key, for a look at a stage."""
    return df.orderBy(key).limit(n)
