"""Mapping differently shaped raw tables onto one canonical schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from claimloom.functions.dates import iso_date
from claimloom.functions.labels import mapping_label
from claimloom.functions.unicode_tables import WHITESPACE_CLASS
from claimloom.functions.urls import first_url
from claimloom.sources.scan import POSITION

# Raw column names by meaning; the first that exists is taken.
ID_COLUMNS = ("uid", "id", "ID", "post_id", "doc_id", "tweet_id")
TEXT_COLUMNS = (
    "text", "text_no_url", "content", "full_text", "title_text", "claim", "body",
    "article_text", "message", "noticia", "texto",
)
LABEL_COLUMNS = (
    "label", "verdict", "target", "misinformation", "classificacao", "Rótulo", "rotulo", "veredito",
)
URL_CLAIM_COLUMNS = ("url", "link", "permalink", "source", "source_url", "url_claim")
URL_REVIEW_COLUMNS = ("review_url", "url_review", "factcheck_url", "url_factcheck")
DATE_COLUMNS = ("date", "data", "created_at", "publish_date", "time", "timestamp")
TITLE_COLUMNS = ("title", "headline", "titulo")
BODY_COLUMNS = ("body", "content", "texto")
# Column order of the merged table; other columns follow.
MERGED_ORDER = (
    "dataset_name", "source_type", "source_description", "label", "date_iso", "tweet_id",
    "url_claim", "text",
)
# Column order of the clean table; other columns follow.
CLEAN_ORDER = (
    "dataset_name", "source_type", "source_description", "label", "date_iso", "tweet_id",
    "url_claim", "url_review", "text", "text_clean",
)


def first_existing(df: DataFrame, names: Sequence[str]) -> str | None:
    """The first of ``names`` that is a column of ``df``, spelled exactly so."""
    return next((name for name in names if name in df.columns), None)


def pick_first(df: DataFrame, names: Sequence[str], default: Column | None = None) -> Column:
    """That column, or ``default`` (null) when none exists. Values are not mixed."""
    name = first_existing(df, names)
    if name is not None:
        return F.col(f"`{name}`")
    return F.lit(None).cast("string") if default is None else default


def _text_column(df: DataFrame, probe: bool) -> Column | None:
    """The text column; title and body in its place if it is missing or all null."""
    name = first_existing(df, TEXT_COLUMNS)
    text = None if name is None else F.col(f"`{name}`").cast("string")
    # Stops at the first row that has a text, so it rarely reads more than one file.
    if text is not None and not (probe and df.where(text.isNotNull()).isEmpty()):
        return text
    title = first_existing(df, TITLE_COLUMNS)
    body = first_existing(df, BODY_COLUMNS)
    if title and body:
        filled = [F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")) for name in (title, body)]
        joined = F.concat(filled[0], F.lit(". "), filled[1])
        return F.regexp_replace(joined, rf"^\.[{WHITESPACE_CLASS}]*", "")
    if title or body:
        return F.col(f"`{title or body}`").cast("string")
    return None


def ensure_schema(
    df: DataFrame,
    dataset_name: str,
    source_type: str = "news",
    source_description: str | None = None,
    probe: bool = True,
) -> DataFrame:
    """One canonical row per raw row; a table without any text column gives none.

    ``probe=False`` skips the check for an all-null text column (streams).
    """
    text = _text_column(df, probe)
    missing = F.lit(None).cast("string")
    date = first_existing(df, DATE_COLUMNS)
    label = first_existing(df, LABEL_COLUMNS)
    claim = pick_first(
        df, URL_CLAIM_COLUMNS, first_url(F.col("text").cast("string")) if "text" in df.columns else None
    )
    columns = {
        "orig_id": pick_first(df, ID_COLUMNS).cast("string"),
        "text": missing if text is None else text,
        "label": mapping_label(F.col(f"`{label}`")) if label else missing,
        "url_claim": claim.cast("string"),
        "url_review": pick_first(df, URL_REVIEW_COLUMNS).cast("string"),
        "date_iso": iso_date(F.col(f"`{date}`"), df.schema[date].dataType) if date else missing,
        "dataset_name": F.lit(dataset_name),
        "source_type": F.lit(source_type),
        "source_description": F.lit(source_description or f"Dataset {dataset_name}"),
    }
    kept = [F.col(POSITION)] if POSITION in df.columns else []
    out = df.select(*[c.alias(name) for name, c in columns.items()], *kept)
    return out.where(F.lit(False)) if text is None else out


def reorder(df: DataFrame, first: Sequence[str]) -> DataFrame:
    """Columns of ``first`` that exist, then all others where they stood."""
    leading = [name for name in first if name in df.columns]
    return df.select(*leading, *[name for name in df.columns if name not in leading])


def unify_urls(df: DataFrame) -> DataFrame:
    """Fill the review URL from the claim URL; drop the claim URL and the uid."""
    if "url_claim" in df.columns:
        review = F.col("url_review") if "url_review" in df.columns else F.lit(None)
        df = df.withColumn("url_review", F.coalesce(review, F.col("url_claim"))).drop("url_claim")
    return df.drop("uid")

