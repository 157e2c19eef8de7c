"""Named queries over the given tables: one or more per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from claimloom.functions.dates import iso_date
from claimloom.functions.labels import cleaning_label, is_kept_label, mapping_label
from claimloom.functions.text import (
    clean_text,
    normalize_accents,
    normalize_spaces,
    query_text,
    remove_emojis,
    remove_outer_quotes,
    text_digest,
    token_count,
)
from claimloom.functions.urls import drop_urls, find_urls, first_url, is_number_like, plausible_url, tweet_id
from claimloom.operators import audit
from claimloom.operators.duplicates import flag_duplicates, with_quality_flags
from claimloom.operators.enrich import enrich_with_reviews
from claimloom.operators.mapping import ensure_schema, unify_urls
from claimloom.operators.merge import (
    describe_datasets,
    drop_null_texts,
    mapped_corpora,
    union_corpora,
    unnumbered_corpora,
)
from claimloom.operators.near_duplicates import (
    NearDuplicateSettings,
    find_near_duplicates,
    near_duplicate_pairs,
)
from claimloom.operators.numbering import with_row_ids
from claimloom.plans import inputs
from claimloom.plans.corpus import clean_corpus, flag_corpus, merge_corpora, preview, run, surviving_texts
from claimloom.plans.inputs import plain, table
from claimloom.sources.scan import POSITION, dataset_name_column, share_out

Query = Callable[[SparkSession, str], DataFrame]
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
EMOJI_SAMPLE = "👨‍👩‍👧 🇧🇷 5️⃣ 5 # ❤️ ☀ © 🏽 ok"


# --- scalar functions -------------------------------------------------------


def clean_text_query(spark, folder):
    raw = F.concat(F.lit('  "'), "text", F.lit("'  "))
    return plain(spark, folder, "documents").select(
        "doc_id", clean_text(raw).alias("text_clean")
    ).withColumn("n_tokens", token_count(F.col("text_clean")).cast("long"))


def outer_quotes(spark, folder):
    part = plain(spark, folder, "part")
    quoted = F.concat(
        F.element_at(F.array(*[F.lit(q) for q in (' "', "'", "", '""')]), (F.col("p_size") % 4 + 1).cast("int")),
        F.col("p_name"),
        F.element_at(F.array(*[F.lit(q) for q in ('"', "' ", "'", "\n", "")]), (F.col("p_partkey") % 5 + 1).cast("int")),
    )
    return part.select("p_partkey", remove_outer_quotes(quoted).alias("unquoted"))


def accents(spark, folder):
    return plain(spark, folder, "documents").select("doc_id", normalize_accents(F.col("text")).alias("plain"))


def spaces(spark, folder):
    raw = F.concat(F.lit(" \n\t"), "text", F.lit(" \r\n  fim "))
    return plain(spark, folder, "documents").select("doc_id", normalize_spaces(raw).alias("spaced"))


def emojis(spark, folder):
    raw = F.concat("text", F.lit(EMOJI_SAMPLE), F.col("doc_id"))
    return plain(spark, folder, "documents").select("doc_id", remove_emojis(raw).alias("no_emoji"))


def _texts_with_urls(spark, folder) -> DataFrame:
    pages = plain(spark, folder, "pages").select(F.col("page_id").alias("doc_id"), "url")
    documents = plain(spark, folder, "documents").select("doc_id", "text").join(pages, "doc_id", "left")
    url = F.coalesce("url", F.lit("www.exemplo.com.br"))
    return documents.select(
        "doc_id",
        F.concat("text", F.lit(" "), url, F.lit(" custa 50.OOO veja exemplo.com/a, e "), url).alias("text"),
    )


def removed_urls(spark, folder):
    found = _texts_with_urls(spark, folder).withColumn("urls", find_urls(F.col("text")))
    return found.select(
        "doc_id",
        drop_urls(F.col("text"), F.col("urls")).alias("text_no_url"),
        F.array_join("urls", " ").alias("extracted_urls"),
        F.size("urls").cast("long").alias("n_urls"),
    )


def numbers_in_disguise(spark, folder):
    value = F.regexp_replace(F.col("o_totalprice").cast("decimal(18,2)").cast("string"), "0", "O")
    shown = F.when(F.col("o_orderstatus") == "F", F.concat(value, F.lit("x"))).otherwise(value)
    return plain(spark, folder, "orders").select("o_orderkey", is_number_like(shown).alias("number_like"))


def first_urls(spark, folder):
    bare = F.regexp_replace("url", "^https?://", "www.")
    text = F.concat(F.lit("custa 50.000 em "), F.when(F.col("page_id") % 2 == 0, F.col("url")).otherwise(bare), F.lit(" agora"))
    return plain(spark, folder, "pages").select("page_id", first_url(text).alias("url"))


def tweet_ids(spark, folder):
    event = F.col("event_id")
    url = (
        F.when(F.col("event_type") == "click", F.concat(F.lit("https://twitter.com/u"), "user_id", F.lit("/status/"), event))
        .when(F.col("event_type") == "view", F.concat(F.lit("https://x.com/u/status/"), event + 1_000_000_000_000))
        .otherwise(F.concat(F.lit("https://x.com/u/status/"), event % 1000))
    )
    return plain(spark, folder, "events").select("event_id", tweet_id(url).alias("tweet_id"))


def plausible_urls(spark, folder):
    documents = plain(spark, folder, "documents").select(
        "doc_id",
        F.explode(
            F.array(
                F.col("source"),
                F.concat(F.lit(" "), F.col("source"), F.lit(".com.br/a ")),
                F.col("n_chars").cast("string"),
                F.concat(F.col("n_chars"), F.lit(".5")),
                F.concat(F.lit("http://"), F.col("source"), F.lit("/a.b")),
                F.concat(F.lit("ftp://x."), F.col("source"), F.lit("?q=1")),
            )
        ).alias("raw"),
    )
    pages = plain(spark, folder, "pages").select(F.col("page_id").alias("doc_id"), F.col("url").alias("raw"))
    return documents.unionByName(pages).select("doc_id", "raw", plausible_url(F.col("raw")).alias("url_claim"))


def _raw_labels(spark, folder) -> DataFrame:
    """(doc_id, raw): both labels of a document as text, and a spelling of a label."""
    toxic, quality = F.col("toxic").cast("string"), F.concat(F.lit(" "), "quality")
    raw = F.array(toxic, quality, inputs.pick(inputs.LABEL_SPELLINGS, F.col("doc_id")))
    return plain(spark, folder, "labels").select("doc_id", F.explode(raw).alias("raw"))


def mapping_labels(spark, folder):
    return _raw_labels(spark, folder).withColumn("label", mapping_label(F.col("raw")))


def cleaning_labels(spark, folder):
    label = cleaning_label(F.col("raw"))
    kept = F.coalesce(is_kept_label(label), F.lit(False))
    return _raw_labels(spark, folder).withColumns({"label": label, "kept": kept})


def iso_dates(spark, folder):
    formats = (
        "yyyy-MM-dd", "dd/MM/yyyy", "yyyy/MM/dd", "d-M-yyyy", "yyyy-MM-dd HH:mm:ss",
        "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyyMMdd", "MMM d yyyy", "'sem data' yyyy",
    )
    day, kind = F.col("o_orderdate"), F.col("o_orderkey") % len(formats)
    text = F.lit(None)
    for i, pattern in enumerate(formats):
        text = F.when(kind == i, F.date_format(day, pattern)).otherwise(text)
    return plain(spark, folder, "orders").select("o_orderkey", iso_date(text).alias("date_iso"))


def free_form_dates(spark, folder):
    formats = (
        "EEE, dd MMM yyyy", "d-MMM-yyyy", "d'th of' MMMM yyyy HH:mm", "MMMM d, yyyy 'at' h:mm a", "yyyy MMM d",
        "MM.dd.yyyy", "EEEE d MMMM yyyy", "MMM yyyy", "yyyyMMdd'T'HHmmss", "EEE, dd MMM yyyy HH:mm:ss 'GMT'",
        "d 'de' MMMM",
    )
    day, kind = F.col("o_orderdate").cast("timestamp"), F.col("o_orderkey") % len(formats)
    text = F.lit(None)
    for i, pattern in enumerate(formats):
        text = F.when(kind == i, F.date_format(day, pattern)).otherwise(text)
    return plain(spark, folder, "orders").select("o_orderkey", iso_date(text).alias("date_iso"))


def query_texts(spark, folder):
    return plain(spark, folder, "documents").select("doc_id", query_text(F.col("text")).alias("query"))


def text_digests(spark, folder):
    return plain(spark, folder, "documents").select("doc_id", text_digest(F.col("text")).alias("sha256"))


# --- mapping, numbering, union ----------------------------------------------


def _mapped(frame: DataFrame, *args) -> DataFrame:
    return ensure_schema(frame.drop(POSITION), *args)


def mapped_documents(spark, folder):
    return _mapped(inputs.labelled_documents(spark, folder), "documents", "web", "Documents with labels")


def mapped_pages(spark, folder):
    return _mapped(inputs.page_articles(spark, folder), "pages")


def mapped_conversations(spark, folder):
    return _mapped(inputs.chat_messages(spark, folder), "conversations", "chat")


def mapped_claims(spark, folder):
    return _mapped(inputs.status_claims(spark, folder), "FakeTweetBr", "tweets")


def claim_url_from_text(spark, folder):
    """No URL column: the claim URL comes from the text."""
    return ensure_schema(_texts_with_urls(spark, folder), "texts").select("orig_id", "url_claim")


def text_fallback(spark, folder):
    """The text column exists but is null everywhere: title and body take its place."""
    part = plain(spark, folder, "part").select(
        F.col("p_partkey").alias("id"),
        F.lit(None).cast("string").alias("text"),
        F.when(F.col("p_size") > 10, F.col("p_name")).alias("title"),
        F.when(F.col("p_size") < 40, F.col("p_type")).alias("body"),
    )
    return ensure_schema(part, "parts").select("orig_id", "text")


def row_ids(spark, folder):
    return with_row_ids(table(spark, folder, "orders")).select("rid", "o_orderkey")


def normalized_corpora(spark, folder):
    return union_corpora(inputs.corpora(spark, folder))


def merged_corpora(spark, folder):
    return merge_corpora(inputs.corpora(spark, folder))


def described_datasets(spark, folder):
    """Nation per customer as dataset name; only some nations are described."""
    customers = plain(spark, folder, "customer").select(
        F.col("c_custkey").alias("uid"), F.concat(F.lit("nation "), "c_nationkey").alias("dataset_name")
    )
    dimension = plain(spark, folder, "nation").where(F.col("n_regionkey") < 3).select(
        F.concat(F.lit("nation "), "n_nationkey").alias("dataset_name"),
        F.concat(F.lit("region "), "n_regionkey").alias("source_type"),
        F.col("n_name").alias("source_description"),
    )
    return describe_datasets(customers, dimension)


def dataset_names(spark, folder):
    """Dataset name from the file each row was read from."""
    parts = [
        spark.read.parquet(f"{folder}/{name}.parquet").select(dataset_name_column().alias("dataset_name"))
        for name in TABLES
    ]
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    return together.groupBy("dataset_name").agg(F.count("*").alias("n_rows"))


# --- duplicates and cleaning ------------------------------------------------


def duplicates_by_language(spark, folder):
    documents = plain(spark, folder, "documents").select("doc_id", "lang", clean_text(F.col("text")).alias("text_clean"))
    return flag_duplicates(documents, "doc_id", "text_clean", "lang").select("doc_id", "lang", "is_duplicated")


def duplicates_overall(spark, folder):
    documents = plain(spark, folder, "documents").select("doc_id", clean_text(F.col("text")).alias("text_clean"))
    return flag_duplicates(documents, "doc_id", "text_clean", None).select("doc_id", "is_duplicated")


def quality_flags(spark, folder):
    texts = inputs.checked_texts(spark, folder).select("uid", clean_text(F.col("text")).alias("text_clean"))
    return with_quality_flags(texts, 5).select("uid", "is_null", "too_short")


def flagged_corpus(spark, folder):
    columns = ["uid", "label", "is_duplicated", "is_null", "too_short"]
    return flag_corpus(merged_corpora(spark, folder)).select(columns)


def _listed_as_text(df: DataFrame) -> DataFrame:
    return df.withColumn("extracted_urls", F.array_join("extracted_urls", " "))


def cleaned_corpus(spark, folder):
    return _listed_as_text(clean_corpus(merged_corpora(spark, folder)))


# --- audits -----------------------------------------------------------------


def dataset_counts(spark, folder):
    return audit.dataset_counts(drop_null_texts(unnumbered_corpora(inputs.corpora(spark, folder))))


def label_counts(spark, folder):
    return audit.label_counts(drop_null_texts(unnumbered_corpora(inputs.corpora(spark, folder))))


def label_counts_by_dataset(spark, folder):
    return audit.label_counts(unnumbered_corpora(inputs.corpora(spark, folder)), by_dataset=True)


def dataset_stats(spark, folder):
    return audit.dataset_stats(unnumbered_corpora(inputs.corpora(spark, folder)))


def url_audit(spark, folder):
    return audit.url_audit(mapped_corpora(inputs.corpora(spark, folder)))


def stage_audit(spark, folder):
    corpora = inputs.corpora(spark, folder)
    normalized = unnumbered_corpora(corpora)
    with_text = share_out(drop_null_texts(normalized), "dataset_name", "orig_id")
    return audit.stage_audit(normalized, surviving_texts(with_text), len(corpora))


def merged_preview(spark, folder):
    return preview(merged_corpora(spark, folder)).select("uid", "dataset_name", "label", "text")


# --- lookup -----------------------------------------------------------------


def enriched_texts(spark, folder):
    enriched = enrich_with_reviews(inputs.checked_texts(spark, folder), inputs.responses(spark, folder))
    return enriched.orderBy("uid")


def unified_urls(spark, folder):
    texts = inputs.checked_texts(spark, folder).withColumn("row_key", F.col("uid"))
    return unify_urls(texts)


# --- near-duplicates --------------------------------------------------------


def near_duplicate_pairs_query(spark, folder):
    return near_duplicate_pairs(plain(spark, folder, "documents"), "doc_id", "text")


def verified_pairs(spark, folder):
    return near_duplicate_pairs(plain(spark, folder, "documents"), "doc_id", "text", verify=True)


def near_duplicate_lists(spark, folder):
    documents = plain(spark, folder, "documents").select("doc_id", "text")
    found = find_near_duplicates(documents, "doc_id", "text", lists=True)
    return found.withColumns(
        {
            "near_duplicate_groups": F.array_join("near_duplicate_groups", " "),
            "near_duplicates": F.array_join(F.col("near_duplicates").cast("array<string>"), " "),
        }
    )


# --- whole job and files ----------------------------------------------------


def whole_run(spark, folder):
    result = run(
        inputs.corpora(spark, folder), inputs.responses(spark, folder), NearDuplicateSettings()
    )
    final = result.final.withColumn("near_duplicate_groups", F.array_join("near_duplicate_groups", " "))
    return _listed_as_text(final)


QUERIES: dict[str, Query] = {
    "clean_text": clean_text_query,
    "outer_quotes": outer_quotes,
    "accents": accents,
    "spaces": spaces,
    "strip_emoji": emojis,
    "remove_urls": removed_urls,
    "numbers_in_disguise": numbers_in_disguise,
    "extract_url": first_urls,
    "tweet_id": tweet_ids,
    "url_plausible": plausible_urls,
    "label_map_raw": mapping_labels,
    "label_map_clean": cleaning_labels,
    "date_iso": iso_dates,
    "date_free_form": free_form_dates,
    "query_text": query_texts,
    "text_digest": text_digests,
    "ensure_schema_docs": mapped_documents,
    "ensure_schema_pages": mapped_pages,
    "ensure_schema_conv": mapped_conversations,
    "ensure_schema_claims": mapped_claims,
    "claim_url_from_text": claim_url_from_text,
    "text_fallback": text_fallback,
    "row_ids": row_ids,
    "normalized_corpora": normalized_corpora,
    "merge_corpora": merged_corpora,
    "describe_datasets": described_datasets,
    "dataset_names": dataset_names,
    "duplicates_by_language": duplicates_by_language,
    "exact_duplicates": duplicates_overall,
    "quality_flags": quality_flags,
    "flag_corpus": flagged_corpus,
    "clean_corpus": cleaned_corpus,
    "dataset_counts": dataset_counts,
    "label_counts": label_counts,
    "label_counts_by_dataset": label_counts_by_dataset,
    "dataset_stats": dataset_stats,
    "url_audit": url_audit,
    "stage_audit": stage_audit,
    "preview": merged_preview,
    "review_enrich": enriched_texts,
    "unify_urls": unified_urls,
    "near_duplicates": near_duplicate_pairs_query,
    "near_dup_verified": verified_pairs,
    "near_dup_lists": near_duplicate_lists,
    "whole_run": whole_run,
}
