"""Preparation of labelled text corpora on Spark."""

from claimloom.functions.dates import iso_date
from claimloom.operators.enrich import enrich_with_reviews
from claimloom.operators.mapping import ensure_schema, unify_urls
from claimloom.operators.near_duplicates import (
    NearDuplicateSettings,
    find_near_duplicates,
    near_duplicate_pairs,
    with_near_duplicates,
)
from claimloom.operators.numbering import assign_uids, with_row_ids
from claimloom.plans.corpus import clean_corpus, flag_corpus, merge_corpora, preview, run, run_to
from claimloom.sources.scan import Corpus, read_corpora, read_responses

__all__ = [
    "Corpus", "NearDuplicateSettings", "assign_uids", "clean_corpus", "enrich_with_reviews",
    "ensure_schema", "find_near_duplicates", "flag_corpus", "iso_date", "merge_corpora", "near_duplicate_pairs", "preview",
    "read_corpora", "read_responses", "run", "run_to", "unify_urls", "with_near_duplicates", "with_row_ids",
]
