"""Near-duplicate texts: MinHash bands and the groups they form.

Two rows are near-duplicate candidates when their texts share a band bucket.
The answer has one form, whatever the sizes, and grows with the rows; with
``lists`` each row also names all its candidates, as many as there are:

* exact copies are one text, named by its least key (``text_id``), so a text
  occurring a billion times is hashed once;
* a bucket of several texts is a group, named by its band and its least text,
  as ``3:17`` (a text has one bucket in each band, so the name is unique);
* every row carries its text and its text's groups, one per band at most. Rows
  of the same text, or with a group in common, are candidates of each other,
  and there are no others.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from claimloom.functions.minhash import band_digests, lsh_bands
from claimloom.functions.text import text_digest
from claimloom.operators.similarity import verified_pairs
from claimloom.operators.skew import ROWS_PER_TASK, hot_keys, salted_left_join
from claimloom.session import ensure_checkpoint_dir
from claimloom.staging import stage


@dataclass(frozen=True)
class NearDuplicateSettings:
    threshold: float = 0.7
    ngram: int = 5
    seed: int = 3
    num_perm: int = 128
    rows_per_task: int = ROWS_PER_TASK


DEFAULTS = NearDuplicateSettings()


def distinct_texts(df: DataFrame, key: str, text: str) -> DataFrame:
    """(digest, text_id, copies, text): one row per text; text_id is its least key.

    Copies are combined before the shuffle; null counts as the empty text.
    """
    filled = F.coalesce(F.col(text), F.lit(""))
    return (
        df.select(text_digest(filled).alias("digest"), F.col(key).alias("_key"), filled.alias("text"))
        .groupBy("digest")
        .agg(F.min("_key").alias("text_id"), F.count("*").alias("copies"), F.any_value("text").alias("text"))
    )


def band_buckets(texts: DataFrame, settings: NearDuplicateSettings = DEFAULTS) -> DataFrame:
    """(digest, text_id, copies, buckets), checkpointed.

    The signatures cost far more than everything after them and are read
    several times; a tenth of the size of the texts, they are stored once.
    """
    ensure_checkpoint_dir(texts.sparkSession)
    bands, rows = lsh_bands(settings.threshold, settings.num_perm)
    digests = band_digests(
        F.col("text"), settings.ngram, settings.num_perm, settings.seed, bands, rows
    )
    return texts.select("digest", "text_id", "copies", digests.alias("buckets")).checkpoint()


def text_groups(banded: DataFrame, settings: NearDuplicateSettings = DEFAULTS) -> DataFrame:
    """(text_id, band, least): the groups of every text, ``least`` being the group's least text id."""
    members = banded.select("text_id", F.posexplode("buckets").alias("band", "bucket"))
    groups = members.groupBy("bucket").agg(F.count("*").alias("n_texts"), F.min("text_id").alias("least"))
    shared = salted_left_join(
        members,
        groups.where(F.col("n_texts") > 1).select("bucket", "least"),
        "bucket",
        row_id="text_id",
        how="inner",
        hot=hot_keys(groups, "bucket", rows_per_task=settings.rows_per_task, weight="n_texts"),
    )
    return shared.select("text_id", "band", "least")


def near_duplicate_pairs(
    df: DataFrame, key: str, text: str, settings: NearDuplicateSettings = DEFAULTS, verify: bool = False
) -> DataFrame:
    """(id_a, id_b, band) with id_a < id_b: every group as a star around its least text.

    Texts with the same (id_a, band), and id_a itself, are candidates of each
    other: at most one row per text and band tells them all.

    With ``verify``: (id_a, id_b, jaccard), every two candidates whose exact
    Jaccard similarity reaches the threshold. Each text is named by its least
    key, so copies of it are not repeated; ``key`` must be unique then.
    """
    groups = text_groups(band_buckets(distinct_texts(df, key, text), settings), settings)
    if verify:
        texts = df.select(F.col(key).alias("text_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        return verified_pairs(texts, groups, settings.threshold, settings.ngram, settings.rows_per_task)
    return groups.where(F.col("least") < F.col("text_id")).select(
        F.col("least").alias("id_a"), F.col("text_id").alias("id_b"), "band"
    )


def candidate_lists(rows: DataFrame, banded: DataFrame, settings: NearDuplicateSettings = DEFAULTS) -> DataFrame:
    """(digest, near_duplicates) for every text of ``rows(digest, _key)``: the sorted keys of all its candidates.

    The keys of the text's own rows are among them. Buckets with the same
    members, as near copies share them, are one list, sent to a text once. The lists hold
    every candidate, so they grow with the square of a bucket: they are
    joined in pieces of at most ``rows_per_task`` keys or one list.
    """
    own = stage(rows.groupBy("digest").agg(F.collect_list("_key").alias("keys")), "keys")
    members = banded.select("digest", F.explode("buckets").alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n_texts"))
    hot = hot_keys(sizes, "bucket", rows_per_task=settings.rows_per_task, weight="n_texts")
    several = sizes.where(F.col("n_texts") > 1)
    shared = stage(salted_left_join(members, several, "bucket", "digest", how="inner", hot=hot), "shared")
    every_key = F.array_sort(F.array_distinct(F.flatten(F.collect_list("keys")))).alias("keys")
    buckets = shared.join(own, "digest").groupBy("bucket").agg(F.first("n_texts").alias("n_texts"), every_key)
    named = stage(buckets.withColumn("list", F.sha2(F.to_json(F.struct("keys")), 256)), "bucket-lists")
    lists = named.groupBy("list").agg(
        F.any_value("keys").alias("keys"), F.sum(F.col("n_texts") * F.size("keys")).alias("n_keys")
    )
    of_text = salted_left_join(shared.drop("n_texts"), named.select("bucket", "list"), "bucket", "digest", hot=hot)
    found = salted_left_join(
        of_text.select("digest", "list").distinct(),
        lists.drop("n_keys"),
        "list",
        row_id="digest",
        how="inner",
        hot=hot_keys(lists, "list", rows_per_task=settings.rows_per_task, weight="n_keys"),
    )
    whole = found.select("digest", "keys").unionByName(own).groupBy("digest").agg(every_key)
    return whole.withColumnRenamed("keys", "near_duplicates")


def find_near_duplicates(
    df: DataFrame, key: str, text: str, settings: NearDuplicateSettings = DEFAULTS, lists: bool = False
) -> DataFrame:
    """(key, text_id, near_duplicate_groups), one row per row of ``df``.

    ``text_id`` is the least key of the rows with the same text, and
    ``near_duplicate_groups`` the sorted names of the text's groups; empty
    where no other text is like it.

    With ``lists``, ``near_duplicates`` too: the sorted keys, each once, of all
    rows that are candidates of the row, its own and its copies' included.
    """
    banded = band_buckets(distinct_texts(df, key, text), settings)
    name = F.concat_ws(":", "band", "least")
    named = (
        text_groups(banded, settings)
        .groupBy("text_id")
        .agg(F.array_sort(F.collect_list(name)).alias("near_duplicate_groups"))
    )
    found = banded.select("digest", "text_id").join(named, "text_id", "left")
    digest = text_digest(F.coalesce(F.col(text), F.lit("")))
    rows = df.select(F.col(key).alias("_key"), digest.alias("digest"))
    weights, listed = banded, []
    if lists:
        every = stage(candidate_lists(rows, banded, settings), "candidate-lists")
        found = found.join(every, "digest", "left")
        sizes = every.select("digest", F.greatest(F.size("near_duplicates"), F.lit(1)).alias("n"))
        weights = banded.join(sizes, "digest").select("digest", (F.col("copies") * F.col("n")).alias("copies"))
        listed = ["near_duplicates"]
    answers = salted_left_join(
        rows,
        found,
        "digest",
        row_id="_key",
        hot=hot_keys(weights, "digest", rows_per_task=settings.rows_per_task, weight="copies"),
    )
    none = F.array().cast("array<string>")
    groups = F.coalesce("near_duplicate_groups", none).alias("near_duplicate_groups")
    return answers.select(F.col("_key").alias(key), "text_id", groups, *listed)


def with_near_duplicates(
    df: DataFrame, key: str, text: str, settings: NearDuplicateSettings = DEFAULTS
) -> DataFrame:
    """``df`` with the two columns added."""
    return df.join(find_near_duplicates(df, key, text, settings), key, "left")
