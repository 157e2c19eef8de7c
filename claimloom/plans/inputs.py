"""Raw corpora in four different shapes, built from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from claimloom.sources.scan import POSITION, Corpus, read_parquet, share_out

# Raw spellings, chosen by id; they cover every branch of both label maps.
LABEL_SPELLINGS = (
    " Falso", "falsa", "MENTIRA", "fake", "1", "misleading", "duvidoso", "Parcialmente Falso",
    "partly false", "partly_true", "mixed", "verdadeiro", "Verdadeira ", "real", "TRUE", "verdade",
    "0", "-1", "None", "nan", "false", "1.0", "", "satire",
)
ROLE_VERDICTS = {"user": "Verdadeiro", "assistant": " FALSO", "system": "misleading"}


# Tables of long texts and their keys: worth sharing out where the session asks for it.
_TEXT_KEYS = {"documents": ["doc_id"], "pages": ["page_id"], "conversations": ["conv_id", "turn"]}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One given table, with each row's place in its file."""
    return read_parquet(spark, f"{folder}/{name}.parquet")


def plain(spark: SparkSession, folder: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return share_out(df, *_TEXT_KEYS[name]) if name in _TEXT_KEYS else df


def pick(spellings: tuple[str, ...], key: Column) -> Column:
    """A spelling by key, so that each occurs for many rows."""
    index = (key % len(spellings)).cast("int")
    return F.element_at(F.array(*[F.lit(s) for s in spellings]), index + 1)


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, text, source, label): documents with their 0/1 label where they have one."""
    labels = plain(spark, folder, "labels").select("doc_id", F.col("toxic").alias("label"))
    documents = table(spark, folder, "documents").select("doc_id", "text", "source", "lang", POSITION)
    return documents.join(labels, "doc_id", "left")


def page_articles(spark: SparkSession, folder: str) -> DataFrame:
    """(ID, link, content, veredito): web pages under other column names."""
    return table(spark, folder, "pages").select(
        F.col("page_id").alias("ID"),
        F.col("url").alias("link"),
        F.col("html").alias("content"),
        pick(LABEL_SPELLINGS, F.col("page_id")).alias("veredito"),
        POSITION,
    )


def chat_messages(spark: SparkSession, folder: str) -> DataFrame:
    """(post_id, message, verdict): turns, system turns without a text."""
    verdict = F.lit(None)
    for role, spelling in ROLE_VERDICTS.items():
        verdict = F.when(F.col("role") == role, spelling).otherwise(verdict)
    return table(spark, folder, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("post_id"),
        F.when(F.col("role") != "system", F.col("text")).alias("message"),
        verdict.alias("verdict"),
        POSITION,
    )


def status_claims(spark: SparkSession, folder: str) -> DataFrame:
    """(id, claim, url, review_url, date): claims tied to status URLs."""
    item = F.col("item_id")
    return table(spark, folder, "benchmark").select(
        item.alias("id"),
        F.col("text").alias("claim"),
        F.concat(F.lit("https://twitter.com/u/status/"), item + 500).alias("url"),
        F.when(item % 2 == 0, F.concat(F.lit("https://check.example.org/"), item)).alias("review_url"),
        F.concat(F.lit("1"), item % 10, F.lit("/03/2021")).alias("date"),
        POSITION,
    )


def corpora(spark: SparkSession, folder: str) -> list[Corpus]:
    return [
        Corpus("documents", labelled_documents(spark, folder), "web", "Documents with labels"),
        Corpus("pages", page_articles(spark, folder)),
        Corpus("conversations", chat_messages(spark, folder), "chat"),
        Corpus("FakeTweetBr", status_claims(spark, folder), "tweets"),
    ]


def responses(spark: SparkSession, folder: str) -> DataFrame:
    """(query, response_json) for every benchmark text, in four forms by id.

    A full response, one without reviews, one without claims, and broken JSON.
    """
    item = F.col("item_id")
    claimant = F.concat(F.lit("agency "), item)
    review = F.struct(
        F.when(item % 3 == 0, "False").otherwise("Misleading").alias("textualRating"),
        F.concat(F.lit("https://check.example.org/"), item).alias("url"),
    )

    def claims(reviews: Column) -> Column:
        return F.to_json(
            F.struct(
                F.array(F.struct(claimant.alias("claimant"), reviews.alias("claimReview"))).alias("claims")
            )
        )

    kind = item % 4
    no_reviews = F.array().cast("array<struct<textualRating:string,url:string>>")
    response = (
        F.when(kind <= 1, claims(F.array(review)))
        .when(kind == 2, claims(no_reviews))
        .otherwise(F.when(item % 8 == 3, '{"claims":[]}').otherwise("not json"))
    )
    return plain(spark, folder, "benchmark").select(
        F.col("text").alias("query"), response.alias("response_json")
    )


def checked_texts(spark: SparkSession, folder: str) -> DataFrame:
    """(uid, text, url_claim, url_review): documents, benchmark texts twice, blank texts."""
    documents = plain(spark, folder, "documents").select(
        F.col("doc_id").alias("uid"),
        "text",
        F.concat(F.lit("http://site.example.com/"), "doc_id").alias("url_claim"),
        F.lit(None).cast("string").alias("url_review"),
    )
    offset = 1_000_000_000

    def claims(shift: int) -> DataFrame:
        item = F.col("item_id")
        return plain(spark, folder, "benchmark").select(
            (item + offset * shift).alias("uid"),
            "text",
            F.lit(None).cast("string").alias("url_claim"),
            F.concat(F.lit("https://check.example.org/"), item).alias("url_review"),
        )

    blanks = plain(spark, folder, "labels").select(
        (F.col("doc_id") + 3 * offset).alias("uid"),
        F.when(F.col("toxic") == 1, "  ").alias("text"),
        F.lit(None).cast("string").alias("url_claim"),
        F.lit(None).cast("string").alias("url_review"),
    )
    return documents.unionByName(claims(1)).unionByName(claims(2)).unionByName(blanks)
