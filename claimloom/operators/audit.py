"""Counts that describe what each stage did."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from claimloom.functions.labels import cleaning_label, is_kept_label
from claimloom.functions.urls import plausible_url
from claimloom.sources.scan import Corpus


def dataset_counts(df: DataFrame) -> DataFrame:
    """Rows per dataset, null included, largest first."""
    return df.groupBy("dataset_name").agg(F.count("*").alias("n_rows")).orderBy(F.desc("n_rows"), "dataset_name")


def label_counts(df: DataFrame, by_dataset: bool = False) -> DataFrame:
    """Rows per label (and dataset), null included, largest first."""
    group = ["dataset_name", "label"] if by_dataset else ["label"]
    return df.groupBy(*group).agg(F.count("*").alias("n_rows")).orderBy(F.desc("n_rows"), *group)


def dataset_stats(normalized: DataFrame) -> DataFrame:
    """Normalised rows and rows that have a text, per dataset and in total."""
    return normalized.rollup("dataset_name").agg(
        F.count("*").alias("normalized_rows"),
        F.count("text").alias("merged_rows"),
        (F.grouping("dataset_name") == 1).alias("is_total"),
    )


def url_audit(mapped: DataFrame, cleaned: DataFrame | None = None) -> DataFrame:
    """Claim URLs per dataset before and after the plausibility check.

    One pass over the mapped rows; ``cleaned`` compares them with a table
    whose URLs were checked elsewhere.
    """
    if cleaned is None:
        return mapped.groupBy("dataset_name").agg(
            F.count("url_claim").alias("urls_before"),
            F.count(plausible_url(F.col("url_claim"))).alias("urls_after"),
            (F.count("url_review") == 0).alias("no_review_url"),
        )
    none = F.lit(None).cast("string")
    before = mapped.select("dataset_name", F.col("url_claim").alias("before"), none.alias("after"), none.alias("review"))
    after = cleaned.select("dataset_name", none, F.col("url_claim"), F.col("url_review"))
    return before.union(after).groupBy("dataset_name").agg(
        F.count("before").alias("urls_before"),
        F.count("after").alias("urls_after"),
        (F.count("review") == 0).alias("no_review_url"),
    )


def _stage_counts() -> dict[str, Column]:
    """What is counted over the normalised rows, by stage."""
    has_text = F.col("text").isNotNull()
    kept = has_text & F.coalesce(is_kept_label(cleaning_label(F.col("label"))), F.lit(False))
    return {
        "normalized": F.count("*"),
        "null_text_removed": F.count_if(~has_text),
        "merged": F.count_if(has_text),
        "labelled": F.count_if(kept),
    }


def stage_audit(normalized: DataFrame, clean: DataFrame, n_files: int) -> DataFrame:
    """Counts along the job: (stage, n_rows). ``clean`` needs its rows only, no column of them."""
    counts = normalized.agg(
        F.lit(n_files).cast("long").alias("files_scanned"), *[c.alias(name) for name, c in _stage_counts().items()]
    )
    names = counts.columns
    stages = F.explode(
        F.array(*[F.struct(F.lit(n).alias("stage"), F.col(n).alias("n_rows")) for n in names])
    )
    return counts.select(stages.alias("s")).select("s.*").unionByName(
        clean.agg(F.count("*").alias("n_rows")).select(F.lit("clean").alias("stage"), "n_rows")
    )


class StageCounts:
    """The counts of ``stage_audit`` and ``dataset_stats``, taken while the tables are written.

    Rows are observed in the tasks that write them, behind the last shuffle: a
    task that is run again after a loss counts once.
    """

    def __init__(self, corpora: Sequence[Corpus]) -> None:
        self._names = list(dict.fromkeys(corpus.name for corpus in corpora))
        self._files = len(corpora)
        self._normalized, self._clean = Observation(), Observation()

    def normalized(self, df: DataFrame) -> DataFrame:
        by_name = {
            f"{kind}_{i}": F.count_if((F.col("dataset_name") == name) & counted)
            for i, name in enumerate(self._names)
            for kind, counted in (("rows", F.lit(True)), ("texts", F.col("text").isNotNull()))
        }
        return df.observe(self._normalized, *[c.alias(n) for n, c in (_stage_counts() | by_name).items()])

    def clean(self, df: DataFrame) -> DataFrame:
        return df.observe(self._clean, F.count("*").alias("clean"))

    def stage_audit(self, spark: SparkSession) -> DataFrame:
        """(stage, n_rows), once both tables are written."""
        seen = {"files_scanned": self._files} | self._normalized.get | self._clean.get
        stages = ["files_scanned", *_stage_counts(), "clean"]
        # a frame that is empty by its plan is observed by no task
        return spark.createDataFrame([(s, seen.get(s, 0)) for s in stages], "stage string, n_rows long")

    def dataset_stats(self, spark: SparkSession) -> DataFrame:
        """(dataset_name, normalized_rows, merged_rows, is_total), once the merged table is written."""
        seen = self._normalized.get
        rows = [(name, seen.get(f"rows_{i}", 0), seen.get(f"texts_{i}", 0), False) for i, name in enumerate(self._names)]
        total = (None, seen.get("normalized", 0), seen.get("merged", 0), True)
        return spark.createDataFrame(
            [*(row for row in rows if row[1]), total],
            "dataset_name string, normalized_rows long, merged_rows long, is_total boolean",
        )
