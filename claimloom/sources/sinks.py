"""Writing results: tables, manifest, dataset statistics."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Columns that are text in every written table.
TEXT_COLUMNS = (
    "label", "text", "text_clean", "url_claim", "url_review", "dataset_name", "source_type",
    "source_description", "date_iso", "factcheck_rating", "factcheck_claimant", "dataset_url",
    "tweet_id",
)


HASHED_WHOLE = 1 << 28  # bytes of a file that its task holds at once; larger ones are streamed
PIECE_BYTES = 1 << 23
# Stores that Spark and Arrow call by different names.
STORES = {"s3a": "s3", "s3n": "s3"}


def as_text_columns(df: DataFrame) -> DataFrame:
    """Cast the text-like columns to string, whatever their source typed them as."""
    present = [name for name in TEXT_COLUMNS if name in df.columns]
    return df.withColumns({name: F.col(name).cast("string") for name in present})


def sized_files(df: DataFrame, partition_by: str | None) -> DataFrame:
    """Rows dealt by ``partition_by`` into pieces of about the session's advisory size.

    A large value takes several tasks, many small ones share one: the files of a
    partitioned table follow its bytes, not the tasks that happened to make its rows.
    """
    return df.hint("rebalance", partition_by) if partition_by in df.columns else df


def write_parquet(df: DataFrame, path: str, partition_by: str | None = None, sized: bool = True) -> None:
    """Parquet, partitioned if asked for; ``sized=False`` if the rows are dealt by ``sized_files`` already."""
    writer = as_text_columns(sized_files(df, partition_by) if sized else df).write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by in df.columns else writer).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV directory with a header; list columns become JSON text."""
    nested = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.StructType))]
    flat = df.withColumns({name: F.to_json(name) for name in nested}) if nested else df
    flat.write.mode("overwrite").csv(path, header=True, quote='"', escape='"')


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Name, sha256 and size of every file below ``folder``, by name.

    Names are paths relative to ``folder``. Markers and checksums (names that
    begin with ``_`` or ``.``) and the manifest itself are left out. A file is
    hashed by one task: beyond ``HASHED_WHOLE`` bytes it is read as a stream, so
    no file is too large. The digest is the same either way.
    """
    place = re.sub(r"^[a-zA-Z][\w+.-]*:(//[^/]*)?", "", folder.rstrip("/"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    name = F.regexp_extract("path", rf"^(?:[a-zA-Z][\w+.-]*:(?://[^/]*(?=/))?)?.*?\Q{place}\E/(.*)$", 1)
    listed = files.withColumn("name", name).where(~F.col("name").rlike(r"^manifest\.json(/|$)"))
    small = listed.where(F.col("length") <= HASHED_WHOLE).select(
        "name", F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes")
    )
    large = listed.where(F.col("length") > HASHED_WHOLE).select("name", "path", F.col("length").alias("bytes"))
    streamed = large.mapInArrow(_digests, "name string, sha256 string, bytes bigint")
    return small.union(streamed).orderBy("name")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(name, sha256, bytes) of files at ``path``, each read piece by piece."""
    for batch in batches:
        for name, path, size in zip(*(column.to_pylist() for column in batch.columns)):
            digest, read = hashlib.sha256(), 0
            with _input_stream(path) as stream:
                while piece := stream.read(PIECE_BYTES):
                    digest.update(piece)
                    read += len(piece)
            if read != size:
                raise OSError(f"{path}: {read} bytes read of {size}")
            yield pa.RecordBatch.from_pydict({"name": [name], "sha256": [digest.hexdigest()], "bytes": pa.array([size], pa.int64())})


def _input_stream(path: str) -> pa.NativeFile:
    """The file of a path as Spark names it, local or in any store that Arrow reads (hdfs, s3, gs, abfs)."""
    local = re.sub(r"^file:(//)?(?=/)", "", path)
    if local.startswith("/"):
        return fs.LocalFileSystem().open_input_stream(local)
    scheme, _, place = path.partition("://")
    store, name = fs.FileSystem.from_uri(f"{STORES.get(scheme, scheme)}://{quote(place)}")
    return store.open_input_stream(name)


def write_manifest(spark: SparkSession, folder: str, target: str) -> None:
    manifest(spark, folder).write.mode("overwrite").json(target)


def write_counts(counts: DataFrame, target: str) -> None:
    """A small table of counts as one JSON file."""
    counts.coalesce(1).write.mode("overwrite").json(target)
