"""Intermediate tables: written once to the shared folder, read back as Parquet.

A staged table cuts the lineage like a checkpoint does, but later readers
take only the columns they name, and it lies where every executor sees it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from claimloom.session import ensure_checkpoint_dir

_STAGED: dict[str, list[str]] = {}
_TABLES: dict[str, list[str]] = {}


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and return the written table."""
    spark = df.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    _STAGED.setdefault(spark.sparkContext.applicationId, []).append(folder)
    return spark.read.schema(df.schema).parquet(folder)


def stage_buckets(df: DataFrame, name: str, key: str) -> DataFrame:
    """``stage``, with the rows bucketed by ``key``: a join on it leaves them where they are."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    folder = f"{ensure_checkpoint_dir(spark)}/{table}"
    writer = df.write.option("path", folder).option("compression", "zstd")
    writer.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).saveAsTable(table)
    _STAGED.setdefault(spark.sparkContext.applicationId, []).append(folder)
    _TABLES.setdefault(spark.sparkContext.applicationId, []).append(table)
    return spark.table(table)


def drop_staged(spark: SparkSession) -> int:
    """Delete this application's staged tables; call it when all results are written."""
    folders = _STAGED.pop(spark.sparkContext.applicationId, [])
    for table in _TABLES.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
    return len(folders)
