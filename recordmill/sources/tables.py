"""Full-refresh tables kept as versions, and small table reads."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession


ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def escaped(spark: SparkSession, value: str) -> str:
    """A partition value as its folder is named."""
    return spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


def unescaped(spark: SparkSession, name: str) -> str:
    """The partition value a folder's name stands for."""
    return spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(name)


def file_system(spark: SparkSession, path: str):
    """The store a path lies in, and the path as the store takes it."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = file_system(spark, path)
    return fs.exists(hadoop_path)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    fs, hadoop_path = file_system(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(s.getPath().toString() for s in fs.listStatus(hadoop_path) if s.isDirectory())


def publish(df: DataFrame, table_dir: str) -> str:
    """Write a new version of a table next to the old ones and return its folder.

    The version being read is never touched, so a failed or repeated write cannot lose it.
    """
    version = f"v{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    target = f"{table_dir.rstrip('/')}/{version}"
    df.write.parquet(target)
    return target


def current(spark: SparkSession, table_dir: str) -> DataFrame | None:
    """The newest complete version, None when there is none."""
    for folder in reversed(subfolders(spark, table_dir)):
        if path_exists(spark, f"{folder}/_SUCCESS"):
            return spark.read.parquet(folder)
    return None


def prune(spark: SparkSession, table_dir: str, keep: int = 2) -> int:
    """Delete all but the newest complete versions, and broken ones older than these; returns how many went."""
    folders = subfolders(spark, table_dir)
    complete = [f for f in folders if path_exists(spark, f"{f}/_SUCCESS")]
    oldest_kept = complete[-keep:][:1]
    old = [f for f in folders if oldest_kept and f < oldest_kept[0]]
    for folder in old:
        fs, path = file_system(spark, folder)
        fs.delete(path, True)
    return len(old)


def scalar(df: DataFrame):
    """First column of the first row, None when there is no row."""
    row = df.first()
    return row[0] if row else None


def append_columns(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Stack frames by column name; a column one of them lacks is NULL there."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
