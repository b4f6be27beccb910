"""Bulk folders: which files are new or changed, and reading only those."""

from __future__ import annotations

from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession

FILE_KEYS = ["path", "length", "modificationTime"]


def list_files(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    """Path, size and change time of every file; the content column is never read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(folder).select(*FILE_KEYS)


def changed_files(listing: DataFrame, seen: DataFrame) -> DataFrame:
    """Files that are not in the manifest, or stand there with another size or time."""
    return listing.join(seen.select(*FILE_KEYS), FILE_KEYS, "left_anti")


def paths_of(listing: DataFrame) -> list[str]:
    """File names for the next read; the scan's own file index holds the same list."""
    return [row.path for row in listing.select("path").orderBy("path").toLocalIterator()]


def split_uri(uri: str) -> tuple[str, str]:
    """Bucket and key prefix of an object-store address."""
    parts = urlparse(uri)
    return parts.netloc, parts.path.lstrip("/")
