"""NDJSON files: scan, raw sink, fingerprints and the file manifest."""

from __future__ import annotations

import hashlib
import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from recordmill.functions.texts import content_hash
from recordmill.sources import tables

# The length of a fingerprint in a raw file's name and the layout of its path.
HASH_LENGTH = 16
RAW_PATH = r"raw/([^/]+)/(\d{4})/(\d{2})/(\d{2})/"


def parse_lines(lines: DataFrame, rescue: bool = False) -> DataFrame:
    """Parse text lines to ``file_path, file_time, line, data``, dropping blank ones.

    Any JSON value is a record. A bad line fails the job, or with ``rescue`` is kept
    with ``data`` NULL.
    """
    parse = F.try_parse_json if rescue else F.parse_json
    return (
        lines.select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_modification_time").alias("file_time"),
            F.col("value").alias("line"),
        )
        .where(F.col("line").rlike(r"\S"))
        .withColumn("data", parse("line"))
    )


def read_ndjson(spark: SparkSession, path: str | list[str], rescue: bool = False) -> DataFrame:
    """Every record below ``path`` with the file it came from."""
    return parse_lines(spark.read.option("recursiveFileLookup", "true").text(path), rescue)


def source_of(file_path: Column) -> Column:
    """The source named in a raw file's path, ``unknown`` elsewhere."""
    found = F.regexp_extract(file_path, RAW_PATH, 1)
    return F.when(found == "", "unknown").otherwise(found)


def date_of(file_path: Column) -> Column:
    """The UTC date in a raw file's path."""
    parts = [F.regexp_extract(file_path, RAW_PATH, i) for i in (2, 3, 4)]
    return F.concat_ws("-", *parts).try_cast("date")


def record_lines(records: DataFrame) -> DataFrame:
    """Each row as one JSON line; a column named ``data`` of VARIANT type is the record itself."""
    if records.columns == ["data"]:
        return records.select(F.to_json("data").alias("line"))
    return records.select(F.to_json(F.struct(*records.columns)).alias("line"))


def digest(line: Column) -> list[Column]:
    """Aggregates giving record count and a 16-digit fingerprint of a bag of lines.

    The fingerprint ignores the order of the lines, so it needs no single ordered pass.
    """
    count = F.count(F.lit(1))
    return [
        count.alias("record_count"),
        content_hash(F.concat_ws(":", count.cast("string"), _line_sum(line).cast("string"))).alias("content_hash"),
    ]


def _line_sum(line: Column) -> Column:
    return F.coalesce(F.sum(F.xxhash64(line).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))


def manifest(records: DataFrame) -> DataFrame:
    """One row per file: ``file_path, source, record_count, content_hash, ingested_at``."""
    return (
        records.groupBy("file_path")
        .agg(*digest(F.col("line")), F.max("file_time").alias("ingested_at"))
        .withColumn("source", source_of(F.col("file_path")))
        .select("file_path", "source", "record_count", "content_hash", "ingested_at")
    )


def raw_key(source: str, written_at: datetime, fingerprint: str, run_id: str | None = None) -> str:
    """``raw/<source>/YYYY/MM/DD/HHMMSS_<fingerprint>[_<run>].ndjson``."""
    suffix = f"_{run_id}" if run_id else ""
    return f"raw/{source}/{written_at:%Y/%m/%d}/{written_at:%H%M%S}_{fingerprint}{suffix}.ndjson"


def raw_key_column(source: Column, written_at: Column, fingerprint: Column, run_id: Column) -> Column:
    """:func:`raw_key` over columns."""
    return F.concat(
        F.lit("raw/"), source, F.lit("/"), F.date_format(written_at, "yyyy/MM/dd"), F.lit("/"),
        F.date_format(written_at, "HHmmss"), F.lit("_"), fingerprint,
        F.coalesce(F.concat(F.lit("_"), run_id), F.lit("")), F.lit(".ndjson"),
    )


def write_raw(records: DataFrame, base: str, source: str, written_at: datetime, run_id: str | None = None) -> dict:
    """Write records under their dated key and return the summary; no records, no file.

    The key is a folder holding one part per task, so a large drop is written in parallel.
    Count and fingerprint are observed while the lines are written to a folder that scans
    skip; it gets its name once they are known. A folder that is complete under the same
    key is left alone if its whole fingerprint and count are the same, else it is an error.
    """
    spark, root = records.sparkSession, base.rstrip("/")
    aside, seen = f"{root}/raw/_{uuid.uuid4().hex}", Observation()
    lines = record_lines(records)
    lines.observe(seen, F.count(F.lit(1)).alias("n"), _line_sum(F.col("line")).alias("total")).write.text(aside)
    store, written = tables.file_system(spark, aside)
    count, whole = seen.get["n"], hashlib.sha256(f"{seen.get['n']}:{seen.get['total']}".encode()).hexdigest()
    summary = {"source": source, "recordCount": count, "s3Key": None}
    if count == 0:
        store.delete(written, True)
        for folder in (written.getParent(), written.getParent().getParent()):  # made for this drop alone
            if len(store.listStatus(folder)) == 0:
                store.delete(folder, False)
        return summary
    key = raw_key(source, written_at, whole[:HASH_LENGTH], run_id)
    _, target = tables.file_system(spark, f"{root}/{key}")
    mark = f"{whole} {count}"
    if store.exists(target.suffix("/_SUCCESS")):
        store.delete(written, True)
        if _mark_of(spark, f"{root}/{key}") != mark:
            raise ValueError(f"{key} holds other records")
    else:
        _, told = tables.file_system(spark, f"{aside}/_fingerprint")
        out = store.create(told, True)
        out.write(bytearray(mark.encode()))
        out.close()
        store.mkdirs(target.getParent())
        store.delete(target, True)  # an incomplete one
        if not store.rename(written, target):
            raise OSError(f"cannot name {target}")
    return {**summary, "s3Key": key, "contentHash": whole[:HASH_LENGTH]}


def _mark_of(spark: SparkSession, folder: str) -> str | None:
    """Fingerprint and count a drop was written with."""
    store, path = tables.file_system(spark, f"{folder}/_fingerprint")
    if not store.exists(path):
        return None
    stream = store.open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_raw_by_source(rows: DataFrame, base: str) -> None:
    """Write rows ``source, ingested_at, line`` of many sources into dated folders.

    Folders are ``source=../y=../m=../d=..``. The rebalance hint cuts a source that holds
    most of the rows into several files and keeps small ones in one.
    """
    dated = rows.select(
        "line",
        "source",
        F.date_format("ingested_at", "yyyy").alias("y"),
        F.date_format("ingested_at", "MM").alias("m"),
        F.date_format("ingested_at", "dd").alias("d"),
    )
    parts = ["source", "y", "m", "d"]
    dated.hint("rebalance", *parts).write.mode("append").partitionBy(*parts).text(base)
