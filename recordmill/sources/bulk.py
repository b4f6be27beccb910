"""Bulk CSV files landed like any other record, each new or changed file once."""

from __future__ import annotations

import hashlib
import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordmill.sources import csv, files, landing, tables

SEEN = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modificationTime", T.TimestampType()),
    ]
)


def csv_records(spark: SparkSession, paths: list[str], multi_line: bool = True) -> DataFrame:
    """Each CSV line as a record of text fields: ``file_path, data``; headers may differ."""
    frames = [
        spark.read.options(**csv.reading(multi_line)).csv(group).select(
            F.col("_metadata.file_path").alias("file_path"),
            F.to_variant_object(F.struct("*")).alias("data"),
        )
        for group in csv.by_header(spark, paths).values()
    ]
    return tables.append_columns(*frames)


def land_changed(
    spark: SparkSession, folder: str, seen_dir: str, landing_dir: str, source: str, load_id: str, ingested_at: datetime
) -> dict:
    """Land the files that are new or changed since the last call, and remember them.

    The files are remembered under the attempt that lands them, so one commit makes both
    count: a call that fails before it leaves neither. A call repeated for the same files
    under the same load id replaces what the first one left behind; other files under
    that id are added.
    """
    listing = files.list_files(spark, folder, "*.csv")
    if tables.path_exists(spark, seen_dir):
        told = spark.read.schema(T.StructType([*SEEN.fields, T.StructField("attempt", T.StringType())])).parquet(seen_dir)
        landed = landing.commit_log(spark, landing_dir).current().where(F.col("owner") == source).select("attempt").distinct()
        listing = files.changed_files(listing, told.join(landed, "attempt", "left_semi"))
    # One row of metadata per new file, fixed here: a file arriving later waits for the next call.
    found = sorted(listing.collect())
    if not found:
        return {"status": "SKIPPED", "reason": "no new files", "source": source, "rowsLoaded": 0, "filesLoaded": 0}
    records = csv_records(spark, [row.path for row in found])
    attempt = landing.stage_batch(landing.to_landing(records, source, load_id, ingested_at), landing_dir)
    spark.createDataFrame(found, SEEN).write.parquet(f"{seen_dir}/attempt={attempt}")
    which = hashlib.sha256(json.dumps([list(map(str, row)) for row in found]).encode()).hexdigest()[:16]
    done = landing.commit_batch(spark, landing_dir, attempt, f"{load_id}-{which}", source)
    rows = done.get(source, 0)
    return {
        "status": "LOADED" if rows else "SKIPPED",
        "source": source,
        "loadId": load_id,
        "rowsLoaded": rows,
        "filesLoaded": len(found) if rows else 0,
    }
