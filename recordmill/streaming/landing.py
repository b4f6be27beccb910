"""Landing new raw files exactly once."""

from __future__ import annotations

import hashlib
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.sources import landing, ndjson, tables


def raw_file_stream(spark: SparkSession, raw_dir: str, files_per_trigger: int = 1_000) -> DataFrame:
    """Parsed records of every raw file as a stream: ``file_path, file_time, line, data``."""
    lines = (
        spark.readStream.option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_trigger)
        .text(raw_dir)
    )
    return ndjson.parse_lines(lines)


def land_new_files(
    spark: SparkSession,
    raw_dir: str,
    landing_dir: str,
    checkpoint_dir: str,
    load_id: str,
    ingested_at: datetime | None = None,
    source: Column | None = None,
    files_per_trigger: int = 1_000,
) -> None:
    """Add the records of files not landed before, then return.

    The checkpoint remembers the files of each batch before it is written and a batch is
    committed under its own name, so one that failed half-way is replaced by its next try,
    under whatever load id that runs. No batch looks at what others landed. A bad line fails
    the batch as a whole. Rows of one source and one time stay in the tasks that read them.
    """
    records = raw_file_stream(spark, raw_dir, files_per_trigger)
    wanted = source if source is not None else ndjson.source_of(F.col("file_path"))
    at = F.lit(ingested_at).cast("timestamp") if ingested_at else F.current_timestamp()
    rows = landing.to_landing(records, wanted, load_id, at)
    several = ingested_at is None or len(tables.subfolders(spark, raw_dir)) != 1
    stream = hashlib.sha256(checkpoint_dir.encode()).hexdigest()[:16]

    def land(batch: DataFrame, batch_id: int) -> None:
        landing.write_batch(batch, landing_dir, f"{batch_id:09d}", f"stream {stream}", several)

    query = (
        rows.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
