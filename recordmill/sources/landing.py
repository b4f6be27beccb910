"""The landing table: one row per record, published write by write.

A write puts its rows into a folder of its own try (``attempt``), then the list of its raw files
with their row counts, and then one commit makes both visible. A write has a name (``batch``) and
an owner, by default the source of the rows: the newest commit under an owner's name replaces the
one before, whatever its day, and nobody else's. A try that ended before its commit is never seen.

    rows/attempt=../source=../ingest_date=../   the records
    files/attempt=../                           one row per raw file
    commits/                                    what of these is visible
"""

from __future__ import annotations

import uuid
from collections import Counter
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordmill import schemas
from recordmill.functions.variants import text_at, truthy
from recordmill.operators.checks import TableState
from recordmill.sources import tables
from recordmill.sources.commits import Log

FEW_COMMITS = 10_000  # (attempt, source) lines written into a plan; more of them are joined
BROADCAST_COMMITS = 1_000_000  # of a hundred bytes; beyond that Spark chooses the join


def to_landing(records: DataFrame, source: Column | str, load_id: str, ingested_at: datetime | Column) -> DataFrame:
    """Wrap parsed records (``file_path, data``) in the landing envelope."""
    at = ingested_at if isinstance(ingested_at, Column) else F.lit(ingested_at).cast("timestamp")
    return records.select(
        F.lit(load_id).alias("load_id"),
        (F.lit(source) if isinstance(source, str) else source).alias("source"),
        "file_path",
        at.alias("ingested_at"),
        "data",
    ).withColumn("ingest_date", F.to_date("ingested_at"))


def commit_log(spark: SparkSession, path: str) -> Log:
    return Log(spark, f"{path}/commits", schemas.LANDING_COMMITS, ["owner", "batch"])


def stage_batch(landing: DataFrame, path: str, gather: bool = True) -> str:
    """Write rows and their file list under a new attempt, seen by nobody yet; returns its name.

    A source or day holding most of the rows is split over several files, small ones are
    put together. Without ``gather`` each task writes its own rows, so no record is moved: for
    rows of one source and day. A NULL in a column that must be set fails the write. The file
    list is made from the narrow columns of what was written.
    """
    spark, attempt = landing.sparkSession, uuid.uuid4().hex
    named = landing.select(*[_required(f) for f in schemas.LANDING if f.name != "attempt"])
    target = f"{path}/rows/attempt={attempt}"
    named = named.hint("rebalance", "source", "ingest_date") if gather else named
    named.write.partitionBy("source", "ingest_date").parquet(target)
    rows = spark.read.schema(T.StructType([f for f in schemas.LANDING if f.name != "attempt"])).parquet(target)
    per_file(rows).write.parquet(f"{path}/files/attempt={attempt}")
    return attempt


def commit_batch(spark: SparkSession, path: str, attempt: str, batch: str, owner: str | None = None) -> dict[str, int]:
    """Make an attempt the visible one of its name; returns its row count by source.

    Without ``owner`` each source owns its rows, so two sources may use one name. An owner
    replaces all that it wrote under the name, also sources the new attempt does not have.
    """
    mine = spark.read.schema(schemas.LANDED_FILES).parquet(f"{path}/files").where(F.col("attempt") == attempt)
    found = mine.groupBy("source").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("files"), F.date_format(F.max("last"), tables.ISO).alias("newest")).collect()
    lines = [{"owner": owner or r.source, "batch": batch, "attempt": attempt, "source": r.source, "sources": len(found), "rows": r.rows, "files": r.files, "newest": r.newest} for r in found]
    if owner:
        lines.append({"owner": owner, "batch": batch, "attempt": attempt, "source": None, "sources": 0, "rows": 0, "files": 0, "newest": None})
    if lines:
        commit_log(spark, path).publish(lines)
    return {r.source: r.rows for r in found}


def write_batch(landing: DataFrame, path: str, batch: str, owner: str | None = None, gather: bool = True) -> dict[str, int]:
    """Add rows under the name of their write; the same owner and name again replace them."""
    return commit_batch(landing.sparkSession, path, stage_batch(landing, path, gather), batch, owner)


def _required(field: T.StructField) -> Column:
    complaint = F.raise_error(F.lit(f"NULL in landing column {field.name}")).cast(field.dataType)
    return F.coalesce(F.col(field.name), complaint).alias(field.name)


def _visible(spark: SparkSession, path: str, folder: str, schema: T.StructType) -> DataFrame:
    """Rows of a folder that commits list, by attempt and source.

    Both name folders, so a filter made of the lines prunes the others while planning and
    fields of a record are still read by the scan. Very many lines are joined instead.
    """
    if not tables.path_exists(spark, f"{path}/{folder}"):
        return schemas.empty(spark, schema)
    rows = spark.read.schema(schema).parquet(f"{path}/{folder}")
    seen = commit_log(spark, path).current().where("source IS NOT NULL").select("attempt", "source", "sources")
    lines = seen.limit(FEW_COMMITS + 1).collect()
    if len(lines) > FEW_COMMITS:
        pairs = seen.select("attempt", "source")
        pairs = F.broadcast(pairs) if pairs.count() <= BROADCAST_COMMITS else pairs
        return rows.join(pairs, ["attempt", "source"], "left_semi").select(*schema.names)
    left = Counter(r.attempt for r in lines)
    wanted = F.col("attempt").isin(sorted({r.attempt for r in lines if left[r.attempt] == r.sources}))
    for r in lines:
        if left[r.attempt] < r.sources:  # other sources of the attempt were replaced
            wanted |= (F.col("attempt") == r.attempt) & (F.col("source") == r.source)
    return rows.where(wanted)


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """The landing table under a fixed schema, as the commits up to now show it."""
    return _visible(spark, path, "rows", schemas.LANDING)


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per raw file of the visible writes: what :func:`per_file` gives, without reading a record."""
    return _visible(spark, path, "files", schemas.LANDED_FILES)


def state(spark: SparkSession, path: str) -> TableState:
    """Rows, newest ``ingested_at`` and NULLs of the landing table, from its commits. A write cannot set NULLs."""
    told = commit_log(spark, path).current().agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n"), F.max("newest").alias("newest")).first()
    newest = datetime.fromisoformat(told.newest) if told.newest else None
    return TableState(told.n, {f.name: 0 for f in schemas.LANDING}, {"ingested_at": newest})


def visible_parts(spark: SparkSession, path: str) -> dict[tuple, str]:
    """The folder of each visible (attempt, source, ingest_date)."""
    rows = landed_files(spark, path).select("attempt", "source", F.col("load_date").cast("string")).distinct().collect()
    return {tuple(r): f"{path}/rows/attempt={r[0]}/source={tables.escaped(spark, r[1])}/ingest_date={r[2]}" for r in rows}


def drop_unseen(spark: SparkSession, path: str) -> int:
    """Delete attempts that no commit shows: replaced ones and those of writers that died. Call it when none is at work."""
    seen = {r.attempt for r in commit_log(spark, path).current().select("attempt").distinct().collect()}
    old = [f for kind in ("rows", "files") for f in tables.subfolders(spark, f"{path}/{kind}") if f.rpartition("attempt=")[2] not in seen]
    for folder in old:
        store, found = tables.file_system(spark, folder)
        store.delete(found, True)
    return len(old)


def from_source(landing: DataFrame, source: str) -> DataFrame:
    """The envelope and record of one source; on the partitioned table only its folders are read."""
    return landing.where(F.col("source") == source).select("load_id", "file_path", "ingested_at", "data")


def per_file(landing: DataFrame) -> DataFrame:
    """Landed rows counted by source, day, load and file: ``source, load_date, load_id, file_path, n, last``."""
    return landing.groupBy("source", F.to_date("ingested_at").alias("load_date"), "load_id", "file_path").agg(
        F.count(F.lit(1)).alias("n"), F.max("ingested_at").alias("last")
    )


def load_summary(landing: DataFrame) -> DataFrame:
    """Per load and source ``rows_loaded, files_loaded``, from landed rows.

    Rows are counted per file first, so counting the files needs no second pass over rows.
    """
    return summary_of(per_file(landing))


def summary_of(counted: DataFrame) -> DataFrame:
    """:func:`load_summary` from rows of :func:`per_file` or :func:`landed_files`."""
    once = counted.groupBy("load_id", "source", "file_path").agg(F.sum("n").alias("n"))
    return once.groupBy("load_id", "source").agg(F.sum("n").alias("rows_loaded"), F.count(F.lit(1)).alias("files_loaded"))


def load_target(state: Column) -> tuple[Column, Column]:
    """``source`` and file key a load should use, read from a run's VARIANT state.

    A stage result that is there decides alone; without one the top level is used.
    """
    payload = F.try_variant_get(state, "$['ingestResult']['Payload']", "variant")
    nested = truthy(payload)
    source = F.when(nested, text_at(payload, "source")).otherwise(text_at(state, "source"))
    key = F.when(nested, text_at(payload, "s3Key")).otherwise(text_at(state, "s3Key"))
    return F.coalesce(source, F.lit("unknown")), key


def load_report(targets: DataFrame, landing: DataFrame) -> DataFrame:
    """Outcome of each wanted load: rows ``load_id, source, s3_key`` in, status out."""
    return report_of(targets, per_file(landing))


def report_of(targets: DataFrame, counted: DataFrame) -> DataFrame:
    """:func:`load_report` from rows of :func:`per_file` or :func:`landed_files`."""
    done = summary_of(counted)
    rows = F.coalesce("rows_loaded", F.lit(0))
    reason = F.when(F.col("s3_key").isNull(), "no s3Key in ingest result").when(rows == 0, "file contained zero records")
    return targets.join(done, ["load_id", "source"], "left").select(
        "load_id",
        "source",
        "s3_key",
        rows.cast("bigint").alias("rows_loaded"),
        F.coalesce("files_loaded", F.lit(0)).cast("bigint").alias("files_loaded"),
        F.when(reason.isNotNull(), "SKIPPED").otherwise("LOADED").alias("status"),
        reason.alias("reason"),
    )


def landing_audit(landing: DataFrame) -> DataFrame:
    """Per source and day: rows, distinct loads and files, last load; newest day first.

    The first aggregate leaves one row per file and load, and only those are expanded for
    the two distinct counts.
    """
    return audit_of(per_file(landing))


def audit_of(counted: DataFrame) -> DataFrame:
    """:func:`landing_audit` from rows of :func:`per_file` or :func:`landed_files`."""
    return (
        counted.groupBy("source", "load_date")
        .agg(
            F.sum("n").alias("rows_loaded"),
            F.count_distinct("load_id").alias("load_count"),
            F.count_distinct("file_path").alias("file_count"),
            F.max("last").alias("last_load_at"),
        )
        .orderBy(F.desc("load_date"), "source")
    )
