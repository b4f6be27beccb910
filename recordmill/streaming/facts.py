"""The daily fact table and the run metrics kept up to date from a stream."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.operators import facts, run_metrics
from recordmill.session import cut_lineage


def _run(stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint_dir: str, mode: str = "append") -> None:
    """Hand every micro-batch there is to ``apply``, then return."""
    query = (
        stream.writeStream.foreachBatch(apply)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def upsert_from_stream(
    staged_stream: DataFrame,
    landing: Callable[[SparkSession], DataFrame],
    path: str,
    checkpoint_dir: str,
    key: str,
    maxima: Sequence[str],
    day: str = "ingest_date",
) -> None:
    """Run the daily upsert for every micro-batch of newly staged rows, then return.

    A batch says which days have news; those not older than the newest loaded day are
    computed again from the staged rows (``landing``) of these days, so the upsert gives the
    same table however the rows were cut into batches, and a repeated batch changes nothing.
    ``day`` is the date that staged rows are partitioned by: folders of other days are not
    read. Rows without it are told apart by their time.
    """
    staged = staged_stream if day in staged_stream.columns else staged_stream.withColumn(day, F.to_date("ingested_at"))

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        news = [r[0] for r in batch.select(F.col(day)).distinct().collect()]  # one row a day
        if not news:
            return
        rows = landing(spark)
        rows = (rows if day in rows.columns else rows.withColumn(day, F.to_date("ingested_at"))).where(F.col(day).isin(news))
        bounded = facts.since_high_water(rows, day, facts.read_fact(spark, path))
        facts.upsert_days(spark, facts.daily_metrics(bounded, key, maxima), path, [key, "metric_date"])

    _run(staged, apply, checkpoint_dir)


def stream_metric(
    ledger_stream: DataFrame,
    metric: Callable[[DataFrame], DataFrame],
    table_dir: str,
    checkpoint_dir: str,
    at: str = "ended_at",
    late_by: str = "1 day",
    by: Sequence[str] = (),
) -> None:
    """Keep a run metric per window in a table, windows that are still open included, then return.

    The stream holds the totals of the windows that can still change and each micro-batch
    gives those that did; they replace the table's rows of the same window and ``by``, in the
    folders of their days only. A repeated batch replaces rows by themselves. Rows later than
    ``late_by`` behind the newest one are dropped.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        dated = batch.withColumn("metric_date", F.to_date("window_start"))
        facts.upsert_days(batch.sparkSession, dated, table_dir, ["window_start", *by])

    _run(metric(ledger_stream.withWatermark(at, late_by)), merge, checkpoint_dir, "update")


def read_metric(spark: SparkSession, table_dir: str) -> DataFrame:
    """What :func:`stream_metric` has kept."""
    return facts.read_fact(spark, table_dir).drop("metric_date")


def stream_durations(ledger_stream: DataFrame, table_dir: str, checkpoint_dir: str, at: str = "ended_at", width: str = run_metrics.DURATION_WINDOW) -> None:
    """Keep the mergeable state of each window's durations in a table, then return.

    A micro-batch is read once, summed up by itself and merged with the stored states of its windows, so
    no row is too late and nothing is held between batches. The table's commit carries the
    batch's number: a repeated batch is not added twice. The states are the same however
    the rows were cut into batches; :func:`read_durations` gives average and percentile.
    """
    writer = hashlib.sha256(checkpoint_dir.encode()).hexdigest()[:16]

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if facts.has_taken(spark, table_dir, writer, batch_id):
            return
        runs = cut_lineage(batch.select("run_id", "status", at, "duration_seconds"))  # each use of ``batch`` reads its files again
        news = cut_lineage(run_metrics.duration_states(runs, at, width).withColumn("metric_date", F.to_date("window_start")))
        days = [r[0] for r in news.select("metric_date").distinct().collect()]
        stored = facts.read_fact(spark, table_dir)
        if stored is not None:
            touched = stored.where(F.col("metric_date").isin(days)).join(news.select("window_start"), "window_start", "left_semi")
            news = run_metrics.merge_duration_states(touched.select(*news.columns).unionByName(news), ["window_start", "metric_date"])
        facts.upsert_days(spark, news, table_dir, ["window_start"], writer, batch_id)

    _run(ledger_stream, merge, checkpoint_dir)


def read_durations(spark: SparkSession, table_dir: str) -> DataFrame:
    """Per window the 95th percentile and the mean, from the stored states."""
    return run_metrics.durations_of(facts.read_fact(spark, table_dir))
