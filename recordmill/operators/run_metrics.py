"""Tumbling-window sums, durations and alarms over the run ledger.

All but the exact percentile work on a streaming ledger too, after ``withWatermark``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from recordmill.functions.order_statistics import exact_percentile

# Window widths and alarm thresholds.
COUNT_WINDOW = "5 minutes"
DURATION_WINDOW = "15 minutes"
TOTAL_WINDOW = "24 hours"
MAX_P95_SECONDS = 3600.0
SAMPLE_SIZE = 4_096  # runs of a window that its sketch keeps


def window_start(at: str | Column, width: str) -> Column:
    return F.window(at, width)["start"]


def _sums(ledger: DataFrame, at: str, width: str, by: Sequence[str], total: Column, name: str) -> DataFrame:
    return (
        ledger.groupBy(F.window(at, width), *by)
        .agg(total.alias(name))
        .select(F.col("window.start").alias("window_start"), *by, name)
    )


def executions(ledger: DataFrame, at: str = "ended_at", width: str = COUNT_WINDOW) -> DataFrame:
    """Runs per window and status."""
    return _sums(ledger, at, width, ["status"], F.count(F.lit(1)), "executions")


def quality_errors(ledger: DataFrame, at: str = "ended_at", width: str = COUNT_WINDOW) -> DataFrame:
    """Check errors of failed runs per window."""
    failed = ledger.where(F.col("status") == "FAILURE")
    return _sums(failed, at, width, [], F.sum("quality_errors"), "quality_errors")


def rows_by_source(ledger: DataFrame, at: str = "ended_at", width: str = COUNT_WINDOW) -> DataFrame:
    """Rows ingested per window and source."""
    return _sums(ledger, at, width, ["source"], F.sum("rows_ingested"), "rows_ingested")


def totals(ledger: DataFrame, at: str = "ended_at") -> DataFrame:
    """Runs per day and status."""
    return executions(ledger, at, TOTAL_WINDOW)


def duration_average(ledger: DataFrame, at: str = "ended_at", width: str = DURATION_WINDOW) -> DataFrame:
    """Mean duration of successful runs per window."""
    done = ledger.where(F.col("status") == "SUCCESS")
    return _sums(done, at, width, [], F.avg("duration_seconds"), "avg_duration")


def duration_p95(ledger: DataFrame, at: str = "ended_at", width: str = DURATION_WINDOW) -> DataFrame:
    """Exact 95th percentile of the duration of successful runs per window."""
    done = ledger.where(F.col("status") == "SUCCESS").select(
        window_start(at, width).alias("window_start"), "duration_seconds"
    )
    return exact_percentile(done, ["window_start"], F.col("duration_seconds"), 0.95, "p95")


def duration_p95_approx(
    ledger: DataFrame, at: str = "ended_at", width: str = DURATION_WINDOW, accuracy: int = 10_000
) -> DataFrame:
    """The percentile as a mergeable sketch, for streams; its rank is off by at most ``1/accuracy``."""
    done = ledger.where(F.col("status") == "SUCCESS")
    p95 = F.percentile_approx("duration_seconds", 0.95, accuracy)
    return _sums(done, at, width, [], p95, "p95")


def duration_states(ledger: DataFrame, at: str = "ended_at", width: str = DURATION_WINDOW, size: int = SAMPLE_SIZE) -> DataFrame:
    """Per window a state that can be merged: ``window_start, n, total, sample``.

    ``sample`` holds the durations of the ``size`` runs with the smallest hash of their id.
    Which these are depends on the runs alone, so states merged in any order and cut are the
    same. Up to ``size`` runs the sample is all of them and the percentile exact; beyond, the
    rank of an estimate of quantile q is off by a standard error of sqrt(q * (1 - q) / size),
    0.0034 for the 95th percentile of 4,096. ``total`` is a sum of whole nanoseconds.
    """
    done = ledger.where((F.col("status") == "SUCCESS") & F.col("duration_seconds").isNotNull()).select(
        window_start(at, width).alias("window_start"),
        F.col("duration_seconds").alias("v"),
        F.xxhash64(F.col("run_id").cast("string")).alias("h"),
    )
    nanos = F.sum((F.col("v") * 1e9).cast("decimal(38,0)"))
    sums = done.groupBy("window_start").agg(F.count(F.lit(1)).alias("n"), nanos.alias("total"))
    return sums.join(_samples(done, ["window_start"], size), "window_start")


def _samples(entries: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """The ``size`` entries (h, v) of smallest hash per key; ranked in each task first, so no window is gathered whole."""
    ranked = entries.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy("h", "v")))
    return ranked.where(F.col("_rank") <= size).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("h", "v"))).alias("sample"))


def merge_duration_states(states: DataFrame, keys: Sequence[str], size: int = SAMPLE_SIZE) -> DataFrame:
    """States of the same keys as one."""
    sums = states.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total"))
    entries = states.select(*keys, F.explode("sample").alias("e")).select(*keys, "e.h", "e.v")
    return sums.join(_samples(entries, keys, size), list(keys))


def durations_of(states: DataFrame, q: float = 0.95) -> DataFrame:
    """Per window the interpolated percentile of the sample and the mean of all runs: ``window_start, p95, avg_duration``."""
    values = F.sort_array(F.transform("sample", lambda e: e["v"]))
    ranked = states.select("window_start", "n", "total", values.alias("v")).withColumn("at", F.lit(q) * (F.size("v") - 1))
    low, high = (F.element_at("v", (f("at") + 1).cast("int")) for f in (F.floor, F.ceil))
    p95 = low + (high - low) * (F.col("at") - F.floor("at"))
    return ranked.select("window_start", p95.alias("p95"), (F.col("total").cast("double") / 1e9 / F.col("n")).alias("avg_duration"))


def duration_stats(ledger: DataFrame, at: str = "ended_at", width: str = DURATION_WINDOW) -> DataFrame:
    """Per window the 95th percentile and the mean of successful runs."""
    return duration_p95(ledger, at, width).join(duration_average(ledger, at, width), "window_start")


def alarms(ledger: DataFrame, at: str = "ended_at", max_p95: float = MAX_P95_SECONDS) -> DataFrame:
    """Windows that breach: ``window_start, alarm``. A window without runs never does.

    Both alarms of failed runs come from one aggregate.
    """
    failed = ledger.where(F.col("status") == "FAILURE")
    counted = failed.groupBy(F.window(at, COUNT_WINDOW)).agg(F.sum("quality_errors").alias("errors"))
    names = F.when(F.col("errors") >= 1, F.array(F.lit("failure"), F.lit("quality"))).otherwise(F.array(F.lit("failure")))
    slow = duration_p95(ledger, at).where(F.col("p95") > max_p95)
    return counted.select(F.col("window.start").alias("window_start"), F.explode(names).alias("alarm")).unionByName(
        slow.select("window_start", F.lit("duration").alias("alarm"))
    )
