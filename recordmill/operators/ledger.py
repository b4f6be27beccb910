"""The run ledger: nested run states to rows, metrics and report texts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.functions import texts
from recordmill.functions.variants import count_at, resolve, text_at, truthy

# Metric name, unit, dimension, and the ledger column behind it.
METRICS = [
    ("PipelineExecutions", "Count", "Status", None),
    ("PipelineDuration", "Seconds", "Status", "duration_seconds"),
    ("RowsIngested", "Count", "Source", "rows_ingested"),
    ("RowsLoaded", "Count", "Source", "rows_loaded"),
    ("MLRowsLoaded", "Count", "Source", "ml_rows_loaded"),
    ("QualityCheckErrors", "Count", "Status", "quality_errors"),
    ("QualityCheckWarns", "Count", "Status", "quality_warns"),
]


def run_status(gate_passed: Column, error_info: Column) -> Column:
    """``SUCCESS`` only for a run without a stage error whose gate passed."""
    return F.when(error_info.isNull() & F.coalesce(gate_passed, F.lit(False)), "SUCCESS").otherwise("FAILURE")


def stats(state: Column) -> list[Column]:
    """The figures of a run, read from its VARIANT state with defaults; ``truncated`` counts paged runs that a cap ended."""
    return [
        texts.first_set(text_at(state, "source_name"), text_at(state, "ingestResult.Payload.source")).alias("source"),
        count_at(state, "ingestResult.Payload.recordCount").alias("rows_ingested"),
        count_at(state, "loadResult.Payload.rowsLoaded").alias("rows_loaded"),
        F.coalesce(text_at(state, "loadResult.Payload.status"), F.lit("n/a")).alias("load_status"),
        truthy(resolve(state, "ml_enabled")).alias("ml_enabled"),
        count_at(state, "mlLoadResult.Payload.rowsLoaded").alias("ml_rows_loaded"),
        text_at(state, "qualityResult.passed").try_cast("boolean").alias("quality_passed"),
        count_at(state, "qualityResult.totalChecks").alias("quality_total"),
        count_at(state, "qualityResult.errorCount").alias("quality_errors"),
        count_at(state, "qualityResult.warnCount").alias("quality_warns"),
        text_at(state, "errorInfo").alias("error_info"),
        count_at(state, "ingestResult.Payload.truncatedRuns").alias("truncated"),
        F.coalesce(text_at(state, "freshnessResult.status"), F.lit("n/a")).alias("freshness"),
    ]


def flatten_states(states: DataFrame) -> DataFrame:
    """Rows ``run_id, status, started_at, ended_at, state`` to one ledger row per run."""
    parsed = states.withColumn("state", F.parse_json("state"))
    return parsed.select(
        "run_id",
        "status",
        "started_at",
        "ended_at",
        texts.seconds_since(F.col("started_at"), F.col("ended_at")).alias("duration_seconds"),
        *stats(F.col("state")),
    )


def metrics_long(ledger: DataFrame) -> DataFrame:
    """One row per run and metric: ``run_id, at, metric, unit, dimension, dimension_value, metric_value``."""

    def point(metric: str, unit: str, dimension: str, column: str | None) -> Column:
        value = F.lit(1.0) if column is None else F.col(column).cast("double")
        if unit == "Seconds":
            value = F.bround(value, 3)
        return F.struct(
            F.lit(metric).alias("metric"),
            F.lit(unit).alias("unit"),
            F.lit(dimension).alias("dimension"),
            F.col(dimension.lower()).alias("dimension_value"),
            value.alias("metric_value"),
        )

    points = F.array(*[point(*m) for m in METRICS])
    return ledger.select("run_id", F.col("ended_at").alias("at"), F.inline(points))


def subject(status: Column, run_id: Column, source: Column) -> Column:
    """The report's subject line, at most 100 characters. Layout and lengths."""
    short = texts.prefix(texts.first_set(run_id, default="?"), 8)
    named = texts.prefix(F.coalesce(source, F.lit("?")), 30)
    return texts.prefix(F.concat(F.lit("[Pipeline "), status, F.lit("] "), named, F.lit(" ("), short, F.lit(")")), 100)


def message(name: str = "recordmill") -> Column:
    """The report's text over the columns of the ledger; NULL lines are left out."""
    c = F.col
    # The labels and their spacing.
    gate = F.concat(
        F.lit("  Quality gate:    "), F.when(c("quality_passed"), "PASSED").otherwise("FAILED"), F.lit("  ("),
        c("quality_total").cast("string"), F.lit(" checks, "), c("quality_errors").cast("string"),
        F.lit(" errors, "), c("quality_warns").cast("string"), F.lit(" warnings)"),
    )
    failed = (c("status") == "FAILURE") & (F.coalesce(c("error_info"), F.lit("")) != "")
    lines = [
        F.lit(f"Pipeline:  {name}"),
        F.concat(F.lit("Execution: "), c("run_id")),
        F.concat(F.lit("Status:    "), c("status")),
        F.concat(F.lit("Duration:  "), texts.duration_text(c("duration_seconds"))),
        F.concat(F.lit("Start:     "), texts.first_set(c("started_at"))),
        F.lit(""),
        F.lit("--- Pipeline Stats ---"),
        F.concat(F.lit("  Source:          "), c("source")),
        F.concat(F.lit("  Rows ingested:   "), texts.thousands(c("rows_ingested"))),
        F.concat(
            F.lit("  Rows loaded:     "), texts.thousands(c("rows_loaded")), F.lit("  ("), c("load_status"), F.lit(")")
        ),
        F.concat(
            F.lit("  ML predictions:  "),
            F.when(c("ml_enabled"), texts.thousands(c("ml_rows_loaded"))).otherwise("(disabled)"),
        ),
        F.when(c("quality_passed").isNotNull(), gate),
        F.when(failed, F.concat(F.lit("\n--- Error ---\n"), texts.prefix(c("error_info"), 1000))),
    ]
    return F.concat_ws("\n", *lines)


def report(ledger: DataFrame, name: str = "recordmill") -> DataFrame:
    """Subject and text of each run's report."""
    return ledger.select(
        "run_id", subject(F.col("status"), F.col("run_id"), F.col("source")).alias("subject"), message(name).alias("message")
    )


def state_row(run_id: str, status: str, started_at: datetime, ended_at: datetime, state: str) -> tuple:
    """A row of :data:`recordmill.schemas.RUN_STATES`."""
    return (run_id, status, started_at.isoformat(), ended_at, state)
