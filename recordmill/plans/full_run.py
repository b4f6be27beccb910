"""A whole run as one driver program: pages to landing, tables, scores, gate, ledger."""

from __future__ import annotations

import json
import warnings
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill import schemas
from recordmill.operators import boosting, checks, data_tests, facts, latest, ledger
from recordmill.plans import markets, repos
from recordmill.session import cut_lineage
from recordmill.sources import catalog, landing, ndjson, tables
from recordmill.sources.pages import PagedRuns, SourceConfig
from recordmill.sources.parts import NO_VALUE, Snapshot
from recordmill.streaming.landing import land_new_files


@dataclass(frozen=True)
class Warehouse:
    """Where the run keeps its files and tables."""

    base: str

    @property
    def raw(self) -> str:
        return f"{self.base}/raw"

    @property
    def landing(self) -> str:
        return f"{self.base}/landing"

    @property
    def landed(self) -> str:
        return f"{self.base}/landing_checkpoint"

    @property
    def latest(self) -> str:
        return f"{self.base}/intermediate/latest_repos"

    @property
    def dimension(self) -> str:
        return f"{self.base}/marts/dim_repos"

    @property
    def fact(self) -> str:
        return f"{self.base}/marts/fct_daily_repo_metrics"

    @property
    def predictions(self) -> str:
        return f"{self.base}/marts/ml_predictions"

    @property
    def ledger(self) -> str:
        return f"{self.base}/run_states"


@dataclass(frozen=True)
class Scoring:
    """A trained model and the columns it is given."""

    trained: boosting.Trained
    row_key: str


def default_checks(as_of: datetime) -> list[dict[str, Any]]:
    """The checks of the gate. Names, tables, limits and severities."""
    week_ago = (as_of - timedelta(days=7)).isoformat(sep=" ")
    recent = f"SELECT count(*) FROM marts.ml_predictions WHERE predicted_at >= TIMESTAMP '{week_ago}'"
    return [
        {"name": "landing_has_data", "type": "row_count_min", "table": "raw.landing", "min_rows": 1, "severity": "error"},
        {"name": "landing_is_fresh", "type": "freshness", "table": "raw.landing", "timestamp_column": "ingested_at",
         "max_age_hours": 24, "severity": "error"},
        {"name": "landing_source_not_null", "type": "null_rate", "table": "raw.landing", "column": "source",
         "max_null_rate": 0.0, "severity": "error"},
        {"name": "dim_repos_populated", "type": "row_count_min", "table": "marts.dim_repos", "min_rows": 1,
         "severity": "warn"},
        {"name": "fct_metrics_unique_pk", "type": "uniqueness", "table": "marts.fct_daily_repo_metrics",
         "columns": ["repo_id", "metric_date"], "severity": "error"},
        {"name": "predictions_recent", "type": "custom_sql", "sql": recent, "comparison": "gte",
         "expected_value": 0, "severity": "warn"},
    ]


# ``data`` is checked when it is written; testing it again would read every record whole.
LANDING_RULES = ["load_id", "source", "ingested_at"]


def _not_built(spark: SparkSession, landed: DataFrame, house: Warehouse) -> DataFrame:
    """Landed rows of the attempts that no build has taken in; their folders' names are enough to tell."""
    built = tables.current(spark, _built(house))
    return landed if built is None else landed.join(built, "attempt", "left_anti")


def _built(house: Warehouse) -> str:
    return f"{house.latest.rstrip('/')}-attempts"


def build_tables(spark: SparkSession, house: Warehouse) -> None:
    """Rules on the landed rows, then latest rows, dimension and fact.

    A broken rule stops the build. Attempts that an earlier build took in are neither checked
    again nor read for the latest rows; one that is new counts whatever its day. Latest rows
    and dimension are rewritten only in buckets that have news.
    """
    landed = landing.read_landing(spark, house.landing)
    fresh = _not_built(spark, landed, house)
    taken = cut_lineage(landing.landed_files(spark, house.landing).select("attempt").distinct())
    data_tests.require(fresh, "landing", data_tests.rules(LANDING_RULES))
    data_tests.require(repos.staged(fresh), "staged repos", repos.staging_rules())
    data_tests.require(markets.staged(fresh), "staged markets", markets.staging_rules())
    touched = repos.keep_repos(spark, fresh, house.latest, house.dimension)
    tables.publish(taken, _built(house))
    if touched:  # a key lies in one bucket, so rules about the whole hold if they hold in each
        data_tests.require(latest.read_buckets(spark, house.dimension, touched), "dim_repos", repos.dimension_rules())
    recent = facts.since_high_water(landed, "ingest_date", facts.read_fact(spark, house.fact))
    facts.upsert_days(spark, repos.daily_repo_metrics(recent), house.fact, repos.FACT_KEY)
    data_tests.require(daily_facts(spark, house), "daily metrics", repos.fact_rules(dimension(spark, house)))


def dimension(spark: SparkSession, house: Warehouse) -> DataFrame:
    """The repositories as last built."""
    kept = latest.read_kept(spark, house.dimension)
    return schemas.empty(spark, repos.dim_repos(repos.latest_repos(landing.read_landing(spark, house.landing))).schema) if kept is None else kept


def daily_facts(spark: SparkSession, house: Warehouse) -> DataFrame:
    """The fact table, without rows before the first repository was landed."""
    fact = facts.read_fact(spark, house.fact)
    if fact is not None:
        return fact
    columns = repos.daily_repo_metrics(landing.read_landing(spark, house.landing)).schema
    return schemas.empty(spark, columns)


def _predictions(spark: SparkSession, house: Warehouse) -> DataFrame:
    if not tables.subfolders(spark, house.predictions):
        return schemas.empty(spark, schemas.PREDICTIONS)
    return spark.read.schema(schemas.PREDICTIONS).parquet(house.predictions)


def publish_names(spark: SparkSession, house: Warehouse) -> None:
    """Let the catalog's ``raw.landing``, ``marts.dim_repos``, ``marts.fct_daily_repo_metrics`` and ``marts.ml_predictions`` be this warehouse's tables.

    External tables whose partitions are the folders that commits show; only partitions that
    changed are named again.
    """
    schemas.create_namespaces(spark)
    rows = f"{house.landing}/rows"
    catalog.publish(spark, "raw.landing", schemas.LANDING, ["attempt", "source", "ingest_date"], rows, landing.visible_parts(spark, house.landing))
    for name, path, column, empty in (
        ("marts.dim_repos", house.dimension, latest.BUCKET, dimension),
        ("marts.fct_daily_repo_metrics", house.fact, facts.DAY, daily_facts),
    ):
        now = Snapshot(spark, path, column)
        schema = now.columns or empty(spark, house).withColumn(column, F.lit(None).cast("int" if column == latest.BUCKET else "date")).schema
        folders = {(None if p == NO_VALUE else p,): now.folder(p) for p in now.parts}
        catalog.publish(spark, name, schema, [column], f"{path}/rows", folders, folders)
    found = {(f.rpartition("load_id=")[2],): f for f in tables.subfolders(spark, house.predictions)}
    catalog.publish(spark, "marts.ml_predictions", schemas.PREDICTIONS, ["load_id"], house.predictions, found, found)


def table_state(spark: SparkSession, house: Warehouse, name: str) -> checks.TableState | None:
    """What commits tell of a table, None for one that keeps no states."""
    if name == "raw.landing":
        return landing.state(spark, house.landing)
    kept = {"marts.dim_repos": (house.dimension, latest.BUCKET), "marts.fct_daily_repo_metrics": (house.fact, facts.DAY)}
    return Snapshot(spark, *kept[name]).state() if name in kept else None


def run_gate(spark: SparkSession, house: Warehouse, specs: Sequence[dict], as_of: datetime) -> dict[str, Any]:
    """Run the checks and give the summary the ledger keeps whole.

    Names in checks and in their SQL are the catalog's. Counts, NULL shares, ages and repeated
    keys come from the states that writes left; no landed row is read for them.
    """
    publish_names(spark, house)
    results = checks.run_checks(spark, specs, as_of, state=lambda name: table_state(spark, house, name))
    row = checks.gate(checks.results_table(spark, results)).first()
    return {
        "passed": row.passed,
        "totalChecks": row.total_checks,
        "errorCount": row.error_count,
        "warnCount": row.warn_count,
        "failed": [r.name for r in results if not r.passed],
    }


def landing_freshness(spark: SparkSession, house: Warehouse, as_of: datetime) -> dict[str, Any]:
    """Age of the newest landed row of the table as a whole and what that means, from its commits."""
    newest = landing.state(spark, house.landing).newest["ingested_at"]
    rows = spark.createDataFrame([("landing", newest)], "source string, ingested_at timestamp_ntz")
    row = data_tests.source_freshness(rows, "source", "ingested_at", as_of).first()
    return {"status": row.status, "hoursSinceLast": row.hours_since_last}


def run(
    spark: SparkSession,
    house: Warehouse,
    run_id: str,
    pages: DataFrame,
    config: SourceConfig,
    started_at: datetime,
    as_of: datetime,
    specs: Sequence[dict] | None = None,
    scoring: Scoring | None = None,
) -> str:
    """One run of one source; returns its status. The ledger row is written either way.

    ``pages`` holds ``source, run_id, page_no, payload``.
    """
    state: dict[str, Any] = {"source_name": config.source_name, "ml_enabled": scoring is not None}
    status = "FAILURE"
    try:
        own = pages.where(F.col("source") == config.source_name)
        paged = PagedRuns(own, [config])
        written = ndjson.write_raw(paged.records().select("data"), house.base, config.source_name, as_of, run_id)
        cut = paged.cut().count()
        state["ingestResult"] = {"Payload": {**written, "truncatedRuns": cut}}
        if cut:
            warnings.warn(f"{config.source_name}: max_pages = {config.max_pages} ended {cut} runs before their last page", stacklevel=2)
        if written["s3Key"]:
            land_new_files(spark, house.raw, house.landing, house.landed, run_id, as_of)
        mine = (F.col("source") == config.source_name) & (F.col("load_id") == run_id)
        landed = written["recordCount"] and landing.summary_of(landing.landed_files(spark, house.landing).where(mine)).first()
        loaded = landed.rows_loaded if landed else 0
        state["loadResult"] = {
            "Payload": {
                "loadId": run_id,
                "source": config.source_name,
                "rowsLoaded": loaded,
                "filesLoaded": landed.files_loaded if landed else 0,
                "status": "LOADED" if loaded else "SKIPPED",
            }
        }
        build_tables(spark, house)
        state["dbtResult"] = {"status": "BUILT"}
        state["freshnessResult"] = landing_freshness(spark, house, as_of)
        if scoring is not None:
            inputs = dimension(spark, house)
            state["mlLoadResult"] = {
                "Payload": boosting.score_run(scoring.trained, inputs, scoring.row_key, house.predictions, run_id, as_of)
            }
        state["qualityResult"] = run_gate(spark, house, specs if specs is not None else default_checks(as_of), as_of)
        status = "SUCCESS" if state["qualityResult"]["passed"] else "FAILURE"
    except Exception as exc:
        state["errorInfo"] = {"Error": type(exc).__name__, "Cause": str(exc)}
    row = ledger.state_row(run_id, status, started_at, as_of, json.dumps(state, default=str))
    spark.createDataFrame([row], schemas.RUN_STATES).write.mode("append").parquet(house.ledger)
    return status


def read_ledger(spark: SparkSession, house: Warehouse) -> DataFrame:
    """One ledger row per recorded run."""
    states = spark.read.schema(schemas.RUN_STATES).parquet(house.ledger)
    return ledger.flatten_states(states)
