
from __future__ import annotations

import os
import sys
from collections.abc import Callable
from datetime import datetime

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.ml.functions import vector_to_array  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from recordmill import schemas  # noqa: E402
from recordmill.functions import texts  # noqa: E402
from recordmill.functions.order_statistics import medians, modes  # noqa: E402
from recordmill.operators import boosting, checks, data_tests, facts, features, latest, ledger, run_metrics  # noqa: E402
from recordmill.plans import derived, full_run, markets, models, repos  # noqa: E402
from recordmill.plans.derived import k_of, observations, table  # noqa: E402
from recordmill.session import configure, scratch_dir  # noqa: E402
from recordmill.sources import catalog, csv, files, landing, ndjson, tables  # noqa: E402
from recordmill.sources.pages import SourceConfig, cut_runs, flatten_pages, page_gaps  # noqa: E402
from recordmill.sources.parts import Snapshot  # noqa: E402
from recordmill.streaming.facts import read_durations, read_metric, stream_durations, stream_metric, upsert_from_stream  # noqa: E402
from recordmill.streaming.landing import land_new_files  # noqa: E402

AS_OF = datetime(2024, 2, 1, 12, 0, 0)
CUTOFF = "2024-01-16 12:00:00"

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

# The landing envelope over events, shared by many of the SQL twins.
OBS = """WITH obs AS (
SELECT strftime(ts,'%Y-%m-%d') AS load_id, event_type AS source,
 'raw/'||event_type||'/'||strftime(ts,'%Y/%m/%d')||'/000000.ndjson' AS file_path,
 ts AS ingested_at, props AS data, event_id, user_id, value FROM events) """
K = "CAST(json_extract_string(props,'$.k') AS INTEGER)"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL twin if there is one."""

    def add(run: Query) -> Query:
        def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(configure(spark), sf_dir)

        _QUERIES[run.__name__] = prepared
        if sql is not None:
            _SQL[run.__name__] = sql
        return prepared

    return add


# --- landing -----------------------------------------------------------------------------


@query(OBS + "SELECT load_id, file_path, ingested_at, data FROM obs WHERE source='purchase'")
def landing_by_source(spark, sf_dir):
    return landing.from_source(observations(spark, sf_dir), "purchase")


@query(
    OBS
    + """SELECT source, strftime(ingested_at,'%Y-%m-%d') AS load_date, count(*) AS rows_loaded,
 count(DISTINCT load_id) AS load_count, count(DISTINCT file_path) AS file_count,
 max(ingested_at) AS last_load_at FROM obs GROUP BY 1,2"""
)
def landing_audit(spark, sf_dir):
    audit = landing.landing_audit(observations(spark, sf_dir))
    return audit.withColumn("load_date", F.col("load_date").cast("string"))


@query(
    """SELECT event_id,
 CASE WHEN event_type IN ('view','error') THEN 'top-'||event_type WHEN event_type='signup' THEN 'unknown'
  ELSE event_type END AS source,
 CASE WHEN event_type NOT IN ('view','error') THEN props END AS s3_key FROM events"""
)
def load_target(spark, sf_dir):
    source, key = landing.load_target(F.col("state"))
    states = derived.load_states(spark, sf_dir).withColumn("state", F.parse_json("state"))
    return states.select("event_id", source.alias("source"), key.alias("s3_key"))


@query(
    OBS
    + """SELECT load_id, source, CASE WHEN source='view' THEN 0 WHEN source='error' THEN 0 ELSE count(*) END AS rows_loaded,
 CASE WHEN source IN ('view','error') THEN 0 ELSE count(DISTINCT file_path) END AS files_loaded,
 CASE WHEN source IN ('view','error') THEN 'SKIPPED' ELSE 'LOADED' END AS status,
 CASE WHEN source='view' THEN 'no s3Key in ingest result'
  WHEN source='error' THEN 'file contained zero records' ELSE 'none' END AS reason
 FROM obs GROUP BY load_id, source"""
)
def load_report(spark, sf_dir):
    rows = observations(spark, sf_dir)
    key = F.when(F.col("source") != "view", F.col("file_path"))
    targets = rows.groupBy("load_id", "source").agg(F.max(key).alias("s3_key"))
    loaded = rows.where(~F.col("source").isin("view", "error"))
    return landing.load_report(targets, loaded).drop("s3_key").fillna("none", ["reason"])


@query("SELECT event_id, substr(sha256(props),1,16) AS content_hash FROM events")
def fingerprint(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", texts.content_hash(F.col("props")).alias("content_hash"))


@query(
    """SELECT event_id, 'raw/'||event_type||'/'||strftime(ts,'%Y/%m/%d')||'/'||strftime(ts,'%H%M%S')||'_'||
 substr(sha256(props),1,16)||'_'||event_id||'.ndjson' AS raw_key FROM events"""
)
def raw_keys(spark, sf_dir):
    key = ndjson.raw_key_column(
        F.col("event_type"), F.col("ts"), texts.content_hash(F.col("props")), F.col("event_id").cast("string")
    )
    return table(spark, sf_dir, "events").select("event_id", key.alias("raw_key"))


def _event_lines(spark, sf_dir):
    """Events as JSON lines; each error is followed by a blank line."""
    events = table(spark, sf_dir, "events")
    line = F.to_json(F.struct("event_id", "user_id", "event_type", "value", "props"))
    lines = F.when(F.col("event_type") == "error", F.array(line, F.lit("  "))).otherwise(F.array(line))
    return events.select(F.col("event_type").alias("source"), F.col("ts").alias("ingested_at"), F.explode(lines).alias("line"))


@query(
    """SELECT event_type AS source, count(*) AS rows_loaded, count(DISTINCT strftime(ts,'%Y-%m-%d')) AS files_loaded,
 sum(event_id)::BIGINT AS id_sum, round(sum(value),2) AS value_sum FROM events GROUP BY 1"""
)
def ndjson_roundtrip(spark, sf_dir):
    base = scratch_dir(spark, "raw")
    ndjson.write_raw_by_source(_event_lines(spark, sf_dir), base)
    records = ndjson.read_ndjson(spark, base)
    folder = F.regexp_extract("file_path", r"^(.*)/[^/]*$", 1)
    return (
        records.withColumn("source", F.regexp_extract("file_path", "source=([^/]+)", 1))
        .groupBy("source", folder.alias("folder"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.variant_get("data", "$.event_id", "string").cast("bigint")).alias("ids"),
            F.sum(F.variant_get("data", "$.value", "decimal(38,2)")).alias("total"),
        )
        .groupBy("source")
        .agg(
            F.sum("n").alias("rows_loaded"),
            F.count(F.lit(1)).alias("files_loaded"),
            F.sum("ids").alias("id_sum"),
            F.round(F.sum("total").cast("double"), 2).alias("value_sum"),
        )
    )


@query("SELECT event_type AS source, count(*) AS record_count FROM events GROUP BY 1")
def file_manifest(spark, sf_dir):
    base = scratch_dir(spark, "manifest")
    ndjson.write_raw_by_source(_event_lines(spark, sf_dir), base)
    found = ndjson.manifest(ndjson.read_ndjson(spark, base))
    source = F.regexp_extract("file_path", "source=([^/]+)", 1)
    return found.groupBy(source.alias("source")).agg(F.sum("record_count").alias("record_count"))


def _drop(spark, sf_dir, base, condition):
    ndjson.write_raw_by_source(_event_lines(spark, sf_dir).where(condition), base)


def _event_records(spark, sf_dir):
    """Events in the landing envelope with the event itself as record."""
    data = F.parse_json(F.to_json(F.struct("event_id", "user_id", "value")))
    return observations(spark, sf_dir).withColumn("data", data).withColumn("ingest_date", F.to_date("ingested_at"))


def _landed(spark, path):
    """Landed rows with the id of their event."""
    rows = landing.read_landing(spark, path)
    return rows.select("load_id", "source", "file_path", "ingested_at", F.variant_get("data", "$.event_id", "bigint").alias("event_id"))


_LANDED_SQL = OBS + "SELECT load_id, source, file_path, ingested_at, event_id FROM obs"


@query(_LANDED_SQL)
def landing_two_sources(spark, sf_dir):
    """Each source lands under the same name, one after the other."""
    path, rows = scratch_dir(spark, "landing"), _event_records(spark, sf_dir)
    for source in ("view", "click", "signup", "purchase", "error"):
        landing.write_batch(rows.where(F.col("source") == source), path, "load-1")
    return _landed(spark, path)


@query(_LANDED_SQL)
def landing_retry(spark, sf_dir):
    """A try with other rows of another day, one that ends before its commit, then the whole; another writer's rows stay."""
    path, rows = scratch_dir(spark, "landing"), _event_records(spark, sf_dir)
    late = F.col("ingested_at") >= F.lit(CUTOFF)
    landing.write_batch(rows.where(late), path, "late", "writer b")
    landing.write_batch(rows.where(late), path, "first", "writer a")
    landing.stage_batch(rows, path)
    landing.write_batch(rows.where(~late), path, "first", "writer a")
    return _landed(spark, path)


@query(
    OBS
    + """SELECT source, strftime(ingested_at,'%Y-%m-%d') AS load_date, count(*) AS rows_loaded,
 count(DISTINCT load_id) AS load_count, count(DISTINCT file_path) AS file_count,
 max(ingested_at) AS last_load_at FROM obs GROUP BY 1,2"""
)
def landing_audit_of_files(spark, sf_dir):
    """The audit from the file lists of committed writes; no record is read."""
    path, rows = scratch_dir(spark, "landing"), _event_records(spark, sf_dir)
    for i, part in enumerate((F.col("ingested_at") < F.lit(CUTOFF), F.col("ingested_at") >= F.lit(CUTOFF))):
        landing.write_batch(rows.where(part), path, f"load-{i}")
    audit = landing.audit_of(landing.landed_files(spark, path))
    return audit.withColumn("load_date", F.col("load_date").cast("string"))


@query("SELECT event_type AS source, event_id, user_id, value FROM events")
def incremental_landing(spark, sf_dir):
    base = scratch_dir(spark, "landing")
    source = F.regexp_extract("file_path", "source=([^/]+)", 1)

    def land():
        land_new_files(spark, f"{base}/raw", f"{base}/landing", f"{base}/checkpoint", "load", AS_OF, source)

    _drop(spark, sf_dir, f"{base}/raw", F.col("ingested_at") < F.lit(CUTOFF))
    land()
    _drop(spark, sf_dir, f"{base}/raw", F.col("ingested_at") >= F.lit(CUTOFF))
    land()
    land()
    fields = [F.variant_get("data", f"$.{c}", kind).alias(c) for c, kind in (("event_id", "bigint"), ("user_id", "bigint"), ("value", "double"))]
    return landing.read_landing(spark, f"{base}/landing").select("source", *fields)


@query(f"SELECT event_type AS source, event_id, value FROM events WHERE ts >= TIMESTAMP '{CUTOFF}'")
def bulk_changed_files(spark, sf_dir):
    base = scratch_dir(spark, "bulk")
    _drop(spark, sf_dir, base, F.col("ingested_at") < F.lit(CUTOFF))
    seen = scratch_dir(spark, "seen")
    files.list_files(spark, base).write.parquet(seen)
    _drop(spark, sf_dir, base, F.col("ingested_at") >= F.lit(CUTOFF))
    fresh = files.changed_files(files.list_files(spark, base), spark.read.parquet(seen))
    records = ndjson.read_ndjson(spark, files.paths_of(fresh))
    source = F.regexp_extract("file_path", "source=([^/]+)", 1)
    event_id, value = (F.variant_get("data", f"$.{c}", kind).alias(c) for c, kind in (("event_id", "bigint"), ("value", "double")))
    return records.select(source.alias("source"), event_id, value)


# --- pages -------------------------------------------------------------------------------

_PAGES_SQL = """WITH pages AS (SELECT user_id, event_id, event_type, {k} AS k,
 row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS page_rank FROM events),
 stops AS (SELECT user_id, min(page_rank) AS stop FROM pages WHERE {stop} GROUP BY 1)
 SELECT CAST(p.user_id AS VARCHAR) AS run_id, p.event_id AS page_no, (u.item-1)::INTEGER AS position,
 p.event_id AS page, u.item::INTEGER AS item
 FROM pages p LEFT JOIN stops s ON p.user_id=s.user_id, LATERAL (SELECT unnest(range(1, p.k+1)) AS item) u
 WHERE p.page_rank <= least(coalesce(s.stop, {cap}), {cap})"""


def _paged(spark, sf_dir, **settings):
    config = SourceConfig("events_api", "https://example.org", records_json_path="body.items", **settings)
    records = flatten_pages(derived.page_payloads(spark, sf_dir), [config])
    return records.select(
        "run_id",
        "page_no",
        "position",
        F.variant_get("data", "$.page", "bigint").alias("page"),
        F.variant_get("data", "$.item", "int").alias("item"),
    )


@query(_PAGES_SQL.format(k=K, stop="k < 10", cap=50))
def paged_records(spark, sf_dir):
    return _paged(spark, sf_dir, pagination_type="page", page_size=10)


@query(_PAGES_SQL.format(k=K, stop="k < 5", cap=8))
def paged_records_offset(spark, sf_dir):
    return _paged(spark, sf_dir, pagination_type="offset", page_size=5, max_pages=8)


@query(_PAGES_SQL.format(k=K, stop="k = 0 OR event_type='error'", cap=50))
def paged_records_cursor(spark, sf_dir):
    return _paged(spark, sf_dir, pagination_type="cursor")


@query(_PAGES_SQL.format(k=K, stop="true", cap=50))
def paged_records_single(spark, sf_dir):
    return _paged(spark, sf_dir)


@query(
    """SELECT CAST(user_id AS VARCHAR) AS run_id, max(event_id) AS expected, count(*) FILTER (event_id > 0) AS present,
 count(*) FILTER (event_id < 1) AS stray FROM events GROUP BY 1
 HAVING max(event_id) <> count(*) FILTER (event_id > 0) OR count(*) FILTER (event_id < 1) > 0"""
)
def paged_gaps(spark, sf_dir):
    """Runs whose pages are not numbered one after the other from 1."""
    return page_gaps(derived.page_payloads(spark, sf_dir)).drop("source")


@query(
    """WITH p AS (SELECT user_id, event_id // 7 * 5 + CASE WHEN event_type='error' THEN 1 ELSE 0 END AS pos FROM events),
 d AS (SELECT DISTINCT user_id, pos FROM p)
 SELECT CAST(user_id AS VARCHAR) AS run_id, coalesce(max(pos) FILTER (pos % 5 = 0) // 5 + 1, 0)::BIGINT AS expected,
 count(*) FILTER (pos % 5 = 0) AS present, count(*) FILTER (pos % 5 <> 0) AS stray FROM d GROUP BY 1
 HAVING coalesce(max(pos) FILTER (pos % 5 = 0) // 5 + 1, 0) <> count(*) FILTER (pos % 5 = 0) OR count(*) FILTER (pos % 5 <> 0) > 0"""
)
def paged_gaps_offset(spark, sf_dir):
    """Runs whose offsets are not 0, 5, 10 and so on."""
    config = SourceConfig("events_api", "https://example.org", pagination_type="offset", page_size=5)
    odd = F.get_json_object("payload", "$.next_cursor").isNull().cast("long")
    pages = derived.page_payloads(spark, sf_dir).withColumn("page_no", F.floor(F.col("page_no") / 7) * 5 + odd)
    return page_gaps(pages, [config]).drop("source")


@query(_PAGES_SQL.format(k=K, stop="k < 2", cap=10**9))
def paged_records_uncapped(spark, sf_dir):
    return _paged(spark, sf_dir, pagination_type="page", page_size=2, max_pages=None)


@query(
    f"""WITH pages AS (SELECT user_id, {K} AS k, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events),
 runs AS (SELECT user_id, min(r) FILTER (k < 1) AS stop, count(*) AS n FROM pages GROUP BY 1)
 SELECT CAST(user_id AS VARCHAR) AS run_id, 3::BIGINT AS max_pages FROM runs WHERE coalesce(stop > 3, n >= 3)"""
)
def paged_cut_runs(spark, sf_dir):
    """Runs that a cap of three pages ended."""
    config = SourceConfig("events_api", "https://example.org", records_json_path="body.items", pagination_type="page", page_size=1, max_pages=3)
    return cut_runs(derived.page_payloads(spark, sf_dir), [config]).drop("source")


# --- staging and tables ------------------------------------------------------------------

_REPO_COLUMNS = f"""user_id AS repo_id, 'repo-'||user_id AS repo_name, event_type||'/repo-'||user_id AS full_name,
 CASE WHEN event_type<>'error' THEN 'a "quoted" text' ELSE 'none' END AS description, event_type AS language,
 {K} AS star_count, CAST(trunc(value) AS INTEGER) AS fork_count, {K} AS watcher_count,
 length(event_type)::INTEGER AS open_issue_count, event_id::INTEGER AS size_kb, 'main' AS default_branch,
 event_type||',x' AS topics, ts AS repo_created_at, ts AS repo_updated_at, ts AS repo_pushed_at,
 'u'||user_id AS owner_login, user_id AS owner_id, 'User' AS owner_type,
 'https://example.org/repo-'||user_id AS html_url, 'none' AS homepage_url,
 CASE WHEN event_type<>'view' THEN 'MIT' ELSE 'none' END AS license_spdx"""


def _plain(df: DataFrame) -> DataFrame:
    """Types the comparison can hold: naive timestamps, joined topics, no NULL text."""
    columns = []
    for name, kind in df.dtypes:
        column = F.col(name)
        if kind == "timestamp":
            column = column.cast("timestamp_ntz")
        elif kind == "array<string>":
            column = F.concat_ws(",", column)
        elif kind.startswith("decimal"):
            column = column.cast("double")
        elif kind == "date":
            column = column.cast("string")
        elif kind == "string":
            column = F.coalesce(column, F.lit("none"))
        columns.append(column.alias(name))
    return df.select(*columns)


@query(
    f"""SELECT {_REPO_COLUMNS}, strftime(ts,'%Y-%m-%d') AS load_id, 'raw/'||event_type AS file_path,
 ts AS ingested_at FROM events WHERE event_type<>'purchase'"""
)
def staging_repos(spark, sf_dir):
    return _plain(repos.staged(derived.repo_landing(spark, sf_dir)))


@query(
    """SELECT 'c'||p_partkey AS coin_id, p_brand AS symbol, p_name AS coin_name, p_retailprice AS current_price_usd,
 CAST(CAST(p_retailprice*1000 AS DECIMAL(38,2)) AS DOUBLE) AS market_cap_usd, (p_partkey+1)::INTEGER AS market_cap_rank,
 CASE WHEN p_type<>'ECONOMY' THEN CAST(CAST(p_retailprice AS DECIMAL(38,2)) AS DOUBLE) ELSE -1 END AS fdv_usd,
 p_size::DOUBLE AS total_volume_usd, p_retailprice AS high_24h_usd, p_retailprice AS low_24h_usd,
 -0.125::DOUBLE AS price_change_24h_usd, 1e-7::DOUBLE AS price_change_pct_24h, (p_size*1000)::DOUBLE AS circulating_supply,
 CASE WHEN p_size%2=0 THEN (p_size*2000)::DOUBLE ELSE -1 END AS total_supply, -1::DOUBLE AS max_supply,
 CAST(CAST(p_retailprice*3 AS DECIMAL(38,8)) AS DOUBLE) AS ath_usd,
 TIMESTAMP '2021-11-10 14:24:11.849' AS ath_at, TIMESTAMP '2024-01-31' AS coin_updated_at FROM part"""
)
def staging_markets(spark, sf_dir):
    staged = _plain(markets.staged(derived.market_landing(spark, sf_dir)))
    return staged.drop("load_id", "file_path", "ingested_at").fillna(-1.0, ["fdv_usd", "total_supply", "max_supply"])


@query(
    OBS
    + """SELECT * EXCLUDE rn FROM (SELECT user_id, event_id, source, ingested_at,
 row_number() OVER (PARTITION BY user_id ORDER BY ingested_at DESC, event_id DESC) rn FROM obs) WHERE rn=1"""
)
def latest_per_entity(spark, sf_dir):
    rows = observations(spark, sf_dir).select("user_id", "event_id", "source", "ingested_at")
    return latest.latest_per_key(rows, ["user_id"], tie_breakers=["event_id"])


@query(
    """SELECT user_id, event_id, ts, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r
 FROM events) WHERE r = 1"""
)
def latest_kept(spark, sf_dir):
    """Latest rows kept over three runs whose rows overlap in time."""
    path = scratch_dir(spark, "latest")
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    for part in range(3):
        latest.keep_latest(spark, events.where(F.col("event_id") % 3 == part), path, ["user_id"], newest="ts", tie_breakers=["event_id"])
    return latest.read_kept(spark, path)


@query(
    """WITH d AS (SELECT user_id, CAST(ts AS DATE) AS metric_date, count(*) AS n, max(ts) AS last FROM events GROUP BY 1,2)
 SELECT 'rows' AS name, count(*)::DOUBLE AS actual FROM d
 UNION ALL SELECT 'age', floor((epoch(TIMESTAMP '2024-02-01 12:00:00')-epoch(max(last)))/3600) FROM d
 UNION ALL SELECT 'nulls', count(*) FILTER (metric_date IS NULL) FROM d
 UNION ALL SELECT 'keys', 0
 UNION ALL SELECT 'sql', sum(n)::DOUBLE FROM d WHERE metric_date >= DATE '2024-01-16'"""
)
def gate_from_states(spark, sf_dir):
    """Checks of a fact table upserted in two overlapping parts: from what its commits tell, and by its name in SQL."""
    path, keys = scratch_dir(spark, "fact"), ["user_id", "metric_date"]
    rows = observations(spark, sf_dir)
    for part in (F.col("ingested_at") < F.lit(CUTOFF), F.lit(True)):
        daily = rows.where(part).groupBy("user_id", F.to_date("ingested_at").alias("metric_date")).agg(F.count("*").alias("n"), F.max("ingested_at").alias("last"))
        facts.upsert_days(spark, daily, path, keys)
    now = Snapshot(spark, path, facts.DAY)
    folders = {(p,): now.folder(p) for p in now.parts}
    catalog.publish(spark, "marts.daily_events", now.columns, [facts.DAY], f"{path}/rows", folders, folders)
    on = {"table": "marts.daily_events"}
    specs = [
        {"name": "rows", "type": "row_count_min", **on},
        {"name": "age", "type": "freshness", "timestamp_column": "last", **on},
        {"name": "nulls", "type": "null_rate", "column": "metric_date", **on},
        {"name": "keys", "type": "uniqueness", "columns": keys, **on},
        {"name": "sql", "type": "custom_sql", "sql": "SELECT sum(n) FROM marts.daily_events WHERE metric_date >= DATE '2024-01-16'"},
    ]
    told = checks.run_checks(spark, specs, AS_OF, state=lambda name: now.state())
    key = {"rows": "actual_rows", "age": "hours_since_last", "nulls": "null_rows", "keys": "duplicate_groups", "sql": "actual"}
    return spark.createDataFrame([(r.name, float(r.details[key[r.name]])) for r in told], "name string, actual double")


@query(
    f"""SELECT repo_id, repo_name, full_name, owner_login, owner_id, owner_type, language, license_spdx, description,
 homepage_url, html_url, default_branch, topics, repo_created_at, repo_updated_at, ingested_at AS dim_refreshed_at
 FROM (SELECT {_REPO_COLUMNS}, ts AS ingested_at,
 row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, strftime(ts,'%Y-%m-%d') DESC, event_type DESC) rn
 FROM events WHERE event_type<>'purchase') WHERE rn=1"""
)
def dim_repos(spark, sf_dir):
    return _plain(repos.dim_repos(repos.latest_repos(derived.repo_landing(spark, sf_dir))))


_DAILY_SQL = (
    OBS
    + """SELECT user_id, strftime(ingested_at,'%Y-%m-%d') AS metric_date,
 max(CAST(json_extract_string(data,'$.k') AS INTEGER)) AS k, max(value) AS value,
 count(*) AS observation_count, max(ingested_at) AS last_observed_at FROM obs GROUP BY 1,2"""
)


@query(_DAILY_SQL)
def daily_metrics(spark, sf_dir):
    staged = observations(spark, sf_dir).withColumn("k", k_of("data"))
    return _plain(facts.daily_metrics(staged, "user_id", ["k", "value"]))


@query(
    f"""SELECT user_id AS repo_id, strftime(ts,'%Y-%m-%d') AS metric_date, max({K}) AS star_count,
 max(CAST(trunc(value) AS INTEGER)) AS fork_count, max({K}) AS watcher_count,
 max(length(event_type))::INTEGER AS open_issue_count, count(*) AS observation_count, max(ts) AS last_observed_at
 FROM events WHERE event_type<>'purchase' GROUP BY 1,2"""
)
def daily_repo_metrics(spark, sf_dir):
    return _plain(repos.daily_repo_metrics(derived.repo_landing(spark, sf_dir)))


@query(
    OBS
    + """SELECT user_id, strftime(ingested_at,'%Y-%m-%d') AS metric_date, max(value) AS value, count(*) AS observation_count,
 max(ingested_at) AS last_observed_at FROM obs WHERE ingested_at >= TIMESTAMP '2024-01-16' OR source<>'error' GROUP BY 1,2"""
)
def daily_metrics_incremental(spark, sf_dir):
    """First run without errors up to noon of a day, second run over everything."""
    path = scratch_dir(spark, "fact")
    rows = observations(spark, sf_dir).withColumn("day", F.to_date("ingested_at"))
    first = rows.where((F.col("source") != "error") & (F.col("ingested_at") < F.lit(CUTOFF)))
    for seen in (first, rows):
        recent = facts.since_high_water(seen, "day", facts.read_fact(spark, path))
        facts.upsert_days(spark, facts.daily_metrics(recent, "user_id", ["value"]), path, ["user_id", "metric_date"])
    return _plain(facts.read_fact(spark, path))


@query(
    """SELECT user_id AS id, value AS first_only, -1::DOUBLE AS second_only FROM events
 UNION ALL SELECT c_custkey, -1, c_acctbal FROM customer"""
)
def append_columns(spark, sf_dir):
    old = table(spark, sf_dir, "events").select(F.col("user_id").alias("id"), F.col("value").alias("first_only"))
    new = table(spark, sf_dir, "customer").select(F.col("c_acctbal").alias("second_only"), F.col("c_custkey").alias("id"))
    return tables.append_columns(old, new).fillna(-1.0)


@query("SELECT props AS placeholder_column, event_type AS target FROM events")
def empty_relation(spark, sf_dir):
    """The placeholder without rows, an always-false filter and the rows that replace both."""
    rows = table(spark, sf_dir, "events").select(
        F.col("props").alias("placeholder_column"), F.col("event_type").alias("target")
    )
    return schemas.empty(spark, schemas.TRAINING_DATA).unionByName(rows.where(F.lit(False))).unionByName(rows)


@query(
    OBS
    + """SELECT user_id, strftime(ingested_at,'%Y-%m-%d') AS metric_date, max(value) AS value, count(*) AS observation_count,
 max(ingested_at) AS last_observed_at FROM obs GROUP BY 1,2"""
)
def stream_daily_metrics(spark, sf_dir):
    """The daily fact kept by a stream over two drops of files, the second one starting mid-day."""
    base = scratch_dir(spark, "staged")
    rows = observations(spark, sf_dir).select("user_id", "value", "ingested_at", F.to_date("ingested_at").alias("ingest_date"))
    for part in (F.col("ingested_at") < F.lit(CUTOFF), F.col("ingested_at") >= F.lit(CUTOFF)):
        rows.where(part).write.mode("append").partitionBy("ingest_date").parquet(f"{base}/in")
        upsert_from_stream(
            spark.readStream.schema(rows.schema).parquet(f"{base}/in"),
            lambda session: session.read.schema(rows.schema).parquet(f"{base}/in"),
            f"{base}/fact",
            f"{base}/checkpoint",
            "user_id",
            ["value"],
        )
    return _plain(facts.read_fact(spark, f"{base}/fact"))


# --- checks ------------------------------------------------------------------------------


@query("SELECT count(*) AS actual_rows, count(*)>=1000 AS passed FROM orders")
def check_row_count_min(spark, sf_dir):
    return table(spark, sf_dir, "orders").agg(
        checks.row_count().alias("actual_rows"), (checks.row_count() >= 1000).alias("passed")
    )


@query(
    """SELECT CAST(floor((epoch(TIMESTAMP '2024-02-01 12:00:00')-epoch(max(ts)))/3600) AS BIGINT) AS hours_since_last,
 floor((epoch(TIMESTAMP '2024-02-01 12:00:00')-epoch(max(ts)))/3600)<=24 AS passed FROM events"""
)
def check_freshness(spark, sf_dir):
    hours = checks.whole_hours_since(F.max("ts"), AS_OF)
    return table(spark, sf_dir, "events").agg(hours.alias("hours_since_last"), (hours <= 24).alias("passed"))


@query(
    """SELECT count(*) AS total_rows, count(*) FILTER (nullif(event_type,'error') IS NULL) AS null_rows,
 round((count(*) FILTER (nullif(event_type,'error') IS NULL))/count(*), 6) AS null_rate FROM events"""
)
def check_null_rate(spark, sf_dir):
    total, nulls = checks.row_count(), checks.null_count("nullif(event_type, 'error')")
    return table(spark, sf_dir, "events").agg(
        total.alias("total_rows"), nulls.alias("null_rows"), F.round(checks.null_share(nulls, total), 6).alias("null_rate")
    )


@query(
    """SELECT count(*) AS dup_groups FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey,l_linenumber HAVING count(*)>1)"""
)
def check_uniqueness(spark, sf_dir):
    return checks.duplicate_group_count(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


_RECENT = "SELECT count(*) AS actual FROM events WHERE ts >= TIMESTAMP '2024-02-01 00:00:00' - INTERVAL '7' DAY"


@query(
    f"""SELECT comparison, actual, passed FROM ({_RECENT}) n, (SELECT unnest(['eq','ne','lt','lte','gt','gte']) AS comparison) c,
 LATERAL (SELECT CASE comparison WHEN 'eq' THEN actual=0 WHEN 'ne' THEN actual<>0 WHEN 'lt' THEN actual<0
 WHEN 'lte' THEN actual<=0 WHEN 'gt' THEN actual>0 ELSE actual>=0 END AS passed)"""
)
def check_custom_sql(spark, sf_dir):
    table(spark, sf_dir, "events").createOrReplaceTempView("events")
    specs = [{"name": c, "type": "custom_sql", "sql": _RECENT, "comparison": c} for c in checks.COMPARISONS]
    results = checks.results_table(spark, checks.run_checks(spark, specs, AS_OF))
    actual = F.get_json_object("details", "$.actual").cast("bigint")
    return results.select(F.col("name").alias("comparison"), actual.alias("actual"), "passed")


GATE_SPECS = [
    {"name": "orders_rows", "type": "row_count_min", "table": "orders", "min_rows": 1000},
    {"name": "events_fresh", "type": "freshness", "table": "events", "timestamp_column": "ts", "max_age_hours": 1,
     "severity": "warn"},
    {"name": "event_type_set", "type": "null_rate", "table": "events", "column": "nullif(event_type, 'error')",
     "max_null_rate": 0.5},
    {"name": "lineitem_key", "type": "uniqueness", "table": "lineitem", "columns": ["l_orderkey", "l_linenumber"]},
    {"name": "recent_events", "type": "custom_sql", "sql": _RECENT, "comparison": "gte", "expected_value": 0},
    {"name": "odd", "type": "no_such_type", "severity": "warn"},
]


@query(
    """SELECT (o.n>=1000 AND e.nulls<=0.5*e.n AND l.dups=0) AS passed, 6::BIGINT AS total_checks,
 ((o.n<1000)::INT+(e.nulls>0.5*e.n)::INT+(l.dups>0)::INT)::BIGINT AS error_count,
 (1+(e.h>1)::INT)::BIGINT AS warn_count
 FROM (SELECT count(*) AS n FROM orders) o,
 (SELECT count(*) AS n, count(*) FILTER (event_type='error') AS nulls,
   floor((epoch(TIMESTAMP '2024-02-01 12:00:00')-epoch(max(ts)))/3600) AS h FROM events) e,
 (SELECT count(*) AS dups FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey,l_linenumber HAVING count(*)>1)) l"""
)
def gate_summary(spark, sf_dir):
    table(spark, sf_dir, "events").createOrReplaceTempView("events")
    results = checks.run_checks(spark, GATE_SPECS, AS_OF, lambda name: table(spark, sf_dir, name))
    return checks.gate(checks.results_table(spark, results))


@query("SELECT event_id FROM events WHERE nullif(event_type,'error') IS NULL")
def dq_not_null(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("event_type", F.nullif("event_type", F.lit("error")))
    return data_tests.not_null(rows, "event_type").select("event_id")


@query("SELECT o_custkey, count(*) AS n_records FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1 HAVING count(*)>1")
def dq_unique(spark, sf_dir):
    return data_tests.unique(table(spark, sf_dir, "orders"), "o_custkey")


@query("SELECT c_custkey FROM customer WHERE NOT (c_acctbal >= 0)")
def dq_accepted_range(spark, sf_dir):
    return data_tests.accepted_range(table(spark, sf_dir, "customer"), "c_acctbal", 0).select("c_custkey")


@query("SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1,2 HAVING count(*)>1")
def dq_unique_combination(spark, sf_dir):
    return data_tests.unique_combination(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM events)")
def dq_relationships(spark, sf_dir):
    parent = table(spark, sf_dir, "events")
    return data_tests.relationships(table(spark, sf_dir, "orders"), "o_custkey", parent, "user_id").select("o_orderkey")


@query(
    """SELECT o_custkey, count(*) AS n_records FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM events) GROUP BY 1"""
)
def dq_orphan_keys(spark, sf_dir):
    return data_tests.orphan_keys(table(spark, sf_dir, "orders"), "o_custkey", table(spark, sf_dir, "events"), "user_id")


@query(
    """SELECT event_type AS source, CASE WHEN h>48 THEN 'error' WHEN h>12 THEN 'warn' ELSE 'pass' END AS status
 FROM (SELECT event_type, (epoch(TIMESTAMP '2024-01-31 11:30:00')-epoch(max(ts)))/3600 AS h FROM events GROUP BY 1)"""
)
def source_freshness(spark, sf_dir):
    rows = observations(spark, sf_dir)
    return data_tests.source_freshness(rows, "source", "ingested_at", datetime(2024, 1, 31, 11, 30)).select("source", "status")


# --- ledger ------------------------------------------------------------------------------

_LEDGER_SQL = f"""WITH ledger AS (SELECT CAST(event_id AS VARCHAR) AS run_id, event_type, ts AS ended_at, event_id,
 CASE WHEN event_type='error' THEN 'FAILURE' ELSE 'SUCCESS' END AS status,
 CASE WHEN event_type='view' THEN 'unknown' ELSE event_type END AS source, {K}::BIGINT AS rows_ingested,
 CASE WHEN event_type IN ('view','click') THEN 0 ELSE event_id END AS rows_loaded,
 CASE WHEN event_type='click' THEN 'n/a' ELSE 'LOADED' END AS load_status, event_type='purchase' AS ml_enabled,
 (CASE WHEN event_type='purchase' THEN {K} ELSE 0 END)::BIGINT AS ml_rows_loaded,
 CASE WHEN event_type='click' THEN 'none' WHEN event_type='error' THEN 'false' ELSE 'true' END AS quality_passed,
 (CASE WHEN event_type='click' THEN 0 ELSE 6 END)::BIGINT AS quality_total,
 (CASE WHEN event_type='error' THEN {K} ELSE 0 END)::BIGINT AS quality_errors,
 (CASE WHEN event_type='click' THEN 0 ELSE 1 END)::BIGINT AS quality_warns,
 (CASE WHEN event_type='signup' THEN {K} ELSE 0 END)::BIGINT AS truncated,
 CASE WHEN event_type<>'click' THEN 'n/a' WHEN {K}>50 THEN 'warn' ELSE 'pass' END AS freshness,
 CASE WHEN event_type='error' THEN '{{"Error":"States.TaskFailed"}}' ELSE 'none' END AS error_info,
 CASE WHEN event_type='signup' THEN 0 ELSE round(value+0.004,3) END AS duration_seconds,
 CASE WHEN event_type='signup' THEN 'not a date' ELSE
  strftime(ts - to_microseconds(CAST(round(value*1000000) AS BIGINT)+4000),'%Y-%m-%dT%H:%M:%S.%fZ') END AS started_at
 FROM events) """


def _ledger(spark, sf_dir):
    return ledger.flatten_states(derived.run_states(spark, sf_dir))


@query(
    _LEDGER_SQL
    + """SELECT run_id, status, started_at, ended_at, duration_seconds, source, rows_ingested, rows_loaded, load_status,
 ml_enabled, ml_rows_loaded, quality_passed, quality_total, quality_errors, quality_warns, error_info, truncated, freshness FROM ledger"""
)
def run_ledger(spark, sf_dir):
    rows = _ledger(spark, sf_dir).withColumn("quality_passed", F.col("quality_passed").cast("string"))
    return _plain(rows.withColumn("duration_seconds", F.round("duration_seconds", 3)))


@query(
    _LEDGER_SQL
    + """SELECT run_id, ended_at AS at, m.metric, m.unit, m.dimension,
 CASE m.dimension WHEN 'Status' THEN status ELSE source END AS dimension_value, round(m.v,3) AS metric_value
 FROM ledger, LATERAL (VALUES ('PipelineExecutions','Count','Status',1::DOUBLE),
 ('PipelineDuration','Seconds','Status',duration_seconds), ('RowsIngested','Count','Source',rows_ingested),
 ('RowsLoaded','Count','Source',rows_loaded), ('MLRowsLoaded','Count','Source',ml_rows_loaded),
 ('QualityCheckErrors','Count','Status',quality_errors), ('QualityCheckWarns','Count','Status',quality_warns))
 m(metric,unit,dimension,v)"""
)
def run_metrics_long(spark, sf_dir):
    return ledger.metrics_long(_ledger(spark, sf_dir))


@query(
    _LEDGER_SQL
    + """SELECT run_id, '[Pipeline '||status||'] '||substr(source,1,30)||' ('||substr(run_id,1,8)||')' AS subject,
 'Pipeline:  recordmill'||chr(10)||'Execution: '||run_id||chr(10)||'Status:    '||status||chr(10)||
 'Duration:  '||CASE WHEN duration_seconds<60 THEN printf('%.1fs',duration_seconds) WHEN duration_seconds<3600 THEN
  floor(duration_seconds/60)::BIGINT||'m '||(floor(duration_seconds)::BIGINT%60)||'s' ELSE
  floor(duration_seconds/3600)::BIGINT||'h '||(floor(duration_seconds/60)::BIGINT%60)||'m '||
  (floor(duration_seconds)::BIGINT%60)||'s' END||chr(10)||
 'Start:     '||started_at||chr(10)||chr(10)||'--- Pipeline Stats ---'||chr(10)||
 '  Source:          '||source||chr(10)||'  Rows ingested:   '||format('{:,}',rows_ingested)||chr(10)||
 '  Rows loaded:     '||format('{:,}',rows_loaded)||'  ('||load_status||')'||chr(10)||
 '  ML predictions:  '||CASE WHEN ml_enabled THEN format('{:,}',ml_rows_loaded) ELSE '(disabled)' END||
 CASE WHEN quality_passed='none' THEN '' ELSE chr(10)||'  Quality gate:    '||
  CASE WHEN quality_passed='true' THEN 'PASSED' ELSE 'FAILED' END||'  ('||quality_total||' checks, '||
  quality_errors||' errors, '||quality_warns||' warnings)' END||
 CASE WHEN status='FAILURE' THEN chr(10)||chr(10)||'--- Error ---'||chr(10)||error_info ELSE '' END AS message
 FROM ledger"""
)
def run_report(spark, sf_dir):
    return ledger.report(_ledger(spark, sf_dir))


@query(
    """SELECT CAST(event_id AS VARCHAR) AS run_id,
 CASE WHEN event_type IN ('error','click') THEN 'FAILURE' ELSE 'SUCCESS' END AS routed FROM events"""
)
def run_routing(spark, sf_dir):
    """A run succeeds when no stage failed and its gate passed."""
    routed = ledger.run_status(F.col("quality_passed"), F.col("error_info"))
    return _ledger(spark, sf_dir).select("run_id", routed.alias("routed"))


# --- windows -----------------------------------------------------------------------------


@query(
    """SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
 CASE WHEN event_type='error' THEN 'FAILURE' ELSE 'SUCCESS' END AS status, count(*) AS executions FROM events GROUP BY 1,2"""
)
def exec_5m(spark, sf_dir):
    return run_metrics.executions(_ledger(spark, sf_dir))


@query(
    _LEDGER_SQL
    + """SELECT time_bucket(INTERVAL 15 MINUTE, ended_at) AS window_start, round(quantile_cont(duration_seconds,0.95),9) AS p95,
 round(avg(duration_seconds),9) AS avg_duration FROM ledger WHERE status='SUCCESS' GROUP BY 1"""
)
def duration_15m(spark, sf_dir):
    found = run_metrics.duration_stats(_ledger(spark, sf_dir))
    return found.withColumn("p95", F.round("p95", 9)).withColumn("avg_duration", F.round("avg_duration", 9))


@query(
    f"""SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, sum({K})::BIGINT AS quality_errors
 FROM events WHERE event_type='error' GROUP BY 1"""
)
def quality_errors_5m(spark, sf_dir):
    return run_metrics.quality_errors(_ledger(spark, sf_dir))


@query(
    f"""SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
 CASE WHEN event_type='view' THEN 'unknown' ELSE event_type END AS source, sum({K})::BIGINT AS rows_ingested
 FROM events GROUP BY 1,2"""
)
def rows_by_source_5m(spark, sf_dir):
    return run_metrics.rows_by_source(_ledger(spark, sf_dir))


@query(
    """SELECT time_bucket(INTERVAL 24 HOUR, ts) AS window_start,
 CASE WHEN event_type='error' THEN 'FAILURE' ELSE 'SUCCESS' END AS status, count(*) AS executions FROM events GROUP BY 1,2"""
)
def totals_24h(spark, sf_dir):
    return run_metrics.totals(_ledger(spark, sf_dir))


@query(
    f"""SELECT time_bucket(INTERVAL 24 HOUR, ts) AS window_start, sum({K})::BIGINT AS quality_errors
 FROM events WHERE event_type='error' GROUP BY 1"""
)
def quality_errors_24h(spark, sf_dir):
    return run_metrics.quality_errors(_ledger(spark, sf_dir), width=run_metrics.TOTAL_WINDOW)


@query(
    _LEDGER_SQL
    + """SELECT time_bucket(INTERVAL 15 MINUTE, ended_at) AS window_start, 'duration' AS alarm FROM ledger
 WHERE status='SUCCESS' GROUP BY 1 HAVING quantile_cont(duration_seconds,0.95)>250
 UNION ALL SELECT time_bucket(INTERVAL 5 MINUTE, ended_at), 'failure' FROM ledger WHERE status='FAILURE' GROUP BY 1
 UNION ALL SELECT time_bucket(INTERVAL 5 MINUTE, ended_at), 'quality' FROM ledger WHERE status='FAILURE' GROUP BY 1
 HAVING sum(quality_errors)>=1"""
)
def alarms(spark, sf_dir):
    return run_metrics.alarms(_ledger(spark, sf_dir), max_p95=250.0)


def _states_in_parts(spark, sf_dir):
    """The run states written in three drops of files, none of which is a range of time; a micro-batch takes as many files as a drop holds."""
    base = scratch_dir(spark, "states")
    states = derived.run_states(spark, sf_dir)
    for part in range(3):
        states.where(F.crc32(F.col("run_id").cast("binary")) % 3 == part).write.mode("append").parquet(base)
    written = spark.read.parquet(base)
    a_drop = max(1, -(-len(written.inputFiles()) // 3))
    stream = ledger.flatten_states(spark.readStream.schema(written.schema).option("maxFilesPerTrigger", a_drop).parquet(base))
    return stream.withColumn("ended_at", F.col("ended_at").cast("timestamp"))


def _streamed(spark, sf_dir, metric, *by):
    base = scratch_dir(spark, "windows")
    # The parts overlap in time: a run counts however late its file comes.
    stream_metric(_states_in_parts(spark, sf_dir), metric, f"{base}/table", f"{base}/checkpoint", late_by="10000 days", by=by)
    return _plain(read_metric(spark, f"{base}/table"))


@query(
    """SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
 CASE WHEN event_type='error' THEN 'FAILURE' ELSE 'SUCCESS' END AS status, count(*) AS executions FROM events GROUP BY 1,2"""
)
def stream_exec_5m(spark, sf_dir):
    return _streamed(spark, sf_dir, run_metrics.executions, "status")


@query(
    f"""SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
 CASE WHEN event_type='view' THEN 'unknown' ELSE event_type END AS source, sum({K})::BIGINT AS rows_ingested
 FROM events GROUP BY 1,2"""
)
def stream_rows_by_source_5m(spark, sf_dir):
    return _streamed(spark, sf_dir, run_metrics.rows_by_source, "source")


@query(
    f"""SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, sum({K})::BIGINT AS quality_errors
 FROM events WHERE event_type='error' GROUP BY 1"""
)
def stream_quality_errors_5m(spark, sf_dir):
    return _streamed(spark, sf_dir, run_metrics.quality_errors)


@query(
    """SELECT time_bucket(INTERVAL 24 HOUR, ts) AS window_start,
 CASE WHEN event_type='error' THEN 'FAILURE' ELSE 'SUCCESS' END AS status, count(*) AS executions FROM events GROUP BY 1,2"""
)
def stream_totals_24h(spark, sf_dir):
    return _streamed(spark, sf_dir, run_metrics.totals, "status")


@query(
    _LEDGER_SQL
    + """SELECT time_bucket(INTERVAL 15 MINUTE, ended_at) AS window_start, round(quantile_cont(duration_seconds,0.95),6) AS p95,
 round(avg(duration_seconds),6) AS avg_duration FROM ledger WHERE status='SUCCESS' GROUP BY 1"""
)
def stream_duration_15m(spark, sf_dir):
    """Sketches kept by a stream; windows of up to 4,096 runs are exact."""
    base = scratch_dir(spark, "durations")
    stream_durations(_states_in_parts(spark, sf_dir), f"{base}/table", f"{base}/checkpoint")
    found = _plain(read_durations(spark, f"{base}/table"))
    return found.withColumn("p95", F.round("p95", 6)).withColumn("avg_duration", F.round("avg_duration", 6))


# --- models ------------------------------------------------------------------------------


@query(
    """SELECT o_orderkey, datediff('day', o_orderdate, TIMESTAMP '2002-01-01') AS days_active,
 CASE WHEN o_totalprice>300000 THEN 1 ELSE 0 END AS is_popular FROM orders WHERE o_totalprice IS NOT NULL"""
)
def training_mart(spark, sf_dir):
    days = F.datediff(F.lit("2002-01-01").cast("date"), F.col("o_orderdate"))
    return (
        table(spark, sf_dir, "orders")
        .where(F.col("o_totalprice").isNotNull())
        .select(
            "o_orderkey",
            days.cast("bigint").alias("days_active"),
            F.when(F.col("o_totalprice") > 300000, 1).otherwise(0).alias("is_popular"),
        )
    )


@query(
    """SELECT o_orderkey, CAST('0x'||substr(md5(CAST(o_orderkey AS VARCHAR)),1,8) AS BIGINT)%100<80 AS is_train FROM orders"""
)
def ml_split(spark, sf_dir):
    return features.hash_split(table(spark, sf_dir, "orders"), "o_orderkey").select("o_orderkey", "is_train")


@query(
    """SELECT o_orderkey, o_orderstatus, rn <= floor(0.8*n) AS is_train FROM (SELECT o_orderkey, o_orderstatus,
 row_number() OVER (PARTITION BY o_orderstatus ORDER BY CAST('0x'||substr(md5(CAST(o_orderkey AS VARCHAR)),1,13) AS BIGINT)) AS rn,
 count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)"""
)
def ml_split_stratified(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return features.stratified_split(rows, "o_orderkey", "o_orderstatus")


@query(
    """SELECT 'l_quantity' AS "column", median(l_quantity) AS median FROM lineitem
 UNION ALL SELECT 'l_extendedprice', round(median(l_extendedprice),4) FROM lineitem
 UNION ALL SELECT 'l_linenumber', median(l_linenumber) FROM lineitem"""
)
def column_medians(spark, sf_dir):
    found = medians(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_linenumber"])
    return found.withColumn("median", F.round("median", 4))


@query(
    """(SELECT 'l_returnflag' AS "column", l_returnflag AS mode FROM lineitem GROUP BY 2 ORDER BY count(*) DESC, 2 LIMIT 1)
 UNION ALL (SELECT 'l_linestatus', l_linestatus FROM lineitem GROUP BY 2 ORDER BY count(*) DESC, 2 LIMIT 1)
 UNION ALL (SELECT 'l_linenumber', CAST(l_linenumber AS VARCHAR) FROM lineitem GROUP BY 2 ORDER BY count(*) DESC, 2 LIMIT 1)"""
)
def column_modes(spark, sf_dir):
    return modes(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"])


@query(
    """SELECT c_custkey, round((coalesce(b,m)-avg(coalesce(b,m)) OVER ())/stddev_pop(coalesce(b,m)) OVER (),6) AS acctbal_scaled
 FROM (SELECT c_custkey, CASE WHEN c_mktsegment<>'MACHINERY' THEN c_acctbal END AS b,
 (SELECT median(c_acctbal) FROM customer WHERE c_mktsegment<>'MACHINERY') AS m FROM customer)"""
)
def ml_preprocess(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").withColumn(
        "c_acctbal", F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_acctbal"))
    )
    scaling = features.fit_scaling(rows, ["c_acctbal"])[0]
    return rows.select("c_custkey", F.round(features.scaled(scaling), 6).alias("acctbal_scaled"))


@query(
    """SELECT event_id, (event_type='click')::DOUBLE AS is_click, (event_type='error')::DOUBLE AS is_error,
 (event_type='purchase')::DOUBLE AS is_purchase, (event_type='signup')::DOUBLE AS is_signup FROM events"""
)
def ml_one_hot(spark, sf_dir):
    """Encoder fitted without views, applied to all events."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    model = features.preprocess(events.where(F.col("event_type") != "view"), [], ["event_type"])
    hot = vector_to_array("features")
    names = ["is_click", "is_error", "is_purchase", "is_signup"]
    return model.transform(events).select("event_id", *[hot[i].alias(n) for i, n in enumerate(names)])


@query(
    """SELECT o_orderkey, o_totalprice, -1::DOUBLE AS not_there FROM orders"""
)
def ml_align(spark, sf_dir):
    wanted = {"o_totalprice": "double", "not_there": "double"}
    return features.align(table(spark, sf_dir, "orders"), wanted, keep=["o_orderkey"]).fillna(-1.0, ["not_there"])


@query(
    """SELECT round(avg(abs(y-p)),4) AS mae, round(1-sum((y-p)*(y-p))/(count(*)*var_pop(y)),6) AS r2
 FROM (SELECT l_extendedprice AS y, l_quantity*p_retailprice AS p FROM lineitem JOIN part ON l_partkey=p_partkey)"""
)
def ml_eval_regression(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    ).select("l_extendedprice", (F.col("l_quantity") * F.col("p_retailprice")).alias("guess"))
    found = boosting.regression_metrics(rows, "l_extendedprice", "guess")
    return found.select(F.round("mae", 4).alias("mae"), F.round("r2", 6).alias("r2"))


@query("SELECT quality AS truth, 1-toxic AS predicted, count(*) AS n FROM labels GROUP BY 1,2")
def ml_confusion(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").withColumn("guess", 1 - F.col("toxic"))
    return boosting.confusion(rows, "quality", "guess")


@query(
    """WITH r AS (SELECT quality AS t, 1-toxic AS p FROM labels), c AS (SELECT unnest([0,1]) AS l),
 f AS (SELECT l, (SELECT count(*) FROM r WHERE t=l) AS s, (SELECT count(*) FROM r WHERE p=l) AS q,
 (SELECT count(*) FROM r WHERE t=l AND p=l) AS h FROM c)
 SELECT round(sum(h)/sum(s),9) AS accuracy, round(sum(s*(CASE WHEN s+q>0 THEN 2*h/(s+q) ELSE 0 END))/sum(s),9) AS f1_weighted FROM f"""
)
def ml_eval_classification(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").withColumn("guess", 1 - F.col("toxic"))
    found = boosting.classification_metrics(rows, "quality", "guess")
    return found.select(F.round("accuracy", 9).alias("accuracy"), F.round("f1_weighted", 9).alias("f1_weighted"))


def _order_features(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_totalprice",
        "o_orderpriority",
        F.datediff(F.lit("2002-01-01").cast("date"), F.col("o_orderdate")).alias("days_active"),
        F.col("o_orderstatus").alias("status"),
    )


@query()
def ml_train_score(spark, sf_dir):
    """Train, save, load and score a classifier of expensive orders."""
    rows = _order_features(spark, sf_dir).withColumn("is_popular", (F.col("o_totalprice") > 300000).cast("int"))
    folder = scratch_dir(spark, "model")
    trained = boosting.train(rows, "is_popular", "classification", "o_orderkey")
    boosting.save(trained, folder, spark)
    return boosting.predict(boosting.load(spark, folder), rows.drop("is_popular"), ["o_orderkey"])


@query()
def ml_train_score_regression(spark, sf_dir):
    """Train a regressor and append its scores to the predictions table."""
    rows = _order_features(spark, sf_dir)
    base = scratch_dir(spark, "predictions")
    trained = boosting.train(rows, "o_totalprice", "regression", "o_orderkey")
    boosting.score_run(trained, rows, "o_orderkey", base, "run-1", AS_OF)
    return spark.read.schema(schemas.PREDICTIONS).parquet(base)


# Targets that two features decide, so a model that learned them says what SQL says.
_CLASS = "CASE WHEN o_orderpriority='1-URGENT' THEN 'now' WHEN o_orderstatus='O' THEN 'open' ELSE 'rest' END"
_AMOUNT = "CASE o_orderpriority WHEN '1-URGENT' THEN 150 WHEN '2-HIGH' THEN 120 ELSE 100 END + CASE WHEN o_orderstatus='O' THEN 3 ELSE 0 END"


def _decided(spark, sf_dir, target):
    days = F.datediff(F.lit("2002-01-01").cast("date"), F.col("o_orderdate")).alias("days_active")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus", days, F.expr(target).alias("target")
    )


@query(f"SELECT o_orderkey, {_CLASS} AS prediction FROM orders")
def ml_train_classes(spark, sf_dir):
    """Train, save, load and score a classifier of three classes."""
    rows = _decided(spark, sf_dir, _CLASS)
    folder = scratch_dir(spark, "model")
    boosting.save(boosting.train(rows, "target", "classification", "o_orderkey", n_estimators=10), folder, spark)
    return boosting.predict(boosting.load(spark, folder), rows.drop("target"), ["o_orderkey"])


@query(f"SELECT CAST(o_orderkey AS VARCHAR) AS row_key, ({_AMOUNT})::DOUBLE AS prediction, 'run-1' AS load_id FROM orders")
def ml_train_amounts(spark, sf_dir):
    """Train a regressor and score a run into the predictions table."""
    rows = _decided(spark, sf_dir, _AMOUNT)
    base = scratch_dir(spark, "predictions")
    trained = boosting.train(rows, "target", "regression", "o_orderkey", n_estimators=10)
    boosting.score_run(trained, rows.drop("target"), "o_orderkey", base, "run-1", AS_OF)
    back = spark.read.schema(schemas.PREDICTIONS).parquet(base)
    return back.select("row_key", F.round(F.col("prediction").cast("double"), 6).alias("prediction"), "load_id")


@query(f"SELECT {_CLASS} AS prediction, 'run-7' AS load_id, count(*) AS n FROM orders GROUP BY 1")
def ml_files_to_scores(spark, sf_dir):
    """CSV files of two layouts to a model, input files to ``.out`` files, those loaded by a run's state."""
    base = scratch_dir(spark, "files")
    rows = _decided(spark, sf_dir, _CLASS)
    odd = F.col("o_orderkey") % 2 == 1
    rows.where(odd).write.options(**csv.WRITTEN).csv(f"{base}/training/a")
    rows.where(~odd).select(*reversed(rows.columns), F.lit("late").alias("drop")).write.options(**csv.WRITTEN).csv(f"{base}/training/b")
    models.train_files(spark, f"{base}/training", f"{base}/model", "target", "classification", "o_orderkey", n_estimators=10)
    exported = csv.export_csv(rows.drop("target"), base, "run-7")
    models.score_files(spark, f"{base}/model", exported["path"], f"{base}/scores", ["o_orderkey"])
    state = {"mlExport": {"Payload": exported}, "transformResult": {"transformOutput": {"s3OutputPath": f"{base}/scores"}}}
    csv.load_of_state(spark, state, f"{base}/table", AS_OF, "no-run")
    back = spark.read.schema(schemas.PREDICTIONS).parquet(f"{base}/table")
    return back.groupBy("prediction", "load_id").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey, round(o_totalprice*0.5+2,4) AS prediction FROM orders")
def ml_predict_hooks(spark, sf_dir):
    """A model of the user's own, loaded once per task."""
    scored = features.predict_with(
        table(spark, sf_dir, "orders"),
        model_fn=lambda: {"slope": 0.5, "offset": 2.0},
        predict_fn=lambda model, rows: rows["o_totalprice"] * model["slope"] + model["offset"],
        keys=["o_orderkey"],
        features=["o_totalprice"],
    )
    return scored.withColumn("prediction", F.round("prediction", 4))


# --- a whole run -------------------------------------------------------------------------


@query(
    f"""SELECT user_id AS repo_id, '2024-02-01' AS metric_date, max({K}) AS star_count,
 max(CAST(trunc(value) AS INTEGER)) AS fork_count, max({K}) AS watcher_count,
 max(length(event_type))::INTEGER AS open_issue_count, count(*) AS observation_count,
 TIMESTAMP '2024-02-01 12:00:00' AS last_observed_at, 'SUCCESS' AS status FROM events GROUP BY 1"""
)
def whole_run(spark, sf_dir):
    """Pages to raw files, landing, tables, gate and ledger; gives the fact and the run's status."""
    house = full_run.Warehouse(scratch_dir(spark, "house"))
    config = SourceConfig(
        repos.SOURCE, "https://example.org", pagination_type="page", page_size=1, max_pages=None, records_json_path="items"
    )
    status = full_run.run(spark, house, "run-1", derived.repo_pages(spark, sf_dir), config, AS_OF, AS_OF)
    return _plain(full_run.daily_facts(spark, house)).withColumn("status", F.lit(status))


# --- CSV ---------------------------------------------------------------------------------


@query("SELECT count(*) AS n, sum(c_custkey)::BIGINT AS keys, round(sum(c_acctbal),2) AS balance FROM customer")
def csv_export(spark, sf_dir):
    done = csv.export_csv(table(spark, sf_dir, "customer"), scratch_dir(spark, "export"), "run-1")
    back = csv.read_scoring(spark, done["path"])
    return back.agg(
        F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("keys"), F.round(F.sum("c_acctbal"), 2).alias("balance")
    )


@query(
    """SELECT id, amount, label FROM (SELECT c_custkey AS id, c_acctbal AS amount, 'none' AS label FROM customer
 UNION ALL SELECT s_suppkey, -1, s_name FROM supplier)"""
)
def csv_training_scan(spark, sf_dir):
    """Files with different headers stacked by column name."""
    folder = scratch_dir(spark, "training")
    first = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("amount"))
    second = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("label"), F.col("s_suppkey").alias("id"))
    for frame in (first, second):
        frame.write.mode("append").option("header", "true").csv(folder)
    rows = csv.read_training(spark, folder)
    return rows.select(F.col("id").cast("bigint").alias("id"), "amount", "label").fillna(-1.0, ["amount"]).fillna("none", ["label"])


@query("SELECT count(*) AS n, round(sum(o_totalprice),2) AS total FROM orders")
def predictions_load(spark, sf_dir):
    """Scores written as ``.out`` files by a scoring job, appended to the predictions table."""
    base = scratch_dir(spark, "scores")
    scores = table(spark, sf_dir, "orders").select(F.col("o_totalprice").alias("prediction"), F.lit("x").alias("extra"))
    scores.write.option("header", "true").option("extension", "out").csv(f"{base}/raw")
    csv.load_predictions(spark, f"{base}/raw", f"{base}/table", "run-1", AS_OF)
    back = spark.read.schema(schemas.PREDICTIONS).parquet(f"{base}/table")
    return back.agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("prediction").cast("double")), 2).alias("total")
    )


@query(
    """SELECT c_custkey, CASE WHEN c_custkey%7=0 OR c_custkey%5=0 THEN 'none'
 ELSE c_name||', "'||c_mktsegment||'"'||chr(10)||'next, line' END AS note FROM customer"""
)
def csv_export_rows(spark, sf_dir):
    """Texts with quotes, commas and line breaks, out and back; an empty text and NULL are both no value."""
    key = F.col("c_custkey")
    text = F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"\nnext, line'))
    note = F.when(key % 7 == 0, None).when(key % 5 == 0, "").otherwise(text)
    done = csv.export_csv(table(spark, sf_dir, "customer").select("c_custkey", note.alias("note")), scratch_dir(spark, "export"), "run-1")
    back = csv.read_scoring(spark, done["path"])
    return back.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), F.coalesce("note", F.lit("none")).alias("note"))


@query("""SELECT 'order "'||o_orderkey||'", '||o_orderstatus AS prediction, 'run-1' AS load_id FROM orders""")
def predictions_load_rows(spark, sf_dir):
    """Prediction cells with quotes and commas, row by row."""
    base = scratch_dir(spark, "scores")
    text = F.concat(F.lit('order "'), F.col("o_orderkey").cast("string"), F.lit('", '), F.col("o_orderstatus"))
    scores = table(spark, sf_dir, "orders").select(text.alias("prediction"), F.lit("a,b").alias("extra"))
    scores.write.options(**csv.WRITTEN).option("extension", "out").csv(f"{base}/raw")
    csv.load_predictions(spark, f"{base}/raw", f"{base}/table", "run-1", AS_OF)
    return spark.read.schema(schemas.PREDICTIONS).parquet(f"{base}/table").select("prediction", "load_id")


# --- contract ----------------------------------------------------------------------------


# --- training corpora ----------------------------------------------------------------------


def _prepared(run: Query) -> Query:
    return lambda spark, sf_dir: run(configure(spark), sf_dir)


try:
    import corpus_pipeline
    from recordmill.llm import queries as corpus
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "recordmill.llm", "recordmill.llm.queries"):
        raise
else:
    _QUERIES.update({name: _prepared(run) for name, run in corpus.QUERIES.items()}, pipeline=_prepared(corpus_pipeline.run))
    _SQL.update(corpus.SQL)


def entry(spark: SparkSession) -> DataFrame:
    """Daily metrics per entity, staged from landed JSON."""
    return daily_metrics(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    """Every registered query by name."""
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    """The SQL twin of each query that has one."""
    return dict(_SQL)
