"""Inputs for the registered queries, derived row by row from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.plans import markets, repos
from recordmill.session import spread

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events on all cores: a file of few megabytes is one task, but the texts made of its rows are many times as large."""
    return spread(table(spark, sf_dir, "events"))


def k_of(props: str | Column) -> Column:
    """The integer ``k`` of an event's properties, read like any landed integer."""
    return F.variant_get(F.parse_json(props), "$.k", "string").cast("int")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the landing envelope, one load per day and one file per source and day."""
    events = table(spark, sf_dir, "events")
    day = F.date_format("ts", "yyyy/MM/dd")
    return events.select(
        F.date_format("ts", "yyyy-MM-dd").alias("load_id"),
        F.col("event_type").alias("source"),
        F.concat(F.lit("raw/"), "event_type", F.lit("/"), day, F.lit("/000000.ndjson")).alias("file_path"),
        F.col("ts").alias("ingested_at"),
        F.col("props").alias("data"),
        "event_id",
        "user_id",
        "value",
    )


def repo_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a repository record each, as JSON text in ``data``."""
    events = _events(spark, sf_dir).withColumn("k", k_of("props"))
    iso = F.date_format("ts", ISO)
    owner = F.struct(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("login"),
        F.col("user_id").alias("id"),
        F.lit("User").alias("type"),
    )
    licence = F.when(F.col("event_type") != "view", F.struct(F.lit("MIT").alias("spdx_id")))
    name = F.concat(F.lit("repo-"), F.col("user_id").cast("string"))
    record = F.struct(
        F.col("user_id").alias("id"),
        name.alias("name"),
        F.concat("event_type", F.lit("/"), name).alias("full_name"),
        F.when(F.col("event_type") != "error", F.lit('a "quoted" text')).alias("description"),
        F.col("event_type").alias("language"),
        F.col("k").alias("stargazers_count"),
        F.col("value").cast("int").alias("forks_count"),
        F.col("k").cast("string").alias("watchers_count"),
        F.length("event_type").alias("open_issues_count"),
        F.col("event_id").alias("size"),
        F.lit("main").alias("default_branch"),
        F.array(F.col("event_type"), F.lit("x")).alias("topics"),
        iso.alias("created_at"),
        iso.alias("updated_at"),
        iso.alias("pushed_at"),
        owner.alias("owner"),
        F.concat(F.lit("https://example.org/"), name).alias("html_url"),
        licence.alias("license"),
    )
    return events.withColumn("data", F.to_json(record, {"ignoreNullFields": "false"}))


def repo_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as landed repository records; purchases belong to another source."""
    return repo_records(spark, sf_dir).select(
        F.date_format("ts", "yyyy-MM-dd").alias("load_id"),
        F.when(F.col("event_type") == "purchase", "other").otherwise(repos.SOURCE).alias("source"),
        F.concat(F.lit("raw/"), "event_type").alias("file_path"),
        F.col("ts").alias("ingested_at"),
        "data",
    )


def repo_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a page with one repository record, a user's events as one run."""
    return repo_records(spark, sf_dir).select(
        F.lit(repos.SOURCE).alias("source"),
        F.col("user_id").cast("string").alias("run_id"),
        F.col("event_id").alias("page_no"),
        F.concat(F.lit('{"items":['), "data", F.lit("]}")).alias("payload"),
    )


def market_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as landed market records, prices as JSON numbers."""
    part = table(spark, sf_dir, "part")
    price = F.col("p_retailprice")
    record = F.struct(
        F.concat(F.lit("c"), F.col("p_partkey").cast("string")).alias("id"),
        F.col("p_brand").alias("symbol"),
        F.col("p_name").alias("name"),
        price.alias("current_price"),
        (price * 1000).alias("market_cap"),
        (F.col("p_partkey") + 1).alias("market_cap_rank"),
        F.when(F.col("p_type") != "ECONOMY", price).alias("fully_diluted_valuation"),
        F.col("p_size").alias("total_volume"),
        price.cast("string").alias("high_24h"),
        price.alias("low_24h"),
        F.lit(-0.125).alias("price_change_24h"),
        F.lit(1e-7).alias("price_change_percentage_24h"),
        (F.col("p_size") * 1000).alias("circulating_supply"),
        F.when(F.col("p_size") % 2 == 0, F.col("p_size") * 2000).alias("total_supply"),
        (price * 3).alias("ath"),
        F.lit("2021-11-10T14:24:11.849Z").alias("ath_date"),
        F.lit("2024-01-31T00:00:00.000Z").alias("last_updated"),
    )
    return part.select(
        F.lit("load").alias("load_id"),
        F.lit(markets.SOURCE).alias("source"),
        F.lit("raw/file").alias("file_path"),
        F.lit("2024-01-31 00:00:00").cast("timestamp_ntz").alias("ingested_at"),
        F.to_json(record, {"ignoreNullFields": "false"}).alias("data"),
    )


def page_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as one page holding ``k`` records, a user's events as one run."""
    events = _events(spark, sf_dir).withColumn("k", k_of("props"))
    items = F.when(
        F.col("k") > 0,
        F.transform(F.sequence(F.lit(1), F.greatest("k", F.lit(1))), lambda i: F.struct(F.col("event_id").alias("page"), i.alias("item"))),
    ).otherwise(F.array().cast("array<struct<page:bigint,item:int>>"))
    cursor = F.when(F.col("event_type") != "error", F.concat(F.lit("c"), F.col("event_id").cast("string")))
    payload = F.struct(F.struct(items.alias("items")).alias("body"), cursor.alias("next_cursor"))
    return events.select(
        F.lit("events_api").alias("source"),
        F.col("user_id").cast("string").alias("run_id"),
        F.col("event_id").alias("page_no"),
        F.to_json(payload, {"ignoreNullFields": "false"}).alias("payload"),
    )


def run_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as the nested state of one finished run.

    Runs of type ``error`` failed, ``view`` names no source, ``signup`` has an unreadable
    start, ``click`` ran without a gate result.
    """
    events = _events(spark, sf_dir).withColumn("k", k_of("props"))
    kind = F.col("event_type")
    micros = (F.col("value") * 1e6 + 4000).cast("decimal(20,0)").cast("bigint")
    begun = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) - micros)
    cut = F.when(kind == "signup", F.col("k"))
    ingest = F.struct(F.struct(F.col("k").alias("recordCount"), cut.alias("truncatedRuns")).alias("Payload"))
    load = F.struct(
        F.struct(
            F.when(kind != "view", F.col("event_id")).alias("rowsLoaded"), F.lit("LOADED").alias("status")
        ).alias("Payload")
    )
    quality = F.struct(
        (kind != "error").alias("passed"),
        F.lit(6).alias("totalChecks"),
        F.when(kind == "error", F.col("k")).otherwise(0).alias("errorCount"),
        F.lit(1).alias("warnCount"),
    )
    state = F.struct(
        F.when(kind != "view", kind).alias("source_name"),
        (kind == "purchase").alias("ml_enabled"),
        ingest.alias("ingestResult"),
        F.when(kind != "click", load).alias("loadResult"),
        F.when(kind == "purchase", F.struct(F.struct(F.col("k").alias("rowsLoaded")).alias("Payload"))).alias("mlLoadResult"),
        F.when(kind != "click", quality).alias("qualityResult"),
        F.when(kind == "error", F.struct(F.lit("States.TaskFailed").alias("Error"))).alias("errorInfo"),
        F.when(kind == "click", F.struct(F.when(F.col("k") > 50, "warn").otherwise("pass").alias("status"))).alias("freshnessResult"),
    )
    return events.select(
        F.col("event_id").cast("string").alias("run_id"),
        F.when(kind == "error", "FAILURE").otherwise("SUCCESS").alias("status"),
        F.when(kind == "signup", "not a date").otherwise(F.date_format(begun, ISO)).alias("started_at"),
        F.col("ts").alias("ended_at"),
        F.to_json(state, {"ignoreNullFields": "false"}).alias("state"),
    )


def load_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as the state a load starts from: nested stage result, empty one, or none."""
    kind = F.col("event_type")
    inner = F.when(kind == "signup", F.to_json(F.struct(F.col("props").alias("s3Key")))).when(
        kind == "error", "{}"
    ).when(kind != "view", F.to_json(F.struct(kind.alias("source"), F.col("props").alias("s3Key"))))
    nested = F.concat(F.lit(',"ingestResult":{"Payload":'), inner, F.lit("}"))
    top = F.concat(F.lit('"source":"top-'), kind, F.lit('"'))
    return table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit("{"), top, F.coalesce(nested, F.lit("")), F.lit("}")).alias("state")
    )
