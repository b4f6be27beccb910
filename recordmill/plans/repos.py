"""Code repositories: staging, latest row, dimension and daily fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recordmill.functions.variants import Field
from recordmill.operators import data_tests, facts, latest
from recordmill.operators.staging import stage

# Source name, columns, JSON paths and types of the records.
SOURCE = "github_trending_repos"
FIELDS = [
    Field("repo_id", "id", "bigint"),
    Field("repo_name", "name"),
    Field("full_name", "full_name"),
    Field("description", "description"),
    Field("language", "language"),
    Field("star_count", "stargazers_count", "int"),
    Field("fork_count", "forks_count", "int"),
    Field("watcher_count", "watchers_count", "int"),
    Field("open_issue_count", "open_issues_count", "int"),
    Field("size_kb", "size", "int"),
    Field("default_branch", "default_branch"),
    Field("topics", "topics", "array<string>"),
    Field("repo_created_at", "created_at", "timestamp"),
    Field("repo_updated_at", "updated_at", "timestamp"),
    Field("repo_pushed_at", "pushed_at", "timestamp"),
    Field("owner_login", "owner.login"),
    Field("owner_id", "owner.id", "bigint"),
    Field("owner_type", "owner.type"),
    Field("html_url", "html_url"),
    Field("homepage_url", "homepage"),
    Field("license_spdx", "license.spdx_id"),
]
DIMENSION_COLUMNS = [
    "repo_id",
    "repo_name",
    "full_name",
    "owner_login",
    "owner_id",
    "owner_type",
    "language",
    "license_spdx",
    "description",
    "homepage_url",
    "html_url",
    "default_branch",
    "topics",
    "repo_created_at",
    "repo_updated_at",
]
DAILY_MAXIMA = ["star_count", "fork_count", "watcher_count", "open_issue_count"]
FACT_KEY = ["repo_id", "metric_date"]


def staged(landing: DataFrame) -> DataFrame:
    return stage(landing, SOURCE, FIELDS)


def latest_repos(landing: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """The newest row per repository, starting from the ones ``known`` so far, if any."""
    rows = staged(landing)
    return latest.latest_per_key(rows if known is None else known.unionByName(rows), ["repo_id"])


def dim_repos(latest_rows: DataFrame) -> DataFrame:
    return latest.dimension(latest_rows, DIMENSION_COLUMNS)


def keep_repos(spark: SparkSession, landing: DataFrame, latest_dir: str, dimension_dir: str) -> list[str]:
    """Take landed rows into the kept latest rows and the dimension; returns the buckets that were rewritten.

    A build that ended between the two has to be given the same rows again.
    """
    touched = latest.keep_latest(spark, staged(landing), latest_dir, ["repo_id"])
    bucketed = lambda rows: latest.dimension(rows, [*DIMENSION_COLUMNS, latest.BUCKET])
    return latest.keep_derived(spark, dimension_dir, latest_dir, bucketed, ["repo_id"], touched)


def daily_repo_metrics(landing: DataFrame) -> DataFrame:
    return facts.daily_metrics(staged(landing), "repo_id", DAILY_MAXIMA)


def staging_rules() -> data_tests.Rules:
    """Rules the staged repositories must meet before anything is built on them."""
    return data_tests.rules(
        ["repo_id", "owner_login", "star_count", "fork_count", "repo_created_at", "load_id", "ingested_at"],
        {"star_count": 0, "fork_count": 0},
    )


def dimension_rules() -> data_tests.Rules:
    return data_tests.rules(
        ["repo_id", "owner_login", "repo_name", "dim_refreshed_at"],
        sets={"unique(repo_id)": lambda df: data_tests.unique(df, "repo_id")},
    )


def fact_rules(dimension: DataFrame) -> data_tests.Rules:
    return data_tests.rules(
        ["repo_id", "metric_date", "star_count", "fork_count"],
        {"star_count": 0, "fork_count": 0},
        {
            "relationships(repo_id)": lambda df: data_tests.orphan_keys(df, "repo_id", dimension, "repo_id"),
            "unique_combination(repo_id, metric_date)": lambda df: data_tests.unique_combination(df, FACT_KEY),
        },
    )
