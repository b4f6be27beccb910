"""Latest row per key and dimension tables.

Kept tables lie in buckets of the key's hash, copied on write: a change rewrites the buckets it
has news for.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from recordmill.session import cut_lineage
from recordmill.sources.parts import Snapshot, named

BUCKET = "bucket"
BUCKETS = 64  # of a new table; choose so that one is a few files' size


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    newest: str = "ingested_at",
    tie_breakers: Sequence[str] = ("load_id", "file_path"),
) -> DataFrame:
    """The newest row of each key; ties go to the largest tie breakers, then by the row's hash.

    The rank filter is applied in each task before the shuffle, so a key seen in most of
    the rows sends one row per task.
    """
    told = [c for c, kind in df.dtypes if "variant" not in kind and "map<" not in kind]
    order = [F.desc(newest), *[F.desc(c) for c in tie_breakers], F.desc(F.xxhash64(*told))]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def dimension(latest: DataFrame, columns: Sequence[str], refreshed_from: str = "ingested_at") -> DataFrame:
    """The descriptive columns of the latest rows and when they were seen."""
    return latest.select(*columns, F.col(refreshed_from).alias("dim_refreshed_at"))


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket a key lies in."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def read_kept(spark: SparkSession, path: str) -> DataFrame | None:
    """A kept table as last committed, None before the first change."""
    rows = Snapshot(spark, path, BUCKET).read()
    return None if rows is None else rows.drop(BUCKET)


def keep_latest(spark: SparkSession, news: DataFrame, path: str, keys: Sequence[str], buckets: int = BUCKETS, **order) -> list[str]:
    """Merge new rows into the kept latest rows; returns the buckets that were rewritten.

    News are cut to one row a key before anything stored is read, and only the buckets of
    these keys are. The number of buckets is fixed by the first change.
    """
    now = Snapshot(spark, path, BUCKET)
    buckets = now.settings.get("buckets", buckets)
    newest = cut_lineage(latest_per_key(news, keys, **order).withColumn(BUCKET, bucket_of(keys, buckets)))
    touched = named([r[0] for r in newest.select(BUCKET).distinct().collect()])  # at most ``buckets``
    if touched:
        old = now.read(touched)
        merged = newest if old is None else latest_per_key(old.unionByName(newest, allowMissingColumns=True), keys, **order)
        now.replace(merged, touched, {"buckets": buckets}, unique=[list(keys)])
    return touched


def keep_derived(
    spark: SparkSession, path: str, source_path: str, derive: Callable[[DataFrame], DataFrame], keys: Sequence[str], touched: Sequence[str] | None = None
) -> list[str]:
    """Rewrite the buckets of a table that is derived row by row from a kept one.

    Without ``touched`` all buckets, for a table that is new or whose rule has changed. Returns the buckets.
    """
    source, now = Snapshot(spark, source_path, BUCKET), Snapshot(spark, path, BUCKET)
    wanted = [p for p in source.parts if touched is None or p in touched or p not in now.parts]
    if wanted:
        now.replace(derive(source.read(wanted)), wanted, {"buckets": source.settings["buckets"]}, unique=[list(keys)])
    return wanted


def read_buckets(spark: SparkSession, path: str, buckets: Sequence[str]) -> DataFrame | None:
    """Some buckets of a kept table."""
    rows = Snapshot(spark, path, BUCKET).read(buckets)
    return None if rows is None else rows.drop(BUCKET)
