"""Daily facts and their incremental upsert.

A fact table is copied on write by day (:mod:`recordmill.sources.parts`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.session import cut_lineage
from recordmill.sources import tables
from recordmill.sources.parts import Snapshot, named

DAY = "metric_date"
FLOOR = "1900-01-01"


def daily_metrics(staged: DataFrame, key: str, maxima: Sequence[str]) -> DataFrame:
    """Per key and UTC day: the maximum of each measure, row count, last sighting."""
    return staged.groupBy(key, F.to_date("ingested_at").alias("metric_date")).agg(
        *[F.max(c).alias(c) for c in maxima],
        F.count(F.lit(1)).alias("observation_count"),
        F.max("ingested_at").alias("last_observed_at"),
    )


def high_water(fact: DataFrame, lookback_days: int = 0) -> DataFrame:
    """One row: the newest day in the fact table, less an optional look-back."""
    newest = F.coalesce(F.max("metric_date"), F.to_date(F.lit(FLOOR)))
    return fact.agg(F.date_sub(newest, lookback_days).alias("high_water"))


def since_high_water(rows: DataFrame, day: str, fact: DataFrame | None, lookback_days: int = 0) -> DataFrame:
    """Rows of the newest loaded day and later; all rows on the first run.

    The bound is a scalar subquery, so on a partition column it prunes folders at run time.
    """
    if fact is None:
        return rows
    return rows.where(F.col(day) >= high_water(fact, lookback_days).scalar())


def replace_by_key(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in the batch, then the batch; new columns are added. A NULL in a key is a value like others."""
    given = batch.select(*[F.col(k).alias(f"_key_{k}") for k in keys])
    same = [target[k].eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    kept = target.join(given, same, "left_anti")
    return tables.append_columns(kept, batch)


def read_fact(spark: SparkSession, path: str) -> DataFrame | None:
    """The fact table as last committed, None before the first run.

    Columns come from the commit; one that older days lack is NULL there. A filter on
    ``metric_date`` prunes folders.
    """
    return Snapshot(spark, path, DAY).read()


def has_taken(spark: SparkSession, path: str, writer: str | None, batch_id: int | None) -> bool:
    """Whether the table holds the writer's batch, or a newer one, already."""
    return Snapshot(spark, path, DAY).has_taken(writer, batch_id)


def upsert_days(
    spark: SparkSession, batch: DataFrame, path: str, keys: Sequence[str], writer: str | None = None, batch_id: int | None = None
) -> bool:
    """Merge daily rows into the fact table by ``keys``, writing new folders for the days the batch has.

    Rows of those days that the batch does not replace are kept. Folders of other days stay
    as they are. The new folders count from one commit on; an upsert that ends before it
    leaves the table as it was, and one that another upsert overtook fails. ``batch`` should
    already be bounded by :func:`since_high_water`; it is far smaller than the rows behind
    it and is computed once. With ``writer`` a ``batch_id`` that is not newer than the
    writer's last one changes nothing; returns whether the table changed.
    """
    now = Snapshot(spark, path, DAY)
    if now.has_taken(writer, batch_id):
        return False
    batch = cut_lineage(batch)
    days = named([r[0] for r in batch.select(DAY).distinct().collect()])  # one row a day, of the calendar's size
    old = now.read(days) if days else None
    now.replace(batch if old is None else replace_by_key(old, batch, keys), days, writer=writer, batch_id=batch_id, unique=[list(keys)] if DAY in keys else [])
    return bool(days) or writer is not None


def drop_unseen(spark: SparkSession, path: str) -> int:
    """Delete the folders that the newest commit does not point at; call it when nobody reads or writes an older one."""
    return Snapshot(spark, path, DAY).drop_unseen()
