"""How a model's rows are kept: as a view, inlined, as a full table or by upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from recordmill.operators import facts
from recordmill.sources import tables

# The default of each layer; a layer's name is also its namespace.
LAYER_DEFAULTS = {"staging": "view", "intermediate": "ephemeral", "marts": "table"}


def materialize(
    df: DataFrame, layer: str, name: str, base: str, how: str | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """Keep a model's rows and return the relation later models read.

    ``view`` and ``ephemeral`` are inlined by the optimizer, the former under a name SQL
    can use. ``table`` writes a new version. ``incremental`` upserts the days of ``df`` by
    ``keys``; bound ``df`` with :func:`recordmill.operators.facts.since_high_water` first.
    """
    spark = df.sparkSession
    how = how or LAYER_DEFAULTS[layer]
    path = f"{base.rstrip('/')}/{layer}/{name}"
    if how == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if how == "ephemeral":
        return df
    if how == "table":
        return spark.read.schema(df.schema).parquet(tables.publish(df, path))
    if how == "incremental":
        facts.upsert_days(spark, df, path, keys)
        return facts.read_fact(spark, path)
    raise ValueError(f"unknown materialization: {how}")
