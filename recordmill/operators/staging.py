"""Typed staging of landed records from a list of fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordmill.functions.variants import Field
from recordmill.sources.landing import from_source

ENVELOPE = ["load_id", "file_path", "ingested_at"]


def stage(landing: DataFrame, source: str, fields: Sequence[Field]) -> DataFrame:
    """One source's records as typed columns, followed by the landing envelope.

    A landing table that holds JSON text instead of VARIANT is parsed once per row.
    Missing keys give NULL, extra keys are ignored, text that does not fit a column's
    type fails the job.
    """
    records = from_source(landing, source)
    if dict(records.dtypes)["data"] == "string":
        records = records.withColumn("data", F.parse_json("data"))
    return records.select(*[f.column(F.col("data")) for f in fields], *ENVELOPE)
