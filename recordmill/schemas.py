"""Table layouts and the empty relations that stand in for tables not built yet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

LANDING = T.StructType(
    [
        T.StructField("load_id", T.StringType(), False),
        T.StructField("file_path", T.StringType(), False),
        T.StructField("ingested_at", T.TimestampType(), False),
        T.StructField("data", T.VariantType(), False),
        T.StructField("attempt", T.StringType(), False),
        T.StructField("source", T.StringType(), False),
        T.StructField("ingest_date", T.DateType(), False),
    ]
)

# One row per raw file of a landing write, and the lines of the landing table's commits.
LANDED_FILES = T.StructType(
    [
        T.StructField("load_id", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("load_date", T.DateType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("last", T.TimestampType()),
        T.StructField("attempt", T.StringType()),
    ]
)
LANDING_COMMITS = T.StructType(
    [
        T.StructField("owner", T.StringType()),
        T.StructField("batch", T.StringType()),
        T.StructField("attempt", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("sources", T.LongType()),  # how many the attempt has
        T.StructField("rows", T.LongType()),
        T.StructField("files", T.LongType()),
        T.StructField("newest", T.StringType()),
    ]
)

PREDICTIONS = T.StructType(
    [
        T.StructField("row_key", T.StringType()),
        T.StructField("prediction", T.StringType()),
        T.StructField("predicted_at", T.TimestampType(), False),
        T.StructField("load_id", T.StringType(), False),
    ]
)

CHECK_RESULTS = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("passed", T.BooleanType()),
        T.StructField("details", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)

RUN_STATES = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("started_at", T.StringType()),
        T.StructField("ended_at", T.TimestampType(), False),
        T.StructField("state", T.StringType(), False),
    ]
)

# The columns of the two placeholder relations.
INFERENCE_INPUT = T.StructType([T.StructField("placeholder_column", T.StringType())])
TRAINING_DATA = T.StructType(
    [T.StructField("placeholder_column", T.StringType()), T.StructField("target", T.StringType())]
)

# The namespaces of the warehouse.
NAMESPACES = ["raw", "staging", "intermediate", "marts", "ml"]


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A typed relation without rows."""
    return spark.createDataFrame([], schema)


def create_namespaces(spark: SparkSession) -> None:
    for name in NAMESPACES:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def create_table(spark: SparkSession, name: str, schema: T.StructType, partitions: list[str] | None = None) -> None:
    """Create a Parquet table unless it is there already."""
    if spark.catalog.tableExists(name):
        return
    writer = empty(spark, schema).write.format("parquet")
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.saveAsTable(name)


def create_tables(spark: SparkSession) -> None:
    """The landing and predictions tables and the two placeholder relations."""
    create_namespaces(spark)
    create_table(spark, "raw.landing", LANDING, ["attempt", "source", "ingest_date"])
    create_table(spark, "marts.ml_predictions", PREDICTIONS, ["load_id"])
    create_table(spark, "marts.ml_inference_input", INFERENCE_INPUT)
    create_table(spark, "marts.ml_training_data", TRAINING_DATA)
