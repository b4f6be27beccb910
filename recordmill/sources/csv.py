"""CSV in and out: exports, training files, scoring input and prediction files."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping
from csv import reader
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.sources import files, tables


# Quotes are doubled inside quotes, and an empty text is not the same as no value.
WRITTEN = {"header": "true", "escape": '"', "emptyValue": '""', "nullValue": ""}


def reading(multi_line: bool) -> dict[str, str]:
    """Options to read what :data:`WRITTEN` writes. A text may hold line breaks only with
    ``multi_line``, which reads each file in one task; switch it off for very large files
    without any."""
    return {"header": "true", "escape": '"', "multiLine": str(multi_line).lower()}


def export_csv(df: DataFrame, base: str, run_id: str) -> dict:
    """Write a table with a header line under the run's own folder; no rows, no files."""
    if df.isEmpty():
        return {"status": "SKIPPED", "reason": "no rows to export", "runId": run_id, "path": None}
    path = f"{base.rstrip('/')}/ml/input/{run_id}"
    df.write.options(**WRITTEN).csv(path)
    return {"status": "EXPORTED", "runId": run_id, "path": path, "columns": column_names(df)}


def column_names(df: DataFrame) -> list[str]:
    """Column names in order, ``col_<i>`` for one without a name."""
    return [name or f"col_{i}" for i, name in enumerate(df.columns)]


def _first_lines(batches):
    seen: set[str] = set()
    for batch in batches:
        heads = batch.drop_duplicates("file_path")
        heads = heads[~heads["file_path"].isin(seen)]
        seen.update(heads["file_path"])
        yield heads


def header_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The first line of each file: ``file_path, header``; one text scan, one row per file."""
    lines = spark.read.text(paths).where(F.col("_metadata.file_block_start") == 0)
    return lines.select(F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("header")).mapInPandas(
        _first_lines, "file_path string, header string"
    )


def by_header(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """The files grouped by their header line."""
    groups = defaultdict(list)
    for row in header_lines(spark, paths).orderBy("file_path").collect():
        groups[row.header].append(row.file_path)
    return groups


def read_training(spark: SparkSession, folder: str, types: Mapping[str, str] | None = None, multi_line: bool = True) -> DataFrame:
    """Every ``*.csv`` file of a folder as one frame, stacked by column name.

    Files sharing a header line are read together, so there is one scan per distinct
    header and not one per file. Without ``types`` they are inferred, at the price of one
    more scan, and a column that is text in one file is text in all.
    """
    paths = files.paths_of(files.list_files(spark, folder, "*.csv"))
    if not paths:
        raise FileNotFoundError(f"no CSV files in {folder}")
    groups = by_header(spark, paths).values()
    if types is not None:
        texts = tables.append_columns(*[spark.read.options(**reading(multi_line)).csv(group) for group in groups])
        return texts.select(*[F.col(c).cast(types.get(c, "string")) for c in texts.columns])
    frames = [spark.read.options(**reading(multi_line)).option("inferSchema", "true").csv(group) for group in groups]
    text = {name for frame in frames for name, kind in frame.dtypes if kind == "string"}
    frames = [f.select(*[F.col(c).cast("string") if c in text else F.col(c) for c in f.columns]) for f in frames]
    return tables.append_columns(*frames)


def read_scoring(spark: SparkSession, path: str, content_type: str = "text/csv", multi_line: bool = True) -> DataFrame:
    """Scoring input with a header line, or JSON records."""
    if content_type == "text/csv":
        return spark.read.options(**reading(multi_line)).option("inferSchema", "true").csv(path)
    if content_type == "application/json":
        return spark.read.json(path)
    raise ValueError(f"Unsupported format to read: {content_type}")


def write_scoring(df: DataFrame, path: str, accept: str = "text/csv") -> None:
    """Scoring output with a header line, or JSON records."""
    if accept == "text/csv":
        df.write.options(**WRITTEN).csv(path)
    elif accept == "application/json":
        df.write.json(path)
    else:
        raise ValueError(f"Unsupported format to write: {accept}")


def read_predictions(spark: SparkSession, prefix: str, load_id: str, predicted_at: datetime) -> DataFrame | None:
    """First cells of the ``*.out`` files below a prefix, without blank lines.

    A file's first line is dropped if its first cell is ``prediction``. An empty cell is an
    empty text. Returns ``load_id, predicted_at, prediction`` or None when no file matches.
    """
    found = files.paths_of(files.list_files(spark, prefix, "*.out"))
    if not found:
        return None
    split = {True: [], False: []}
    for header, paths in by_header(spark, found).items():
        split[next(iter(next(reader([header]), [])), None) == "prediction"] += paths
    read = lambda headed: spark.read.schema("prediction string").options(**reading(False) | {"header": str(headed).lower()}).csv(split[headed])
    rows = reduce(DataFrame.unionByName, [read(headed) for headed in split if split[headed]] or [spark.createDataFrame([], "prediction string")])
    return rows.select(
        F.lit(load_id).alias("load_id"),
        F.lit(predicted_at).cast("timestamp").alias("predicted_at"),
        F.coalesce("prediction", F.lit("")).alias("prediction"),
    )


def load_predictions(spark: SparkSession, prefix: str, table_dir: str, load_id: str, predicted_at: datetime) -> dict:
    """Append the predictions of one run to the table and report what was loaded.

    The run's own folder is replaced, so loading it again adds nothing.
    """
    rows = read_predictions(spark, prefix, load_id, predicted_at)
    if rows is None:
        return {"status": "SKIPPED", "reason": "no prediction files below the output path", "rowsLoaded": 0}
    target = f"{table_dir.rstrip('/')}/load_id={load_id}"
    rows.drop("load_id").write.mode("overwrite").parquet(target)
    return {
        "status": "LOADED",
        "loadId": load_id,
        "s3OutputPath": prefix,
        "rowsLoaded": spark.read.parquet(target).count(),
        "filesLoaded": files.list_files(spark, prefix, "*.out").count(),
    }


def _named(state, *path: str):
    """The value at a path of keys, whatever their capitals; None where the path ends early."""
    for key in path:
        if not isinstance(state, Mapping):
            return None
        state = next((value for name, value in state.items() if name.lower() == key.lower()), None)
    return state


def load_of_state(spark: SparkSession, state: Mapping, table_dir: str, predicted_at: datetime, default_id: str) -> dict:
    """:func:`load_predictions` of the scoring output that a run's state names.

    The load is named after the run that exported the input, or ``default_id``. A state
    without an output path loads nothing.
    """
    prefix = _named(state, "transformResult", "transformOutput", "s3OutputPath")
    if not prefix:
        return {"status": "SKIPPED", "reason": "the state names no scoring output", "rowsLoaded": 0}
    run_id = _named(state, "mlExport", "payload", "runId") or default_id
    return load_predictions(spark, prefix, table_dir, run_id, predicted_at)
