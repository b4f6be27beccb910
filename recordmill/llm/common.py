"""Helpers that the corpus operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Rows handed to Python at once. Texts are long, so batches are short: memory of a task is
# this many texts, whatever the table holds.
BATCH_ROWS = 512
BATCH_BYTES = 8 << 20  # of those rows, unless one alone is longer
FEW_ROWS, ROWS_A_FILE = 300_000, 50_000  # of a step


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def short_batches(spark: SparkSession) -> None:
    """Bound the rows and bytes that one Arrow batch carries to Python."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    # a whole group that cogroups hand over may hold long values
    spark.conf.set("spark.sql.execution.arrow.useLargeVarTypes", "true")


def broadcast_bytes(spark: SparkSession, path: str):
    """A vocabulary file, read once by the driver and shared; its size is the tokenizer's own."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def at_most_partitions(spark: SparkSession, rows: int, a_task: int) -> int:
    """Partitions for so many rows: as the session has them, fewer when a task would get less than ``a_task``, never fewer than cores."""
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(usual, max(spark.sparkContext.defaultParallelism, -(-rows // a_task))))


def files_for(rows: int) -> int | None:
    """Files of a step of at most so many rows if they are few, None for a step that is written as its partitions lie.

    On a local disk each file is three processes that set its mode.
    """
    return max(1, -(-rows // ROWS_A_FILE)) if rows <= FEW_ROWS else None


_KEPT: list[tuple[str, Callable]] = []


def kept(values: int) -> Callable[[Callable], Callable]:
    """``lru_cache`` for what tasks of one operator share in a worker; it is dropped once the worker runs another's task."""

    def add(function: Callable) -> Callable:
        cached = lru_cache(values)(function)
        _KEPT.append((function.__module__, cached))
        return cached

    return add


def _drop_others(module: str) -> None:
    for owner, cached in _KEPT:
        if owner != module:
            cached.cache_clear()


def _give_back() -> None:
    """Return freed memory to the machine: a worker outlives its task, and the next stage's tasks need the room."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def map_batches(rows: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``rows.mapInArrow``, giving memory back at the end of each task, and at its start what other operators kept in the worker."""
    module = run.__module__

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _drop_others(module)
        try:
            yield from run(batches)
        finally:
            _give_back()

    return rows.mapInArrow(whole, schema)
