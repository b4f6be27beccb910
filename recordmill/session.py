"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators rely on: naive timestamps mean UTC, and a JSON
# object that repeats a key keeps its last value. The last one lets a join hash its
# smaller side when each of that side's partitions is at most this large, so that wide
# rows on the other side (payloads) are not sorted.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`SETTINGS` to a session somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A single-JVM session for tests and timing; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("recordmill")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting (a test) gets a folder of its own; on a
    cluster a folder of one machine would be read back in part.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not configured and not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(configured or tempfile.mkdtemp(prefix="recordmill-"))
        current = spark.sparkContext.getCheckpointDir()
    return configured or current


_scratch: list[str] = []


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A path under :func:`shared_dir` that nothing else uses."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def drop_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders this program made; call it once its results are written."""
    jvm = spark.sparkContext._jvm
    dropped = 0
    while _scratch:
        path = jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        dropped += path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return dropped


def cut_lineage(df: DataFrame, files: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Later uses see one fixed result, and a lost executor does not bring back the work. With
    ``files`` the rows are dealt to so many tasks first, each of which writes a file: a file
    costs as much as many rows, so a step of few rows should not be one a partition. They are
    dealt, not coalesced: a task that ran many partitions' joins would hold all their tables.
    """
    path = scratch_dir(df.sparkSession, "step")
    df = df.repartition(files) if files else df
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, rows_a_task: int | None = None) -> DataFrame:
    """At least one partition per core, and with ``rows_a_task`` none much larger than that, for work that passes over the rows many times or makes them much wider."""
    wanted = df.sparkSession.sparkContext.defaultParallelism
    if rows_a_task:
        wanted = max(wanted, -(-df.count() // rows_a_task))
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df
