"""From folders of files to a model, and from input files to files of scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession

from recordmill.operators import boosting
from recordmill.sources import csv


def train_files(
    spark: SparkSession,
    folder: str,
    model_dir: str,
    target: str,
    task_type: str,
    row_key: str,
    types: Mapping[str, str] | None = None,
    **options,
) -> boosting.Trained:
    """Train on every CSV file of a folder and save the model.

    Files may differ in columns and their order. ``options`` are those of :func:`boosting.train`.
    """
    trained = boosting.train(csv.read_training(spark, folder, types), target, task_type, row_key, **options)
    boosting.save(trained, model_dir, spark)
    return trained


def score_files(
    spark: SparkSession, model_dir: str, source: str, output: str, keys: Sequence[str] = (), content_type: str = "text/csv"
) -> None:
    """Score input files with a saved model into ``.out`` files: the prediction first, then ``keys``."""
    scored = boosting.predict(boosting.load(spark, model_dir), csv.read_scoring(spark, source, content_type), keys)
    scored.select("prediction", *keys).write.options(**csv.WRITTEN).option("extension", "out").csv(output)
