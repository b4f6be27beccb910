"""Gradient-boosted models over tables: train, evaluate, save, load, score."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass
from datetime import datetime

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, OneVsRest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.operators import features as feats
from recordmill.session import cut_lineage, shared_dir, spread

MAX_CLASSES = 1_000

# The boosting settings.
BOOSTING = {"maxDepth": 3, "stepSize": 0.1, "seed": 42}
N_ESTIMATORS = 100
ROWS_A_TASK = 250_000  # boosting keeps some 500 bytes a row in memory and reads them for every level of every tree
ROWS_AT_ONCE = 8_000_000  # of all classes' models that are boosted side by side, each with its rows in memory


@dataclass(frozen=True)
class Metadata:
    """What scoring needs besides the fitted stages."""

    target_column: str
    task_type: str
    feature_columns: list[str]
    feature_types: dict[str, str]
    numeric_features: list[str]
    categorical_features: list[str]
    classes: list[str]
    target_type: str
    metrics: dict[str, float]


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    metadata: Metadata


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """How often each truth met each prediction: ``truth, predicted, n``."""
    return df.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def classification_metrics(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """One row ``accuracy, f1_weighted``; everything after the confusion counts is tiny."""
    hit = F.when(F.col("truth").eqNullSafe(F.col("predicted")), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("truth").alias("label"), F.col("n").alias("support"), zero.alias("called"), hit.alias("hits")),
        F.struct(F.col("predicted").alias("label"), zero.alias("support"), F.col("n").alias("called"), zero.alias("hits")),
    )
    per_class = (
        confusion(df, truth, predicted)
        .select(F.inline(sides))
        .groupBy("label")
        .agg(F.sum("support").alias("support"), F.sum("called").alias("called"), F.sum("hits").alias("hits"))
    )
    f1 = 2 * F.col("hits") / (F.col("support") + F.col("called"))
    total = F.sum("support")
    return per_class.agg(
        (F.sum("hits") / total).alias("accuracy"), (F.sum(f1 * F.col("support")) / total).alias("f1_weighted")
    )


def regression_metrics(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """One row ``mae, r2``."""
    y, p = F.col(truth).cast("double"), F.col(predicted).cast("double")
    error = y - p
    return df.agg(
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.sum(error * error) / (F.count(error) * F.var_pop(y))).alias("r2"),
    )


def _classes(df: DataFrame, target: str) -> list[str]:
    found = df.select(F.col(target).cast("string").alias("c")).where(F.col("c").isNotNull()).distinct()
    rows = found.orderBy("c").limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes in '{target}'")
    return [r.c for r in rows]


def _estimator(task_type: str, n_estimators: int, max_depth: int, n_classes: int, n_rows: int):
    settings = {**BOOSTING, "maxIter": n_estimators, "maxDepth": max_depth, "checkpointInterval": 10}
    settings |= {"featuresCol": "_features", "labelCol": "_label"}
    if task_type == "regression":
        return GBTRegressor(predictionCol="_predicted", **settings)
    if n_classes == 2:
        return GBTClassifier(predictionCol="_predicted", **settings)
    each = GBTClassifier(predictionCol="_predicted", **settings)
    side_by_side = min(4, max(1, ROWS_AT_ONCE // max(1, n_rows)))
    return OneVsRest(
        classifier=each, featuresCol="_features", labelCol="_label", predictionCol="_predicted", parallelism=side_by_side
    )


def _labelled(df: DataFrame, target: str, classes: Sequence[str]) -> DataFrame:
    """Add the numeric label; for a classifier the position of the class."""
    if not classes:
        return df.withColumn("_label", F.col(target).cast("double"))
    known = F.array(*[F.lit(c) for c in classes])
    return df.withColumn("_label", (F.array_position(known, F.col(target).cast("string")) - 1).cast("double"))


def train(
    df: DataFrame,
    target: str,
    task_type: str,
    row_key: str,
    n_estimators: int = N_ESTIMATORS,
    max_depth: int = BOOSTING["maxDepth"],
) -> Trained:
    """Fit preprocessing and boosting on 80 % of the rows and measure on the rest.

    ``row_key`` decides the split and is not a feature. A classifier's split is exact per
    class; with more than two classes one model is fitted per class. Rows without a target
    are left out.
    """
    if task_type not in ("classification", "regression"):
        raise ValueError(f"task_type must be 'classification' or 'regression', got {task_type}")
    feats.require_column(df, target)
    shared_dir(df.sparkSession)
    numeric, categorical = feats.split_by_type(df.schema, exclude=[target, row_key])
    features = [c for c in df.columns if c not in (target, row_key)]
    rows = df.where(F.col(target).isNotNull())
    if task_type == "classification":
        rows = cut_lineage(rows)  # classes, cuts and split read it; files are parsed once
    classes = _classes(rows, target) if task_type == "classification" else []
    split = feats.stratified_split(rows, row_key, target) if classes else feats.hash_split(rows, row_key)
    split = cut_lineage(_labelled(split, target, classes))
    train_rows, test_rows = split.where("is_train"), split.where("NOT is_train")
    stages = feats.preprocessing_stages(train_rows, numeric, categorical, "_features")
    estimator = _estimator(task_type, n_estimators, max_depth, len(classes), train_rows.count())
    model = Pipeline(stages=[*stages, estimator]).fit(spread(train_rows, ROWS_A_TASK))
    scored = model.transform(test_rows)
    measure = classification_metrics if classes else regression_metrics
    metrics = measure(scored, "_label", "_predicted").first().asDict()
    types = dict(df.dtypes)
    return Trained(
        model,
        Metadata(
            target_column=target,
            task_type=task_type,
            feature_columns=features,
            feature_types={c: types[c] for c in features},
            numeric_features=numeric,
            categorical_features=categorical,
            classes=classes,
            target_type=types[target],
            metrics={k: float(v) for k, v in metrics.items() if v is not None},
        ),
    )


def save(trained: Trained, folder: str, spark: SparkSession) -> None:
    """Write the fitted stages and their metadata."""
    trained.model.write().overwrite().save(f"{folder}/model")
    line = spark.createDataFrame([(json.dumps(asdict(trained.metadata)),)], "value string")
    line.coalesce(1).write.mode("overwrite").text(f"{folder}/metadata")


def load(spark: SparkSession, folder: str) -> Trained:
    line = spark.read.text(f"{folder}/metadata").first().value
    return Trained(PipelineModel.load(f"{folder}/model"), Metadata(**json.loads(line)))


def predict(trained: Trained, df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Score a table: ``keys, prediction``, the prediction in the target's own values."""
    meta = trained.metadata
    renamed = [F.col(k).alias(f"_key_{k}") for k in keys]
    aligned = feats.align(df.select("*", *renamed), meta.feature_types, keep=[f"_key_{k}" for k in keys])
    scored = trained.model.transform(aligned)
    prediction = F.col("_predicted")
    if meta.classes:
        known = F.array(*[F.lit(c) for c in meta.classes])
        prediction = F.element_at(known, prediction.cast("int") + 1).cast(meta.target_type)
    return scored.select(*[F.col(f"_key_{k}").alias(k) for k in keys], prediction.alias("prediction"))


def score_run(
    trained: Trained, inputs: DataFrame, row_key: str, table_dir: str, load_id: str, predicted_at: datetime
) -> dict:
    """Score the inputs of one run into the predictions table; no inputs, nothing scored.

    The run's folder is replaced, so scoring it again adds nothing.
    """
    if inputs.isEmpty():
        return {"status": "SKIPPED", "reason": "no rows to score", "loadId": load_id, "rowsLoaded": 0}
    rows = predict(trained, inputs, [row_key]).select(
        F.col(row_key).cast("string").alias("row_key"),
        F.col("prediction").cast("string").alias("prediction"),
        F.lit(predicted_at).cast("timestamp").alias("predicted_at"),
    )
    target = f"{table_dir.rstrip('/')}/load_id={load_id}"
    rows.write.mode("overwrite").parquet(target)
    return {"status": "LOADED", "loadId": load_id, "rowsLoaded": inputs.sparkSession.read.parquet(target).count()}
