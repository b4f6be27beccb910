from datetime import datetime

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordmill.operators import boosting, features
from recordmill.sources import csv, tables

AT = datetime(2024, 1, 1)


def table(spark, n=600):
    return spark.range(n).select(
        F.col("id").alias("key"),
        F.when(F.col("id") % 11 != 0, (F.col("id") % 50).cast("double")).alias("x"),
        F.when(F.col("id") % 13 != 0, F.element_at(F.array(F.lit("a'\\"), F.lit("b"), F.lit("c")), (F.col("id") % 3 + 1).cast("int"))).alias("kind"),
        (F.col("id") % 2 == 0).alias("flag"),
        F.lit(None).cast("double").alias("void"),
        F.lit(4.0).alias("constant"),
        F.when(F.col("id") % 50 > 25, "yes").otherwise("no").alias("label"),
        ((F.col("id") % 50) * 2.0 + 1).alias("amount"),
    )


def test_column_types(spark):
    schema = T.StructType.fromDDL("a int, b string, c boolean, d decimal(5,2), e timestamp, y double")
    assert features.split_by_type(schema, ["y"]) == (["a", "d"], ["b", "c", "e"])


def test_missing_target():
    class Frame:
        columns = ["a", "b"]

    with pytest.raises(ValueError, match=r"'y' not found. Available: \['a', 'b'\]"):
        features.require_column(Frame, "y")


def test_align(spark):
    df = spark.createDataFrame([(1, 2, "x")], "b int, extra int, k string")
    got = features.align(df, {"a": "double", "b": "bigint"}, keep=["k"])
    assert got.columns == ["k", "a", "b"] and tuple(got.first()) == ("x", None, 1)


def test_scaling_matches_population_figures(spark):
    df = table(spark)
    x = np.array([r.x if r.x is not None else np.nan for r in df.select("x").collect()])
    filled = np.where(np.isnan(x), np.nanmedian(x), x)
    got = {s.column: s for s in features.fit_scaling(df, ["x", "void", "constant"])}
    assert set(got) == {"x", "constant"}
    assert np.allclose([got["x"].median, got["x"].mean, got["x"].deviation], [np.nanmedian(x), filled.mean(), filled.std()])
    assert got["constant"].deviation == 1.0


def test_preprocessing(spark):
    df = table(spark)
    model = features.preprocess(df, ["x", "void", "constant"], ["kind", "flag"])
    odd = df.limit(2).withColumn("kind", F.lit("never seen")).withColumn("flag", F.lit(None).cast("boolean"))
    rows = model.transform(odd).select(vector_to_array("features").alias("f")).collect()
    assert all(len(r.f) == 2 + 3 + 2 for r in rows)
    assert all(r.f[2:5] == [0.0, 0.0, 0.0] and r.f[5:] == [1.0, 0.0] for r in rows)  # unseen; filled with 'false'


def test_too_many_categories_is_an_error(spark):
    exact = spark.range(100).select(F.col("id").cast("string").alias("s"), F.lit("x").alias("t"))
    features.check_categories(exact, ["s", "t"], limit=100)
    with pytest.raises(ValueError, match="'s': 100"):
        features.check_categories(exact, ["s", "t"], limit=99)
    with pytest.raises(ValueError, match="too many categories"):
        features.check_categories(spark.range(100).select(F.col("id").cast("string").alias("s")), ["s"], limit=10)


def test_train_save_load_score(spark, scratch):
    rows = table(spark).drop("amount")
    trained = boosting.train(rows, "label", "classification", "key", n_estimators=5)
    assert trained.metadata.classes == ["no", "yes"]
    assert trained.metadata.feature_columns == ["x", "kind", "flag", "void", "constant"]
    assert trained.metadata.metrics["accuracy"] > 0.9
    boosting.save(trained, scratch, spark)
    again = boosting.load(spark, scratch)
    assert again.metadata == trained.metadata
    partial = rows.drop("label", "flag").withColumn("more", F.lit(1))
    got = boosting.predict(again, partial, ["key"])
    assert got.columns == ["key", "prediction"] and got.count() == 600
    truth = got.join(rows, "key").where(F.col("x").isNotNull())
    assert truth.where("prediction = label").count() > 0.9 * truth.count()


def test_three_classes_and_regression(spark, scratch):
    rows = table(spark).withColumn("label", F.when(F.col("x") > 40, 3).when(F.col("x") > 20, 2).otherwise(1)).drop("amount", "void")
    trained = boosting.train(rows, "label", "classification", "key", n_estimators=3)
    assert set(r.prediction for r in boosting.predict(trained, rows).distinct().collect()) == {1, 2, 3}
    assert dict(boosting.predict(trained, rows).dtypes)["prediction"] == "int"
    boosting.save(trained, scratch, spark)
    assert boosting.predict(boosting.load(spark, scratch), rows).count() == 600
    numbers = table(spark).drop("label", "void")
    fitted = boosting.train(numbers, "amount", "regression", "key", n_estimators=20)
    assert fitted.metadata.metrics["r2"] > 0.7
    with pytest.raises(ValueError, match="task_type"):
        boosting.train(numbers, "amount", "ranking", "key")


def test_score_run_is_repeatable_and_skips_empty_input(spark, scratch):
    numbers = table(spark).select("key", "x", "amount")
    fitted = boosting.train(numbers, "amount", "regression", "key", n_estimators=2)
    for _ in range(2):
        assert boosting.score_run(fitted, numbers, "key", scratch, "r1", AT)["rowsLoaded"] == 600
    assert boosting.score_run(fitted, numbers.limit(0), "key", scratch, "r2", AT)["status"] == "SKIPPED"
    assert spark.read.parquet(scratch).count() == 600


def test_metrics(spark):
    df = spark.createDataFrame([("a", "a")] * 3 + [("a", "b")] + [("b", "b")] * 2 + [("c", "a")], "t string, p string")
    row = boosting.classification_metrics(df, "t", "p").first()
    f1 = {"a": 2 * 3 / (4 + 4), "b": 2 * 2 / (2 + 3), "c": 0.0}
    assert np.allclose([row.accuracy, row.f1_weighted], [5 / 7, (4 * f1["a"] + 2 * f1["b"]) / 7])
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 4.0)], "y double, p double")
    row = boosting.regression_metrics(df, "y", "p").first()
    assert np.allclose([row.mae, row.r2], [2 / 3, 1 - 2 / 8])


def test_users_own_model(spark):
    got = features.predict_with(
        spark.createDataFrame([(1, 2.0), (2, 3.0)], "k int, x double"), lambda: 10, lambda m, rows: rows["x"] * m, ["k"], ["x"]
    )
    assert sorted(map(tuple, got.collect())) == [(1, 20.0), (2, 30.0)]


def test_csv_export_and_skip(spark, scratch):
    df = spark.createDataFrame([(1, "a,b"), (2, 'q"x')], "id int, s string")
    done = csv.export_csv(df, scratch, "r1")
    assert done["path"].endswith("/ml/input/r1") and done["columns"] == ["id", "s"]
    assert csv.export_csv(df.limit(0), scratch, "r2")["status"] == "SKIPPED"
    assert not tables.path_exists(spark, f"{scratch}/ml/input/r2")


def test_training_files(spark, scratch):
    with pytest.raises(Exception):
        csv.read_training(spark, f"{scratch}/none")
    spark.createDataFrame([(1, 2.5)], "a int, b double").write.option("header", "true").csv(f"{scratch}/t/1")
    spark.createDataFrame([("x", 7)], "c string, a int").write.option("header", "true").csv(f"{scratch}/t/2")
    spark.createDataFrame([(5, "y")], "a int, b string").write.option("header", "true").csv(f"{scratch}/t/3")
    got = {tuple(r) for r in csv.read_training(spark, f"{scratch}/t").select("a", "b", "c").collect()}
    assert got == {(1, "2.5", None), (7, None, "x"), (5, "y", None)}
    typed = csv.read_training(spark, f"{scratch}/t", {"a": "bigint"})
    assert dict(typed.dtypes) == {"a": "bigint", "b": "string", "c": "string"} and typed.count() == 3


@pytest.mark.parametrize("kind", ["text/csv", "application/json"])
def test_scoring_formats(spark, scratch, kind):
    df = spark.createDataFrame([(1.5,), (2.5,)], "prediction double")
    csv.write_scoring(df, scratch, kind)
    assert sorted(r.prediction for r in csv.read_scoring(spark, scratch, kind).collect()) == [1.5, 2.5]
    with pytest.raises(ValueError, match="Unsupported"):
        csv.read_scoring(spark, scratch, "text/xml")
    with pytest.raises(ValueError, match="Unsupported"):
        csv.write_scoring(df, scratch + "x", "text/xml")


def test_prediction_files(spark, scratch):
    df = spark.createDataFrame([("0.5", "x"), ("0.7", "y")], "prediction string, other string")
    df.coalesce(1).write.option("header", "true").option("extension", "out").csv(f"{scratch}/out")
    df.coalesce(1).write.mode("append").option("extension", "out").csv(f"{scratch}/out")
    df.write.mode("append").csv(f"{scratch}/out")
    for _ in range(2):
        assert csv.load_predictions(spark, f"{scratch}/out", f"{scratch}/t", "r1", AT)["rowsLoaded"] == 4
    assert spark.read.parquet(f"{scratch}/t").count() == 4
    spark.range(1).write.csv(f"{scratch}/empty")
    assert csv.load_predictions(spark, f"{scratch}/empty", f"{scratch}/t", "r2", AT)["status"] == "SKIPPED"


def test_predictions_are_loaded_by_run_state(spark, scratch):
    df = spark.createDataFrame([("a",), ("b",)], "prediction string")
    for part in range(2):
        df.coalesce(1).write.mode("append").option("header", "true").option("extension", "out").csv(f"{scratch}/out")
    for told in ({"TransformOutput": {"S3OutputPath": f"{scratch}/out"}}, {"transformOutput": {"s3OutputPath": f"{scratch}/out"}}):
        done = csv.load_of_state(spark, {"transformResult": told}, f"{scratch}/t", AT, "own")
        assert (done["status"], done["loadId"], done["rowsLoaded"], done["filesLoaded"]) == ("LOADED", "own", 4, 2)
    named = {"transformResult": told, "mlExport": {"Payload": {"runId": "r9"}}}
    assert csv.load_of_state(spark, named, f"{scratch}/t", AT, "own")["loadId"] == "r9"
    for state in ({}, {"transformResult": None}, {"transformResult": {"TransformOutput": {}}}):
        assert csv.load_of_state(spark, state, f"{scratch}/t", AT, "own")["status"] == "SKIPPED"


def test_a_rule_is_learned_whole(spark):
    rows = table(spark).select("key", "x", "kind", F.expr("CASE WHEN kind = 'c' THEN 9 WHEN flag THEN 5 ELSE 1 END").alias("target"), "flag").fillna("b", ["kind"])
    rows = rows.withColumn("target", F.expr("CASE WHEN kind = 'c' THEN 9 WHEN flag THEN 5 ELSE 1 END"))
    fitted = boosting.train(rows, "target", "classification", "key", n_estimators=3)
    assert fitted.metadata.metrics == {"accuracy": 1.0, "f1_weighted": 1.0}
    assert boosting.predict(fitted, rows, ["key"]).join(rows, "key").where("prediction <> target").isEmpty()
    amounts = boosting.train(rows, "target", "regression", "key", n_estimators=3)
    assert amounts.metadata.metrics["mae"] < 1e-9 and amounts.metadata.metrics["r2"] > 1 - 1e-9


def test_prediction_files_lose_nothing_but_header_lines(spark, scratch):
    for headed in (True, False):
        lines = ["prediction,other"] * headed + ["0.5,a", ",b", "prediction,c"]
        spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.mode("append").option("extension", "out").text(f"{scratch}/t{headed}")
        spark.read.text(f"{scratch}/t{headed}").coalesce(1).write.mode("append").option("quote", "").option("sep", "\x01").option("extension", "out").csv(f"{scratch}/out")
    got = csv.read_predictions(spark, f"{scratch}/out", "r1", AT)
    assert sorted(r.prediction for r in got.collect()) == ["", "", "0.5", "0.5", "prediction", "prediction"]


def test_registered_trainings_boost_the_default_trees(spark, monkeypatch):
    import __spark_entry__ as entry

    asked = []

    def train(*args, n_estimators=boosting.N_ESTIMATORS, **options):
        asked.append(n_estimators)
        raise InterruptedError

    monkeypatch.setattr(boosting, "train", train)
    for name in ("ml_train_score", "ml_train_score_regression"):
        with pytest.raises(InterruptedError):
            entry.queries()[name](spark, "/root/testdata/sf0.001")
    assert asked == [100, 100]


def test_a_classifier_reads_its_rows_once_and_boosts_small_partitions(spark, monkeypatch):
    read = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def told(key):
        read.add(1)
        return key

    rows = spark.range(2_000).select(told("id").alias("id"), (F.col("id") % 7).cast("double").alias("x"), F.when(F.col("id") % 7 > 3, "a").otherwise("b").alias("target"))
    parts, spread = [], boosting.spread

    def noted(*given):
        out = spread(*given)
        parts.append(out.rdd.getNumPartitions())
        return out

    monkeypatch.setattr(boosting, "spread", noted)
    monkeypatch.setattr(boosting, "ROWS_A_TASK", 100)
    boosting.train(rows, "target", "classification", "id", n_estimators=2)
    assert read.value == 2_000 and parts == [16]


def test_models_of_many_rows_are_boosted_one_after_the_other():
    at_once = [boosting._estimator("classification", 1, 1, 3, n).getParallelism() for n in (0, 1_000, boosting.ROWS_AT_ONCE // 2, boosting.ROWS_AT_ONCE * 10)]
    assert at_once == [4, 4, 2, 1]
