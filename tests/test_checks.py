import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from recordmill.operators import checks
from recordmill.plans.full_run import default_checks

AS_OF = datetime(2024, 2, 1, 12)


def run(spark, df, *specs):
    specs = [{"name": f"c{i}", "table": "t", **s} for i, s in enumerate(specs)]
    return checks.run_checks(spark, specs, AS_OF, lambda name: df)


@pytest.mark.parametrize("rows, least, passed", [(50, 10, True), (5, 10, False), (0, 1, False)])
def test_row_count(spark, rows, least, passed):
    got = run(spark, spark.range(rows), {"type": "row_count_min", "min_rows": least})[0]
    assert got.passed is passed and got.details["actual_rows"] == rows


@pytest.mark.parametrize(
    "age, passed, hours", [(timedelta(hours=3), True, 3), (timedelta(hours=48), False, 48), (timedelta(hours=24.9), True, 24), (timedelta(hours=-2.5), True, -2)]
)
def test_freshness(spark, age, passed, hours):
    df = spark.createDataFrame([(AS_OF - age,), (None,)], "ingested_at timestamp")
    got = run(spark, df, {"type": "freshness", "max_age_hours": 24})[0]
    assert (got.passed, got.details["hours_since_last"]) == (passed, hours)


def test_freshness_without_timestamps(spark):
    df = spark.createDataFrame([(None,)], "ingested_at timestamp")
    got = run(spark, df, {"type": "freshness"})[0]
    assert not got.passed and "reason" in got.details and got.error is None


@pytest.mark.parametrize("rows, nulls, limit, passed, rate", [(1000, 0, 0.0, True, 0.0), (1000, 100, 0.05, False, 0.1), (0, 0, 0.0, True, 0.0)])
def test_null_rate(spark, rows, nulls, limit, passed, rate):
    df = spark.range(rows).select(F.when(F.col("id") >= nulls, F.col("id")).alias("x"))
    got = run(spark, df, {"type": "null_rate", "column": "x", "max_null_rate": limit})[0]
    assert (got.passed, got.details["null_rate"], got.details["null_rows"]) == (passed, rate, nulls)


def test_uniqueness(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (2, 1), (3, None), (3, None), (4, 4), (4, 4)], "a int, b int")
    got = run(spark, df, {"type": "uniqueness", "columns": ["a", "b"]})[0]
    assert not got.passed and got.details["duplicate_groups"] == 3
    assert run(spark, df.distinct(), {"type": "uniqueness", "columns": ["a", "b"]})[0].passed


@pytest.mark.parametrize(
    "op, actual, expected, passed",
    [("eq", 5, 5, True), ("eq", 5, 6, False), ("ne", 5, 6, True), ("lt", 1, 2, True), ("lte", 2, 2, True),
     ("gt", 3, 2, True), ("gte", 2, 2, True), ("gte", 1, 2, False)],
)
def test_comparisons(spark, op, actual, expected, passed):
    got = run(spark, spark.range(1), {"type": "custom_sql", "sql": f"SELECT {actual}", "comparison": op, "expected_value": expected})[0]
    assert got.passed is passed and got.details["actual"] == actual


def test_custom_sql_errors_are_results(spark):
    got = run(
        spark, spark.range(1),
        {"type": "custom_sql", "sql": "SELECT 1", "comparison": "bogus"},
        {"type": "custom_sql", "sql": "SELECT NULL", "comparison": "gt"},
        {"type": "custom_sql", "sql": "SELECT nothing FROM nowhere"},
        {"type": "nonsense"},
        {"type": "null_rate", "column": "no_such_column"},
        {"type": "null_rate"},
        {"type": "row_count_min"},
        {"type": "row_count_min", "min_rows": "many"},
    )
    assert [r.passed for r in got] == [False] * 6 + [True, False]
    assert got[0].error == "Unknown comparison operator: bogus"
    assert got[1].error.startswith("Comparison failed")
    assert got[3].error == "Unknown check type: nonsense"
    assert all(r.error for r in got if not r.passed)
    assert all(r.severity == "error" for r in got)


def test_a_check_that_fails_at_run_time_fails_alone(spark):
    df = spark.createDataFrame([("x",)], "s string")
    got = run(spark, df, {"type": "null_rate", "column": "cast(s AS int)"}, {"type": "row_count_min"})
    assert [r.passed for r in got] == [False, True] and got[0].error


def test_unknown_table_fails_its_checks_only(spark):
    spark.range(3).createOrReplaceTempView("known_table")
    got = checks.run_checks(
        spark,
        [{"name": "a", "type": "row_count_min", "table": "known_table"}, {"name": "b", "type": "row_count_min", "table": "unknown_table"}],
        AS_OF,
    )
    assert [r.passed for r in got] == [True, False]


def test_checks_of_one_table_share_a_job(spark):
    df = spark.createDataFrame([(AS_OF, 1)], "ingested_at timestamp, x int")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("gate", "gate")
    run(spark, df, {"type": "row_count_min"}, {"type": "freshness"}, {"type": "null_rate", "column": "x"})
    jobs = len(tracker.getJobIdsForGroup("gate"))
    spark.sparkContext.setJobGroup("single", "single")
    run(spark, df, {"type": "row_count_min"})
    assert jobs == len(tracker.getJobIdsForGroup("single"))


def test_gate(spark):
    def result(severity, passed):
        return checks.CheckResult("n", "t", severity, passed)

    def of(*results):
        return tuple(checks.gate(checks.results_table(spark, results)).first())

    assert of(result("error", True), result("warn", False), result("info", False)) == (True, 3, 0, 1)
    assert of(result("error", False), result("warn", True)) == (False, 2, 1, 0)
    assert of() == (True, 0, 0, 0)


def test_registering_a_type(spark):
    checks.register(
        "max_rows",
        checks.AggregateCheck(lambda spec, as_of: {"n": checks.row_count()}, lambda spec, got: checks.Verdict(got["n"] <= spec["limit"], {"n": got["n"]})),
    )
    try:
        assert [r.passed for r in run(spark, spark.range(3), {"type": "max_rows", "limit": 3}, {"type": "max_rows", "limit": 2})] == [True, False]
    finally:
        checks.REGISTRY.pop("max_rows")


def test_specs_are_an_array():
    assert len(checks.load_specs(json.dumps(default_checks(AS_OF)))) == 6
    with pytest.raises(ValueError):
        checks.load_specs("{}")


def test_states_of_parts_merge_to_the_state_of_the_whole(spark, scratch):
    from datetime import datetime, timedelta

    from pyspark.sql import functions as F

    from recordmill.operators import checks
    from recordmill.sources.parts import Snapshot

    at = datetime(2024, 1, 1)
    rows = [(i, i % 4, None if i % 3 == 0 else "x", None if i % 5 == 0 else at + timedelta(hours=i)) for i in range(60)] + [(7, 3, "y", None)]
    df = spark.createDataFrame(rows, "id long, part int, text string, seen timestamp")
    Snapshot(spark, scratch, "part").replace(df.where("part < 2"), ["0", "1"], unique=[["id"]])
    Snapshot(spark, scratch, "part").replace(df.where("part >= 1").withColumn("more", F.lit(1)), ["1", "2", "3"], unique=[["id"]])
    now = Snapshot(spark, scratch, "part")
    specs = [
        {"name": "n", "type": "row_count_min", "table": "t", "min_rows": 70},
        {"name": "a", "type": "freshness", "table": "t", "timestamp_column": "seen", "max_age_hours": 24},
        {"name": "u", "type": "uniqueness", "table": "t", "columns": ["id"]},
        *[{"name": c, "type": "null_rate", "table": "t", "column": c, "max_null_rate": 0.3} for c in ("text", "seen", "more", "coalesce(more, id)", "absent")],
    ]
    as_of = at + timedelta(days=9, minutes=59)
    read = []
    scanned = checks.run_checks(spark, specs, as_of, lambda name: now.read())
    told = checks.run_checks(spark, specs, as_of, lambda name: read.append(name) or now.read(), lambda name: now.state())
    for results in (scanned, told):
        results[-1].error = results[-1].error.partition(" A column")[0]  # the rest numbers the plan's columns
    assert scanned == told and [r.passed for r in told][:4] == [False, False, False, False]
    assert told[2].details["duplicate_groups"] == 1 and len(read) == 1  # only what is no plain column is read
