import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from recordmill import schemas
from recordmill.functions import texts
from recordmill.operators import ledger, run_metrics
from recordmill.streaming.facts import read_metric, stream_metric

AS_OF = datetime(2024, 1, 1, 12)

FULL = {
    "source_name": "src", "ml_enabled": True,
    "ingestResult": {"Payload": {"source": "x", "recordCount": 1234}},
    "loadResult": {"Payload": {"rowsLoaded": 1200, "status": "LOADED"}},
    "mlLoadResult": {"Payload": {"rowsLoaded": 50}},
    "qualityResult": {"passed": True, "totalChecks": 6, "errorCount": 0, "warnCount": 1},
}


def flat(spark, state, status="SUCCESS", started="2024-01-01T11:58:30Z", run_id="run-123456789"):
    return ledger.flatten_states(spark.createDataFrame([(run_id, status, started, AS_OF, json.dumps(state))], schemas.RUN_STATES))


def test_full_state(spark):
    row = flat(spark, FULL).first()
    assert (row.source, row.rows_ingested, row.rows_loaded, row.load_status) == ("src", 1234, 1200, "LOADED")
    assert (row.ml_enabled, row.ml_rows_loaded, row.quality_passed) == (True, 50, True)
    assert (row.quality_total, row.quality_errors, row.quality_warns, row.error_info) == (6, 0, 1, None)
    assert row.duration_seconds == 90.0


def test_empty_state(spark):
    row = flat(spark, {}).first()
    assert (row.source, row.rows_ingested, row.load_status, row.ml_enabled) == ("unknown", 0, "n/a", False)
    assert row.quality_passed is None and row.error_info is None


@pytest.mark.parametrize(
    "state, wanted",
    [
        ({"source_name": "", "ingestResult": {"Payload": {"source": "x"}}}, ("x", 0)),
        ({"ingestResult": {"Payload": None}}, ("unknown", 0)),
        ({"ingestResult": "oops"}, ("unknown", 0)),
        ({"ingestResult": {"Payload": {"recordCount": "12"}}}, ("unknown", 12)),
        ({"ingestResult": {"Payload": {"recordCount": ""}}}, ("unknown", 0)),
    ],
)
def test_defaults(spark, state, wanted):
    row = flat(spark, state).first()
    assert (row.source, row.rows_ingested) == wanted


@pytest.mark.parametrize("value, wanted", [(True, True), (1, True), ("no", True), ([0], True), (False, False), (0, False), ("", False), (None, False), ([], False), ({}, False), (0.0, False)])
def test_ml_enabled_is_truthiness(spark, value, wanted):
    assert flat(spark, {"ml_enabled": value}).first().ml_enabled is wanted


@pytest.mark.parametrize(
    "start, seconds",
    [("2024-01-01T11:00:00Z", 3600.0), ("2024-01-01T11:00:00", 3600.0), ("2024-01-01T12:00:00+02:00", 7200.0),
     ("2024-01-01T11:59:59.500Z", 0.5), (None, 0.0), ("not a date", 0.0), ("", 0.0), ("12:00", 0.0)],
)
def test_duration_seconds(spark, start, seconds):
    df = spark.createDataFrame([(start,)], "s string")
    assert df.select(texts.seconds_since(F.col("s"), F.lit(AS_OF))).first()[0] == seconds


@pytest.mark.parametrize("seconds, text", [(5.2, "5.2s"), (0.0, "0.0s"), (90.0, "1m 30s"), (3700.0, "1h 1m 40s"), (60.0, "1m 0s"), (3599.9, "59m 59s"), (90061.0, "25h 1m 1s")])
def test_duration_text(spark, seconds, text):
    assert spark.createDataFrame([(seconds,)], "s double").select(texts.duration_text(F.col("s"))).first()[0] == text


def test_report_of_a_success(spark):
    row = ledger.report(flat(spark, FULL), "nightly").first()
    assert row.subject == "[Pipeline SUCCESS] src (run-1234)"
    assert row.message.split("\n") == [
        "Pipeline:  nightly", "Execution: run-123456789", "Status:    SUCCESS", "Duration:  1m 30s",
        "Start:     2024-01-01T11:58:30Z", "", "--- Pipeline Stats ---", "  Source:          src",
        "  Rows ingested:   1,234", "  Rows loaded:     1,200  (LOADED)", "  ML predictions:  50",
        "  Quality gate:    PASSED  (6 checks, 0 errors, 1 warnings)",
    ]


def test_report_of_a_failure(spark):
    state = {"errorInfo": {"Error": "E", "Cause": "c" * 2000}}
    message = ledger.report(flat(spark, state, "FAILURE", None)).first().message
    assert "Quality gate" not in message and "(disabled)" in message and "Start:     unknown" in message
    head, tail = message.split("\n\n--- Error ---\n")
    assert len(tail) == 1000
    assert "--- Error ---" not in ledger.report(flat(spark, state, "SUCCESS")).first().message


def test_subject_is_short(spark):
    row = ledger.report(flat(spark, {"source_name": "s" * 200}, run_id="")).first()
    assert len(row.subject) <= 100 and row.subject.endswith("(?)") and "s" * 30 in row.subject


def test_status_routing(spark):
    df = spark.createDataFrame([(True, None), (False, None), (None, None), (True, "e")], "p boolean, e string")
    got = [r[0] for r in df.select(ledger.run_status(F.col("p"), F.col("e"))).collect()]
    assert got == ["SUCCESS", "FAILURE", "FAILURE", "FAILURE"]


def test_metrics(spark):
    rows = {r.metric: r for r in ledger.metrics_long(flat(spark, FULL)).collect()}
    assert len(rows) == 7
    assert (rows["RowsIngested"].dimension_value, rows["RowsIngested"].metric_value) == ("src", 1234.0)
    assert (rows["PipelineDuration"].unit, rows["PipelineDuration"].dimension_value) == ("Seconds", "SUCCESS")


def runs(spark, *rows):
    df = spark.createDataFrame(rows, "ended_at timestamp, status string, source string, duration_seconds double, quality_errors long, rows_ingested long")
    return df


def test_alarms(spark):
    t = AS_OF
    df = runs(
        spark,
        (t, "SUCCESS", "a", 3600.0, 0, 1), (t + timedelta(minutes=20), "SUCCESS", "a", 3601.0, 0, 1),
        (t + timedelta(hours=1), "FAILURE", "a", 9999.0, 0, 1), (t + timedelta(hours=2), "FAILURE", "a", 1.0, 2, 1),
    )
    got = sorted((r.alarm, r.window_start - t) for r in run_metrics.alarms(df).collect())
    assert got == [
        ("duration", timedelta(minutes=15)), ("failure", timedelta(hours=1)), ("failure", timedelta(hours=2)), ("quality", timedelta(hours=2)),
    ]


def test_sums(spark):
    t = AS_OF
    df = runs(spark, (t, "SUCCESS", "a", 1.0, 5, 10), (t + timedelta(minutes=4), "SUCCESS", "b", 3.0, 5, 1), (t + timedelta(minutes=5), "FAILURE", "a", 1.0, 3, 7))
    assert {(r.status, r.executions) for r in run_metrics.executions(df).collect()} == {("SUCCESS", 2), ("FAILURE", 1)}
    assert [(r.quality_errors) for r in run_metrics.quality_errors(df).collect()] == [3]
    assert {(r.source, r.rows_ingested) for r in run_metrics.rows_by_source(df).collect()} == {("a", 10), ("b", 1), ("a", 7)}
    assert {(r.status, r.executions) for r in run_metrics.totals(df).collect()} == {("SUCCESS", 2), ("FAILURE", 1)}
    row = run_metrics.duration_stats(df).first()
    assert (round(row.p95, 9), row.avg_duration) == (2.9, 2.0)


def test_streamed_windows_match_the_batch(spark, scratch):
    t = AS_OF
    rows = [(t + timedelta(minutes=3 * i), "FAILURE" if i % 4 == 0 else "SUCCESS", "a", float(i), i, i) for i in range(40)]
    # one late run of each status moves every watermark past all other windows; its own stay open
    last = [(t + timedelta(days=5), status, "a", 1.0, 0, 0) for status in ("SUCCESS", "FAILURE")]
    df = runs(spark, *rows)
    for name, metric in {"n": run_metrics.executions, "p": run_metrics.duration_p95_approx, "q": run_metrics.quality_errors}.items():
        base = f"{scratch}/{name}"
        runs(spark, *rows).write.parquet(f"{base}/in")
        runs(spark, *last).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 100).parquet(f"{base}/in")
        stream_metric(stream, metric, f"{base}/out", f"{base}/cp", by=["status"] if name == "n" else [])
        got = read_metric(spark, f"{base}/out")
        want = metric(runs(spark, *rows, *last))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())), name
