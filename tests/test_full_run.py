import json
from datetime import datetime, timedelta


from recordmill import schemas, session
from recordmill.operators import boosting, checks, facts
from recordmill.plans import full_run, repos
from recordmill.sources import landing, tables
from recordmill.sources.pages import SourceConfig

T0 = datetime(2024, 1, 10, 12)


def repo(i, stars=1, **more):
    return {
        "id": i, "name": f"n{i}", "full_name": f"o/n{i}", "stargazers_count": stars, "forks_count": 1, "watchers_count": 1,
        "open_issues_count": 0, "size": 1, "topics": [], "created_at": "2020-01-01T00:00:00Z", "owner": {"login": "o", "id": 1, "type": "User"},
        "license": None, **more,
    }


CONFIG = SourceConfig(repos.SOURCE, "https://example.org", pagination_type="page", page_size=2, records_json_path="items")


def pages(spark, run, *groups):
    rows = [(repos.SOURCE, run, i + 1, json.dumps({"items": g})) for i, g in enumerate(groups)]
    return spark.createDataFrame(rows, "source string, run_id string, page_no long, payload string")


def go(spark, house, run, at, *groups, **more):
    return full_run.run(spark, house, run, pages(spark, run, *groups), CONFIG, at - timedelta(seconds=90), at, **more)


def test_runs_build_on_each_other(spark, scratch):
    house = full_run.Warehouse(scratch)
    assert go(spark, house, "r1", T0, [repo(1, 5), repo(2)], [repo(3)], [repo(99)]) == "SUCCESS"
    assert landing.read_landing(spark, house.landing).count() == 3
    assert go(spark, house, "r2", T0 + timedelta(days=1), [repo(1, 9, name="new"), repo(4)], []) == "SUCCESS"
    dim = {r.repo_id: r.repo_name for r in full_run.dimension(spark, house).collect()}
    assert dim == {1: "new", 2: "n2", 3: "n3", 4: "n4"}
    fact = {(r.repo_id, str(r.metric_date)): r.star_count for r in facts.read_fact(spark, house.fact).collect()}
    assert fact == {(1, "2024-01-10"): 5, (2, "2024-01-10"): 1, (3, "2024-01-10"): 1, (1, "2024-01-11"): 9, (4, "2024-01-11"): 1}
    rows = {r.run_id: r for r in full_run.read_ledger(spark, house).collect()}
    assert (rows["r1"].status, rows["r1"].rows_ingested, rows["r1"].rows_loaded, rows["r1"].duration_seconds) == ("SUCCESS", 3, 3, 90.0)
    assert (rows["r2"].quality_total, rows["r2"].quality_errors) == (6, 0)


def test_no_records_skip_the_load(spark, scratch):
    house = full_run.Warehouse(scratch)
    go(spark, house, "r1", T0, [repo(1)])
    assert go(spark, house, "r2", T0 + timedelta(hours=1), []) == "SUCCESS"
    row = full_run.read_ledger(spark, house).where("run_id = 'r2'").first()
    assert (row.rows_ingested, row.rows_loaded, row.load_status) == (0, 0, "SKIPPED")


def test_broken_rule_stops_the_build_and_is_recorded(spark, scratch):
    house = full_run.Warehouse(scratch)
    assert go(spark, house, "r1", T0, [repo(1, -5)]) == "FAILURE"
    assert full_run.dimension(spark, house).isEmpty()
    row = full_run.read_ledger(spark, house).first()
    assert row.status == "FAILURE" and "accepted_range(star_count)" in row.error_info and row.quality_passed is None


def test_failed_gate_is_a_failure_with_its_totals(spark, scratch):
    house = full_run.Warehouse(scratch)
    specs = [{"name": "many", "type": "row_count_min", "table": "raw.landing", "min_rows": 100}]
    assert go(spark, house, "r1", T0, [repo(1)], specs=specs) == "FAILURE"
    row = full_run.read_ledger(spark, house).first()
    assert (row.quality_passed, row.quality_total, row.quality_errors, row.error_info) == (False, 1, 1, None)


def test_scoring_stage(spark, scratch):
    house = full_run.Warehouse(f"{scratch}/house")
    rows = spark.range(60).selectExpr("id AS repo_id", "IF(id % 2 = 0, 'a', 'b') AS language", "IF(id % 2 = 0, 1.0D, 2.0D) AS y")
    trained = boosting.train(rows, "y", "regression", "repo_id", n_estimators=2)
    assert go(spark, house, "r1", T0, [repo(1), repo(2)], scoring=full_run.Scoring(trained, "repo_id")) == "SUCCESS"
    assert spark.read.schema(schemas.PREDICTIONS).parquet(house.predictions).count() == 2
    row = full_run.read_ledger(spark, house).first()
    assert row.ml_enabled and row.ml_rows_loaded == 2


def test_default_checks_are_known():
    assert all(c["type"] in checks.REGISTRY for c in full_run.default_checks(T0))


def test_namespaces_and_tables(spark):
    schemas.create_tables(spark)
    schemas.create_tables(spark)
    assert spark.table("raw.landing").columns == [f.name for f in schemas.LANDING]
    assert spark.table("marts.ml_inference_input").columns == ["placeholder_column"]
    assert spark.table("marts.ml_training_data").count() == 0


def test_scratch_is_dropped(spark):
    kept = session._scratch[:]
    session._scratch.clear()
    path = session.scratch_dir(spark, "x")
    spark.range(1).write.parquet(path)
    assert session.drop_scratch(spark) == 1 and not tables.path_exists(spark, path)
    session._scratch.extend(kept)




def test_a_run_with_one_new_repository_rewrites_one_bucket(spark, scratch):
    house = full_run.Warehouse(scratch)
    assert go(spark, house, "r1", T0, [repo(i) for i in range(40)]) == "SUCCESS"
    kept = {p: latest_parts(spark, p) for p in (house.latest, house.dimension)}
    assert go(spark, house, "r2", T0 + timedelta(hours=1), [repo(3, 8, name="new")]) == "SUCCESS"
    for path, before in kept.items():
        after = latest_parts(spark, path)
        assert before.keys() == after.keys() and len([b for b in before if before[b] != after[b]]) == 1
    names = {r.repo_id: r.repo_name for r in full_run.dimension(spark, house).collect()}
    assert len(names) == 40 and names[3] == "new"
    assert go(spark, house, "r3", T0 + timedelta(hours=2), [repo(41)]) == "SUCCESS"
    assert full_run.dimension(spark, house).count() == 41


def latest_parts(spark, path):
    from recordmill.operators.latest import BUCKET
    from recordmill.sources.parts import Snapshot

    return Snapshot(spark, path, BUCKET).parts


# Checks as a user of the gate has them.
SPECS = [
    {"name": "landing_has_data", "type": "row_count_min", "table": "raw.landing", "min_rows": 1, "severity": "error"},
    {"name": "landing_is_fresh", "type": "freshness", "table": "raw.landing", "timestamp_column": "ingested_at", "max_age_hours": 24, "severity": "error"},
    {"name": "landing_source_not_null", "type": "null_rate", "table": "raw.landing", "column": "source", "max_null_rate": 0.0, "severity": "error"},
    {"name": "dim_repos_populated", "type": "row_count_min", "table": "marts.dim_repos", "min_rows": 1, "severity": "warn"},
    {"name": "fct_metrics_unique_pk", "type": "uniqueness", "table": "marts.fct_daily_repo_metrics", "columns": ["repo_id", "metric_date"], "severity": "error"},
    {"name": "predictions_recent", "type": "custom_sql", "sql": "SELECT COUNT(*) FROM marts.ml_predictions WHERE predicted_at >= CURRENT_TIMESTAMP - INTERVAL '7 days'",
     "comparison": "gte", "expected_value": 0, "severity": "warn"},
]


def test_the_gate_reads_no_row_of_tables_whose_state_is_known(spark, scratch):
    house = full_run.Warehouse(scratch)
    assert go(spark, house, "r1", T0, [repo(1, 5), repo(2)], specs=SPECS) == "SUCCESS"
    by_scan = checks.run_checks(spark, SPECS, T0)
    by_state = checks.run_checks(spark, SPECS, T0, state=lambda name: full_run.table_state(spark, house, name))
    assert by_scan == by_state and all(r.passed for r in by_scan)
    read = []

    def table(name):
        read.append(name)
        return spark.table(name)

    checks.run_checks(spark, SPECS, T0, table, lambda name: full_run.table_state(spark, house, name))
    assert read == []
    assert "rows" not in landing.commit_log(spark, house.landing).current()._jdf.queryExecution().executedPlan().toString().split("Location:")[-1].split("ReadSchema")[0]
    assert full_run.read_ledger(spark, house).first().freshness == "pass"


def test_names_follow_each_run_and_warehouse(spark, scratch):
    first, second = full_run.Warehouse(f"{scratch}/a"), full_run.Warehouse(f"{scratch}/b")
    go(spark, first, "r1", T0, [repo(1, 5), repo(2)])
    assert spark.table("raw.landing").count() == 2 and spark.table("marts.dim_repos").count() == 2
    go(spark, first, "r2", T0 + timedelta(days=1), [repo(1, 7)])
    assert spark.sql("SELECT sum(star_count) FROM marts.fct_daily_repo_metrics WHERE repo_id = 1").first()[0] == 12
    assert spark.table("raw.landing").count() == 3
    go(spark, second, "r1", T0, [repo(9)])
    assert [r.repo_id for r in spark.table("marts.dim_repos").collect()] == [9] and spark.table("raw.landing").count() == 1


def test_a_cut_run_is_in_the_ledger(spark, scratch):
    house, capped = full_run.Warehouse(scratch), SourceConfig(repos.SOURCE, "https://example.org", pagination_type="page", page_size=1, max_pages=2, records_json_path="items")
    for run, groups in (("r1", [[repo(1)], [repo(2)], [repo(3)]]), ("r2", [[repo(4)], []])):
        full_run.run(spark, house, run, pages(spark, run, *groups), capped, T0, T0)
    assert {r.run_id: r.truncated for r in full_run.read_ledger(spark, house).collect()} == {"r1": 1, "r2": 0}
