"""Staging, latest rows, dimension and daily facts."""

import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from recordmill.functions.variants import Field
from recordmill.operators import data_tests, facts, latest
from recordmill.operators.staging import stage
from recordmill.plans import markets, repos
from recordmill.sources import landing
from recordmill.streaming.facts import upsert_from_stream

REPO = {
    "id": 7, "name": "n", "full_name": "o/n", "description": None, "language": "C", "stargazers_count": "12",
    "forks_count": 3, "watchers_count": 4, "open_issues_count": 5, "size": 6, "default_branch": "main",
    "topics": ["a", "b"], "created_at": "2020-01-02T03:04:05Z", "updated_at": "2020-01-02T05:04:05+02:00",
    "pushed_at": None, "owner": {"login": "o", "id": 9, "type": "User"}, "html_url": "h", "license": None, "extra": 1,
}


def landed(spark, source, *rows):
    """Rows (record, ingested_at[, load_id]) as a landing table."""
    data = [(r[2] if len(r) > 2 else "l", source, "f", r[1], json.dumps(r[0])) for r in rows]
    df = spark.createDataFrame(data, "load_id string, source string, file_path string, ingested_at timestamp, data string")
    return df.withColumn("data", F.parse_json("data"))


AT = datetime(2024, 1, 10, 12)


def test_repo_staging(spark):
    row = repos.staged(landed(spark, repos.SOURCE, (REPO, AT))).first()
    assert (row.repo_id, row.star_count, row.owner_login, row.owner_id, row.topics) == (7, 12, "o", 9, ["a", "b"])
    assert row.description is None and row.license_spdx is None and row.homepage_url is None
    assert row.repo_created_at == row.repo_updated_at.replace() == datetime(2020, 1, 2, 3, 4, 5)
    assert row.repo_pushed_at is None
    assert len(row) == len(repos.FIELDS) + 3


def test_other_sources_are_left_out(spark):
    assert repos.staged(landed(spark, "other", (REPO, AT))).isEmpty()


@pytest.mark.parametrize("bad", [1.5, "x", 99999999999])
def test_bad_integer_fails(spark, bad):
    with pytest.raises(Exception):
        repos.staged(landed(spark, repos.SOURCE, ({**REPO, "size": bad}, AT))).collect()


def test_decimals_keep_their_digits(spark):
    record = '{"id":"b","current_price":12345678901234567890.12345678,"market_cap":1.005,"low_24h":1e-7,"high_24h":"0.1","max_supply":null}'
    df = landed(spark, markets.SOURCE, ({}, AT)).withColumn("data", F.parse_json(F.lit(record)))
    row = markets.staged(df).first()
    assert row.current_price_usd == Decimal("12345678901234567890.12345678")
    assert row.market_cap_usd == Decimal("1.01")
    assert row.low_24h_usd == Decimal("0.0000001") and row.high_24h_usd == Decimal("0.1") and row.max_supply is None


def test_new_source_from_fields(spark):
    df = landed(spark, "mine", ({"a": {"b": "x"}, "n": 3}, AT))
    row = stage(df, "mine", [Field("b", "a.b"), Field("n", "n", "bigint")]).first()
    assert (row.b, row.n, row.load_id) == ("x", 3, "l")


def test_latest_breaks_ties(spark):
    rows = [("k", AT, "a", 1), ("k", AT, "b", 2), ("k", datetime(2023, 1, 1), "z", 3), (None, AT, "a", 4)]
    df = spark.createDataFrame(rows, "id string, ingested_at timestamp, load_id string, v int").withColumn("file_path", F.lit("f"))
    assert sorted(r.v for r in latest.latest_per_key(df, ["id"]).collect()) == [2, 4]


def test_dimension_columns(spark):
    df = landed(spark, repos.SOURCE, (REPO, AT), ({**REPO, "name": "old"}, datetime(2024, 1, 9)))
    dim = repos.dim_repos(repos.latest_repos(df))
    assert dim.columns == [*repos.DIMENSION_COLUMNS, "dim_refreshed_at"]
    assert dim.first().repo_name == "n" and dim.count() == 1


def test_latest_can_start_from_the_known_rows(spark):
    old = landed(spark, repos.SOURCE, ({**REPO, "name": "old"}, datetime(2024, 1, 9)), ({**REPO, "id": 8}, datetime(2024, 1, 9)))
    new = landed(spark, repos.SOURCE, (REPO, AT))
    step = repos.latest_repos(new, repos.latest_repos(old))
    whole = repos.latest_repos(old.union(new))
    pick = ["repo_id", "repo_name", "ingested_at"]
    assert sorted(step.select(pick).collect()) == sorted(whole.select(pick).collect())


def staged(spark, *rows):
    return spark.createDataFrame(rows, "repo_id long, stars int, ingested_at timestamp")


def merge(spark, path, rows, lookback=0):
    days = rows.withColumn("day", F.to_date("ingested_at"))
    recent = facts.since_high_water(days, "day", facts.read_fact(spark, path), lookback)
    facts.upsert_days(spark, facts.daily_metrics(recent, "repo_id", ["stars"]), path, ["repo_id", "metric_date"])
    got = facts.read_fact(spark, path).select("repo_id", "metric_date", "stars", "observation_count").collect()
    return sorted(map(tuple, got))


D9, D10 = date(2024, 1, 9), date(2024, 1, 10)


def test_upsert_rerun_and_late_rows(spark, scratch):
    first = [(1, 5, datetime(2024, 1, 9, 1)), (1, 6, datetime(2024, 1, 10, 1)), (2, 1, datetime(2024, 1, 10, 2))]
    want = [(1, D9, 5, 1), (1, D10, 6, 1), (2, D10, 1, 1)]
    assert merge(spark, scratch, staged(spark, *first)) == want
    assert merge(spark, scratch, staged(spark, *first)) == want
    same_day = [*first, (1, 9, datetime(2024, 1, 10, 0))]
    want = [(1, D9, 5, 1), (1, D10, 9, 2), (2, D10, 1, 1)]
    assert merge(spark, scratch, staged(spark, *same_day)) == want
    older = [*same_day, (1, 50, datetime(2024, 1, 9, 5))]
    assert merge(spark, scratch, staged(spark, *older)) == want
    assert merge(spark, scratch, staged(spark, *older), lookback=1) == [(1, D9, 50, 2), (1, D10, 9, 2), (2, D10, 1, 1)]


def test_upsert_keeps_keys_the_batch_lacks(spark, scratch):
    merge(spark, scratch, staged(spark, (1, 5, AT), (2, 5, AT)))
    assert merge(spark, scratch, staged(spark, (2, 7, AT))) == [(1, D10, 5, 1), (2, D10, 7, 1)]


def test_upsert_appends_columns(spark, scratch):
    merge(spark, scratch, staged(spark, (1, 5, datetime(2024, 1, 9)), (2, 5, AT)))
    wide = staged(spark, (3, 1, AT)).withColumn("forks", F.lit(8))
    batch = facts.daily_metrics(wide, "repo_id", ["stars", "forks"])
    facts.upsert_days(spark, batch, scratch, ["repo_id", "metric_date"])
    got = {r.repo_id: r.forks for r in facts.read_fact(spark, scratch).collect()}
    assert got == {1: None, 2: None, 3: 8}


def test_high_water_prunes_landing_folders(spark, scratch):
    rows = spark.range(2).select(F.lit("f").alias("file_path"), F.parse_json(F.lit("{}")).alias("data"))
    landing.write_batch(landing.to_landing(rows, "s", "l", AT), f"{scratch}/landing", "b")
    fact = spark.createDataFrame([(D10,)], "metric_date date")
    recent = facts.since_high_water(landing.read_landing(spark, f"{scratch}/landing"), "ingest_date", fact)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "ingest_date" in plan[plan.index("PartitionFilters") :].split("PushedFilters")[0]
    assert recent.count() == 2


def test_daily_metrics_combine_before_the_shuffle(spark):
    plan = facts.daily_metrics(staged(spark, (1, 1, AT)), "repo_id", ["stars"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("partial_max")


def test_stream_upsert_equals_batch(spark, scratch):
    rows = staged(spark, (1, 5, datetime(2024, 1, 9, 1)), (1, 6, datetime(2024, 1, 10, 1)), (2, 1, AT))
    schema = rows.schema
    for part in ("2024-01-09", "2024-01-10"):
        rows.where(F.to_date("ingested_at") == part).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
        stream = spark.readStream.schema(schema).parquet(f"{scratch}/in")
        upsert_from_stream(
            stream, lambda s: s.read.schema(schema).parquet(f"{scratch}/in"), f"{scratch}/fact", f"{scratch}/cp", "repo_id", ["stars"]
        )
    got = facts.read_fact(spark, f"{scratch}/fact").select("repo_id", "metric_date", "stars").collect()
    assert sorted(map(tuple, got)) == [(1, D9, 5), (1, D10, 6), (2, D10, 1)]


def test_data_tests(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", -1), (None, "b", None), (None, "c", 0)], "k int, s string, n int")
    assert data_tests.not_null(df, "k").count() == 2
    assert [r.k for r in data_tests.unique(df, "k").collect()] == [1]
    assert data_tests.unique_combination(df, ["k"]).count() == 2  # NULLs form a group
    assert [r.n for r in data_tests.accepted_range(df, "n", 0).collect()] == [-1]
    assert [r.n for r in data_tests.accepted_range(df, "n", 0, 4).collect()] == [5, -1]
    parent = spark.createDataFrame([("a",), ("a",), (None,)], "id string")
    assert sorted(r.s for r in data_tests.relationships(df, "s", parent, "id").collect()) == ["b", "b", "c"]
    assert {r.s: r.n_records for r in data_tests.orphan_keys(df, "s", parent, "id").collect()} == {"b": 2, "c": 1}
    assert data_tests.relationships(df, "k", parent.selectExpr("1 AS id"), "id").isEmpty()


def test_rules_stop_the_next_layer(spark):
    df = spark.createDataFrame([(1, -2), (None, 3)], "k int, n int")
    wanted = data_tests.rules(["k", "n"], {"n": 0}, {"unique(k)": lambda d: data_tests.unique(d, "k")})
    assert data_tests.broken_rules(df, wanted) == ["not_null(k)", "accepted_range(n)"]
    with pytest.raises(data_tests.DataTestFailure, match="t: not_null"):
        data_tests.require(df, "t", wanted)
    assert data_tests.require(df.where("k = 1 AND n > 0"), "t", wanted).isEmpty()


def test_freshness_states(spark):
    as_of = datetime(2024, 1, 3)
    rows = [("a", datetime(2024, 1, 2, 12)), ("b", datetime(2024, 1, 2, 11, 59)), ("c", datetime(2023, 12, 31, 23)), ("d", None)]
    df = spark.createDataFrame(rows, "source string, at timestamp")
    got = {r.source: r.status for r in data_tests.source_freshness(df, "source", "at", as_of).collect()}
    assert got == {"a": "pass", "b": "warn", "c": "error", "d": "error"}


def test_materializations(spark, scratch):
    from recordmill.plans.materialize import materialize

    df = staged(spark, (1, 5, AT))
    assert materialize(df, "staging", "stg_x", scratch).count() == 1 and spark.table("stg_x").count() == 1
    assert materialize(df, "intermediate", "int_x", scratch) is df
    assert materialize(df, "marts", "dim_x", scratch).count() == 1
    assert materialize(df.limit(0), "marts", "dim_x", scratch).count() == 0
    daily = facts.daily_metrics(df, "repo_id", ["stars"])
    for _ in range(2):
        fact = materialize(daily, "marts", "fct_x", scratch, "incremental", ["repo_id", "metric_date"])
        assert fact.count() == 1
    with pytest.raises(ValueError):
        materialize(df, "marts", "x", scratch, "odd")


def test_staging_reads_only_the_fields_it_needs(spark, scratch):
    rows = landed(spark, repos.SOURCE, (REPO, AT), ({**REPO, "id": 8, "license": {"spdx_id": "MIT"}, "size": "6"}, AT))
    landing.write_batch(rows.withColumn("ingest_date", F.to_date("ingested_at")), scratch, "b")
    stored = landing.read_landing(spark, scratch)
    plan = repos.daily_repo_metrics(stored)._jdf.queryExecution().executedPlan().toString()
    schema = plan[plan.index("ReadSchema") :].split("\n")[0]
    assert "variant" not in schema and schema.count(":string") == 1 + len(repos.DAILY_MAXIMA)
    assert sorted(map(str, repos.staged(stored).collect())) == sorted(map(str, repos.staged(rows).collect()))


def test_stored_decimals_keep_their_digits(spark, scratch):
    numbers = ["12345678901234567890.12345678", "1.10", "1e-7", "0", "-3", "1.005"]
    df = landed(spark, markets.SOURCE, *[({}, AT) for _ in numbers[:1]])
    values = spark.createDataFrame([(n,) for n in numbers], "n string")
    record = F.parse_json(F.concat(F.lit('{"id":"'), "n", F.lit('","current_price":'), "n", F.lit(',"market_cap":'), "n", F.lit("}")))
    rows = df.drop("data").crossJoin(values).withColumn("data", record).withColumn("ingest_date", F.to_date("ingested_at"))
    landing.write_batch(rows, scratch, "b")
    got = {r.coin_id: (r.current_price_usd, r.market_cap_usd) for r in markets.staged(landing.read_landing(spark, scratch)).collect()}
    assert got["12345678901234567890.12345678"][0] == Decimal("12345678901234567890.12345678")
    assert got["1.005"] == (Decimal("1.005"), Decimal("1.01")) and got["1e-7"][0] == Decimal("0.0000001")
    assert got["-3"] == (Decimal(-3), Decimal(-3))


def test_random_upserts_match_a_dictionary(spark, scratch):
    import random
    from datetime import timedelta

    rng = random.Random(3)
    rows, fact = [], {}
    for step in range(4):
        rows += [
            (rng.choice([1, 1, 1, 2, 3]), rng.randint(0, 99), datetime(2024, 1, 1) + timedelta(days=step, hours=rng.randint(-40, 40)))
            for _ in range(30)
        ]
        mark = max((day for _, day in fact), default=date(1900, 1, 1))
        fresh = {}
        for key, stars, at in rows:
            if at.date() >= mark:
                fresh.setdefault((key, at.date()), []).append(stars)
        fact |= {k: (max(v), len(v)) for k, v in fresh.items()}
        got = merge(spark, scratch, staged(spark, *rows))
        assert got == sorted((k, d, stars, n) for (k, d), (stars, n) in fact.items())
