import json
import random

import pytest
from pyspark.sql import functions as F

from recordmill.functions.variants import resolve
from recordmill.sources.pages import PagedRuns, SourceConfig, flatten_pages, next_request, page_gaps, page_key


def config(**settings):
    return SourceConfig.from_mapping({"source_name": "s", "base_url": "https://example.org/", **settings})


def pages(spark, *payloads, run="r"):
    rows = [("s", run, i + 1, p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "source string, run_id string, page_no long, payload string")


def ids(df):
    rows = df.select("page_no", "position", F.variant_get("data", "$.id", "int").alias("id")).collect()
    return [r.id for r in sorted(rows, key=lambda r: (r.page_no, r.position))]


def page(*numbers, **extra):
    return {"data": [{"id": n} for n in numbers], **extra}


def test_dotted_path(spark):
    payload = '{"outer":{"inner":{"items":[1,2,3]}}}'
    df = spark.createDataFrame([(payload,)], "p string").select(F.parse_json("p").alias("p"))
    got = df.select(
        *[F.to_json(resolve(F.col("p"), path)).alias(str(i)) for i, path in enumerate(["outer.inner.items", "outer.missing", "", "outer.inner.items.x"])]
    ).first()
    assert got[0] == "[1,2,3]"
    assert got[1] is None and got[3] is None
    assert json.loads(got[2]) == json.loads(payload)


def test_no_paging_keeps_first_page(spark):
    assert ids(flatten_pages(pages(spark, page(1, 2), page(3)), [config()])) == [1, 2]


@pytest.mark.parametrize("kind", ["page", "offset"])
def test_short_page_is_kept_and_ends_the_run(spark, kind):
    got = flatten_pages(pages(spark, page(1, 2, 3), page(4, 5), page(6, 7, 8)), [config(pagination_type=kind, page_size=3, max_pages=10)])
    assert ids(got) == [1, 2, 3, 4, 5]


def test_page_cap(spark):
    endless = [page(2 * i, 2 * i + 1) for i in range(6)]
    got = flatten_pages(pages(spark, *endless), [config(pagination_type="page", page_size=2, max_pages=2)])
    assert ids(got) == [0, 1, 2, 3]


@pytest.mark.parametrize("last", [None, "", 0, False, [], {}])
def test_cursor_ends_when_not_set(spark, last):
    got = flatten_pages(
        pages(spark, page(1, next_cursor="abc"), page(2, next_cursor=last), page(3)), [config(pagination_type="cursor")]
    )
    assert ids(got) == [1, 2]


def test_cursor_missing_and_array_payload(spark):
    got = flatten_pages(pages(spark, page(1, next_cursor="a"), page(2), page(3)), [config(pagination_type="cursor")])
    assert ids(got) == [1, 2]
    got = flatten_pages(
        pages(spark, [{"id": 1}], [{"id": 2}]), [config(pagination_type="cursor", records_json_path="")]
    )
    assert ids(got) == [1]


def test_empty_page_ends_a_cursor_run(spark):
    got = flatten_pages(pages(spark, page(1, next_cursor="a"), page(next_cursor="b"), page(3)), [config(pagination_type="cursor")])
    assert ids(got) == [1]


@pytest.mark.parametrize("payload", [{"data": "not a list"}, {"other": []}, {"data": {"a": 1}}])
def test_not_a_list_fails(spark, payload):
    with pytest.raises(Exception, match="Expected list at 'data'"):
        flatten_pages(pages(spark, payload), [config()]).collect()


def test_not_a_list_after_the_stop_is_not_looked_at(spark):
    got = flatten_pages(pages(spark, page(1), {"data": "x"}), [config(pagination_type="page", page_size=2)])
    assert ids(got) == [1]


def test_two_sources_with_their_own_rules(spark):
    other = config(source_name="t", pagination_type="page", page_size=1, records_json_path="a.b")
    rows = [("t", "r", i, json.dumps({"a": {"b": [{"id": 10 + i}] if i < 3 else []}})) for i in range(1, 5)]
    both = pages(spark, page(1), page(2)).union(
        spark.createDataFrame(rows, "source string, run_id string, page_no long, payload string")
    )
    got = flatten_pages(both, [config(), other])
    assert sorted(r.id for r in got.select(F.variant_get("data", "$.id", "int").alias("id")).collect()) == [1, 11, 12]


def test_pages_of_a_run_with_gaps_are_ranked(spark):
    rows = [("s", "r", n, json.dumps(page(n))) for n in (10, 20, 40)]
    df = spark.createDataFrame(rows, "source string, run_id string, page_no long, payload string")
    got = flatten_pages(df, [config(pagination_type="page", page_size=1, max_pages=2)])
    assert ids(got) == [10, 20]
    assert page_gaps(df).collect()[0].present == 3


@pytest.mark.parametrize("cap", [1, 3, 50, 4_000, None])
def test_no_run_is_sorted_at_any_cap(spark, cap):
    rows = spark.range(5_000).select(F.lit("s").alias("source"), F.lit("r").alias("run_id"), (F.col("id") * F.col("id") * 1_000).alias("page_no"), F.lit('{"data":[1]}').alias("payload"))
    runs = PagedRuns(rows, [config(pagination_type="page", page_size=1, max_pages=cap)])
    kept = runs.kept()
    assert "Window" not in kept._jdf.queryExecution().executedPlan().toString()
    last = 5_000 if cap is None else cap
    assert kept.agg(F.count("*"), F.max("page_no")).first() == (last, (last - 1) ** 2 * 1_000)
    assert runs.cut().count() == (cap is not None)


def test_gaps_by_key(spark):
    def gaps(keys, **settings):
        df = spark.createDataFrame([("s", "r", k, "") for k in keys], "source string, run_id string, page_no long, payload string")
        return [(r.expected, r.present, r.stray) for r in page_gaps(df, [config(**settings)]).collect()]

    assert gaps([1, 2, 3], pagination_type="page") == [] and gaps([1, 1, 2], pagination_type="page") == []
    assert gaps([2, 3], pagination_type="page") == [(3, 2, 0)] and gaps([1, 3], pagination_type="page") == [(3, 2, 0)]
    assert gaps([0, 100, 200], pagination_type="offset") == [] and gaps([100, 200], pagination_type="offset") == [(3, 2, 0)]
    assert gaps([0, 100, 150], pagination_type="offset") == [(2, 2, 1)] and gaps([0, 1], pagination_type="page") == [(1, 1, 1)]


def test_payloads_are_never_broadcast(spark):
    plan = flatten_pages(pages(spark, page(1)), [config()])._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "BuildLeft" not in plan and "NestedLoop" not in plan


def test_config_defaults_and_required_fields():
    got = config()
    assert (got.endpoint, got.method, got.auth_type, got.pagination_type) == ("/", "GET", "none", "none")
    assert (got.page_size, got.max_pages, got.cursor_field, got.records_json_path) == (100, 50, "next_cursor", "data")
    assert got.base_url == "https://example.org"
    assert config(page_size="25").page_size == 25
    with pytest.raises(ValueError, match="base_url"):
        SourceConfig.from_mapping({"source_name": "s"})
    with pytest.raises(ValueError):
        config(pagination_type="bogus")
    with pytest.raises(ValueError):
        config(auth_type="bogus")


def test_first_request(spark):
    assert next_request(config(pagination_type="page"), {"q": 1}) == {"page": 1, "per_page": 100, "q": 1}
    assert next_request(config(pagination_type="offset"), {"limit": 7}) == {"offset": 0, "limit": 7}
    df = spark.range(1, 4).select(page_key(config(pagination_type="offset"), F.col("id")).alias("k"))
    assert [r.k for r in df.collect()] == [0, 100, 200]


def walk(payloads, cfg):
    """The records a reader asking for one page after the other would see."""
    seen = []
    for n, payload in enumerate(payloads, 1):
        records = payload["data"]
        seen += [r["id"] for r in records]
        full = cfg.pagination_type not in ("page", "offset") or len(records) >= cfg.page_size
        more = cfg.pagination_type != "cursor" or payload.get("next_cursor")
        if n == cfg.max_pages or cfg.pagination_type == "none" or not records or not full or not more:
            break
    return seen


@pytest.mark.parametrize("kind", ["none", "page", "offset", "cursor"])
def test_random_runs_match_a_page_by_page_reader(spark, kind):
    rng = random.Random(kind)
    cfg = config(pagination_type=kind, page_size=3, max_pages=6)
    rows, want = [], {}
    for run in range(60):
        length = 400 if run == 0 else rng.randint(1, 10)  # one run holds most of the pages
        sizes = [3] * length if run == 0 else [rng.choice([3, 3, 3, 3, 4, 2, 0]) for _ in range(length)]
        group = []
        for n, size in enumerate(sizes):
            payload = page(*[run * 10_000 + n * 10 + i for i in range(size)])
            if rng.random() < 0.9:
                payload["next_cursor"] = rng.choice(["a", "0", 7, True, "b", None] if run else ["a"])
            group.append(payload)
        want[str(run)] = walk(group, cfg)
        rows += [("s", str(run), n, json.dumps(p)) for n, p in enumerate(group)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "source string, run_id string, page_no long, payload string").repartition(5)
    got = {run: [] for run in want}
    picked = flatten_pages(df, [cfg]).select("run_id", "page_no", "position", F.variant_get("data", "$.id", "int").alias("id"))
    for r in sorted(picked.collect(), key=lambda r: (r.page_no, r.position)):
        got[r.run_id].append(r.id)
    assert got == want


@pytest.mark.parametrize("key", ["run_id", "page_no"])
def test_a_page_without_key_fails_the_job(spark, key):
    df = pages(spark, page(1)).unionByName(pages(spark, page(2)).withColumn(key, F.lit(None).cast("string" if key == "run_id" else "long")))
    with pytest.raises(Exception, match=f"a page has no {key}"):
        flatten_pages(df, [config()]).collect()


def test_runs_cut_by_the_cap_are_told(spark):
    from recordmill.sources.pages import cut_runs

    settings = [config(pagination_type="page", page_size=2, max_pages=2)]
    both = pages(spark, page(1, 2), page(3, 4), page(5), run="cut").unionByName(pages(spark, page(1, 2), page(3), run="whole"))
    assert [tuple(r) for r in cut_runs(both, settings).collect()] == [("s", "cut", 2)]


def test_only_keys_of_pages_are_written(spark, monkeypatch):
    from recordmill.sources import pages as module

    written, cut = [], module.cut_lineage
    monkeypatch.setattr(module, "cut_lineage", lambda df: written.append(df.columns) or cut(df))
    many = [page(1, 2)] * 3 + [page(3)] + [page(4, 5)] * 20
    assert ids(flatten_pages(pages(spark, *many), [config(pagination_type="page", page_size=2)])) == [1, 2] * 3 + [3]
    assert written and not {"records", "payload"} & {c for columns in written for c in columns}
