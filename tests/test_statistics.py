"""Order statistics and splits against brute force, with one hot group."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordmill.functions import order_statistics as stats
from recordmill.operators import features


def grouped(spark, n=30_000, seed=1):
    rng = random.Random(seed)
    rows = [("hot" if i % 3 else f"k{i % 7}", round(rng.lognormvariate(2, 2), 2)) for i in range(n)]
    rows += [("hot", 1.25)] * (n // 3) + [("nulls", None), (None, 3.0), (None, 5.0), ("one", 4.0)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "k string, v double").repartition(6)


def brute(rows, p):
    groups = defaultdict(list)
    for k, v in rows:
        if v is not None:
            groups[k].append(v)
    return {k: float(np.percentile(v, p * 100)) for k, v in groups.items()}


@pytest.mark.parametrize("p", [0.0, 0.5, 0.95, 1.0])
@pytest.mark.parametrize("small", [0, 1_500, 100_000])
def test_exact_percentile(spark, monkeypatch, p, small):
    monkeypatch.setattr(stats, "SMALL_GROUP", small)
    rows, df = grouped(spark)
    got = {r.k: r.x for r in stats.exact_percentile(df, ["k"], F.col("v"), p, "x").collect()}
    want = brute(rows, p)
    assert set(got) == set(want)
    assert all(math.isclose(got[k], want[k], rel_tol=1e-12) for k in want)


def test_salted_join_beyond_the_broadcast_size(spark, monkeypatch):
    monkeypatch.setattr(stats, "BROADCAST_GROUPS", 0)
    monkeypatch.setattr(stats, "SMALL_GROUP", 1_500)
    rows, df = grouped(spark)
    got = {r.k: r.x for r in stats.exact_percentile(df, ["k"], F.col("v"), 0.95, "x").collect()}
    assert all(math.isclose(got[k], v, rel_tol=1e-12) for k, v in brute(rows, 0.95).items())


def test_brackets_are_narrowed_until_small(spark, monkeypatch):
    monkeypatch.setattr(stats, "SMALL_GROUP", 20)
    monkeypatch.setattr(stats, "GRID", 10)
    rng = random.Random(5)
    rows = [(k, rng.random() ** 3) for k in "abc" for _ in range(8_000)]
    df = spark.createDataFrame(rows, "k string, _v double").repartition(4)

    def ranks(n):
        return F.floor(n * 0.7), F.floor(n * 0.7) + 1

    brackets, _ = stats._brackets(df, ["k"], ranks, 10_000)
    for r in brackets.collect():
        held = [v for k, v in rows if k == r._g_k and r._from <= v <= r._to]
        assert len(held) <= 30  # three grid steps of the last narrowing, give or take the sketch's error
    got = {r.k: (r.low, r.high) for r in stats._bracketed_ranks(df, ["k"], ranks).collect()}
    for key in "abc":
        ordered = sorted(v for k, v in rows if k == key)
        assert got[key] == (ordered[5_600], ordered[5_601])


@pytest.mark.parametrize("small", [20, 100_000])
def test_a_bracket_that_misses_is_run_again(spark, monkeypatch, small):
    """A sketch this coarse points anywhere; the result is exact all the same."""
    monkeypatch.setattr(stats, "SMALL_GROUP", small)
    rng = random.Random(6)
    rows = [(k, rng.random()) for k in "ab" for _ in range(5_000)]
    df = spark.createDataFrame(rows, "k string, _v double").repartition(7)
    got = {r.k: (r.low, r.high) for r in stats._bracketed_ranks(df, ["k"], lambda n: (F.lit(1234), F.lit(1235)), accuracy=3).collect()}
    for key in "ab":
        ordered = sorted(v for k, v in rows if k == key)
        assert got[key] == (ordered[1234], ordered[1235])


def test_only_small_groups_are_gathered(spark, monkeypatch):
    """The plan that sorts whole groups leaves the large ones out before its shuffle."""
    monkeypatch.setattr(stats, "SMALL_GROUP", 1_500)
    _, df = grouped(spark)
    plan = stats.exact_percentile(df, ["k"], F.col("v"), 0.5, "x")._jdf.queryExecution().executedPlan().toString()
    gather = plan[plan.index("partial_collect_list") :]
    assert "LeftAnti" in gather.split("Union")[0]


def test_medians_and_modes(spark):
    rows = [(1, 2.0, "b"), (3, None, "a"), (2, 8.0, "a"), (None, 4.0, "b"), (5, 9.0, None)]
    df = spark.createDataFrame(rows, "i int, d double, s string")
    assert {r["column"]: r["median"] for r in stats.medians(df, ["i", "d"]).collect()} == {"i": 2.5, "d": 6.0}
    assert {r["column"]: r["mode"] for r in stats.modes(df, ["s", "i"]).collect()} == {"s": "a", "i": "1"}


@pytest.mark.parametrize("small", [0, 100_000])
def test_stratified_split_is_exact(spark, monkeypatch, small):
    monkeypatch.setattr(stats, "SMALL_GROUP", small)
    df = spark.range(5003).select("id", F.when(F.col("id") % 3 == 0, "a").when(F.col("id") == 1, "solo").otherwise("b").alias("label"))
    got = features.stratified_split(df, "id", "label").collect()
    n, train = Counter(r.label for r in got), Counter(r.label for r in got if r.is_train)
    assert {k: train[k] for k in n} == {k: math.floor(0.8 * n[k]) for k in n}
    again = features.stratified_split(df.repartition(5), "id", "label").collect()
    assert sorted(got) == sorted(again)


def test_hash_split_share(spark):
    got = features.hash_split(spark.range(10_000), "id").where("is_train").count()
    assert 7_800 < got < 8_200
