"""Exact percentiles and modes that never gather an unbounded group in one task.

``percentile()`` keeps every distinct value of a group in one buffer. Here the groups are
counted first. Those up to ``SMALL_GROUP`` rows are sorted whole, a bounded amount each.
For the larger ones a mergeable sketch of fixed size gives a bracket of values around the
wanted ranks, narrowed again until it is expected to hold no more than ``SMALL_GROUP``
rows; a last scan counts what lies below the bracket and sorts the distinct values in it.
All scans aggregate before they shuffle, so a group holding most of the rows is spread
over all tasks. The sketch only decides where the bracket lies: a group whose ranks fall
outside it is run again with a finer sketch, so the result is always exact.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import Window

from recordmill.session import cut_lineage

SMALL_GROUP = 100_000
# Per-group tables (one row of about 100 bytes each) up to this many groups are broadcast;
# beyond it the rows are joined on salted keys.
BROADCAST_GROUPS = 50_000
JOIN_SALTS = 32
SKETCH_ACCURACY = 10_000
# The sketch is asked for this many evenly spaced points; a bracket spans about three of
# them, so each narrowing leaves some three thousandths of the rows.
GRID = 1_000
MAX_NARROWINGS = 10

Ranks = Callable[[Column], tuple[Column, Column]]


def _same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[f"_g_{key}"])
    return condition


def _join_groups(
    rows: DataFrame, groups: DataFrame, keys: Sequence[str], n_groups: int, how: str = "inner", keep: bool = False
) -> DataFrame:
    """Attach the per-group row to every row; ``groups`` holds the keys as ``_g_<key>``."""
    drop = [] if keep else [f"_g_{k}" for k in keys]
    if n_groups <= BROADCAST_GROUPS:
        return rows.join(F.broadcast(groups), _same_keys(rows, groups, keys), how).drop(*drop)
    salted = rows.withColumn("_salt", F.spark_partition_id() % JOIN_SALTS)
    copies = groups.withColumn("_g_salt", F.explode(F.sequence(F.lit(0), F.lit(JOIN_SALTS - 1))))
    condition = _same_keys(salted, copies, keys) & (salted["_salt"] == copies["_g_salt"])
    return salted.join(copies, condition, how).drop("_salt", "_g_salt", *drop)


def _as_group_keys(keys: Sequence[str]) -> list[Column]:
    return [F.col(k).alias(f"_g_{k}") for k in keys]


def select_ranks(df: DataFrame, keys: Sequence[str], value: Column, ranks: Ranks) -> DataFrame:
    """Per group, the values at two zero-based ranks: columns ``keys, n, low, high``.

    ``ranks(n)`` gives the ranks, the lower one first, for a group of ``n`` non-NULL values.
    Equal values hold one rank each. A negative rank gives NULL. ``keys`` names at least
    one column; for one group over all rows pass a constant column.
    """
    rows = df.select(*keys, value.cast("double").alias("_v")).where(F.col("_v").isNotNull())
    sizes = rows.groupBy(*_as_group_keys(keys)).agg(F.count(F.lit(1)).alias("n"))
    seen = Observation()
    counted = sizes.observe(seen, F.count(F.lit(1)).alias("groups"))
    large = cut_lineage(counted.where(F.col("n") > SMALL_GROUP).drop("n"))
    n_large = large.count()
    if n_large == 0:
        return _sorted_ranks(rows, keys, ranks)
    if n_large == seen.get["groups"]:
        return _bracketed_ranks(rows, keys, ranks)
    small_rows = _join_groups(rows, large, keys, n_large, "left_anti")
    large_rows = _join_groups(rows, large, keys, n_large, "left_semi")
    return _sorted_ranks(small_rows, keys, ranks).unionByName(_bracketed_ranks(large_rows, keys, ranks))


def _sorted_ranks(rows: DataFrame, keys: Sequence[str], ranks: Ranks) -> DataFrame:
    """Ranks of groups known to be small, each sorted as one array."""
    first, second = ranks(F.col("n"))

    def at(rank: Column) -> Column:
        return F.get("_all", rank.cast("int"))

    arrays = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("_v")).alias("_all"))
    return arrays.select(*keys, "n", at(first).alias("low"), at(second).alias("high"))


def _grid_points(value: Column, accuracy: int) -> Column:
    return F.percentile_approx(value, [i / GRID for i in range(GRID + 1)], accuracy)


def _narrowed(ranks: Ranks, below: Column, inside: Column) -> list[Column]:
    """Bracket and expected rows in it, from the grid over ``inside`` rows after ``below``."""
    first, second = [F.greatest(rank, F.lit(0)) - below for rank in ranks(F.col("n"))]
    low = F.greatest(F.floor(F.try_divide(first, inside) * GRID) - 1, F.lit(0)).cast("int")
    high = F.least(F.ceil(F.try_divide(second, inside) * GRID) + 1, F.lit(GRID)).cast("int")
    return [
        F.get("_grid", low).alias("_from"),
        F.get("_grid", high).alias("_to"),
        (inside * (high - low) / GRID).alias("_expected"),
    ]


def _brackets(rows: DataFrame, keys: Sequence[str], ranks: Ranks, accuracy: int) -> tuple[DataFrame, int]:
    """Per group a range of values around its ranks, and the number of groups."""
    names = [f"_g_{k}" for k in keys]
    sketch = rows.groupBy(*_as_group_keys(keys)).agg(
        F.count(F.lit(1)).alias("n"), _grid_points(F.col("_v"), accuracy).alias("_grid")
    )
    found = cut_lineage(sketch.select(*names, "n", *_narrowed(ranks, F.lit(0), F.col("n"))))
    n_groups = found.count()
    first, second = ranks(F.col("n"))
    for _ in range(MAX_NARROWINGS):
        if found.where((F.col("_expected") > SMALL_GROUP) & (F.col("_from") < F.col("_to"))).isEmpty():
            break
        inside = F.col("_v").between(F.col("_from"), F.col("_to"))
        counts = (
            _join_groups(rows, found, keys, n_groups, keep=True)
            .groupBy(*names, "n", F.col("_from").alias("_was_from"), F.col("_to").alias("_was_to"))
            .agg(
                F.count_if(F.col("_v") < F.col("_from")).alias("_below"),
                F.count_if(inside).alias("_inside"),
                _grid_points(F.when(inside, F.col("_v")), accuracy).alias("_grid"),
            )
        )
        # A bracket that misses its ranks is left as it is, for the last scan to find out.
        holds = (F.greatest(first, F.lit(0)) >= F.col("_below")) & (second < F.col("_below") + F.col("_inside"))
        low, high, expected = _narrowed(ranks, F.col("_below"), F.col("_inside"))
        found = cut_lineage(
            counts.select(
                *names,
                "n",
                F.when(holds, low).otherwise(F.col("_was_from")).alias("_from"),
                F.when(holds, high).otherwise(F.col("_was_to")).alias("_to"),
                F.when(holds, expected).otherwise(0.0).alias("_expected"),
            )
        )
    return found.drop("_expected"), n_groups


def _bracketed_ranks(rows: DataFrame, keys: Sequence[str], ranks: Ranks, accuracy: int = SKETCH_ACCURACY) -> DataFrame:
    """Ranks of groups of any size, by sketch and bracket."""
    brackets, n_groups = _brackets(rows, keys, ranks, accuracy)
    side = F.when(F.col("_v") < F.col("_from"), -1).when(F.col("_v") > F.col("_to"), 1).otherwise(0)
    counted = (
        _join_groups(rows, brackets, keys, n_groups)
        .withColumn("_side", side)
        .withColumn("_v", F.when(F.col("_side") == 0, F.col("_v")))
        .groupBy(*keys, "n", "_side", "_v")
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    running = Window.partitionBy(*keys).orderBy("_side", "_v")
    first, second = ranks(F.col("n"))
    placed = counted.withColumn("_end", F.sum("_c").over(running)).withColumn("_start", F.col("_end") - F.col("_c"))

    def holds(rank: Column) -> Column:
        return (F.col("_start") <= rank) & (rank < F.col("_end"))

    # A group without a wanted rank keeps one row, with NULLs.
    picked = cut_lineage(
        placed.where(holds(first) | holds(second) | (F.col("_start") == 0))
        .groupBy(*keys, "n")
        .agg(
            F.max(F.when(holds(first), F.col("_v"))).alias("low"),
            F.max(F.when(holds(second), F.col("_v"))).alias("high"),
        )
    )
    outside = ((first >= 0) & F.col("low").isNull()) | ((second >= 0) & F.col("high").isNull())
    again = picked.where(outside).select(*_as_group_keys(keys))
    n_again = again.count()
    if n_again == 0:
        return picked
    redo = _bracketed_ranks(_join_groups(rows, again, keys, n_again, "left_semi"), keys, ranks, accuracy * 10)
    return picked.where(~outside).unionByName(redo)


def exact_percentile(df: DataFrame, keys: Sequence[str], value: Column, p: float, name: str) -> DataFrame:
    """Linearly interpolated percentile of ``value`` per group: columns ``keys, name``."""

    def ranks(n: Column) -> tuple[Column, Column]:
        position = F.lit(float(p)) * (n - 1)
        return F.floor(position), F.ceil(position)

    position = F.lit(float(p)) * (F.col("n") - 1)
    part = position - F.floor(position)
    between = F.col("low") + (F.col("high") - F.col("low")) * part
    return select_ranks(df, keys, value, ranks).select(*keys, between.alias(name))


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The exact median of each numeric column: rows ``column, median``."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    tall = df.select(F.inline(F.array(*pairs)))
    return exact_percentile(tall, ["column"], F.col("value"), 0.5, "median")


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The most frequent value of each column as text, the smallest on a tie: ``column, mode``."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    counts = (
        df.select(F.inline(F.array(*pairs)))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.groupBy("column").agg(F.min(F.struct(-F.col("n"), F.col("value"))).alias("m")).select("column", F.col("m.value").alias("mode"))
