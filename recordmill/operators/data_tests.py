"""Row-level tests: each returns the rows that break a rule."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.session import cut_lineage


class DataTestFailure(Exception):
    """Raised when a table breaks a rule the next layer depends on."""


def is_missing(column: str) -> Column:
    """Condition of a row that breaks ``not_null``."""
    return F.col(column).isNull()


def out_of_range(column: str, min_value=None, max_value=None) -> Column:
    """Condition of a row outside the inclusive bounds; NULL for a NULL value, which passes."""
    inside = F.lit(True)
    if min_value is not None:
        inside = inside & (F.col(column) >= F.lit(min_value))
    if max_value is not None:
        inside = inside & (F.col(column) <= F.lit(max_value))
    return ~inside


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(is_missing(column))


def accepted_range(df: DataFrame, column: str, min_value=None, max_value=None) -> DataFrame:
    """Rows outside the inclusive bounds; NULL passes."""
    return df.where(out_of_range(column, min_value, max_value))


def duplicate_groups(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once, with their count; NULLs form groups."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, NULLs aside."""
    return duplicate_groups(df.where(F.col(column).isNotNull()), [column])


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return duplicate_groups(df, columns).drop("n_records")


def relationships(child: DataFrame, key: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose key is set but has no parent.

    The parent's keys are reduced to one row each and written down first: a parent row
    repeated many times costs one row per task, and the join is then between two plain
    shuffles, where adaptive skew handling splits the child rows of a hot key.
    """
    keyed = child.where(F.col(key).isNotNull())
    parents = cut_lineage(parent.select(F.col(field).alias("_parent")).where(F.col("_parent").isNotNull()).distinct())
    return keyed.join(parents, F.col(key) == F.col("_parent"), "left_anti")


def orphan_keys(child: DataFrame, key: str, parent: DataFrame, field: str) -> DataFrame:
    """Distinct child keys without a parent and how many child rows hold each."""
    keys = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_records"))
    parents = parent.select(F.col(field).alias("_parent")).distinct()
    return keys.join(parents, F.col(key) == F.col("_parent"), "left_anti")


def age_hours(newest: Column, as_of: datetime | Column) -> Column:
    """Hours from a timestamp to ``as_of``, with the fraction."""
    until = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return (F.unix_micros(until.cast("timestamp")) - F.unix_micros(newest.cast("timestamp"))) / F.lit(3.6e9)


def source_freshness(
    df: DataFrame, by: str, loaded_at: str, as_of: datetime, warn_after: float = 12, error_after: float = 48
) -> DataFrame:
    """Per source the age of the newest row and ``pass``, ``warn`` or ``error``."""
    hours = F.col("hours_since_last")
    status = F.when(hours.isNull() | (hours > error_after), "error").when(hours > warn_after, "warn").otherwise("pass")
    return (
        df.groupBy(by)
        .agg(F.max(loaded_at).alias("_newest"))
        .select(by, age_hours(F.col("_newest"), as_of).alias("hours_since_last"))
        .withColumn("status", status)
    )


@dataclass(frozen=True)
class Rules:
    """What a table must meet before anything is built on it.

    ``rows`` are conditions of a broken row, all looked for in one scan; ``sets`` give the
    violations of rules about the table as a whole.
    """

    rows: Mapping[str, Column] = field(default_factory=dict)
    sets: Mapping[str, Callable[[DataFrame], DataFrame]] = field(default_factory=dict)


def rules(
    needed: Sequence[str] = (),
    at_least: Mapping[str, float] | None = None,
    sets: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None,
) -> Rules:
    """Rules from columns that must be set, lower bounds, and whole-table tests."""
    rows = {f"not_null({c})": is_missing(c) for c in needed}
    rows |= {f"accepted_range({c})": out_of_range(c, bound) for c, bound in (at_least or {}).items()}
    return Rules(rows, dict(sets or {}))


def broken_rules(df: DataFrame, wanted: Rules) -> list[str]:
    """Names of the rules the table breaks."""
    broken = []
    if wanted.rows:
        marks = df.select(*[c.alias(f"_{i}") for i, c in enumerate(wanted.rows.values())])
        found = marks.agg(*[F.bool_or(c) for c in marks.columns]).first()
        broken = [name for i, name in enumerate(wanted.rows) if found[i]]
    return broken + [name for name, violations in wanted.sets.items() if not violations(df).isEmpty()]


def require(df: DataFrame, table: str, wanted: Rules) -> DataFrame:
    """The table itself, or an error that stops the build before the next layer."""
    broken = broken_rules(df, wanted)
    if broken:
        raise DataTestFailure(f"{table}: {', '.join(broken)}")
    return df
