"""Declarative table checks and the gate over their results.

Checks that are aggregates over a table share one scan of it. Each check is analysed and,
if the shared job fails, run on its own, so a broken check fails alone.
"""

from __future__ import annotations

import json
import operator
from collections import defaultdict
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill import schemas
from recordmill.operators.data_tests import duplicate_groups
from recordmill.sources import tables

Spec = Mapping[str, Any]

# The comparison names a custom check may use.
COMPARISONS: dict[str, Callable[[Any, Any], Any]] = {
    "eq": operator.eq,
    "ne": operator.ne,
    "lt": operator.lt,
    "lte": operator.le,
    "gt": operator.gt,
    "gte": operator.ge,
}


@dataclass
class CheckResult:
    """Outcome of one check."""

    name: str
    type: str
    severity: str
    passed: bool
    details: dict[str, Any] = field(default_factory=dict)
    error: str | None = None


class Verdict(NamedTuple):
    passed: bool
    details: dict[str, Any]
    error: str | None = None


@dataclass(frozen=True)
class TableState:
    """What is known of a table without reading it; states of disjoint rows can be merged.

    ``nulls`` by column, ``newest`` by time column, ``duplicates`` (key combinations that occur
    more than once) by key columns. A column that is not there is not known.
    """

    rows: int
    nulls: Mapping[str, int] = field(default_factory=dict)
    newest: Mapping[str, datetime | None] = field(default_factory=dict)
    duplicates: Mapping[tuple[str, ...], int] = field(default_factory=dict)

    def merged(self, other: "TableState") -> "TableState":
        """The state of both; a column that one of them lacks is NULL in its rows. Equal keys must lie on one side."""
        null = lambda s, c: s.nulls.get(c, s.rows)
        times = lambda c: [t for t in (self.newest.get(c), other.newest.get(c)) if t is not None]
        return TableState(
            self.rows + other.rows,
            {c: null(self, c) + null(other, c) for c in {*self.nulls, *other.nulls}},
            {c: max(times(c), default=None) for c in {*self.newest, *other.newest}},
            {k: self.duplicates[k] + other.duplicates[k] for k in self.duplicates.keys() & other.duplicates.keys()},
        )


class AggregateCheck(NamedTuple):
    """A check answered by aggregates over its table, or by the table's state: ``known`` gives the same measures or None."""

    measures: Callable[[Spec, datetime], dict[str, Column]]
    judge: Callable[[Spec, Mapping[str, Any]], Verdict]
    known: Callable[[Spec, datetime, TableState], dict[str, Any] | None] = lambda spec, as_of, state: None


class QueryCheck(NamedTuple):
    """A check that runs a query of its own, unless the table's state gives the verdict."""

    run: Callable[[SparkSession, Spec, Callable[[str], DataFrame]], Verdict]
    known: Callable[[Spec, TableState], Verdict | None] = lambda spec, state: None


# --- measures, also usable on their own ------------------------------------------------


def row_count() -> Column:
    return F.count(F.lit(1))


def null_count(column: str | Column) -> Column:
    column = F.expr(column) if isinstance(column, str) else column
    return F.count_if(column.isNull())


def null_share(nulls: Column, total: Column) -> Column:
    """NULL rows over all rows, 0.0 for an empty table."""
    return F.when(total > 0, nulls / total).otherwise(F.lit(0.0))


def whole_hours_since(newest: Column, as_of: datetime) -> Column:
    """Full hours from the newest timestamp to ``as_of``, cut toward zero."""
    return F.timestamp_diff("HOUR", newest.cast("timestamp"), F.lit(as_of).cast("timestamp"))


def duplicate_group_count(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row ``dup_groups``: how many key combinations occur more than once."""
    return duplicate_groups(df, columns).agg(row_count().alias("dup_groups"))


# --- the five check types --------------------------------------------------------------


def _judge_row_count(spec: Spec, got: Mapping[str, Any]) -> Verdict:
    least = int(spec.get("min_rows", 1))
    return Verdict(got["rows"] >= least, {"table": spec["table"], "actual_rows": got["rows"], "min_rows": least})


def _judge_freshness(spec: Spec, got: Mapping[str, Any]) -> Verdict:
    limit = int(spec.get("max_age_hours", 24))
    hours = got["hours"]
    if hours is None:
        return Verdict(False, {"table": spec["table"], "reason": "table empty or timestamp all null"})
    details = {"table": spec["table"], "timestamp_column": spec.get("timestamp_column", "ingested_at")}
    return Verdict(hours <= limit, {**details, "hours_since_last": hours, "max_age_hours": limit})


def _judge_null_rate(spec: Spec, got: Mapping[str, Any]) -> Verdict:
    limit = float(spec.get("max_null_rate", 0.0))
    total, nulls = got["rows"], got["nulls"]
    share = nulls / total if total else 0.0
    details = {"table": spec["table"], "column": spec["column"], "total_rows": total, "null_rows": nulls}
    return Verdict(share <= limit, {**details, "null_rate": round(share, 6), "max_null_rate": limit})


def _known_age(spec: Spec, as_of: datetime, state: TableState) -> dict[str, Any] | None:
    column = spec.get("timestamp_column", "ingested_at")
    if column not in state.newest:
        return None
    newest = state.newest[column]
    return {"hours": None if newest is None else int((as_of - newest) / timedelta(hours=1))}


def _known_nulls(spec: Spec, as_of: datetime, state: TableState) -> dict[str, Any] | None:
    nulls = state.nulls.get(spec["column"])
    return None if nulls is None else {"rows": state.rows, "nulls": nulls}


def _judge_uniqueness(spec: Spec, groups: int) -> Verdict:
    return Verdict(groups == 0, {"table": spec["table"], "columns": list(spec["columns"]), "duplicate_groups": groups})


def _run_uniqueness(spark: SparkSession, spec: Spec, table: Callable[[str], DataFrame]) -> Verdict:
    return _judge_uniqueness(spec, tables.scalar(duplicate_group_count(table(spec["table"]), list(spec["columns"]))))


def _known_uniqueness(spec: Spec, state: TableState) -> Verdict | None:
    groups = state.duplicates.get(tuple(spec["columns"]))
    return None if groups is None else _judge_uniqueness(spec, groups)


def compare(actual: Any, comparison: str, expected: Any) -> Verdict:
    """Compare a scalar; an unknown name or types that do not compare fail with an error."""
    if comparison not in COMPARISONS:
        return Verdict(False, {}, f"Unknown comparison operator: {comparison}")
    details = {"actual": actual, "expected": expected}
    try:
        passed = bool(COMPARISONS[comparison](actual, expected))
    except TypeError as exc:
        return Verdict(False, details, f"Comparison failed: {exc}")
    return Verdict(passed, {**details, "comparison": comparison})


def _run_custom_sql(spark: SparkSession, spec: Spec, table: Callable[[str], DataFrame], scalars: dict[str, Any] | None = None) -> Verdict:
    scalars = {} if scalars is None else scalars
    if spec["sql"] not in scalars:
        scalars[spec["sql"]] = tables.scalar(spark.sql(spec["sql"]))
    actual = scalars[spec["sql"]]
    return compare(actual, spec.get("comparison", "eq"), spec.get("expected_value", 0))


REGISTRY: dict[str, AggregateCheck | QueryCheck] = {
    "row_count_min": AggregateCheck(
        lambda spec, as_of: {"rows": row_count()}, _judge_row_count, lambda spec, as_of, state: {"rows": state.rows}
    ),
    "freshness": AggregateCheck(
        lambda spec, as_of: {"hours": whole_hours_since(F.max(spec.get("timestamp_column", "ingested_at")), as_of)},
        _judge_freshness,
        _known_age,
    ),
    "null_rate": AggregateCheck(
        lambda spec, as_of: {"rows": row_count(), "nulls": null_count(spec["column"])}, _judge_null_rate, _known_nulls
    ),
    "uniqueness": QueryCheck(_run_uniqueness, _known_uniqueness),
    "custom_sql": QueryCheck(_run_custom_sql),
}


def register(name: str, check: AggregateCheck | QueryCheck) -> None:
    """Add a check type under a name specs can use."""
    REGISTRY[name] = check


# --- running ---------------------------------------------------------------------------


def load_specs(text: str) -> list[dict[str, Any]]:
    """Check specs from JSON text, which must be an array."""
    specs = json.loads(text)
    if not isinstance(specs, list):
        raise ValueError(f"checks must be a JSON array, got {type(specs).__name__}")
    return specs


def _result(spec: Spec, verdict: Verdict) -> CheckResult:
    return CheckResult(
        name=spec.get("name", "<unnamed>"),
        type=spec.get("type") or "<unknown>",
        severity=spec.get("severity", "error"),
        passed=verdict.passed,
        details=verdict.details,
        error=verdict.error,
    )


def _failed(exc: Exception) -> Verdict:
    return Verdict(False, {}, str(exc))


def _judge(spec: Spec, got: Mapping[str, Any]) -> Verdict:
    try:
        return REGISTRY[spec["type"]].judge(spec, got)
    except Exception as exc:  # a check never stops the others
        return _failed(exc)


def _measure_table(df: DataFrame, checks: list[tuple[int, Spec]], as_of: datetime) -> dict[int, Verdict]:
    """All aggregate checks of one table in one job."""
    columns: dict[int, list[Column]] = {}
    verdicts: dict[int, Verdict] = {}
    for i, spec in checks:
        try:
            measures = REGISTRY[spec["type"]].measures(spec, as_of)
            columns[i] = [c.alias(f"{i}.{name}") for name, c in measures.items()]
            df.agg(*columns[i]).schema  # analyses this check alone
        except Exception as exc:
            columns.pop(i, None)
            verdicts[i] = _failed(exc)
    if not columns:
        return verdicts
    by_index = dict(checks)

    def judge(row, indexes) -> dict[int, Verdict]:
        values = row.asDict()
        return {
            i: _judge(by_index[i], {k.split(".", 1)[1]: v for k, v in values.items() if k.split(".", 1)[0] == str(i)})
            for i in indexes
        }

    try:
        verdicts.update(judge(df.agg(*[c for cs in columns.values() for c in cs]).first(), columns))
    except Exception:
        for i, own in columns.items():
            try:
                verdicts.update(judge(df.agg(*own).first(), [i]))
            except Exception as exc:
                verdicts[i] = _failed(exc)
    return verdicts


def run_checks(
    spark: SparkSession,
    specs: Sequence[Spec],
    as_of: datetime,
    table: Callable[[str], DataFrame] | None = None,
    state: Callable[[str], TableState | None] = lambda name: None,
) -> list[CheckResult]:
    """Run every check and give the results in the order of the specs.

    ``table`` finds a DataFrame by table name; by default the session's catalog does.
    ``state`` gives what is known of a table; a check it answers reads no row. SQL that
    several checks share runs once.
    """
    table = table or spark.table
    states: dict[str, TableState | None] = {}
    scalars: dict[str, Any] = {}

    def known(check: AggregateCheck | QueryCheck, spec: Spec) -> Verdict | None:
        name = spec.get("table")
        if name is None:
            return None
        if name not in states:
            states[name] = state(name)
        if states[name] is None:
            return None
        if isinstance(check, QueryCheck):
            return check.known(spec, states[name])
        got = check.known(spec, as_of, states[name])
        return None if got is None else _judge(spec, got)

    verdicts: dict[int, Verdict] = {}
    shared: dict[str, list[tuple[int, Spec]]] = defaultdict(list)
    for i, spec in enumerate(specs):
        check = REGISTRY.get(spec.get("type"))
        if check is None:
            verdicts[i] = Verdict(False, {}, f"Unknown check type: {spec.get('type')}")
            continue
        try:
            told = known(check, spec)
        except Exception:  # the check itself will tell
            told = None
        if told is not None:
            verdicts[i] = told
        elif isinstance(check, AggregateCheck) and "table" in spec:
            shared[spec["table"]].append((i, spec))
        else:
            try:
                verdicts[i] = check.run(spark, spec, table, scalars) if check.run is _run_custom_sql else check.run(spark, spec, table)
            except Exception as exc:
                verdicts[i] = _failed(exc)
    for name, checks in shared.items():
        try:
            verdicts.update(_measure_table(table(name), checks, as_of))
        except Exception as exc:
            verdicts.update({i: _failed(exc) for i, _ in checks})
    return [_result(spec, verdicts[i]) for i, spec in enumerate(specs)]


def results_table(spark: SparkSession, results: Sequence[CheckResult]) -> DataFrame:
    """Check results as rows, details as JSON text."""
    rows = [
        (r.name, r.type, r.severity, r.passed, json.dumps(r.details, default=str), r.error) for r in results
    ]
    return spark.createDataFrame(rows, schemas.CHECK_RESULTS)


def gate(results: DataFrame) -> DataFrame:
    """One row: passed unless a check of severity ``error`` failed; ``warn`` never blocks."""
    failed = ~F.col("passed")
    errors = F.count_if(failed & (F.col("severity") == "error"))
    return results.agg(
        (errors == 0).alias("passed"),
        row_count().alias("total_checks"),
        errors.alias("error_count"),
        F.count_if(failed & (F.col("severity") == "warn")).alias("warn_count"),
    )
