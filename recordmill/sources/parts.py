"""Tables copied on write by part: a day, or a bucket of a key's hash.

A change writes new folders for the parts it touches and one commit points the table at them.
Folders of other parts are not touched, and a reader sees the table before or after a change,
never between.

    rows/attempt=../<column>=../   the rows of a part, as one change left them
    commits/                       which of these each part's are, and the columns
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordmill.operators.checks import TableState
from recordmill.sources import tables
from recordmill.sources.commits import Log

# A line says where a part's rows are, with the columns of the table, how far a writer has come, or a setting.
LINES = T.StructType([T.StructField(c, T.StringType()) for c in ("key", "attempt", "columns")] + [T.StructField("number_of", T.LongType()), T.StructField("state", T.StringType())])
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def named(values: Sequence) -> list[str]:
    """Part values as folders name them."""
    return [NO_VALUE if v is None else str(v) for v in values]


class Snapshot:
    """A table as its newest commit has it: one folder for each part, known columns."""

    def __init__(self, spark: SparkSession, path: str, column: str):
        self.spark, self.path, self.column = spark, path.rstrip("/"), column
        self.log = Log(spark, f"{self.path}/commits", LINES, ["key"])
        self.number = self.log.newest()
        lines = self.log.current().where(F.col("number") <= self.number).collect() if self.number else []  # one a part
        told = {kind: {r.key.partition(":")[2]: r for r in lines if r.key.startswith(f"{kind}:")} for kind in ("part", "writer", "setting")}
        self.parts = {k: r.attempt for k, r in told["part"].items()}
        self._states = {k: json.loads(r.state) for k, r in told["part"].items()}
        self.writers = {k: r.number_of for k, r in told["writer"].items()}
        self.settings = {k: r.number_of for k, r in told["setting"].items()}
        newest = max(told["part"].values(), key=lambda r: r.number, default=None)
        self.columns = T.StructType.fromJson(json.loads(newest.columns)) if newest else None

    def folder(self, part: str) -> str:
        return f"{self.path}/rows/attempt={self.parts[part]}/{self.column}={part}"

    def read(self, parts: Sequence[str] | None = None) -> DataFrame | None:
        """Rows of the table or of some parts; None when there is no table. Columns that older parts lack are NULL there."""
        if self.columns is None:
            return None
        wanted = [self.folder(p) for p in sorted(self.parts) if parts is None or p in parts]
        if not wanted:
            return self.spark.createDataFrame([], self.columns)
        rows = self.spark.read.schema(self.columns).option("basePath", f"{self.path}/rows").parquet(*wanted)
        return rows.select(*self.columns.names)

    def state(self) -> TableState:
        """What checks ask of the table, merged from what was counted when each part was written."""
        whole = TableState(0)
        for i, told in enumerate(self._states.values()):
            newest = {c: t and datetime.fromisoformat(t) for c, t in told["newest"].items()}
            one = TableState(told["rows"], told["nulls"], newest, {tuple(k): n for k, n in told["duplicates"]})
            whole = whole.merged(one) if i else one
        return whole

    def _counted(self, target: str, schema: T.StructType, unique: Sequence[Sequence[str]]) -> dict[str, dict]:
        """Per part written to ``target``: rows, NULLs of each column, newest times, and repeated keys."""
        rows = self.spark.read.schema(schema).parquet(target)
        by = F.col(self.column).cast("string").alias("_part")
        times = [f.name for f in schema if f.name != self.column and isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))]
        nulls = [F.count_if(F.col(f.name).isNull()).alias(f"null {f.name}") for f in schema]
        newest = [F.date_format(F.max(c).cast("timestamp"), tables.ISO).alias(f"newest {c}") for c in times]
        told = {}
        for row in rows.groupBy(by).agg(F.count(F.lit(1)).alias("rows"), *nulls, *newest).collect():
            told[named([row["_part"]])[0]] = {
                "rows": row["rows"],
                "nulls": {f.name: row[f"null {f.name}"] for f in schema},
                "newest": {c: row[f"newest {c}"] for c in times},
                "duplicates": [[list(keys), 0] for keys in unique],
            }
        for i, keys in enumerate(unique):
            repeated = rows.groupBy(by, *keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").groupBy("_part").count()
            for row in repeated.collect():
                told[named([row["_part"]])[0]]["duplicates"][i][1] = row["count"]
        return told

    def replace(
        self,
        rows: DataFrame,
        parts: Sequence[str],
        settings: dict[str, int] | None = None,
        writer: str | None = None,
        batch_id: int | None = None,
        unique: Sequence[Sequence[str]] = (),
    ) -> None:
        """Let ``rows`` be all rows of these parts; fails if another change was published since this snapshot.

        Rows, NULLs, newest times and repeated keys are counted from the new folders and kept
        with the commit. A key of ``unique`` must not occur in two parts of the table.
        """
        lines = [{"key": f"setting:{k}", "number_of": v} for k, v in (settings or {}).items()]
        lines += [] if writer is None else [{"key": f"writer:{writer}", "number_of": batch_id}]
        if parts:
            attempt = uuid.uuid4().hex
            target = f"{self.path}/rows/attempt={attempt}"
            rows.hint("rebalance", self.column).write.partitionBy(self.column).parquet(target)
            columns, told = json.dumps(rows.schema.jsonValue()), self._counted(target, rows.schema, unique)
            lines += [{"key": f"part:{p}", "attempt": attempt, "columns": columns, "state": json.dumps(told[p])} for p in parts]
        if lines:
            self.log.publish(lines, after=self.number)

    def has_taken(self, writer: str | None, batch_id: int | None) -> bool:
        """Whether the writer's batch, or a newer one, is in the table already."""
        return writer is not None and self.writers.get(writer, -1) >= batch_id

    def drop_unseen(self) -> int:
        """Delete folders the snapshot does not point at; call it when nobody reads or writes an older one."""
        kept = {self.folder(p).rpartition("/rows/")[2] for p in self.parts}
        old = [f for a in tables.subfolders(self.spark, f"{self.path}/rows") for f in tables.subfolders(self.spark, a) if f.rpartition("/rows/")[2] not in kept]
        for folder in old:
            store, found = tables.file_system(self.spark, folder)
            store.delete(found, True)
        return len(old)
