"""Catalog tables over folders that commits make visible, so that SQL finds them by name."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from recordmill.sources import tables

AT_ONCE = 500  # partitions of one statement


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spec(columns: Sequence[str], values: Sequence[str | None]) -> str:
    told = ", ".join(f"`{c}` = {'NULL' if v is None else _quoted(v)}" for c, v in zip(columns, values))
    return f"PARTITION ({told})"


def _known(spark: SparkSession, name: str) -> set[str]:
    return {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}


def publish(
    spark: SparkSession, name: str, schema: T.StructType, by: Sequence[str], location: str, folders: Mapping[tuple, str], changed: Iterable[tuple] = ()
) -> None:
    """Let ``name`` be an external table with exactly these partitions: values of ``by`` to folder.

    Partitions that are there already stay unless they are ``changed``. A table of that name
    with other columns or another location is replaced; no file is ever deleted.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.partition('.')[0]}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    store, path = tables.file_system(spark, location)
    where = store.makeQualified(path).toString()
    mark = f"{where} ({columns})"
    if spark.catalog.tableExists(name):
        told = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        if told.get("recordmill.table") != mark:
            spark.sql(f"DROP TABLE {name}")
    if not spark.catalog.tableExists(name):
        parts = ", ".join(f"`{c}`" for c in by)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({parts}) LOCATION {_quoted(where)} TBLPROPERTIES ('recordmill.table' = {_quoted(mark)})")
    shown = lambda values: "/".join(f"{c}={'__HIVE_DEFAULT_PARTITION__' if v is None else tables.escaped(spark, v)}" for c, v in zip(by, values))
    wanted = {shown(values): values for values in folders}
    known, again = _known(spark, name), {shown(v) for v in changed}
    for gone in sorted(known - wanted.keys() | known & again):
        values = [None if v == "__HIVE_DEFAULT_PARTITION__" else tables.unescaped(spark, v) for v in (p.partition("=")[2] for p in gone.split("/"))]
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {_spec(by, values)}")
    new = [v for s, v in sorted(wanted.items()) if s not in known or s in again]
    for i in range(0, len(new), AT_ONCE):
        told = " ".join(f"{_spec(by, v)} LOCATION {_quoted(store.makeQualified(tables.file_system(spark, folders[v])[1]).toString())}" for v in new[i : i + AT_ONCE])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {told}")
    spark.catalog.refreshTable(name)
