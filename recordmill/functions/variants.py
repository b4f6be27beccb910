"""Reading typed values out of VARIANT columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_path(dotted: str, nested: bool = True) -> str:
    """``'a.b'`` as a VARIANT path; the empty string is the whole value.

    With ``nested=False`` the text is one key, dots included.
    """
    if "'" in dotted:
        raise ValueError(f"quote in JSON path: {dotted!r}")
    keys = dotted.split(".") if nested else [dotted]
    return "$" + "".join(f"['{key}']" for key in keys if key)


def resolve(payload: Column, dotted: str) -> Column:
    """The VARIANT found at a dotted path, NULL when a step is missing or no object."""
    return F.variant_get(payload, json_path(dotted), "variant")


def text_at(payload: Column, dotted: str) -> Column:
    """The value at a dotted path as text; JSON null gives NULL."""
    return F.variant_get(payload, json_path(dotted), "string")


def count_at(payload: Column, dotted: str) -> Column:
    """The value at a dotted path as a count, 0 when missing, empty or null."""
    return F.coalesce(F.try_variant_get(payload, json_path(dotted), "bigint"), F.lit(0))


def typed_at(payload: Column, dotted: str, sql_type: str) -> Column:
    """The value at a dotted path under the rules of a text-then-cast read.

    Integers and timestamps go through text, so ``"7"`` is accepted while ``1.5`` or
    ``"x"`` in an integer column raises. Decimals are read from the VARIANT itself,
    which keeps every digit. Arrays and plain text need no second step.
    """
    if sql_type in ("int", "bigint", "timestamp"):
        return text_at(payload, dotted).cast(sql_type)
    return F.variant_get(payload, json_path(dotted), sql_type)


def truthy(value: Column) -> Column:
    """Whether a VARIANT counts as set: not null, empty, zero or false."""
    kind = F.schema_of_variant(value)
    text = F.variant_get(value, "$", "string")
    is_set = (
        F.when(kind == "STRING", text != "")
        .when(kind == "BOOLEAN", text == "true")
        .when(kind.startswith("ARRAY"), text != "[]")
        .when(kind.startswith("OBJECT"), text != "{}")
        .otherwise(text.try_cast("double") != 0.0)
    )
    return F.coalesce(is_set, F.lit(False))


@dataclass(frozen=True)
class Field:
    """One typed output column: its name, where it sits in the record, its SQL type."""

    name: str
    path: str
    type: str = "string"

    def column(self, payload: Column) -> Column:
        return typed_at(payload, self.path, self.type).alias(self.name)
