"""Type normalisation and schema alignment applied before a table is written."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaChanged(ValueError):
    """A table declared with ``on_schema_change='fail'`` received a different schema."""


def _stored_type(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.IntegralType):
        return T.LongType()
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        return T.DoubleType()
    if isinstance(kind, (T.BooleanType, T.TimestampType, T.TimestampNTZType, T.DateType, T.BinaryType)):
        return kind
    return T.StringType()


def _stored(field: T.StructField) -> Column:
    col, nested = F.col(f"`{field.name}`"), (T.ArrayType, T.StructType, T.MapType)
    if isinstance(field.dataType, nested):
        return F.to_json(col).alias(field.name)
    return col.cast(_stored_type(field.dataType)).alias(field.name)


def map_types(df: DataFrame) -> DataFrame:
    """Integers to long, floats to double, decimals to text, nested values to JSON text."""
    return df.select(*[_stored(f) for f in df.schema])


def _fitted(df: DataFrame, field: T.StructField) -> Column:
    have, col = df.schema[field.name].dataType, F.col(f"`{field.name}`")
    cast = col.cast(field.dataType)
    if isinstance(have, (T.DoubleType, T.FloatType)) and isinstance(field.dataType, T.IntegralType):
        lost = F.raise_error(F.concat(F.lit(f"{field.name} holds whole numbers, got "), col.cast("string")))
        cast = F.when(col.isNull() | (col == F.floor(col)), cast).otherwise(lost.cast(field.dataType))
    return cast


def wider(stored: T.DataType, incoming: T.DataType) -> T.DataType | None:
    """The least type that holds the values of both; None where neither can hold the other's.

    Whole numbers by size, then doubles; decimals by digits before and after the point; a date below a time
    without a zone. All else must be equal, but a text column holds whatever comes.
    """
    if stored == incoming or isinstance(stored, T.StringType):
        return stored
    whole = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
    number = [*whole, T.DoubleType()]
    if stored in number and incoming in number:
        return max(stored, incoming, key=number.index)
    if isinstance(stored, T.DecimalType) and isinstance(incoming, T.DecimalType):
        scale = max(stored.scale, incoming.scale)
        digits = max(stored.precision - stored.scale, incoming.precision - incoming.scale) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else None
    days = [T.DateType(), T.TimestampNTZType()]
    return max(stored, incoming, key=days.index) if stored in days and incoming in days else None


@dataclass(frozen=True)
class Difference:
    """What a batch's schema would change in a stored one."""
    added: dict[str, T.DataType]
    removed: list[str]
    widened: dict[str, T.DataType]
    incompatible: dict[str, tuple[T.DataType, T.DataType]]


def schema_difference(stored: T.StructType, incoming: T.StructType) -> Difference:
    have, come = ({f.name: f.dataType for f in schema} for schema in (stored, incoming))
    both = {n: (have[n], come[n], wider(have[n], come[n])) for n in have if n in come}
    return Difference(
        {n: t for n, t in come.items() if n not in have}, [n for n in have if n not in come],
        {n: least for n, (old, _, least) in both.items() if least not in (None, old)},
        {n: (old, new) for n, (old, new, least) in both.items() if least is None})


def synced_schema(stored: T.StructType, incoming: T.StructType, fixed: Sequence[str] = ()) -> tuple[T.StructType, bool]:
    """The stored schema after it took over the incoming one, and whether stored rows must be written anew.

    New columns come last, missing ones go, wider types replace narrower ones. ``SchemaChanged`` where types are
    incompatible, or a ``fixed`` column (a key, a partition) would go or change.
    """
    found = schema_difference(stored, incoming)
    if found.incompatible:
        raise SchemaChanged("incompatible types: " + ", ".join(
            f"{n} is {old.simpleString()}, got {new.simpleString()}" for n, (old, new) in found.incompatible.items()))
    held = [n for n in fixed if n in found.removed or n in found.widened]
    if held:
        raise SchemaChanged(f"keys and partitions must stay: {', '.join(held)}")
    kept = [T.StructField(f.name, found.widened.get(f.name, f.dataType)) for f in stored if f.name not in found.removed]
    added = [T.StructField(n, t) for n, t in found.added.items()]
    return T.StructType(kept + added), bool(found.removed or found.widened)


MODES = ("align", "sync", "sync_all", "fail")


def align_to_schema(df: DataFrame, schema: T.StructType, mode: str = "align") -> DataFrame:
    """Fit a batch to an existing table.

    align: missing columns become NULL, unknown columns are dropped. A stored type holds: a value that it
           cannot hold is an error, a fraction for a column of whole numbers too.
    sync:  as ``align`` for missing columns, but unknown columns are kept (the table widens).
    sync_all: the table follows the batch: new columns come, missing ones go, types widen (``synced_schema``).
    fail:  any difference in column names or types raises ``SchemaChanged``.
    """
    if mode not in MODES:
        raise ValueError(f"unknown schema mode: {mode}")
    if mode == "sync_all":
        schema = synced_schema(schema, df.schema)[0]
    known, present = set(schema.names), set(df.columns)
    if mode == "fail":
        found = schema_difference(schema, df.schema)
        retyped = [f.name for f in schema if f.name in present and df.schema[f.name].dataType != f.dataType]
        if found.added or found.removed or retyped:
            raise SchemaChanged(f"columns differ: {sorted([*found.added, *found.removed, *retyped])}")
    fitted = [
        (_fitted(df, f) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema
    ]
    extra = [F.col(f"`{c}`") for c in df.columns if c not in known] if mode == "sync" else []
    return df.select(*fitted, *extra)
