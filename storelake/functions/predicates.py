"""Document filters (``{"field": {"operator": value}}``) as Spark predicates.

Comparisons of plain columns become plain predicates, so they reach the parquet scan.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelake.functions.documents import id_list, ref_id


@dataclass(frozen=True)
class Fields:
    """How a filter reads the columns of a collection.

    ``relations`` are references stored as JSON and compare by id; ``lists`` are JSON lists of
    references and compare by their ids.
    """

    df: DataFrame
    relations: Collection[str] = ()
    lists: Collection[str] = ()

    def value(self, name: str) -> Column:
        if name in self.relations:
            return ref_id(F.col(name), accept_bare=True)
        return id_list(F.col(name)) if name in self.lists else F.col(name)

    def is_list(self, name: str) -> bool:
        return name in self.lists or isinstance(self.df.schema[name].dataType, T.ArrayType)


def _has_text(col: Column, text: str) -> Column:
    return F.contains(F.lower(col), F.lit(text.lower()))


def _conjunction(parts: list[Column]) -> Column:
    return reduce(Column.__and__, parts, F.lit(True))


def _values(value: Any) -> list:
    return [v.strip() for v in value.split(",")] if isinstance(value, str) else list(value)


def _holds(col: Column, value: Any) -> Column:
    return F.exists(col, lambda e: e == F.lit(value))


def _any_of(col: Column, value: Any, is_list: bool) -> Column:
    wanted = _values(value)
    return F.exists(col, lambda e: e.isin(wanted)) if is_list else col.isin(wanted)


def _condition(col: Column, is_list: bool, operator: str, value: Any, is_relation: bool = False) -> Column:
    """One test of a field. A list equals a value if any element does; a relation contains only its own id."""
    if is_list and operator in ("equals", "not_equals") and value is not None:
        held = F.coalesce(_holds(col, value), F.lit(False))
        return held if operator == "equals" else ~held
    if operator == "equals":
        return col.isNull() if value is None else col == F.lit(value)
    if operator == "not_equals":
        return ~col.eqNullSafe(F.lit(value))
    if operator == "greater_than":
        return col > F.lit(value)
    if operator == "greater_than_equal":
        return col >= F.lit(value)
    if operator == "less_than":
        return col < F.lit(value)
    if operator == "less_than_equal":
        return col <= F.lit(value)
    if operator == "like":
        return _conjunction([_has_text(col, word) for word in value.split()])
    if operator == "contains":
        if is_relation and not is_list:
            return col == F.lit(value).try_cast("bigint")
        return _holds(col, value) if is_list else _has_text(col, value)
    if operator == "in":
        return _any_of(col, value, is_list)
    if operator == "not_in":
        return ~F.coalesce(_any_of(col, value, is_list), F.lit(False))
    if operator == "all":
        return _conjunction([_holds(col, v) for v in _values(value)])
    if operator == "exists":
        return col.isNotNull() if value in (True, "true") else col.isNull()
    raise ValueError(f"unknown where operator: {operator}")


def where_column(fields: Fields, spec: Mapping[str, Any]) -> Column:
    """One predicate for a filter document; sibling entries are conjoined."""
    parts = []
    for key, body in spec.items():
        if key in ("and", "or"):
            nested = [where_column(fields, s) for s in body]
            if nested:
                parts.append(reduce(Column.__and__ if key == "and" else Column.__or__, nested))
        else:
            parts += [_condition(fields.value(key), fields.is_list(key), op, value, key in fields.relations) for op, value in body.items()]
    return _conjunction(parts)
