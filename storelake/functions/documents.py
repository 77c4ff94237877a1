"""Reading references and lists out of JSON document columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ref_id(document: Column, accept_bare: bool = False, strict: bool = False) -> Column:
    """Id of a relation stored as a populated object, e.g. ``{"id": 7, ...}``.

    A relation that was not populated is a bare number. It has no ``$.id`` and gives NULL unless
    ``accept_bare`` is set. An id that is no whole number gives NULL, or an error if ``strict``.
    """
    text = F.get_json_object(document, "$.id")
    populated = text.cast("bigint") if strict else text.try_cast("bigint")
    return F.coalesce(populated, document.try_cast("bigint")) if accept_bare else populated


def string_list(document: Column) -> Column:
    return F.from_json(document, "array<string>")


def id_list(document: Column) -> Column:
    """Ids of a JSON list whose elements are objects or bare ids."""
    return F.transform(string_list(document), lambda e: ref_id(e, accept_bare=True))
