"""Declarative data tests. Each returns the failing rows; ``run_tests`` turns them into a report."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def test_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs are not compared."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
    return counts.agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")


def test_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def test_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Unexpected values with their frequency; NULL is not a value."""
    odd = df.filter(~F.col(column).isin(list(values)))
    return odd.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n_records"))


def test_relationships(df: DataFrame, column: str, to: DataFrame, to_column: str) -> DataFrame:
    """Distinct child keys without a parent; they are deduplicated before they meet the parents."""
    child = df.select(F.col(column).alias("value")).filter("value is not null").distinct()
    return child.join(to.select(F.col(to_column).alias("value")), "value", "left_anti")


def _outside(value: Column, low=None, high=None, inclusive: bool = True) -> Column:
    bad = F.lit(False)
    if low is not None:
        bad = bad | (value < F.lit(low) if inclusive else value <= F.lit(low))
    if high is not None:
        bad = bad | (value > F.lit(high) if inclusive else value >= F.lit(high))
    return bad


def test_accepted_range(df: DataFrame, column: str, low=None, high=None, inclusive: bool = True) -> DataFrame:
    return df.filter(_outside(F.col(column), low, high, inclusive))


def test_singular(query: DataFrame) -> DataFrame:
    """A query written to return rows only when something is wrong."""
    return query


for _operator in (test_unique, test_not_null, test_accepted_values, test_relationships,
                  test_accepted_range, test_singular):
    _operator.__test__ = False  # operators, not pytest cases


@dataclass(frozen=True)
class Check:
    table: str
    kind: str
    column: str
    args: Mapping = field(default_factory=dict)

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.table}_{self.column}"


# The configured suite. First the raw keys, then the mart columns.
_RAW_KEYED = ("orders", "products", "variants", "categories", "users", "transactions", "carts")
_MART_KEYS = {
    "fact_orders": "order_id", "fact_order_items": "order_item_id",
    "fact_transactions": "transaction_id", "dim_products": "product_id",
    "dim_customers": "customer_id", "dim_categories": "category_id", "dim_date": "date_key",
}
_MART_REQUIRED = {
    "fact_orders": ("customer_id", "amount_usd", "order_date"),
    "fact_order_items": ("order_id", "product_id", "quantity"),
    "fact_transactions": ("customer_id", "amount_usd"),
    "dim_products": ("product_name",),
    "dim_customers": ("customer_email",),
}
_MART_VALUES = {
    ("fact_transactions", "status"): ("succeeded", "pending", "failed"),
    ("dim_customers", "customer_segment"):
        ("Champions", "Loyal", "Potential Loyalists", "New Customers", "Dormant"),
}


def configured_suite() -> list[Check]:
    """14 checks on the raw collections and 26 on the marts."""
    keyed = [(t, "id") for t in _RAW_KEYED] + list(_MART_KEYS.items())
    suite = [Check(t, kind, c) for t, c in keyed for kind in ("unique", "not_null")]
    suite += [Check(t, "not_null", c) for t, columns in _MART_REQUIRED.items() for c in columns]
    suite += [Check(t, "accepted_values", c, {"values": v}) for (t, c), v in _MART_VALUES.items()]
    return suite


def _findings(check: Check, number: int, kinds: dict) -> Column:
    """What a row says to a check: (test, number, text), the key or odd value in the column of its type; null for nothing.

    A unique check is told every key, the others only what is wrong.
    """
    col = F.col(check.column)
    whole = isinstance(kinds[check.column], T.IntegralType)
    value = [(col if whole else F.lit(None)).cast("bigint").alias("number"), (F.lit(None) if whole else col).cast("string").alias("text")]
    nothing = [F.lit(None).cast("bigint").alias("number"), F.lit(None).cast("string").alias("text")]
    test = F.lit(number).alias("test")
    if check.kind == "unique":
        return F.when(col.isNotNull(), F.struct(test, *value))
    if check.kind == "not_null":
        return F.when(col.isNull(), F.struct(test, *nothing))
    if check.kind == "accepted_values":
        return F.when(~col.isin(list(check.args["values"])), F.struct(test, *value))
    return F.when(_outside(col, **check.args), F.struct(test, *nothing))


def _one_scan(df: DataFrame, checks: Sequence[Check], passed: Collection[str] = ()) -> DataFrame:
    """All checks of a table that need no other table, in one scan: findings are grouped by check and value.

    Those known to have ``passed`` are told nothing.
    """
    kinds = {f.name: f.dataType for f in df.schema}
    told = [F.when(F.lit(c.name not in passed), _findings(c, i, kinds)) for i, c in enumerate(checks)]
    found = F.array_compact(F.array(*told))
    counted = df.select(F.explode(found).alias("f")).groupBy("f.test", "f.number", "f.text").agg(F.count(F.lit(1)).alias("n"))

    def failures(i: int, kind: str) -> Column:
        mine = F.col("test") == i
        if kind in ("unique", "accepted_values"):  # Values that repeat, values that are odd.
            return F.count_if(mine & (F.col("n") > 1) if kind == "unique" else mine)
        return F.coalesce(F.sum(F.when(mine, F.col("n"))), F.lit(0))

    totals = counted.agg(*[failures(i, c.kind).alias(f"_{i}") for i, c in enumerate(checks)])
    rows = [F.struct(F.lit(c.name).alias("test"), F.col(f"_{i}").alias("failures")) for i, c in enumerate(checks)]
    return totals.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _known_unique(df: DataFrame, check: Check) -> bool:
    """Whether a text column repeats no value, shown by 64-bit hashes, a fraction of the texts' bytes; False if a hash repeats."""
    if check.kind != "unique" or not isinstance(df.schema[check.column].dataType, T.StringType):
        return False
    hashes = df.filter(F.col(check.column).isNotNull()).select(F.xxhash64(check.column).alias("hash"))
    return test_unique(hashes, "hash").isEmpty()


def run_tests(tables: Mapping[str, DataFrame], suite: Sequence[Check] | None = None) -> DataFrame:
    """One row per check: ``test, failures, status``. Each table is scanned once, and once more for each relationship.

    A unique text column is scanned on its own before: only if two of its hashes are equal do the texts themselves move.
    """
    suite = configured_suite() if suite is None else suite
    parts = []
    for table in dict.fromkeys(c.table for c in suite):
        mine = [c for c in suite if c.table == table]
        alone = [c for c in mine if c.kind != "relationships"]
        if alone:
            parts.append(_one_scan(tables[table], alone, {c.name for c in alone if _known_unique(tables[table], c)}))
        for c in mine:
            if c.kind == "relationships":
                bad = test_relationships(tables[table], c.column, **c.args)
                parts.append(bad.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(c.name).alias("test"), "failures"))
    report = reduce(DataFrame.unionAll, parts)
    return report.withColumn("status", F.when(F.col("failures") == 0, "PASS").otherwise("ERROR"))


def totals(report: DataFrame) -> DataFrame:
    return report.agg(F.count_if(F.col("status") == "PASS").alias("passed"),
                      F.count_if(F.col("status") == "ERROR").alias("errors"),
                      F.count(F.lit(1)).alias("total"))
