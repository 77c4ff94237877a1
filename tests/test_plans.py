"""Report rules that the test tables do not reach."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from storelake.functions.dates import months_before, whole_months
from storelake.functions.money import half_up_ratio
from storelake.operators import marts
from storelake.plans import cohorts, customers, distribution, kpi, payments, rfm, sales

DAY = dt.date


def orders(spark, rows):
    schema = "order_id long, customer_id long, amount_usd decimal(18,2), status string, order_date date, item_count long"
    return spark.createDataFrame([(i, c, Decimal(a), s, d, 1) for i, (c, a, s, d) in enumerate(rows)], schema)


@pytest.mark.parametrize("num,den,want", [
    ("1.005", "1", "1.01"), ("-0.015", "1", "-0.02"), ("2", "3", "0.67"), ("-2", "3", "-0.67"), ("1", "-3", "-0.33"),
    ("10", "0", None), ("0", "5", "0.00"),
])
def test_half_up_ratio(spark, num, den, want):
    # Two decimals go in, so thousandths are written as a ratio.
    scale = 1000 if len(num.split(".")[-1]) == 3 and "." in num else 1
    df = spark.range(1).select(
        half_up_ratio(F.lit(Decimal(num) * scale).cast("decimal(18,2)"), F.lit(Decimal(den) * scale).cast("decimal(18,2)")).alias("r"))
    assert df.first()[0] == (None if want is None else Decimal(want))


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(-10**9, 10**9), st.integers(1, 10**6)), min_size=1, max_size=30))
def test_half_up_ratio_equals_exact_rounding(spark, pairs):
    from decimal import ROUND_HALF_UP, localcontext
    df = spark.createDataFrame(pairs, "n long, d long").select(half_up_ratio(F.col("n"), F.col("d")))
    with localcontext() as context:
        context.prec = 60
        want = [(Decimal(n) / Decimal(d)).quantize(Decimal("0.01"), ROUND_HALF_UP) for n, d in pairs]
    assert [r[0] for r in df.collect()] == want


@pytest.mark.parametrize("start,end,want", [
    (DAY(2024, 1, 31), DAY(2024, 2, 29), 1), (DAY(2024, 1, 31), DAY(2024, 2, 28), 0), (DAY(2024, 1, 15), DAY(2024, 2, 14), 0),
    (DAY(2024, 1, 15), DAY(2024, 2, 15), 1), (DAY(2023, 12, 31), DAY(2024, 12, 30), 11), (DAY(2024, 5, 5), DAY(2024, 5, 5), 0),
])
def test_whole_months(spark, start, end, want):
    assert spark.range(1).select(whole_months(F.lit(start), F.lit(end))).first()[0] == want


def test_months_before():
    assert months_before(DAY(2024, 3, 31), 12) == DAY(2023, 3, 1) and months_before(DAY(2024, 1, 5), 1) == DAY(2023, 12, 1)


def test_kpi_without_a_previous_period(spark):
    rows = kpi.kpi_summary(orders(spark, [(1, "10.00", "x", DAY(2024, 3, 1)), (1, "5.01", "x", DAY(2024, 3, 1))]), DAY(2024, 3, 2))
    got = {r["metric"]: (r["current_value"], r["previous_value"], r["growth_percentage"]) for r in rows.collect()}
    assert got["Total Orders"] == (2, 0, None) and got["Unique Customers"] == (1, 0, None)
    assert got["Total Revenue (USD)"] == (Decimal("15.01"), None, None)
    assert got["Avg Order Value (USD)"] == (Decimal("7.51"), None, None)


def test_kpi_period_edges_and_missing_customer(spark):
    rows = [(1, "1.00", "x", DAY(2024, 2, 1)), (None, "1.00", "x", DAY(2024, 2, 1)), (2, "2.00", "x", DAY(2024, 1, 31)),
            (2, "3.00", "x", DAY(2024, 1, 2)), (3, "9.00", "x", DAY(2024, 1, 1))]
    got = {r["metric"]: tuple(r)[1:] for r in kpi.kpi_summary(orders(spark, rows), DAY(2024, 3, 2)).collect()}
    assert got["Total Orders"] == (2, 2, Decimal("0.00"))
    assert got["Unique Customers"] == (1, 1, Decimal("0.00"))
    assert got["Total Revenue (USD)"] == (2, 5, Decimal("-60.00"))


def test_month_zero_is_everyone_and_dates_at_month_ends(spark):
    rows = [(1, "1", "x", DAY(2024, 1, 31)), (1, "1", "x", DAY(2024, 2, 29)), (2, "1", "x", DAY(2024, 1, 1)),
            (2, "1", "x", DAY(2024, 1, 31)), (None, "1", "x", DAY(2023, 1, 1))]
    got = [tuple(r) for r in cohorts.cohort_retention(orders(spark, rows), DAY(2024, 6, 1)).collect()]
    assert got == [("2024-01", 0, 2, 2, Decimal("100.00")), ("2024-01", 1, 1, 2, Decimal("50.00"))]


def test_cohort_by_segment_without_a_segment_is_the_pivot(spark):
    sold = orders(spark, [(c, "1", "x", DAY(2024, 1 + c % 3 + m, 3)) for c in range(9) for m in (0, c % 4)])
    dim = spark.createDataFrame([(c, "Loyal" if c % 2 else "Dormant") for c in range(9)], "customer_id long, customer_segment string")
    everyone = cohorts.cohort_by_segment(sold, dim, DAY(2024, 12, 1)).collect()
    assert everyone == cohorts.cohort_pivot(sold, DAY(2024, 12, 1)).collect()
    assert cohorts.cohort_by_segment(sold, dim, DAY(2024, 12, 1), "VIP").count() == 0


def test_rfm_case_order(spark):
    want = {(5, 5, 5): "Champions", (3, 3, 3): "Loyal Customers", (4, 1, 2): "New Customers", (2, 3, 4): "At Risk",
            (1, 2, 3): "Cant Lose Them", (1, 1, 1): "Lost", (3, 2, 1): "Promising", (3, 1, 3): "Potential Loyalists",
            (4, 3, 1): "Others", (5, 2, 5): "Potential Loyalists"}
    df = spark.createDataFrame(list(want), "r int, f int, m int")
    got = {tuple(r)[:3]: r["s"] for r in df.withColumn("s", rfm.rfm_segment(F.col("r"), F.col("f"), F.col("m"))).collect()}
    assert got == want


def test_lapsed_and_active_are_disjoint(spark):
    as_of = DAY(2024, 7, 1)
    rows = [(1, "1", "completed", as_of - dt.timedelta(days=d)) for d in (100,)]
    rows += [(2, "1", "completed", as_of - dt.timedelta(days=d)) for d in (100, 90)]
    rows += [(3, "1", "completed", as_of - dt.timedelta(days=181)), (4, "1", "cancelled", as_of - dt.timedelta(days=100))]
    sold = orders(spark, rows)
    assert [r[0] for r in customers.lapsed_customers(sold, as_of).collect()] == [1]
    assert [r[0] for r in customers.active_customers(sold, as_of).collect()] == [2]


def test_shares_sum_to_one_hundred(spark):
    paid = spark.createDataFrame([("a", Decimal(1))] * 5 + [("b", Decimal(2))] * 3, "status string, amount_usd decimal(18,2)")
    assert sum(r["percentage"] for r in payments.payment_success_rate(paid).collect()) == 100


def test_periods_use_the_stored_month(spark):
    stored = orders(spark, [(1, "1", "x", DAY(2024, 1, 31)), (1, "1", "x", DAY(2024, 2, 1))])
    stored = stored.withColumn("order_month", F.trunc("order_date", "month"))
    days = marts.dim_date(marts.date_bounds(spark))
    assert [r[0] for r in sales.daily_sales_trend(stored, days, DAY(2024, 2, 2), 1).collect()] == [DAY(2024, 2, 1)]


def brute_percent_rank(units):
    n = len(units)
    return [sum(v > u for v in units) / (n - 1) if n > 1 else 0.0 for u in units]


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.integers(0, 5), st.integers(0, 10**4), st.integers(10**9, 10**12)), min_size=1, max_size=40))
def test_bucketed_percent_rank_equals_the_window(spark, units):
    items = spark.createDataFrame(list(enumerate(units)), "product_id long, quantity long")
    got = {r["units"]: (r["products"], r["percentile"]) for r in distribution.units_percent_rank(items).collect()}
    want = {u: (units.count(u), p) for u, p in zip(units, brute_percent_rank(units))}
    assert got == want
