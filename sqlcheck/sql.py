"""One SQL text per registered query, written against the test tables, not the raw documents.

Shared relations are common table expressions; a query gets those it names and what they need.
Amounts stay integer cents until the last step.
"""

from __future__ import annotations

import hashlib
import re

AS_OF = "DATE '2001-08-02'"
CUTOFF = "TIMESTAMP '2001-06-01'"


def _name_id(name: str) -> int:
    return int(hashlib.md5(name.encode()).hexdigest()[:7], 16)


GAP, SEARCH = _name_id("Brand#1"), _name_id("PROMO")


def ratio(num: str, den: str, digits: int = 2) -> str:
    """num / den rounded half away from zero in integers; NULL for a zero denominator."""
    n, d, p = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)", 10**digits
    return (f"(CASE WHEN {d} = 0 THEN NULL ELSE sign({n}) * sign({d}) * "
            f"CAST((abs({n}) * {2 * p} + abs({d})) // (2 * abs({d})) AS DOUBLE) / {p} END)")


def usd(cents: str) -> str:
    return f"(CAST({cents} AS DOUBLE) / 100)"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def name_id(expr: str) -> str:
    return f"CAST('0x' || substr(md5({expr}), 1, 7) AS BIGINT)"


def slug(expr: str) -> str:
    return f"lower(regexp_replace({expr}, '[^A-Za-z0-9]+', '-', 'g'))"


BORN = "TIMESTAMP '1994-12-31 00:00:00'"

RELATIONS = {
    "ord": """SELECT o_orderkey AS id, o_custkey AS customer_id, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
        CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'processing' WHEN 'P' THEN 'cancelled' END AS status,
        CASE o_orderstatus WHEN 'F' THEN 'succeeded' WHEN 'O' THEN 'pending' WHEN 'P' THEN 'failed' END AS paid,
        o_orderdate AS made, CAST(o_orderdate AS DATE) AS day FROM orders""",
    "item": """SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT),
        CAST(round(l_extendedprice * 100) AS BIGINT)) AS item_id, l_orderkey AS order_id, l_partkey AS product_id,
        CASE WHEN l_linenumber % 2 = 1 THEN l_partkey * 10 + 1 END AS variant_id,
        CAST(l_quantity AS BIGINT) AS quantity FROM lineitem""",
    # lines of whole order documents
    "wline": """SELECT id AS order_id, id || '-' || j AS item_id, j, 1 + (id * 31 + j * 17) % 200 AS part,
        (id + j) % 7 + 1 AS quantity, made FROM (SELECT id, made, unnest(range(1, id % 6)) AS j FROM ord WHERE id % 6 >= 2)""",
    "witem": """SELECT item_id, order_id, CASE WHEN j <> 3 THEN part END AS product_id,
        CASE WHEN j = 1 THEN part * 10 + 1 END AS variant_id, quantity, made FROM wline""",
    "wf_item": """SELECT witem.*, coalesce(vari.cents, prod.cents, 0) AS unit, quantity * coalesce(vari.cents, prod.cents, 0) AS total
        FROM witem LEFT JOIN vari ON vari.id = witem.variant_id LEFT JOIN prod ON prod.id = witem.product_id""",
    "prod": f"""SELECT p_partkey AS id, p_name AS title, {slug('p_name')} || '-' || p_partkey AS slug,
        p_type || ' ' || p_brand AS description, CAST(round(p_retailprice * 100) AS BIGINT) AS cents,
        p_partkey * 7 % 60 AS inventory, p_size > 25 AS has_variants, p_partkey % 17 <> 0 AS has_categories,
        CASE WHEN p_partkey % 11 = 0 THEN 'draft' ELSE 'published' END AS state, p_type, p_brand, p_size FROM part""",
    "vari": """SELECT id * 10 + 1 AS id, id AS product_id, title || ' large' AS title, (cents * 11 + 5) // 10 AS cents,
        id * 3 % 40 AS inventory, 1000 + p_size AS option_a,
        2000 + CAST(regexp_extract(p_brand, '[0-9]+') AS BIGINT) AS option_b FROM prod WHERE has_variants""",
    "label": """SELECT DISTINCT name FROM (SELECT p_type AS name FROM part UNION ALL SELECT p_brand FROM part)""",
    "cat": f"SELECT {name_id('name')} AS id, name, {slug('name')} AS slug FROM label",
    "link": f"""SELECT id AS product_id, {name_id('name')} AS category_id, name FROM
        (SELECT id, unnest([p_type, p_brand]) AS name FROM prod WHERE has_categories)""",
    "cust": """SELECT c_custkey AS id, c_name AS name, c_name || '@example.test' AS email,
        c_custkey % 50 = 0 AS admin FROM customer""",
    "cart": """SELECT event_id AS id, CASE WHEN event_id % 3 <> 0 THEN user_id END AS customer_id,
        CAST(round(value * 100) AS BIGINT) AS cents, CASE WHEN event_type = 'purchase' THEN ts END AS bought, ts AS made,
        CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id, event_id % 2 = 1 AS with_variant,
        event_id % 25 + 1 AS quantity FROM events""",
    # marts
    "f_ord": """SELECT ord.*, coalesce(n.n, 0) AS items FROM ord
        LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) n ON n.l_orderkey = ord.id""",
    "f_item": """SELECT item.*, ord.made, coalesce(vari.cents, prod.cents, 0) AS unit,
        item.quantity * coalesce(vari.cents, prod.cents, 0) AS total FROM item JOIN ord ON ord.id = item.order_id
        LEFT JOIN vari ON vari.id = item.variant_id LEFT JOIN prod ON prod.id = item.product_id""",
    "d_cust": f"""SELECT cust.id, name, email, coalesce(first_at, {BORN}) AS since, coalesce(n, 0) AS orders,
        coalesce(cents, 0) AS cents, first_at, last_at,
        date_diff('day', CAST(coalesce(first_at, {BORN}) AS DATE), {AS_OF}) AS age,
        CASE WHEN n >= 10 THEN 'Champions' WHEN n >= 5 THEN 'Loyal' WHEN n >= 2 THEN 'Potential Loyalists'
             WHEN n = 1 THEN 'New Customers' ELSE 'Dormant' END AS segment
        FROM cust LEFT JOIN (SELECT customer_id, count(*) AS n, {big('sum(cents)')} AS cents, min(made) AS first_at,
            max(made) AS last_at FROM ord GROUP BY 1) h ON h.customer_id = cust.id WHERE NOT admin""",
    "names": "SELECT product_id, string_agg(name, ', ' ORDER BY name) AS names FROM link GROUP BY 1",
    "cohort": """SELECT strftime(first_day, '%Y-%m') AS cohort_month,
        date_sub('month', first_day, day) AS months_since_first, count(DISTINCT customer_id) AS active_customers
        FROM (SELECT customer_id, day, min(day) OVER (PARTITION BY customer_id) AS first_day FROM ord) GROUP BY 1, 2""",
    "rates": f"""SELECT *, first_value(active_customers) OVER w AS cohort_size,
        {ratio('100 * active_customers', 'first_value(active_customers) OVER w')} AS retention_rate
        FROM cohort WINDOW w AS (PARTITION BY cohort_month ORDER BY months_since_first)""",
    "rfm": f"""SELECT id, name, email, date_diff('day', CAST(last_at AS DATE), {AS_OF}) AS recency, orders, cents,
        segment FROM d_cust WHERE orders > 0""",
    # The score cuts and segment rules.
    "scored": """SELECT *, CASE
            WHEN r >= 4 AND f >= 4 AND m >= 4 THEN 'Champions'
            WHEN r >= 3 AND f >= 3 AND m >= 3 THEN 'Loyal Customers'
            WHEN r >= 4 AND f <= 2 AND m <= 2 THEN 'New Customers'
            WHEN r <= 2 AND f >= 3 AND m >= 3 THEN 'At Risk'
            WHEN r <= 2 AND f <= 2 AND m >= 3 THEN 'Cant Lose Them'
            WHEN r <= 2 AND f <= 2 AND m <= 2 THEN 'Lost'
            WHEN r >= 3 AND f <= 2 AND m <= 2 THEN 'Promising'
            WHEN r >= 3 AND m >= 3 THEN 'Potential Loyalists' ELSE 'Others' END AS rfm_segment
        FROM (SELECT *,
            CASE WHEN recency <= 30 THEN 5 WHEN recency <= 60 THEN 4 WHEN recency <= 90 THEN 3 WHEN recency <= 180 THEN 2 ELSE 1 END AS r,
            CASE WHEN orders >= 10 THEN 5 WHEN orders >= 7 THEN 4 WHEN orders >= 4 THEN 3 WHEN orders >= 2 THEN 2 ELSE 1 END AS f,
            CASE WHEN cents >= 500000 THEN 5 WHEN cents >= 200000 THEN 4 WHEN cents >= 100000 THEN 3 WHEN cents >= 50000 THEN 2 ELSE 1 END AS m
            FROM rfm)""",
    "active": f"""SELECT customer_id, {big('sum(cents)')} AS cents FROM ord
        WHERE status = 'completed' AND day >= {AS_OF} - 90 AND day < {AS_OF} GROUP BY 1""",
    "ranked": """SELECT product_id, units, lines, percent_rank() OVER (ORDER BY units DESC) AS pct FROM
        (SELECT product_id, sum(quantity) AS units, count(*) AS lines FROM item GROUP BY 1)""",
    "spine": """SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS day""",
}



def _needs(text: str) -> list[str]:
    return [n for n in RELATIONS if re.search(rf"\b{n}\b", text)]


def _with(body: str) -> str:
    """Prefix the relations a query names, each after those it needs itself."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in _needs(RELATIONS[name]):
            if need != name and need not in ordered:
                add(need)
        if name not in ordered:
            ordered.append(name)

    for name in _needs(body):
        add(name)
    head = ",\n".join(f"{n} AS ({RELATIONS[n]})" for n in ordered)
    return f"WITH {head}\n{body}" if ordered else body


ORDER_HEAD = """id, '{"id":' || customer_id || '}' AS customer, printf('Customer#%09d@example.test', customer_id) AS "customerEmail",
        'USD' AS currency, status"""
PLAIN_ORDERS = f'SELECT {ORDER_HEAD}, cents AS amount, made AS "createdAt", made AS "updatedAt" FROM ord'
CHANGED_ORDERS = f"""SELECT {ORDER_HEAD}, CASE WHEN made >= {CUTOFF} THEN cents + 2 ELSE cents END AS amount,
        made AS "createdAt", CASE WHEN made >= {CUTOFF} THEN made + INTERVAL 2 HOUR ELSE made END AS "updatedAt" FROM ord"""
BORN_STAMPS = f"{BORN} AS created_at, {BORN} AS updated_at"
STAMPS = "made AS created_at, made AS updated_at"
F_ORDERS = f"""SELECT id AS order_id, customer_id, {usd('cents')} AS amount_usd, 'USD' AS currency, status,
    day AS order_date, {STAMPS}, items AS item_count FROM f_ord"""
F_ITEMS = f"""SELECT item_id AS order_item_id, order_id, product_id, variant_id, quantity,
    {usd('unit')} AS unit_price_usd, {usd('total')} AS line_total_usd, {STAMPS} FROM f_item"""


def _distribution(bucket: str, name: str) -> str:
    return f"""SELECT {bucket} AS {name}, count(*) AS customer_count, {usd('sum(cents)')} AS total_value_usd
        FROM rfm GROUP BY 1"""


def _period(first: int, last: int) -> str:
    return f"""SELECT count(*) AS n, count(DISTINCT customer_id) AS c, sum(cents) AS s FROM ord
        WHERE day >= {AS_OF} - {first} AND day < {AS_OF} - {last}"""


def _metric(name: str, expr: str, scale: int) -> str:
    """``expr`` with p. as alias, in units of 1/scale."""
    now, before = expr.replace("p.", "a."), expr.replace("p.", "b.")
    return f"""SELECT '{name}' AS metric, CAST({now} AS DOUBLE) / {scale} AS current_value,
        CAST({before} AS DOUBLE) / {scale} AS previous_value,
        {ratio(f'100 * (({now}) - ({before}))', before)} AS growth_percentage FROM a, b"""


_CHECKS = [(t, c) for t, c in [(t, "id") for t in ("orders", "products", "variants", "categories", "users", "transactions", "carts")]
           + [("fact_orders", "order_id"), ("fact_order_items", "order_item_id"), ("fact_transactions", "transaction_id"),
              ("dim_products", "product_id"), ("dim_customers", "customer_id"), ("dim_categories", "category_id"),
              ("dim_date", "date_key")]]
_TEST_SOURCE = {
    "orders": ("ord", "id"), "products": ("prod", "id"), "variants": ("vari", "id"), "categories": ("cat", "id"),
    "users": ("cust", "id"), "transactions": ("ord", "id"), "carts": ("cart", "id"), "fact_orders": ("f_ord", "id"),
    "fact_order_items": ("f_item", "item_id"), "fact_transactions": ("ord", "id"), "dim_products": ("prod", "id"),
    "dim_customers": ("d_cust", "id"), "dim_categories": ("cat", "id"), "dim_date": ("spine", "day"),
}
_REQUIRED = [
    ("fact_orders", "customer_id", "f_ord", "customer_id"), ("fact_orders", "amount_usd", "f_ord", "cents"),
    ("fact_orders", "order_date", "f_ord", "day"), ("fact_order_items", "order_id", "f_item", "order_id"),
    ("fact_order_items", "product_id", "f_item", "product_id"), ("fact_order_items", "quantity", "f_item", "quantity"),
    ("fact_transactions", "customer_id", "ord", "customer_id"), ("fact_transactions", "amount_usd", "ord", "cents"),
    ("dim_products", "product_name", "prod", "title"), ("dim_customers", "customer_email", "d_cust", "email"),
]


def _test_report() -> str:
    rows = []
    for table, column in _CHECKS:
        rel, key = _TEST_SOURCE[table]
        rows.append(f"""SELECT 'unique_{table}_{column}' AS test, (SELECT count(*) FROM
            (SELECT {key} FROM {rel} WHERE {key} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)) AS failures""")
        rows.append(f"SELECT 'not_null_{table}_{column}', (SELECT count(*) FROM {rel} WHERE {key} IS NULL)")
    for table, column, rel, key in _REQUIRED:
        rows.append(f"SELECT 'not_null_{table}_{column}', (SELECT count(*) FROM {rel} WHERE {key} IS NULL)")
    rows.append("""SELECT 'accepted_values_fact_transactions_status', (SELECT count(DISTINCT paid) FROM ord
        WHERE paid NOT IN ('succeeded', 'pending', 'failed'))""")
    rows.append("""SELECT 'accepted_values_dim_customers_customer_segment', (SELECT count(DISTINCT segment) FROM d_cust
        WHERE segment NOT IN ('Champions', 'Loyal', 'Potential Loyalists', 'New Customers', 'Dormant'))""")
    return f"""SELECT test, failures, CASE WHEN failures = 0 THEN 'PASS' ELSE 'ERROR' END AS status
        FROM ({' UNION ALL '.join(rows)})"""


def _summary() -> str:
    """Table, fields, rows as a relation, first column, and what the rows are ordered by."""
    options = """(SELECT DISTINCT 1000 + p_size AS id FROM part
        UNION ALL SELECT DISTINCT 2000 + CAST(regexp_extract(p_brand, '[0-9]+') AS BIGINT) FROM part)"""
    tables = [("raw.orders", 8, "ord", "id", "id"), ("raw.transactions", 9, "ord", "id", "id"), ("raw.carts", 8, "cart", "id", "id"),
              ("raw.products", 11, "prod", "id", "id"), ("raw.variants", 8, "vari", "id", "id"), ("raw.categories", 5, "cat", "id", "id"),
              ("raw.users", 6, "cust", "id", "id"), ("raw.variantTypes", 5, "(VALUES (1), (2)) t(id)", "id", "id"),
              ("raw.variantOptions", 6, options, "id", "id"),
              ("fact_orders", 10, "f_ord", "id", "id"), ("fact_order_items", 10, "f_item", "item_id", "item_id"),
              ("fact_transactions", 11, "ord", "id", "id"), ("dim_customers", 11, "d_cust", "id", "id"),
              ("dim_products", 9, "prod", "id", "id"), ("dim_categories", 5, "cat", "id", "id"), ("dim_date", 11, "spine", "day", "day"),
              ("bridge_product_categories", 2, "link", "product_id", "product_id, category_id")]
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, {fields} AS fields, (SELECT count(*) FROM {rows}) AS records,
            (SELECT string_agg(k, ',' ORDER BY k) FROM (SELECT CAST({key} AS VARCHAR) AS k FROM {rows} ORDER BY {order} LIMIT 3)) AS first_keys"""
        for name, fields, rows, key, order in tables)


def _collections() -> str:
    parts = {"orders": "ord", "transactions": "ord", "carts": "cart", "products": "prod", "variants": "vari",
             "categories": "cat", "users": "cust",
             "variantTypes": "(VALUES (1), (2)) t", "variantOptions":
             "(SELECT DISTINCT 1, CAST(p_size AS VARCHAR) FROM part UNION ALL SELECT DISTINCT 2, p_brand FROM part) t"}
    return " UNION ALL ".join(
        f"SELECT '{n}' AS collection, (SELECT count(*) FROM {r}) AS records" for n, r in parts.items())


_ANALYTICS = {
    "daily_sales_trend": f"""SELECT day AS date_day, dayname(day) AS day_name, count(DISTINCT id) AS total_orders,
        {usd('sum(cents)')} AS total_revenue_usd, {ratio('sum(cents)', '100 * count(cents)')} AS avg_order_value_usd
        FROM ord WHERE day >= {AS_OF} - 30 GROUP BY 1, 2""",
    "monthly_revenue": f"""SELECT strftime(day, '%Y-%m') AS year_month, count(DISTINCT id) AS total_orders,
        count(DISTINCT customer_id) AS unique_customers, {usd('sum(cents)')} AS total_revenue_usd,
        {ratio('sum(cents)', '100 * count(cents)')} AS avg_order_value_usd,
        {ratio('sum(cents)', '100 * count(DISTINCT customer_id)')} AS revenue_per_customer FROM ord GROUP BY 1""",
    "weekend_vs_weekday": f"""SELECT CASE WHEN isodow(day) > 5 THEN 'Weekend' ELSE 'Weekday' END AS period_type,
        count(DISTINCT id) AS total_orders, {usd('sum(cents)')} AS total_revenue_usd,
        {ratio('sum(cents)', '100 * count(cents)')} AS avg_order_value_usd
        FROM ord WHERE day >= {AS_OF} - 90 GROUP BY 1""",
    "top_products": f"""SELECT title AS product_name, coalesce(names, 'Uncategorized') AS categories,
        count(DISTINCT order_id) AS times_ordered, {big('sum(quantity)')} AS total_quantity_sold,
        {usd('sum(total)')} AS total_revenue_usd, {ratio('sum(unit)', '100 * count(unit)')} AS avg_unit_price_usd
        FROM f_item JOIN prod ON prod.id = f_item.product_id LEFT JOIN names ON names.product_id = prod.id
        GROUP BY 1, 2 ORDER BY sum(total) DESC, 1, 2 LIMIT 10""",
    "category_performance": f"""SELECT name AS category_name, count(DISTINCT order_id) AS total_orders,
        {big('sum(quantity)')} AS items_sold, {usd('sum(total)')} AS total_revenue_usd,
        {ratio('sum(total)', '100 * count(total)')} AS avg_line_value_usd
        FROM f_item JOIN link USING (product_id) GROUP BY 1""",
    "inventory_alert": f"""SELECT title AS product_name, coalesce(names, 'Uncategorized') AS categories, inventory,
        {usd('cents')} AS price_usd, inventory BETWEEN 1 AND 10 AS is_low_stock, inventory > 0 AS is_in_stock
        FROM prod LEFT JOIN names ON names.product_id = prod.id WHERE inventory <= 10""",
    "potential_inventory_value": f"""SELECT id AS product_id, title AS product_name, inventory,
        {usd('cents')} AS price_usd, {usd('cents * inventory')} AS potential_value_usd FROM prod""",
    "segment_overview": f"""SELECT segment AS customer_segment, count(*) AS customer_count,
        {big('sum(orders)')} AS total_orders, {usd('sum(cents)')} AS total_ltv_usd,
        {ratio('sum(cents)', '100 * count(*)')} AS avg_ltv_usd,
        {ratio('sum(orders)', 'count(*)')} AS avg_orders_per_customer FROM d_cust GROUP BY 1""",
    "top_customers_ltv": f"""SELECT name AS customer_name, email AS customer_email, segment AS customer_segment,
        orders AS total_orders, {usd('cents')} AS lifetime_value_usd, CAST(first_at AS DATE) AS first_order_date,
        CAST(last_at AS DATE) AS last_order_date, age AS customer_lifetime_days
        FROM d_cust ORDER BY cents DESC, id LIMIT 20""",
    "customer_acquisition": f"""SELECT strftime(since, '%Y-%m') AS acquisition_month, count(*) AS new_customers,
        {big('sum(orders)')} AS total_orders_from_cohort, {usd('sum(cents)')} AS cohort_ltv_usd,
        {ratio('sum(cents)', '100 * count(*)')} AS avg_customer_ltv_usd FROM d_cust GROUP BY 1""",
    "payment_success_rate": f"""SELECT paid AS status, count(*) AS transaction_count,
        {usd('sum(cents)')} AS total_amount_usd,
        {ratio('100 * count(*)', '(SELECT count(*) FROM ord)')} AS percentage FROM ord GROUP BY 1""",
    "daily_transactions": f"""SELECT day AS date_day, count(*) AS transaction_count,
        count(*) FILTER (WHERE paid = 'succeeded') AS successful_transactions,
        count(*) FILTER (WHERE paid = 'failed') AS failed_transactions, {usd('sum(cents)')} AS total_amount_usd
        FROM ord WHERE day >= {AS_OF} - 30 GROUP BY 1""",
    "cohort_retention": "SELECT * FROM rates WHERE cohort_month >= '1995-08'",
    "recent_cohort_curves": """SELECT * FROM rates QUALIFY dense_rank() OVER (ORDER BY cohort_month DESC) <= 3""",
    "cohort_curves_for": """SELECT * FROM rates
        WHERE cohort_month IN ('2000-10', '2000-11', '2000-12', '1995-01', '1995-02')""",
    "rfm_table": f"""SELECT name AS customer_name, email AS customer_email, recency AS recency_days,
        orders AS frequency, {usd('cents')} AS monetary_usd, segment AS customer_segment
        FROM rfm ORDER BY cents DESC, id LIMIT 20""",
    "product_affinity": f"""SELECT pa.title AS product_a, pb.title AS product_b, n AS times_bought_together,
        {ratio('100 * n', '(SELECT count(*) FROM ord)')} AS frequency_percentage
        FROM (SELECT x.product_id AS a, y.product_id AS b, count(DISTINCT x.order_id) AS n FROM item x
              JOIN item y ON x.order_id = y.order_id AND x.product_id < y.product_id GROUP BY 1, 2 HAVING n >= 3
              ORDER BY n DESC, a, b LIMIT 20)
        JOIN prod pa ON pa.id = a JOIN prod pb ON pb.id = b""",
    "kpi_summary": f"""SELECT m.* FROM (WITH a AS ({_period(30, 0)}), b AS ({_period(60, 30)})
        {_metric('Total Orders', 'p.n', 1)} UNION ALL {_metric('Unique Customers', 'p.c', 1)}
        UNION ALL {_metric('Total Revenue (USD)', 'p.s', 100)}
        UNION ALL {_metric('Avg Order Value (USD)', '((2 * p.s + p.n) // (2 * p.n))', 100)}) m""",
    "monthly_revenue_summary_simple": f"""SELECT CAST(date_trunc('month', day) AS DATE) AS month,
        count(DISTINCT id) AS total_orders, {usd('sum(cents)')} AS total_revenue_usd FROM ord GROUP BY 1""",
    "cohort_pivot": "SELECT cohort_month, " + ", ".join(
        f"max(CASE WHEN months_since_first = {i} THEN retention_rate END) AS \"Month {i}\"" for i in range(5)
    ) + " FROM rates WHERE cohort_month >= '1995-02' GROUP BY 1",
    "cohort_by_segment": f"""SELECT cohort_month, {', '.join(
        f'max(CASE WHEN m = {i} THEN rate END) AS "Month {i}"' for i in range(5))} FROM
        (SELECT cohort_month, m, {ratio('100 * n', 'first_value(n) OVER (PARTITION BY cohort_month ORDER BY m)')} AS rate
         FROM (SELECT strftime(first_day, '%Y-%m') AS cohort_month, date_sub('month', first_day, day) AS m,
               count(DISTINCT customer_id) AS n
               FROM (SELECT customer_id, day, min(day) OVER (PARTITION BY customer_id) AS first_day FROM ord
                     WHERE customer_id IN (SELECT id FROM d_cust WHERE segment = 'Loyal')) GROUP BY 1, 2))
        WHERE cohort_month >= '1995-01' GROUP BY 1""",
    "rfm_scores": f"""SELECT name AS customer_name, email AS customer_email, recency AS recency_days,
        orders AS frequency, {usd('cents')} AS monetary_usd, r AS r_score, f AS f_score, m AS m_score,
        concat(r, f, m) AS rfm_code, rfm_segment, segment AS original_segment FROM scored""",
    "rfm_segment_summary": f"""SELECT rfm_segment, count(*) AS customer_count, {usd('sum(cents)')} AS total_value_usd,
        {ratio('sum(cents)', '100 * count(*)')} AS avg_value_usd, {ratio('sum(recency)', 'count(*)')} AS avg_recency_days,
        {ratio('sum(orders)', 'count(*)')} AS avg_frequency FROM scored GROUP BY 1""",
    "recency_distribution": _distribution("""CASE WHEN recency > 180 THEN '180+ days' WHEN recency > 90 THEN '91-180 days'
        WHEN recency > 60 THEN '61-90 days' WHEN recency > 30 THEN '31-60 days' ELSE '0-30 days' END""", "recency_bucket"),
    "frequency_distribution": _distribution("""CASE WHEN orders < 2 THEN '1 order' WHEN orders < 4 THEN '2-3 orders'
        WHEN orders < 7 THEN '4-6 orders' WHEN orders < 10 THEN '7-9 orders' ELSE '10+ orders' END""", "frequency_bucket"),
    "monetary_distribution": _distribution("""CASE WHEN cents < 50000 THEN '$0-499' WHEN cents < 100000 THEN '$500-999'
        WHEN cents < 200000 THEN '$1000-1999' WHEN cents < 500000 THEN '$2000-4999' ELSE '$5000+' END""", "monetary_bucket"),
    "active_customers": f"SELECT customer_id, 1 AS distinct_customers, {usd('cents')} AS revenue_usd FROM active",
    "spend_tiers": f"""SELECT customer_id, {usd('cents')} AS revenue_usd, CASE WHEN cents < 50000 THEN 'Low'
        WHEN cents <= 200000 THEN 'Medium' ELSE 'High' END AS spend_tier, cents > 500000 AS is_vip FROM active""",
    "category_gap": f"""SELECT customer_id, {usd('cents')} AS revenue_usd FROM active WHERE customer_id NOT IN
        (SELECT ord.customer_id FROM item JOIN link USING (product_id) JOIN ord ON ord.id = item.order_id
         WHERE category_id = {GAP})""",
    "lapsed_customers": f"""SELECT customer_id, max(day) AS last_order_date FROM ord
        WHERE status = 'completed' AND day >= {AS_OF} - 180 AND day < {AS_OF} - 90 AND customer_id NOT IN
        (SELECT customer_id FROM active) GROUP BY 1""",
    "customer_ltv_model": f"""SELECT d_cust.id AS customer_id, email AS customer_email, since AS customer_since,
        n AS total_orders, {usd('s')} AS lifetime_value, {ratio('s', '100 * n')} AS avg_order_value, lo AS first_order_date,
        hi AS last_order_date, {AS_OF} - hi AS days_since_last_order,
        CASE WHEN n = 1 THEN 'One-time' WHEN n <= 5 THEN 'Regular' ELSE 'Loyal' END AS customer_segment,
        CASE WHEN {AS_OF} - hi <= 30 THEN 'Active' WHEN {AS_OF} - hi <= 90 THEN 'Inactive' ELSE 'At Risk' END
            AS engagement_status
        FROM d_cust JOIN (SELECT customer_id, count(*) AS n, sum(cents) AS s, min(day) AS lo, max(day) AS hi FROM ord
            WHERE status = 'completed' GROUP BY 1) h ON h.customer_id = d_cust.id""",
    "monthly_completed_revenue": f"""SELECT CAST(date_trunc('month', day) AS DATE) AS month,
        {usd('sum(cents)')} AS revenue, count(*) AS order_count FROM ord WHERE status = 'completed' GROUP BY 1""",
    "top_selling_units": f"""SELECT title AS product_name, {big('sum(quantity)')} AS units_sold,
        {usd('sum(total)')} AS revenue FROM f_item JOIN prod ON prod.id = f_item.product_id GROUP BY 1
        ORDER BY sum(total) DESC, 1 LIMIT 10""",
    "repeat_customers": f"""SELECT customer_id, count(*) AS order_count, {usd('sum(cents)')} AS lifetime_value
        FROM ord WHERE status = 'completed' GROUP BY 1 HAVING count(*) > 1""",
    "pareto_share": f"""SELECT CASE WHEN pct <= 0.2 THEN 'Top 20%' ELSE 'Bottom 80%' END AS product_tier,
        {big('sum(units)')} AS total_units,
        CAST(sum(units) AS DOUBLE) * 100.0 / (SELECT {big('sum(quantity)')} FROM item) AS percentage
        FROM ranked GROUP BY 1""",
    "cart_abandonment": """SELECT count(*) AS total_carts, count(*) FILTER (WHERE bought IS NULL) AS abandoned,
        CAST(count(*) FILTER (WHERE bought IS NULL) AS DOUBLE) / count(*) * 100 AS abandonment_rate FROM cart""",
    "order_count_segments": """SELECT segment, count(*) AS count,
        CAST(count(*) AS DOUBLE) * 100.0 / sum(count(*)) OVER () AS percentage
        FROM (SELECT CASE WHEN count(*) >= 10 THEN 'VIP' WHEN count(*) >= 3 THEN 'Regular' ELSE 'New' END AS segment
              FROM ord GROUP BY customer_id) GROUP BY 1""",
    "top_products_catalog_price": f"""SELECT title, order_count, units_sold, {usd('worth')} AS revenue FROM
        (SELECT prod.id, title, count(*) AS order_count, {big('sum(quantity)')} AS units_sold,
                sum(quantity * cents) AS worth
         FROM item JOIN prod ON prod.id = item.product_id GROUP BY 1, 2 ORDER BY worth DESC, 1 LIMIT 10)""",
    "customer_lifetime_value": f"""SELECT email, coalesce(n, 0) AS total_orders, {usd('s')} AS lifetime_value,
        CASE WHEN n >= 10 THEN 'VIP' WHEN n >= 3 THEN 'Regular' ELSE 'New' END AS segment
        FROM cust LEFT JOIN (SELECT customer_id, count(*) AS n, sum(cents) AS s FROM ord GROUP BY 1) h
        ON h.customer_id = cust.id""",
    "conversion_funnel": """SELECT CAST(made AS DATE) AS date, count(*) AS total_carts, count(bought) AS converted,
        CAST(count(bought) AS DOUBLE) / count(*) * 100 AS conversion_rate FROM cart GROUP BY 1""",
    "weekly_seasonality": f"""SELECT CAST(date_trunc('week', day) AS DATE) AS week, count(*) AS orders,
        {usd('sum(cents)')} AS revenue FROM ord
        WHERE made BETWEEN TIMESTAMP '2000-11-01' AND TIMESTAMP '2000-12-31' GROUP BY 1""",
    "popularity_mix": f"""SELECT CASE WHEN pct <= 0.2 THEN 'high' WHEN pct <= 0.5 THEN 'medium' ELSE 'low' END
        AS popularity, {big('sum(lines)')} AS items_sold FROM ranked GROUP BY 1""",
}

_QUERIES = {
    "read_collection_pages": f"""SELECT id, name, email,
        CASE WHEN admin THEN '["admin"]' ELSE '["customer"]' END AS roles,
        {BORN} AS "createdAt", {BORN} AS "updatedAt" FROM cust""",
    "read_collections": _collections(),
    "incremental_extract": f"{PLAIN_ORDERS} WHERE made >= {CUTOFF}",
    "advance_cursor": f"SELECT max(made) AS cursor FROM ord WHERE made >= {CUTOFF}",
    "debug_sample": f"""SELECT * FROM (SELECT 'orders' AS collection, id, made AS "createdAt" FROM ord ORDER BY made, id LIMIT 10)
        UNION ALL SELECT * FROM (SELECT 'products', id, {BORN} FROM prod ORDER BY id LIMIT 10)""",
    "write_append": PLAIN_ORDERS,
    "write_replace": f"{PLAIN_ORDERS} WHERE made >= {CUTOFF}",
    "write_merge": CHANGED_ORDERS,
    "create_if_missing": PLAIN_ORDERS,
    "incremental_load": CHANGED_ORDERS,
    "landed_load": f"""SELECT c.*, CASE id % 6 WHEN 0 THEN NULL WHEN 1 THEN '[]' ELSE (
        SELECT '[' || string_agg('{{"id":"' || item_id || '","product":' || CASE j WHEN 3 THEN '' || part ELSE '{{"id":' || part || '}}' END
            || ',"quantity":' || quantity || ',"variant":' || CASE j WHEN 3 THEN '' || (part * 10 + 1)
            WHEN 1 THEN '{{"id":' || (part * 10 + 1) || '}}' ELSE 'null' END || '}}', ',' ORDER BY j) || ']'
        FROM wline WHERE order_id = c.id) END AS items FROM ({CHANGED_ORDERS}) c""",
    "inferred_fields": """SELECT c_custkey AS id, CAST(round(c_acctbal * 100) AS BIGINT) AS points,
        '{"country":' || c_nationkey || ',"label":"' || c_mktsegment || '"}' AS "homeAddress",
        CASE WHEN c_custkey % 3 = 0 THEN c_custkey % 2 = 0 END AS newsletter,
        CASE WHEN c_custkey % 2 = 0 THEN c_custkey / 4 END AS rating FROM customer""",
    "preview": f"""SELECT id AS transaction_id, {usd('cents')} AS amount_usd, paid AS status FROM ord
        ORDER BY id LIMIT 5""",
    "write_skip": f"{PLAIN_ORDERS} WHERE made < {CUTOFF}",
    "align_to_schema": "SELECT id, status, CAST(cents AS DOUBLE) AS amount, CAST(NULL AS DOUBLE) AS discount FROM ord",
    "map_types": """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity AS quantity,
        CAST(CAST(l_extendedprice AS DECIMAL(12, 2)) AS VARCHAR) AS price, l_returnflag = 'R' AS returned,
        CAST(l_shipdate AS DATE) AS shipped, '{"id":' || l_partkey || '}' AS product,
        '[' || l_suppkey || ',' || l_linenumber || ']' AS pair FROM lineitem""",
    "table_summary": _summary(),
    "layer_counts": """SELECT layer, (SELECT count(*) FROM ord) AS records
        FROM (VALUES ('raw'), ('staging'), ('marts')) t(layer)""",
    "list_tables": """SELECT layer, (SELECT count(*) FROM ord) AS records
        FROM (VALUES ('fact_orders'), ('fact_transactions')) t(layer)""",
    "schema_removed": "SELECT id, customer_id, cents AS amount, status FROM ord",
    "schema_widened": f"""SELECT id, CASE WHEN made >= {CUTOFF} THEN cents / 4 ELSE cents END AS amount,
        CASE WHEN made >= {CUTOFF} THEN 'web' END AS channel FROM ord""",
    "schema_incompatible": f"""SELECT 'status' AS column_name, 'string' AS stored, 'array<string>' AS incoming,
        (SELECT count(*) FROM ord WHERE made < {CUTOFF}) AS records""",
    "on_schema_change": f"SELECT id, CASE WHEN made >= {CUTOFF} THEN 'web' END AS channel FROM ord",
    "run_models": """SELECT layer, CASE layer WHEN 'fact_order_items' THEN (SELECT count(*) FROM item)
            WHEN 'dim_products' THEN (SELECT count(*) FROM prod) WHEN 'dim_customers' THEN (SELECT count(*) FROM cust WHERE NOT admin)
            ELSE (SELECT count(*) FROM ord) END AS records
        FROM (VALUES ('fact_orders'), ('fact_order_items'), ('fact_transactions'), ('dim_customers'), ('dim_products')) t(layer)""",
    "duplicate_loads": f"""SELECT status, count(DISTINCT id) AS orders, {usd('sum(cents)')} AS amount_usd,
            CAST(coalesce(sum(n), 0) AS BIGINT) AS items
        FROM ord LEFT JOIN (SELECT order_id, count(*) AS n FROM item GROUP BY 1) ON order_id = id GROUP BY status""",
    "freshness": """SELECT 'raw_created' AS source, CAST(max(made) AS VARCHAR) AS latest FROM ord
        UNION ALL SELECT 'raw_updated', CAST(max(made) AS VARCHAR) FROM ord
        UNION ALL SELECT 'marts', CAST(max(day) AS VARCHAR) FROM ord""",
    "stream_upsert": """SELECT id, CASE WHEN customer_id IS NOT NULL THEN '{"id":' || customer_id || '}' END AS customer,
        '[{"product":{"id":' || product_id || '}' || CASE WHEN with_variant THEN ',"variant":{"id":' || (product_id * 10 + 1) || '}' ELSE '' END
            || ',"quantity":' || quantity || '}]' AS items, 'USD' AS currency, cents AS subtotal,
        date_trunc('millisecond', bought) AS "purchasedAt", date_trunc('millisecond', made) AS "createdAt",
        date_trunc('millisecond', made) AS "updatedAt" FROM cart""",
    "stg_orders": f"""SELECT id AS order_id, customer_id, cents AS amount, 'USD' AS currency, status, {STAMPS} FROM ord""",
    "stg_order_items": "SELECT item_id AS order_item_id, order_id, product_id, variant_id, quantity FROM item",
    "stg_order_items_whole": "SELECT item_id AS order_item_id, order_id, product_id, variant_id, quantity FROM witem",
    "stg_order_items_bare": """SELECT item_id AS order_item_id, order_id, part AS product_id,
        CASE WHEN j % 2 = 1 THEN part * 10 + 1 END AS variant_id, quantity FROM wline""",
    "fact_orders_whole": f"""SELECT id AS order_id, customer_id, {usd('cents')} AS amount_usd, 'USD' AS currency, status,
        day AS order_date, {STAMPS}, CASE WHEN id % 6 >= 2 THEN id % 6 - 1 ELSE 0 END AS item_count FROM ord""",
    "fact_order_items_whole": F_ITEMS.replace("f_item", "wf_item"),
    "incremental_build_whole": F_ITEMS.replace("f_item", "wf_item"),
    "stg_transactions": f"""SELECT id AS transaction_id, id AS order_id, customer_id, cents AS amount, 'USD' AS currency,
        'stripe' AS payment_method, paid AS status, {STAMPS} FROM ord""",
    "stg_carts": f"""SELECT id AS cart_id, customer_id, 'USD' AS currency, cents AS subtotal, bought AS purchased_at,
        {STAMPS}, bought IS NULL AS is_abandoned FROM cart""",
    "stg_products": f"""SELECT id AS product_id, title, slug, cents AS price_in_cents, {usd('cents')} AS price_usd,
        inventory, {BORN_STAMPS} FROM prod""",
    "stg_product_categories": f"""SELECT product_id, category_id, name AS category_name, {slug('name')} AS category_slug
        FROM link""",
    "stg_variants": f"""SELECT id AS variant_id, title AS variant_title, product_id, cents AS price_in_cents,
        {usd('cents')} AS price_usd, inventory, {BORN_STAMPS} FROM vari""",
    "stg_categories": f"SELECT id AS category_id, name AS category_name, slug AS category_slug, {BORN_STAMPS} FROM cat",
    "stg_customers": f"SELECT id AS customer_id, name, email, {BORN_STAMPS} FROM cust WHERE NOT admin",
    "fact_orders": F_ORDERS,
    "fact_order_items": F_ITEMS,
    "fact_transactions": f"""SELECT id AS transaction_id, id AS order_id, customer_id, {usd('cents')} AS amount_usd,
        'USD' AS currency, 'stripe' AS payment_method, paid AS status, day AS transaction_date, {STAMPS} FROM ord""",
    "dim_customers": f"""SELECT id AS customer_id, name AS customer_name, email AS customer_email, since AS customer_since,
        age AS customer_lifetime_days, orders AS total_orders, {usd('cents')} AS lifetime_value_usd,
        first_at AS first_order_date, last_at AS last_order_date, segment AS customer_segment, {BORN} AS updated_at
        FROM d_cust""",
    "dim_products": f"""SELECT id AS product_id, title AS product_name, slug AS product_slug, {usd('cents')} AS price_usd,
        inventory, {BORN_STAMPS}, inventory > 0 AS is_in_stock, inventory BETWEEN 1 AND 10 AS is_low_stock FROM prod""",
    "dim_categories": f"SELECT id AS category_id, name AS category_name, slug AS category_slug, {BORN_STAMPS} FROM cat",
    "bridge_product_categories": "SELECT product_id, category_id FROM link",
    "dim_date": """SELECT d AS date_key, d AS date_day, year(d) AS year, quarter(d) AS quarter, month(d) AS month,
        day(d) AS day, isodow(d) AS day_of_week, dayname(d) AS day_name, weekofyear(d) AS week_of_year,
        isodow(d) > 5 AS is_weekend, month(d) > 10 AS is_holiday_season
        FROM (SELECT CAST(unnest(generate_series(date_trunc('year', lo), date_trunc('year', hi) + INTERVAL 1 YEAR
              - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS d
              FROM (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders))""",
    "incremental_build": F_ORDERS,
    "incremental_build_items": F_ITEMS,
    "test_unique": """SELECT l_orderkey AS value, count(*) AS n_records FROM lineitem GROUP BY 1 HAVING count(*) > 1""",
    "test_not_null": "SELECT id AS cart_id FROM cart WHERE customer_id IS NULL",
    "test_accepted_values": """SELECT status AS value, count(*) AS n_records FROM ord
        WHERE status NOT IN ('completed', 'refunded') GROUP BY 1""",
    "test_relationships": """SELECT DISTINCT variant_id AS value FROM item
        WHERE variant_id IS NOT NULL AND variant_id NOT IN (SELECT id FROM vari)""",
    "test_accepted_range": f"""SELECT id AS order_id, {usd('cents')} AS amount_usd FROM ord
        WHERE cents NOT BETWEEN 1000000 AND 40000000""",
    "test_singular": "SELECT id AS order_id FROM f_ord WHERE items = 0",
    "run_tests": _test_report(),
    **_ANALYTICS,
    "product_affinity_huge": _ANALYTICS["product_affinity"],
    "where": f"""SELECT id, title, inventory, state AS _status FROM prod WHERE
        (title ILIKE '%ring%' AND title ILIKE '%small%' AND inventory BETWEEN 11 AND 45)
        OR (description ILIKE '%promo%' AND state <> 'draft' AND cents >= 95000 AND inventory NOT IN (0, 7, 14))
        OR (has_categories AND p_type = 'PROMO' AND p_brand = 'Brand#1' AND inventory < 30)
        OR (NOT has_categories AND has_variants AND inventory IN (5, 10, 15, 20))""",
    "sort": 'SELECT id, title, cents AS "priceInUSD" FROM prod',
    "page": 'SELECT id, made AS "createdAt" FROM ord ORDER BY made DESC, id LIMIT 100 OFFSET 200',
    "page_walk": """SELECT id, made AS "createdAt", (n - 1) // 1000 + 1 AS page, (n - 1) % 1000 + 1 AS position
        FROM (SELECT *, row_number() OVER (ORDER BY made DESC, id) AS n FROM ord)""",
    "select": 'SELECT id, title, slug, cents AS "priceInUSD" FROM prod',
    "populate": """SELECT ord.id, name AS customer_name, email AS customer_email, cents AS order_amount,
        status AS order_status FROM ord LEFT JOIN cust ON cust.id = ord.customer_id""",
    "populate_depth": """SELECT vari.id, prod.title AS product_title,
            CASE WHEN has_categories THEN p_type || ',' || p_brand END AS categories,
            p_size || ',' || p_brand AS options, 'Size,Brand' AS option_types, CAST(NULL AS VARCHAR) AS lost
        FROM vari JOIN prod ON prod.id = vari.product_id""",
    "product_search": """SELECT id, title, slug, cents AS "priceInUSD" FROM prod WHERE state = 'published'
        AND has_categories AND p_type = 'PROMO' AND (title ILIKE '%ring%' OR description ILIKE '%ring%')""",
    "products_in_categories": f"""SELECT id, title FROM prod WHERE id IN
        (SELECT product_id FROM link WHERE category_id IN ({SEARCH}, {GAP})) ORDER BY id LIMIT 50""",
    "customer_orders": "SELECT id, cents AS amount, status FROM ord WHERE customer_id = 7",
    "order_lookup": "SELECT id, cents AS amount, status FROM ord WHERE id = 965 AND customer_id = 7",
    "visible_rows": "SELECT id, status FROM ord WHERE customer_id = 7",
    "product_price_range": """SELECT prod.id AS product_id, coalesce(min(vari.cents), any_value(prod.cents)) AS lowest_price,
        coalesce(max(vari.cents), any_value(prod.cents)) AS highest_price
        FROM prod LEFT JOIN vari ON vari.product_id = prod.id GROUP BY 1""",
    "product_offer": """SELECT prod.id AS product_id, coalesce(bool_or(CASE WHEN has_variants THEN vari.inventory > 0
        ELSE prod.inventory > 0 END), false) AS in_stock, greatest(any_value(prod.cents), max(vari.cents)) AS offer_price
        FROM prod LEFT JOIN vari ON vari.product_id = prod.id GROUP BY 1""",
    "stock_status": """SELECT product_id, variant_id, quantity, CASE WHEN quantity = 0 THEN 'Out of stock'
        WHEN quantity < 10 THEN 'Only ' || quantity || ' left in stock' END AS notice FROM
        (SELECT id AS product_id, NULL::BIGINT AS variant_id, inventory AS quantity FROM prod WHERE NOT has_variants
         UNION ALL SELECT product_id, id, inventory FROM vari)""",
    "match_variant": """SELECT id AS variant_id, product_id, inventory > 0 AS is_available FROM vari
        WHERE option_a BETWEEN 1026 AND 1040 AND option_b BETWEEN 2001 AND 2012""",
    "cart_quantity": "SELECT id AS cart_id, quantity FROM cart",
    "cart_over_stock": """SELECT cart_id, product_id, variant_id, quantity, available FROM
        (SELECT cart.id AS cart_id, cart.product_id, CASE WHEN with_variant THEN cart.product_id * 10 + 1 END AS variant_id,
            cart.quantity, CASE WHEN NOT prod.has_variants THEN prod.inventory
                WHEN with_variant THEN vari.inventory ELSE 0 END AS available
         FROM cart JOIN prod ON prod.id = cart.product_id LEFT JOIN vari ON vari.product_id = prod.id)
        WHERE quantity >= available""",
}

ORACLE = {name: _with(sql) for name, sql in _QUERIES.items()}
