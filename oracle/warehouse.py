"""Oracle statements of the star tables, paired questions, trips and selective reads."""

from __future__ import annotations

from oracle.shop import mean_money, money, shop

DATE_ID = "CAST(strftime({}, '%Y%m%d') AS INTEGER)"

CUSTOMERS = """customers AS (
  SELECT row_number() OVER (ORDER BY id) AS customer_sk, id AS user_id,
         split_part(email, '@', 1) AS full_name, email, 'Unknown' AS gender, 'Unknown' AS city,
         TIMESTAMP '1900-01-01 00:00:00' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to,
         true AS is_current
  FROM shop_users)"""

PRODUCTS = """products AS (
  SELECT row_number() OVER (ORDER BY product_id) AS product_sk, product_id, category_name,
         product_name, price AS current_price
  FROM shop_catalogue)"""

# Early customers in one load; then everybody reports, buyers with a city.
VERSIONS = """early AS (
  SELECT row_number() OVER (ORDER BY id) AS customer_sk, id AS user_id, email
  FROM shop_users WHERE created_at < TIMESTAMP '1996-07-01 00:00:00'),
reported AS (
  SELECT u.id AS user_id, u.email,
         CASE WHEN EXISTS (SELECT 1 FROM shop_orders o WHERE o.user_id = u.id)
              THEN n_name ELSE 'Unknown' END AS city
  FROM shop_users u LEFT JOIN customer ON c_custkey = u.id LEFT JOIN nation ON n_nationkey = c_nationkey),
opened AS (
  SELECT (SELECT max(customer_sk) FROM early)
           + row_number() OVER (ORDER BY r.user_id) AS customer_sk, r.*
  FROM reported r LEFT JOIN early e ON e.user_id = r.user_id
  WHERE e.user_id IS NULL OR r.city <> 'Unknown'),
versions AS (
  SELECT e.customer_sk, e.user_id, split_part(e.email, '@', 1) AS full_name, e.email,
         'Unknown' AS gender, 'Unknown' AS city, TIMESTAMP '1900-01-01 00:00:00' AS valid_from,
         CASE WHEN o.user_id IS NOT NULL THEN TIMESTAMP '1999-01-01 00:00:00' END AS valid_to,
         o.user_id IS NULL AS is_current
  FROM early e LEFT JOIN opened o ON o.user_id = e.user_id
  UNION ALL
  SELECT customer_sk, user_id, split_part(email, '@', 1), email, 'Unknown', city,
         TIMESTAMP '1999-01-01 00:00:00', NULL, true
  FROM opened)"""

# A load, then another that keeps history: users of one mail domain have moved to a second one.
MOVED = """reloaded AS (
  SELECT customer_sk, user_id, full_name, email, gender, city, valid_from,
         CASE WHEN email LIKE '%@example.com' THEN TIMESTAMP '1999-01-01 00:00:00' END AS valid_to,
         email NOT LIKE '%@example.com' AS is_current
  FROM customers
  UNION ALL
  SELECT (SELECT count(*) FROM customers) + row_number() OVER (ORDER BY user_id), user_id, full_name,
         replace(email, '@example.com', '@example.net'), gender, city,
         TIMESTAMP '1999-01-01 00:00:00', NULL, true
  FROM customers WHERE email LIKE '%@example.com')"""


def _content(name: str, columns: str, rows: str) -> str:
    """Rows of a table and the sum of their hashes."""
    return f"""
SELECT '{name}' AS table_name, count(*) AS row_count,
       CAST(sum(CAST('0x' || substr(md5(concat_ws('|', {columns})), 1, 8) AS BIGINT)) AS BIGINT) AS content
FROM ({rows})"""


def _fct_orders(customers: str, condition: str) -> str:
    return f"""
SELECT o.id AS order_id, c.customer_sk, {DATE_ID.format('o.created_at')} AS date_id, o.status,
       o.total_amount, CAST(0 AS DECIMAL(10,2)) AS shipping_cost
FROM shop_orders o JOIN {customers} c ON c.user_id = o.user_id AND {condition}"""


STAR: dict[str, str] = {
    "e1_dim_date": shop(
        f"""
SELECT {DATE_ID.format('d')} AS date_id, d AS full_date,
       CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name,
       CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
       CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year,
       isodow(d) >= 6 AS is_weekend
FROM (SELECT DISTINCT created_at::DATE AS d FROM shop_orders)"""
    ),
    "e2_dim_product": shop("SELECT * FROM products", PRODUCTS),
    "e3_dim_customer_initial": shop("SELECT * FROM customers", CUSTOMERS),
    "e4_fct_orders": shop(_fct_orders("customers", "c.is_current"), CUSTOMERS),
    "e4_fct_orders_as_of": shop(
        _fct_orders(
            "versions",
            "o.created_at >= c.valid_from "
            "AND o.created_at < coalesce(c.valid_to, TIMESTAMP '9999-12-31')",
        ),
        VERSIONS,
    ),
    "e5_fct_order_items": shop(
        f"""
SELECT item_id AS order_item_id, order_id, product_sk, {DATE_ID.format('created_at')} AS date_id,
       quantity, unit_price, CAST(value AS DECIMAL(10,2)) AS line_total
FROM shop_sales JOIN products USING (product_id)""",
        PRODUCTS,
    ),
    "e6_surrogate_key": shop("SELECT * FROM shop_items"),
    "e7_scd2_apply": shop("SELECT * FROM versions", VERSIONS),
    "e7_scd2_change_log": shop(
        """
SELECT c.customer_sk, c.user_id, c.full_name, c.email, c.gender, c.city, c.valid_from, f.first AS valid_to,
       f.first IS NULL AS is_current
FROM customers c LEFT JOIN placed f USING (user_id)
UNION ALL
SELECT (SELECT count(*) FROM customers) + row_number() OVER (ORDER BY user_id, valid_from), * FROM (
  SELECT user_id, full_name, email, gender, n_name AS city, first AS valid_from,
         CASE WHEN last > first THEN last END AS valid_to, last = first AS is_current
  FROM customers JOIN placed USING (user_id)
  UNION ALL
  SELECT user_id, upper(full_name), email, gender, n_name, last, NULL, true
  FROM customers JOIN placed USING (user_id) WHERE last > first)""",
        CUSTOMERS,
        """placed AS (
  SELECT user_id, n_name, min(o.created_at) AS first, max(o.created_at) AS last
  FROM shop_orders o JOIN customer ON c_custkey = user_id JOIN nation ON n_nationkey = c_nationkey
  JOIN shop_users u ON u.id = user_id GROUP BY ALL)""",
    ),
    "e8_scd2_history": shop("SELECT * FROM versions WHERE user_id = 1", VERSIONS),
    "e9_price_history_backfill": shop(
        """
SELECT id AS product_id, price, TIMESTAMP '2024-01-01 00:00:00' AS valid_from,
       CAST(NULL AS TIMESTAMP) AS valid_to
FROM shop_products"""
    ),
    "e10_full_refresh": shop(
        " UNION ALL ".join(
            [
                _content(
                    "dim_date",
                    "date_id, d, isodow(d), month(d), quarter(d), year(d)",
                    f"SELECT DISTINCT {DATE_ID.format('created_at')} AS date_id, created_at::DATE AS d FROM shop_orders",
                ),
                _content(
                    "dim_product",
                    "product_sk, product_id, category_name, product_name, current_price",
                    "SELECT * FROM products",
                ),
                _content("dim_customer", "customer_sk, user_id, full_name, email, city", "SELECT * FROM customers"),
                _content(
                    "fct_orders",
                    "order_id, customer_sk, date_id, status, total_amount",
                    _fct_orders("customers", "c.is_current"),
                ),
                _content(
                    "fct_order_items",
                    "item_id, order_id, product_sk, date_id, quantity, unit_price, line_total",
                    f"""SELECT item_id, order_id, product_sk, {DATE_ID.format('created_at')} AS date_id, quantity,
                               unit_price, CAST(value AS DECIMAL(10,2)) AS line_total
                        FROM shop_sales JOIN products USING (product_id)""",
                ),
            ]
        ),
        CUSTOMERS,
        PRODUCTS,
    ),
    "e10_refresh_keeps_history": shop("SELECT * FROM reloaded", CUSTOMERS, MOVED),
    "e10_refresh_as_of": shop(
        _fct_orders(
            "reloaded",
            "o.created_at >= c.valid_from "
            "AND o.created_at < coalesce(c.valid_to, TIMESTAMP '9999-12-31')",
        ),
        CUSTOMERS,
        MOVED,
    ),
}

LINES = """lines AS (
  SELECT category_name, product_name, quantity, quantity * unit_price AS value
  FROM shop_items JOIN shop_catalogue USING (product_id))"""


def _top_emails(measure: str, name: str) -> str:
    return shop(f"""
SELECT email, {measure} AS {name} FROM shop_orders o JOIN shop_users u ON u.id = o.user_id
GROUP BY email ORDER BY {measure} DESC, email LIMIT 5""")


def _orders_by(expression: str, name: str) -> str:
    return shop(
        f"SELECT {expression} AS {name}, count(*) AS order_count FROM shop_orders GROUP BY 1"
    )


PAIRED: dict[str, str] = {
    "d01_category_revenue": shop(
        f"SELECT category_name, {money('sum(value)')} AS revenue FROM lines GROUP BY 1", LINES
    ),
    "d02_orders_by_month": _orders_by("CAST(month(created_at) AS INTEGER)", "month"),
    "d03_top5_products_revenue": shop(
        f"""
SELECT product_name, {money('sum(value)')} AS revenue FROM lines
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""",
        LINES,
    ),
    "d04_weekend_split": _orders_by("isodow(created_at) >= 6", "is_weekend"),
    "d05_revenue_by_quarter": shop(
        f"""
SELECT CAST(quarter(created_at) AS INTEGER) AS quarter, {money('sum(value)')} AS revenue
FROM shop_sales GROUP BY 1"""
    ),
    "d05_months_of_quarter": shop(
        f"""
SELECT CAST(month(created_at) AS INTEGER) AS month, {money("sum(value)")} AS revenue
FROM shop_sales WHERE year(created_at) = 1997 AND quarter(created_at) = 2 GROUP BY 1"""
    ),
    "d06_aov_by_status": shop(
        f"""
SELECT status, count(*) AS order_count, {money('sum(total_amount)')} AS total_amount,
       {mean_money('sum(total_amount)', 'count(*)', 6)} AS avg_amount
FROM shop_orders GROUP BY status"""
    ),
    "d07_top5_customers_orders": _top_emails("count(*)", "order_count"),
    "d08_category_units": shop(
        "SELECT category_name, CAST(sum(quantity) AS BIGINT) AS units FROM lines GROUP BY 1", LINES
    ),
    "d09_orders_by_weekday": _orders_by("dayname(created_at)", "weekday"),
    "d10_top5_ltv": _top_emails(money("sum(total_amount)"), "total_spent"),
}


def _trips(select: str, group: str = "") -> str:
    return shop(f"SELECT {select} FROM shop_trips" + (f" GROUP BY {group}" if group else ""))


def _mean(column: str) -> str:
    return mean_money(f"sum({column})", f"count({column})", 6)


TRIPS: dict[str, str] = {
    "x01_count": _trips("count(*) AS trips"),
    "x02_count_by_passengers": _trips("passenger_count, count(*) AS trips", "passenger_count"),
    "x03_avg_fare_by_vendor": _trips(f"VendorID, {_mean('fare_amount')} AS avg_fare", "VendorID"),
    "x04_sum_total_by_payment": _trips(
        f"payment_type, {money('sum(total_amount)')} AS total_amount", "payment_type"
    ),
    "x05_max_distance": _trips("max(trip_distance) AS max_distance"),
    "x06_minmax_tolls": _trips("min(tolls_amount) AS min_tolls, max(tolls_amount) AS max_tolls"),
    "x07_avg_tip_by_passengers": _trips(
        f"passenger_count, {_mean('tip_amount')} AS avg_tip", "passenger_count"
    ),
    "x08_count_by_ratecode": _trips("RatecodeID, count(*) AS trips", "RatecodeID"),
    "x09_sum_extra_by_vendor": _trips(f"VendorID, {money('sum(extra)')} AS extra", "VendorID"),
    "x10_avg_max_fare": _trips(f"{_mean('fare_amount')} AS avg_fare, max(fare_amount) AS max_fare"),
}

JULY_2000 = """
SELECT * FROM shop_orders WHERE year(created_at) = 2000 AND month(created_at) = 7"""
PREFIX = "SELECT * FROM shop_users WHERE email LIKE 'customer.0000001%'"
LOOKUP = "SELECT order_id, product_id, quantity, unit_price FROM shop_items WHERE order_id = 750"
TOP20 = "SELECT id, user_id, total_amount FROM shop_orders ORDER BY total_amount DESC, id LIMIT 20"
CANCELLED = """
SELECT id, total_amount FROM shop_orders
WHERE status = 'cancelled' AND year(created_at) >= 2000"""

LAB: dict[str, str] = {
    "l1_month_filter": shop("SELECT * FROM shop_orders WHERE month(created_at) = 7"),
    "l1_range_filter": shop(JULY_2000),
    "l1_range_filter_by_month": shop(JULY_2000),
    "l1_range_filter_curve": shop(JULY_2000),
    "l2_email_suffix": shop("SELECT * FROM shop_users WHERE email LIKE '%example.com'"),
    "l2_email_suffix_clustered": shop("SELECT * FROM shop_users WHERE email LIKE '%example.com'"),
    "l2_email_prefix": shop(PREFIX),
    "l2_email_prefix_clustered": shop(PREFIX),
    "l3_order_lines_lookup": shop(LOOKUP),
    "l3_order_lines_lookup_clustered": shop(LOOKUP),
    "l4_top20_orders": shop(TOP20),
    "l4_top20_orders_curve": shop(TOP20),
    "l5_status_date_filter": shop(CANCELLED),
    "l5_status_date_filter_curve": shop(CANCELLED),
    "l5_status_date_filter_clustered": shop(CANCELLED),
}

# Asked on one side only, or in a second form.
OTHERS: dict[str, str] = {
    "d05_revenue_by_quarter_of_orders_dwh": PAIRED["d05_revenue_by_quarter"],
    "e10_incremental_refresh": STAR["e10_full_refresh"],
}

PAIRS = {f"{name}_{side}": sql for name, sql in PAIRED.items() for side in ("oltp", "dwh")}
SQL: dict[str, str] = {**STAR, **PAIRS, **OTHERS, **TRIPS, **LAB}
