"""Oracle statements of the fifty business questions."""

from __future__ import annotations

from oracle.shop import mean_money, money, pct, ratio, shop

DONE = "status = 'completed'"

PER_USER = f"""per_user AS (
  SELECT user_id, count(*) AS n, {money('sum(total_amount)')} AS spent, max(created_at) AS latest
  FROM shop_orders WHERE {DONE} GROUP BY user_id)"""

MONTHLY = f"""monthly AS (
  SELECT date_trunc('month', created_at) AS month, {money('sum(total_amount)')} AS revenue
  FROM shop_orders WHERE {DONE} GROUP BY 1)"""

GROWTH = f"""
SELECT month, revenue, lag(revenue) OVER w AS previous_revenue,
       {ratio("(revenue - lag(revenue) OVER w) * 10000", "lag(revenue) OVER w * 100")} AS growth_pct
FROM monthly WINDOW w AS (ORDER BY month)"""

DAILY_UNITS = f"""daily AS (
  SELECT product_id, date_trunc('day', created_at)::TIMESTAMP AS day,
         CAST(sum(quantity) AS BIGINT) AS units
  FROM shop_sales WHERE {DONE} GROUP BY ALL),
rolling AS (
  SELECT product_id, day, units, {ratio("sum(units) OVER w", "count(*) OVER w")} AS rolling_avg
  FROM daily
  WINDOW w AS (PARTITION BY product_id ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))"""


def _product_sales(status: str) -> str:
    return f"""product_sales AS (
  SELECT category_id, category_name, product_id, product_name, count(*) AS line_count,
         CAST(sum(quantity) AS BIGINT) AS units, {money('sum(value)')} AS revenue
  FROM shop_sales JOIN shop_catalogue USING (product_id)
  WHERE status = '{status}' GROUP BY ALL)"""


def _ranked_users(where: str, select: str, order: str, limit: int) -> str:
    return shop(f"""
SELECT {select} FROM (
  SELECT u.id AS user_id, u.email, count(*) AS n, {money('sum(o.total_amount)')} AS spent
  FROM shop_users u JOIN shop_orders o ON o.user_id = u.id WHERE {where} GROUP BY u.id, u.email)
ORDER BY {order}, user_id LIMIT {limit}""")


def _rfm(order: str) -> str:
    return f"""scored AS (
  SELECT user_id, n AS frequency, spent AS monetary,
         CAST(ntile(4) OVER (ORDER BY latest {order}, user_id) AS INTEGER) AS recency_score,
         CAST(ntile(4) OVER (ORDER BY n {order}, user_id) AS INTEGER) AS frequency_score,
         CAST(ntile(4) OVER (ORDER BY spent {order}, user_id) AS INTEGER) AS monetary_score
  FROM per_user)"""


def _streaks(rows: str, as_type: str) -> str:
    return f"""
WITH rows_in AS ({rows}),
days AS (SELECT DISTINCT user_id, ts::DATE AS day FROM rows_in),
runs AS (
  SELECT user_id, day,
         day - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INTEGER) AS run
  FROM days)
SELECT user_id, min(day)::{as_type} AS streak_start, max(day)::{as_type} AS streak_end,
       count(*) AS days
FROM runs GROUP BY user_id, run HAVING count(*) >= 2"""


def _row_streaks(rows: str) -> str:
    return f"""
WITH rows_in AS ({rows}),
numbered AS (
  SELECT DISTINCT user_id, ts::DATE AS day,
         row_number() OVER (PARTITION BY user_id ORDER BY ts::DATE) AS number
  FROM rows_in)
SELECT user_id, min(day) AS streak_start, max(day) AS streak_end, count(*) AS days
FROM numbered GROUP BY user_id, day - CAST(number AS INTEGER) HAVING count(*) >= 2"""


DONE_ORDERS = """
  SELECT o_custkey AS user_id, o_orderdate AS ts FROM orders
  WHERE o_orderkey % 100 >= 10"""
PURCHASES = "SELECT user_id, ts FROM events WHERE event_type = 'purchase'"


def _monthly(where: str, count: str, amount: str) -> str:
    return shop(f"""
SELECT date_trunc('month', created_at) AS month, count(*) AS {count},
       {money('sum(total_amount)')} AS {amount}
FROM shop_orders WHERE {where} GROUP BY 1""")


def _median_gap(pair_filter: str) -> str:
    return shop(
        f"""
SELECT {ratio("sum(gap)", "count(*) * 86400000000", 1)} AS median_days
FROM placed WHERE place IN ((total + 1) // 2, total // 2 + 1)""",
        f"""seq AS (
  SELECT user_id, created_at, row_number() OVER (PARTITION BY user_id ORDER BY created_at) AS n
  FROM shop_orders WHERE {DONE})""",
        f"""gaps AS (
  SELECT epoch_us(b.created_at) - epoch_us(a.created_at) AS gap
  FROM seq a JOIN seq b ON a.user_id = b.user_id AND b.n = a.n + 1 WHERE {pair_filter})""",
        """placed AS (
  SELECT gap, row_number() OVER (ORDER BY gap) AS place, count(*) OVER () AS total FROM gaps)""",
    )


SQL: dict[str, str] = {
    "q01_top3_products_by_revenue": shop(
        """
SELECT category_name, CAST(place AS INTEGER) AS rank, product_id, product_name, revenue
FROM (SELECT *, row_number() OVER (PARTITION BY category_name
                                   ORDER BY revenue DESC, product_id) AS place FROM product_sales)
WHERE place <= 3""",
        _product_sales("completed"),
    ),
    "q02_monthly_growth": shop(GROWTH, MONTHLY),
    "q03_rfm_segments": shop(
        """
SELECT user_id, recency_score, frequency_score, monetary_score,
       recency_score::VARCHAR || frequency_score || monetary_score AS rfm_code,
       CASE WHEN recency_score = 4 AND frequency_score = 4 AND monetary_score = 4
              THEN 'Sampiyonlar'
            WHEN frequency_score >= 3
              THEN CASE WHEN recency_score >= 3 THEN 'Sadik Musteriler'
                        ELSE 'Riskli (Kaybedilmek Uzere)' END
            WHEN recency_score = 1 THEN 'Kaybedilenler'
            ELSE 'Digerleri' END AS segment
FROM scored""",
        PER_USER,
        _rfm("ASC"),
    ),
    "q04_rolling7_product_sales": shop(
        "SELECT product_id, day, units, rolling_avg FROM rolling", DAILY_UNITS
    ),
    "q05_purchase_streaks": _streaks(DONE_ORDERS, "TIMESTAMP"),
    "q05_purchase_streaks_events": _streaks(PURCHASES, "TIMESTAMP"),
    "q06_funnel_conversion": shop(
        f"""
SELECT total AS total_orders, paid AS paid_orders, {pct('paid', 'total')} AS payment_rate_pct,
       shipped AS shipped_orders, {pct('shipped', 'paid')} AS shipping_rate_pct
FROM (SELECT count(DISTINCT o.id) AS total, count(DISTINCT p.order_id) AS paid,
             count(DISTINCT s.order_id) AS shipped
      FROM shop_orders o
      LEFT JOIN shop_payments p ON p.order_id = o.id AND p.status = 'success'
      LEFT JOIN shop_shipments s ON s.order_id = o.id)"""
    ),
    "q06_funnel_users_approx": shop(
        """
SELECT count(DISTINCT o.user_id) AS ordered, count(DISTINCT CASE WHEN p.id IS NOT NULL THEN o.user_id END) AS paid,
       count(DISTINCT CASE WHEN s.id IS NOT NULL THEN o.user_id END) AS shipped,
       true AS ordered_within_bound, true AS paid_within_bound, true AS shipped_within_bound
FROM shop_orders o
LEFT JOIN shop_payments p ON p.order_id = o.id AND p.status = 'success'
LEFT JOIN shop_shipments s ON s.order_id = o.id"""
    ),
    "q07_top10_customers_by_orders": _ranked_users(
        "o.status = 'completed'", "email, n AS order_count, spent AS total_spent", "n DESC", 10
    ),
    "q08_never_ordered_users": shop(
        """
SELECT email, created_at FROM shop_users
WHERE id NOT IN (SELECT user_id FROM shop_orders) ORDER BY created_at DESC, id LIMIT 50"""
    ),
    "q09_category_price_stock": shop(
        f"""
SELECT category_name, {mean_money('sum(price)', 'count(*)')} AS avg_price,
       CAST(sum(stock) AS BIGINT) AS total_stock
FROM shop_catalogue GROUP BY category_id, category_name"""
    ),
    "q10_top10_returned_products": shop(
        """
SELECT product_name, category_name, line_count AS return_lines, units AS returned_units
FROM product_sales ORDER BY units DESC, product_id LIMIT 10""",
        _product_sales("returned"),
    ),
    "q11_coupon_performance": shop(
        f"""
SELECT c.code, c.discount_pct, count(o.id) AS uses,
       {money('coalesce(sum(o.total_amount), 0)')} AS revenue
FROM shop_coupons c LEFT JOIN (SELECT * FROM shop_orders WHERE {DONE}) o ON o.coupon_id = c.id
GROUP BY c.id, c.code, c.discount_pct"""
    ),
    "q12_unsold_products": shop(
        """
SELECT product_name, category_name, stock, price AS unit_price FROM shop_catalogue c
WHERE NOT EXISTS (SELECT 1 FROM shop_items i WHERE i.product_id = c.product_id)
ORDER BY stock DESC, product_id LIMIT 50"""
    ),
    "q13_aov": shop(
        f"""
SELECT {mean_money('sum(total_amount)', 'count(*)')} AS avg_order,
       min(total_amount) AS min_order, max(total_amount) AS max_order
FROM shop_orders WHERE {DONE}"""
    ),
    "q14_orders_by_hour": shop(
        f"""
SELECT CAST(hour(created_at) AS INTEGER) AS hour, count(*) AS order_count,
       {money('sum(total_amount)')} AS revenue
FROM shop_orders WHERE {DONE} GROUP BY 1"""
    ),
    "q15_avg_basket_units": shop(
        f"""
SELECT {ratio('sum(units)', 'count(*)')} AS avg_basket_units
FROM (SELECT order_id, sum(quantity) AS units FROM shop_sales WHERE {DONE} GROUP BY order_id)"""
    ),
    "q16_repeat_customers": shop(
        """
SELECT user_id, email, n AS order_count, spent AS lifetime_value
FROM per_user JOIN shop_users u ON u.id = user_id WHERE n >= 2""",
        PER_USER,
    ),
    "q17_one_time_buyers": shop(
        """
SELECT user_id, email, spent AS revenue FROM per_user JOIN shop_users u ON u.id = user_id
WHERE n = 1 ORDER BY spent DESC, user_id LIMIT 50""",
        PER_USER,
    ),
    "q18_shipment_status": shop(
        "SELECT status, count(*) AS shipment_count FROM shop_shipments GROUP BY status"
    ),
    "q19_monthly_cancel_cost": _monthly("status = 'cancelled'", "cancelled_count", "lost_revenue"),
    "q20_category_revenue": shop(
        f"""
SELECT category_name, CAST(sum(line_count) AS BIGINT) AS line_count,
       {money('sum(revenue)')} AS revenue
FROM product_sales GROUP BY category_id, category_name""",
        _product_sales("completed"),
    ),
    "q21_tied_capital": shop(
        f"""
SELECT product_name, category_name, stock, price AS unit_price, {money('stock * price')} AS value
FROM shop_catalogue WHERE stock > 0 ORDER BY stock * price DESC, product_id LIMIT 20"""
    ),
    "q22_cohort_retention": shop(
        """
SELECT cohort_month,
       CAST(datediff('month', cohort_month, date_trunc('month', o.created_at)) AS INTEGER)
         AS month_number,
       count(DISTINCT u.id) AS retained_users, any_value(total_users) AS total_users
FROM cohort u JOIN shop_orders o ON o.user_id = u.id
WHERE o.status = 'completed' GROUP BY 1, 2""",
        """cohort AS (
  SELECT id, date_trunc('month', created_at) AS cohort_month,
         count(*) OVER (PARTITION BY date_trunc('month', created_at)) AS total_users
  FROM shop_users)""",
    ),
    "q23_top10_no_coupon_spenders": _ranked_users(
        "o.status = 'completed' AND o.coupon_id IS NULL",
        "email, n AS order_count, spent AS total_spent",
        "spent DESC",
        10,
    ),
    "q24_cancellations_by_hour": shop(
        """
SELECT CAST(hour(created_at) AS INTEGER) AS hour, count(*) AS cancelled_count
FROM shop_orders WHERE status = 'cancelled' GROUP BY 1"""
    ),
    "q25_category_price_range": shop(
        f"""
SELECT category_name, max(price) AS max_price, min(price) AS min_price,
       {mean_money('sum(price)', 'count(*)')} AS avg_price
FROM shop_catalogue GROUP BY category_id, category_name"""
    ),
    "q26_monthly_new_users": shop(
        """
SELECT date_trunc('month', created_at) AS month, count(*) AS new_users FROM shop_users GROUP BY 1"""
    ),
    "q27_aov_by_discount": shop(
        f"""
SELECT discount_pct, count(*) AS order_count,
       {mean_money('sum(total_amount)', 'count(*)')} AS avg_order
FROM shop_orders o JOIN shop_coupons c ON o.coupon_id = c.id WHERE {DONE} GROUP BY discount_pct"""
    ),
    "q28_critical_stock": shop(
        """
SELECT product_name, category_name, stock, price AS unit_price FROM shop_catalogue
WHERE stock < 20 ORDER BY stock, product_id LIMIT 30"""
    ),
    "q29_avg_daily_orders": shop(
        f"""
SELECT {ratio('sum(n)', 'count(*)', 0)} AS avg_daily_orders
FROM (SELECT created_at::DATE AS day, count(*) AS n FROM shop_orders GROUP BY 1)"""
    ),
    "q30_largest_order": shop(
        f"""
SELECT email, o.id AS order_id, total_amount, o.created_at
FROM shop_orders o JOIN shop_users u ON u.id = o.user_id
WHERE {DONE} ORDER BY total_amount DESC, o.id LIMIT 1"""
    ),
    "q31_top5_products_by_units": shop(
        """
SELECT product_name, category_name, units FROM product_sales
ORDER BY units DESC, product_id LIMIT 5""",
        _product_sales("completed"),
    ),
    "q32_category_cancel_rate": shop(
        f"""
SELECT category_name, n AS line_count, bad AS cancelled_count, {pct('bad', 'n')} AS cancel_rate_pct
FROM (SELECT category_name, count(*) AS n, count(*) FILTER (status = 'cancelled') AS bad
      FROM shop_sales JOIN shop_catalogue USING (product_id) GROUP BY category_id, category_name)"""
    ),
    "q33_monthly_coupon_trend": _monthly(
        DONE + " AND coupon_id IS NOT NULL", "coupon_orders", "coupon_revenue"
    ),
    "q34_top10_revenue_days": shop(
        f"""
SELECT date_trunc('day', created_at)::TIMESTAMP AS day, {money('sum(total_amount)')} AS revenue,
       count(*) AS order_count
FROM shop_orders WHERE {DONE} GROUP BY 1 ORDER BY sum(total_amount) DESC, 1 LIMIT 10"""
    ),
    "q35_unsold_by_category": shop(
        """
SELECT c.name AS category_name, count(p.id) AS unsold_products
FROM shop_categories c LEFT JOIN shop_products p ON p.category_id = c.id
LEFT JOIN (SELECT DISTINCT product_id FROM shop_items) s ON s.product_id = p.id
WHERE s.product_id IS NULL GROUP BY c.id, c.name"""
    ),
    "q36_arpu": shop(
        f"""
SELECT {mean_money('sum(total_amount)', 'count(DISTINCT user_id)')} AS arpu
FROM shop_orders WHERE {DONE}"""
    ),
    "q36_buyers_by_quarter_approx": shop(
        f"""
SELECT date_trunc('quarter', created_at)::TIMESTAMP AS quarter, count(DISTINCT user_id) AS users, true AS within_bound
FROM shop_orders WHERE {DONE} GROUP BY 1"""
    ),
    "q37_orders_by_weekday": shop(
        f"""
SELECT dayname(created_at) AS weekday, count(*) AS order_count,
       {money('sum(total_amount)')} AS revenue
FROM shop_orders WHERE {DONE} GROUP BY 1"""
    ),
    "q38_repeat_purchase_rate": shop(
        f"""
SELECT {pct('count(*) FILTER (n > 1)', 'count(*)')} AS repeat_rate_pct
FROM (SELECT user_id, product_id, count(*) AS n FROM shop_sales WHERE {DONE} GROUP BY ALL)"""
    ),
    "q39_payments_by_status": shop(
        f"""
SELECT status, count(*) AS payment_count, {money('sum(amount)')} AS total_volume
FROM shop_payments GROUP BY status"""
    ),
    "q40_top15_returners": _ranked_users(
        "o.status = 'returned'",
        "user_id, email, n AS returned_orders, spent AS return_cost",
        "n DESC, spent DESC",
        15,
    ),
    "q41_abandoned_carts": shop(
        """
SELECT email, o.id AS order_id, total_amount, o.created_at
FROM shop_orders o JOIN shop_users u ON u.id = o.user_id
WHERE o.status = 'pending' ORDER BY o.created_at DESC, o.id LIMIT 50"""
    ),
    "q42_price_as_of_order": shop(
        """
SELECT s.order_id, s.product_id, s.created_at, h.price AS price_at_order
FROM shop_sales s JOIN shop_prices h
  ON h.product_id = s.product_id AND s.created_at >= h.valid_from
 AND s.created_at < coalesce(h.valid_to, TIMESTAMP '9999-12-31')"""
    ),
    "q43_top10_bulk_baskets": shop(
        f"""
SELECT order_id, email, CAST(sum(quantity) AS BIGINT) AS units,
       any_value(total_amount) AS total_amount
FROM shop_sales JOIN shop_users u ON u.id = user_id WHERE {DONE}
GROUP BY order_id, email ORDER BY sum(quantity) DESC, order_id LIMIT 10"""
    ),
    "q44_top15_cross_category_orders": shop(
        f"""
SELECT order_id, count(DISTINCT category_id) AS category_count,
       CAST(sum(quantity) AS BIGINT) AS units, any_value(total_amount) AS total_amount
FROM shop_sales JOIN shop_products p ON p.id = product_id WHERE {DONE}
GROUP BY order_id ORDER BY category_count DESC, any_value(total_amount) DESC, order_id LIMIT 15"""
    ),
    "q45_rfm_scores": shop("SELECT * FROM scored", PER_USER, _rfm("DESC")),
    "q46_top3_products_by_units": shop(
        """
SELECT category_name, product_name, units, CAST(place AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY category_id
                                   ORDER BY units DESC, product_id) AS place FROM product_sales)
WHERE place <= 3""",
        _product_sales("completed"),
    ),
    "q47_monthly_growth_inline": shop(GROWTH, MONTHLY),
    "q48_rolling7_named": shop(
        """
SELECT p.name AS product_name, day, units, rolling_avg
FROM rolling JOIN shop_products p ON p.id = product_id""",
        DAILY_UNITS,
    ),
    "q49_streaks_row_semantics": _row_streaks(DONE_ORDERS),
    "q49_streaks_row_semantics_events": _row_streaks(PURCHASES),
    "q50_median_order_gap": _median_gap("true"),
    "q50_median_first_gap": _median_gap("a.n = 1"),
}
