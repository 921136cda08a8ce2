"""The shop model once more, as SQL over the given tables."""

from __future__ import annotations

VIEWS = """
shop_users AS (
  SELECT c_custkey AS id,
         lower(replace(c_name, '#', '.'))
           || CASE WHEN c_custkey % 10 < 3 THEN '@example.com' ELSE '@example.org' END AS email,
         'x' AS password_hash,
         (DATE '1995-01-01' + CAST(c_custkey % 730 AS INTEGER))::TIMESTAMP AS created_at
  FROM customer
  UNION ALL
  SELECT s_suppkey + 1000000000,
         lower(replace(s_name, '#', '.'))
           || CASE WHEN s_suppkey % 10 < 3 THEN '@example.com' ELSE '@example.org' END,
         'x', (DATE '1995-01-01' + CAST(s_suppkey % 730 AS INTEGER))::TIMESTAMP
  FROM supplier),
shop_categories AS (
  SELECT CAST(row_number() OVER (ORDER BY p_type) AS INTEGER) AS id, p_type AS name
  FROM (SELECT DISTINCT p_type FROM part)
  UNION ALL SELECT 99, 'EMPTY'),
shop_coupons AS (
  SELECT n_nationkey AS id, n_name AS code,
         CAST(5 + 5 * (n_nationkey % 10) AS INTEGER) AS discount_pct,
         TIMESTAMP '2030-01-01 00:00:00' AS valid_until
  FROM nation),
shop_products AS (
  SELECT p_partkey AS id, c.id AS category_id, p_name AS name,
         CAST(p_retailprice AS DECIMAL(10,2)) AS price, CAST(p_size % 50 AS INTEGER) AS stock
  FROM (SELECT * FROM part
        UNION ALL SELECT * REPLACE (p_partkey + 1000000000 AS p_partkey) FROM part WHERE p_size >= 49)
  JOIN shop_categories c ON p_type = c.name),
shop_orders AS (
  SELECT o_orderkey AS id, o_custkey AS user_id,
         CASE WHEN o_orderkey % 4 = 0 THEN (o_orderkey // 4) % 20 END AS coupon_id,
         CAST(o_totalprice AS DECIMAL(10,2)) AS total_amount,
         CASE WHEN o_orderkey % 100 < 2 THEN 'returned'
              WHEN o_orderkey % 100 < 7 THEN 'cancelled'
              WHEN o_orderkey % 100 < 10 THEN 'pending'
              ELSE 'completed' END AS status,
         o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS created_at
  FROM orders),
shop_items AS (
  SELECT CAST(row_number() OVER (ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber,
                                          l_quantity, l_extendedprice, l_shipdate) AS BIGINT) AS id,
         l_orderkey AS order_id, l_partkey AS product_id,
         CAST(l_quantity AS INTEGER) AS quantity,
         CAST(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS BIGINT)
                   AS DECIMAL(10,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS unit_price
  FROM lineitem JOIN shop_orders o ON l_orderkey = o.id),
shop_sales AS (
  SELECT i.id AS item_id, i.order_id, i.product_id, i.quantity, i.unit_price,
         i.quantity * i.unit_price AS value,
         o.user_id, o.status, o.created_at, o.total_amount
  FROM shop_items i JOIN shop_orders o ON i.order_id = o.id),
shop_payments AS (
  SELECT id, id AS order_id, total_amount AS amount,
         CASE status WHEN 'completed' THEN 'success' ELSE 'refunded' END AS status
  FROM shop_orders WHERE status IN ('completed', 'returned')),
shop_shipments AS (
  SELECT id, id AS order_id, 'TR-' || id AS tracking_number,
         CASE WHEN id % 3 = 0 THEN 'shipped' ELSE 'delivered' END AS status
  FROM shop_orders WHERE status = 'completed' AND id % 10 <> 9),
shop_prices AS (
  SELECT id AS product_id, CAST(price * factor AS DECIMAL(10,2)) AS price, valid_from, valid_to
  FROM shop_products, (VALUES
    (1, CAST(0.8 AS DECIMAL(2,1)), TIMESTAMP '1995-01-01 00:00:00', TIMESTAMP '1997-01-01 00:00:00'),
    (2, CAST(0.9 AS DECIMAL(2,1)), TIMESTAMP '1997-01-01 00:00:00', TIMESTAMP '1999-07-01 00:00:00'),
    (3, CAST(1.0 AS DECIMAL(2,1)), TIMESTAMP '1999-07-01 00:00:00', NULL)
  ) v(number, factor, valid_from, valid_to)
  WHERE number <> 1 OR id % 7 <> 0),
shop_catalogue AS (
  SELECT p.id AS product_id, p.name AS product_name, c.id AS category_id, c.name AS category_name,
         p.price, p.stock
  FROM shop_products p JOIN shop_categories c ON p.category_id = c.id),
shop_trips AS (
  SELECT CASE l_linestatus WHEN 'F' THEN 1 ELSE 2 END AS VendorID,
         nullif(l_linenumber, 7) AS passenger_count, l_linenumber AS RatecodeID,
         l_returnflag AS payment_type,
         CAST(l_quantity AS DECIMAL(10,2)) AS trip_distance,
         CAST(l_discount AS DECIMAL(10,2)) AS tip_amount,
         CAST(l_tax AS DECIMAL(10,2)) AS tolls_amount,
         CAST(l_suppkey % 5 AS DECIMAL(10,2)) AS extra,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS fare_amount,
         CAST(l_extendedprice AS DECIMAL(12,2)) + CAST(l_tax AS DECIMAL(10,2)) AS total_amount
  FROM lineitem)
""".strip()


def shop(query: str, *ctes: str) -> str:
    """``query`` over the model, with further common table expressions."""
    return "WITH " + ",\n".join([VIEWS, *ctes]) + "\n" + query.strip()


def ratio(numerator: str, denominator: str, digits: int = 2) -> str:
    """Half-up quotient of two whole numbers."""
    n, d = f"({numerator})::HUGEINT", f"nullif(({denominator})::HUGEINT, 0)"
    units = f"(abs({n}) * {2 * 10**digits} + abs({d})) // (2 * abs({d}))"
    if digits == 0:
        return f"CAST(sign({n}) * sign({d}) * ({units}) AS DECIMAL(20,0))"
    step = f"CAST({10**-digits:.{digits}f} AS DECIMAL({digits + 1},{digits}))"
    return (
        f"CAST(CAST(sign({n}) * sign({d}) * ({units}) AS DECIMAL(24,0)) * {step} "
        f"AS DECIMAL(20,{digits}))"
    )


def mean_money(total: str, count: str, digits: int = 2) -> str:
    return ratio(f"({total}) * 100", f"({count}) * 100", digits)


def pct(part: str, whole: str) -> str:
    return ratio(f"({part}) * 100", whole)


def money(amount: str) -> str:
    return f"CAST({amount} AS DECIMAL(20,2))"
