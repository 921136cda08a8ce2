"""Oracle statements of the generated tables and the constraint audits."""

from __future__ import annotations

from oracle.shop import money, shop


def draw(salt: str, key: str = "id", nth: int = 0) -> str:
    """The nth number in [0, 1) for a salt and a key."""
    digest = f"md5('{salt}:' || {key})"
    return f"(('0x' || substr({digest}, {1 + 8 * nth}, 8))::BIGINT / 4294967296::DOUBLE)"


def whole(u: str, low: int, high: int) -> str:
    return f"(CAST(floor({u} * {high - low + 1}::DOUBLE) AS BIGINT) + {low})"


def price(product: str) -> str:
    cents = whole(draw("price", product), 1000, 500000)
    return f"CAST(CAST({cents} AS DECIMAL(10,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2))"


def seconds(u: str, n: int) -> str:
    return f"to_seconds(CAST(floor({u} * {n}::DOUBLE) AS BIGINT))"


YEAR = 365 * 86400

USERS = f"""gen_users AS (
  SELECT id,
         CASE WHEN {draw('missing')} < 0.05 THEN 'user_' || id || '@missing.com'
              ELSE 'user' || id || '@example.com' END AS email,
         sha256('password' || id) AS password_hash,
         TIMESTAMP '2024-01-01 00:00:00' + {seconds(draw('signup'), 730 * 86400)} AS created_at
  FROM (SELECT c_custkey + 1 AS id FROM customer))"""

PRODUCTS = f"""gen_products AS (
  SELECT id, CAST({whole(draw('category'), 1, 10)} AS INTEGER) AS category_id,
         'product-' || id AS name, {price('id')} AS price,
         CAST({whole(draw('stock'), 10, 1000)} AS INTEGER) AS stock
  FROM (SELECT p_partkey + 1 AS id FROM part))"""

# One digest yields four picks.
PICK = "'0x' || substr(md5('pick' || (n // 4) || ':' || o.id), CAST(1 + 8 * (n % 4) AS INTEGER), 8)"

ORDERS = f"""gen_keys AS (SELECT o_orderkey + 1 AS id FROM orders),
gen_heads AS (
  SELECT id,
         CAST(floor({draw('order')} * (SELECT count(*) FROM customer)::DOUBLE) AS BIGINT) + 1
           AS user_id,
         CASE WHEN {draw('order', nth=1)} < 0.02 THEN 'returned'
              WHEN {draw('order', nth=1)} < 0.07::DOUBLE THEN 'cancelled'
              ELSE 'completed' END AS status,
         CASE WHEN {draw('when')} < 0.4
              THEN TIMESTAMP '2025-06-01 00:00:00' + {seconds(draw('when', nth=1), 91 * 86400)}
              ELSE TIMESTAMP '2024-12-31 00:00:00' + {seconds(draw('when', nth=1), YEAR)}
              END AS created_at,
         {whole(draw('order', nth=2), 1, 5)} AS line_count
  FROM gen_keys),
gen_draws AS (
  SELECT o.id, n,
         CASE WHEN n >= 80 THEN n - 80
              ELSE least(CAST(floor((1 - sqrt(u)) * (1 - sqrt(u)) * parts) AS BIGINT), parts - 1)
              END AS place
  FROM (SELECT o.id, n, parts, ({PICK})::BIGINT / 4294967296::DOUBLE AS u
        FROM gen_keys o, range(85) r(n), (SELECT count(*) AS parts FROM part)) o),
gen_chosen AS (
  SELECT id, place + 1 AS product_id, row_number() OVER (PARTITION BY id ORDER BY min(n)) - 1 AS nth
  FROM gen_draws GROUP BY id, place),
gen_items AS (
  SELECT h.id * 5 + nth AS id, h.id AS order_id, product_id,
         CAST({whole("(('0x' || substr(md5('quantity' || nth || ':' || h.id), 1, 8))::BIGINT / 4294967296::DOUBLE)", 1, 3)}
              AS INTEGER) AS quantity,
         {price('product_id')} AS unit_price, user_id, status
  FROM gen_heads h JOIN gen_chosen c ON c.id = h.id AND nth < line_count),
gen_orders AS (
  SELECT h.id, h.user_id, CAST(NULL AS BIGINT) AS coupon_id,
         CAST(t.total AS DECIMAL(10,2)) AS total_amount, h.status, h.created_at
  FROM gen_heads h
  JOIN (SELECT order_id, sum(quantity * unit_price) AS total FROM gen_items GROUP BY 1) t
    ON t.order_id = h.id)"""

REVIEWS = f"""gen_reviews AS (
  SELECT id, user_id, product_id, CAST({whole(draw('rating'), 1, 5)} AS INTEGER) AS rating,
         'review ' || id AS comment
  FROM gen_items WHERE status = 'completed' AND {draw('reviewed', 'order_id')} < 0.1
  QUALIFY row_number() OVER (PARTITION BY user_id, product_id ORDER BY id) = 1)"""

INVENTORY = f"""gen_inventory AS (
  SELECT id, id AS product_id, CAST({whole(draw('movement'), 100, 1000)} AS INTEGER)
           AS quantity_changed,
         'Initial Stock Load' AS reason, TIMESTAMP '2025-12-31 00:00:00' AS created_at
  FROM (SELECT p_partkey + 1 AS id FROM part))"""

CATEGORY_LIST = """
(1, 'Elektronik'), (2, 'Giyim'), (3, 'Ev ve Yaşam'), (4, 'Kitap'), (5, 'Kozmetik'), (6, 'Spor'),
(7, 'Oyuncak'), (8, 'Otomotiv'), (9, 'Gıda'), (10, 'Pet Shop')"""

LINE_TOTALS = f"""line_totals AS (
  SELECT o.id, {money('coalesce(sum(quantity * unit_price), 0)')} AS line_total
  FROM shop_orders o LEFT JOIN shop_items i ON i.order_id = o.id GROUP BY o.id)"""


def _gen(query: str, *ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + query.strip()


# The star as the loads make it.
STAR_TABLES = """star_dim_date AS (
  SELECT DISTINCT CAST(strftime(created_at, '%Y%m%d') AS INTEGER) AS date_id, created_at::DATE AS full_date,
         dayname(created_at) AS day_name, monthname(created_at) AS month_name
  FROM shop_orders),
star_dim_product AS (
  SELECT row_number() OVER (ORDER BY product_id) AS product_sk, product_id, category_name, product_name
  FROM shop_catalogue),
star_dim_customer AS (
  SELECT row_number() OVER (ORDER BY id) AS customer_sk, id AS user_id, split_part(email, '@', 1) AS full_name,
         email, 'Unknown' AS gender, 'Unknown' AS city, TIMESTAMP '1900-01-01 00:00:00' AS valid_from, true AS is_current
  FROM shop_users),
star_fct_orders AS (
  SELECT o.id AS order_id, customer_sk, CAST(strftime(o.created_at, '%Y%m%d') AS INTEGER) AS date_id, status
  FROM shop_orders o JOIN star_dim_customer USING (user_id)),
star_fct_order_items AS (
  SELECT i.id AS order_item_id, i.order_id, product_sk,
         CAST(strftime(o.created_at, '%Y%m%d') AS INTEGER) AS date_id
  FROM shop_items i JOIN shop_orders o ON o.id = i.order_id JOIN star_dim_product USING (product_id))"""


# The columns of the star's tables as they are declared.
STAR_COLUMNS = {
    "dim_date": "date_id int, full_date date, day_of_week int, day_name string, month int, month_name string, "
    "quarter int, year int, is_weekend boolean",
    "dim_product": "product_sk bigint, product_id bigint, category_name string, product_name string, "
    "current_price decimal(10,2)",
    "dim_customer": "customer_sk bigint, user_id bigint, full_name string, email string, gender string, city string, "
    "valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean",
    "fct_orders": "order_id bigint, customer_sk bigint, date_id int, status string, total_amount decimal(10,2), "
    "shipping_cost decimal(10,2)",
    "fct_order_items": "order_item_id bigint, order_id bigint, product_sk bigint, date_id int, quantity int, "
    "unit_price decimal(10,2), line_total decimal(10,2)",
}


def _audit() -> str:
    """Counts per rule, spelled out table by table."""

    def row(table: str, source: str, rule: str, subject: str, bad: str) -> str:
        return (
            f"SELECT '{table}' AS table_name, '{rule}' AS rule, '{subject}' AS subject, "
            f"count(*) FILTER ({bad}) AS violations FROM {source}"
        )

    def repeated(table: str, source: str, key: str) -> str:
        columns = key.replace("+", ", ")
        filled = " AND ".join(f"{c} IS NOT NULL" for c in key.split("+"))
        return (
            f"SELECT '{table}', 'unique', '{key}', count(*) FROM (SELECT {columns} FROM {source} "
            f"WHERE {filled} GROUP BY {columns} HAVING count(*) > 1)"
        )

    def orphans(table: str, source: str, column: str, parent: str, key: str = "id") -> str:
        return (
            f"SELECT '{table}', 'foreign_key', '{column}', count(*) FROM {source} c "
            f"WHERE {column} IS NOT NULL "
            f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{column})"
        )

    def text(table: str, source: str, column: str, limit: int) -> str:
        return row(table, source, "length", column, f"length({column}) > {limit}")

    filled = {
        "users": "id email password_hash",
        "categories": "id name",
        "coupons": "id code valid_until",
        "products": "id category_id name price",
        "orders": "id user_id total_amount status",
        "order_items": "id order_id product_id quantity unit_price",
        "payments": "id order_id amount status",
        "shipments": "id order_id status",
        "reviews": "id user_id product_id rating",
        "inventory_movements": "id product_id quantity_changed reason",
    }
    source = {name: f"shop_{name}" for name in filled}
    source |= {
        "order_items": "shop_items",
        "reviews": "gen_reviews",
        "inventory_movements": "gen_inventory",
    }
    parts = [
        row(t, source[t], "not_null", c, f"{c} IS NULL") for t, cs in filled.items() for c in cs.split()
    ]
    parts += [repeated(t, source[t], "id") for t in filled]
    parts += [
        repeated("users", "shop_users", "email"),
        repeated("categories", "shop_categories", "name"),
        repeated("coupons", "shop_coupons", "code"),
        repeated("payments", "shop_payments", "order_id"),
        repeated("shipments", "shop_shipments", "order_id"),
        repeated("shipments", "shop_shipments", "tracking_number"),
        repeated("reviews", "gen_reviews", "user_id+product_id"),
        orphans("products", "shop_products", "category_id", "shop_categories"),
        orphans("orders", "shop_orders", "user_id", "shop_users"),
        orphans("orders", "shop_orders", "coupon_id", "shop_coupons"),
        orphans("order_items", "shop_items", "order_id", "shop_orders"),
        orphans("order_items", "shop_items", "product_id", "shop_products"),
        orphans("payments", "shop_payments", "order_id", "shop_orders"),
        orphans("shipments", "shop_shipments", "order_id", "shop_orders"),
        orphans("reviews", "gen_reviews", "user_id", "gen_users"),
        orphans("reviews", "gen_reviews", "product_id", "gen_products"),
        orphans("inventory_movements", "gen_inventory", "product_id", "gen_products"),
        row("coupons", "shop_coupons", "check", "discount_range", "discount_pct NOT BETWEEN 1 AND 100"),
        row("products", "shop_products", "check", "price_positive", "price <= 0"),
        row("products", "shop_products", "check", "stock_not_negative", "stock < 0"),
        row("orders", "shop_orders", "check", "total_not_negative", "total_amount < 0"),
        row("order_items", "shop_items", "check", "quantity_positive", "quantity <= 0"),
        row("order_items", "shop_items", "check", "unit_price_positive", "unit_price <= 0"),
        row("payments", "shop_payments", "check", "amount_positive", "amount <= 0"),
        row("reviews", "gen_reviews", "check", "rating_range", "rating NOT BETWEEN 1 AND 5"),
        text("users", "shop_users", "email", 255),
        text("users", "shop_users", "password_hash", 255),
        text("categories", "shop_categories", "name", 100),
        text("coupons", "shop_coupons", "code", 50),
        text("products", "shop_products", "name", 255),
        text("orders", "shop_orders", "status", 50),
        text("payments", "shop_payments", "status", 50),
        text("shipments", "shop_shipments", "tracking_number", 100),
        text("shipments", "shop_shipments", "status", 50),
        text("inventory_movements", "gen_inventory", "reason", 255),
    ]
    star = {
        "dim_date": "date_id full_date",
        "dim_product": "product_sk product_id",
        "dim_customer": "customer_sk user_id valid_from is_current",
        "fct_orders": "order_id",
        "fct_order_items": "order_item_id",
    }
    parts += [
        row(t, f"star_{t}", "not_null", c, f"{c} IS NULL") for t, cs in star.items() for c in cs.split()
    ]
    parts += [repeated(t, f"star_{t}", cs.split()[0]) for t, cs in star.items()]
    parts += [
        orphans("fct_orders", "star_fct_orders", "customer_sk", "star_dim_customer", "customer_sk"),
        orphans("fct_orders", "star_fct_orders", "date_id", "star_dim_date", "date_id"),
        orphans("fct_order_items", "star_fct_order_items", "order_id", "star_fct_orders", "order_id"),
        orphans("fct_order_items", "star_fct_order_items", "product_sk", "star_dim_product", "product_sk"),
        orphans("fct_order_items", "star_fct_order_items", "date_id", "star_dim_date", "date_id"),
        text("dim_date", "star_dim_date", "day_name", 10),
        text("dim_date", "star_dim_date", "month_name", 10),
        text("dim_product", "star_dim_product", "category_name", 100),
        text("dim_product", "star_dim_product", "product_name", 255),
        text("dim_customer", "star_dim_customer", "full_name", 255),
        text("dim_customer", "star_dim_customer", "email", 255),
        text("dim_customer", "star_dim_customer", "gender", 10),
        text("dim_customer", "star_dim_customer", "city", 100),
        text("fct_orders", "star_fct_orders", "status", 50),
    ]
    return shop("\nUNION ALL ".join(parts), USERS, PRODUCTS, ORDERS, REVIEWS, INVENTORY, STAR_TABLES)


SQL: dict[str, str] = {
    "g1_generate_users": _gen("SELECT * FROM gen_users", USERS),
    "g1_generate_products": _gen("SELECT * FROM gen_products", PRODUCTS),
    "g1_generate_coupons": _gen(
        f"""
SELECT CAST(id AS INTEGER) AS id, 'DISCOUNT-' || format('{{:04d}}', id) AS code,
       CAST({whole(draw('discount'), 5, 50)} AS INTEGER) AS discount_pct,
       TIMESTAMP '2025-12-31 00:00:00' + {seconds(draw('expiry'), YEAR)} AS valid_until
FROM keys""",
        "keys AS (SELECT s_suppkey + 1 AS id FROM supplier)",
    ),
    "g1_generate_categories": _gen(
        f"""
SELECT category_id, c.name, count(*) AS product_count
FROM gen_products JOIN (VALUES {CATEGORY_LIST}) c(number, name) ON number = category_id
GROUP BY ALL""",
        PRODUCTS,
    ),
    "g2_generate_orders": _gen("SELECT * FROM gen_orders", ORDERS),
    "g3_generate_order_items": _gen(
        "SELECT id, order_id, product_id, quantity, unit_price FROM gen_items", ORDERS
    ),
    "g4_generate_payments": _gen(
        """
SELECT id, id AS order_id, total_amount AS amount,
       CASE status WHEN 'completed' THEN 'success' ELSE 'refunded' END AS status
FROM gen_orders WHERE status IN ('completed', 'returned')""",
        ORDERS,
    ),
    "g4_generate_shipments": _gen(
        f"""
SELECT id, id AS order_id, 'TR-' || format('{{:09d}}', id) AS tracking_number,
       CASE {whole(draw('shipment'), 0, 2)} WHEN 0 THEN 'shipped' ELSE 'delivered' END AS status
FROM gen_orders WHERE status = 'completed'""",
        ORDERS,
    ),
    "g4_generate_reviews": _gen("SELECT * FROM gen_reviews", ORDERS, REVIEWS),
    "g4_generate_inventory": _gen("SELECT * FROM gen_inventory", INVENTORY),
    "g5_reconcile_order_totals": shop(
        """
SELECT o.id, user_id, coupon_id, line_total AS total_amount, status, created_at
FROM shop_orders o JOIN line_totals t ON t.id = o.id""",
        LINE_TOTALS,
    ),
    "g5_total_mismatches": shop(
        """
SELECT o.id, total_amount, line_total FROM shop_orders o JOIN line_totals t ON t.id = o.id
WHERE total_amount <> line_total""",
        LINE_TOTALS,
    ),
    "c0_constraint_audit": _audit(),
    "c1_not_null": shop("SELECT * FROM shop_trips WHERE passenger_count IS NULL"),
    "c2_unique": """
SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
GROUP BY ALL HAVING count(*) > 1""",
    "c3_foreign_key": shop(
        """
SELECT order_id, count(*) AS row_count FROM shop_payments
WHERE order_id NOT IN (SELECT id FROM shop_shipments)
GROUP BY 1"""
    ),
    "c4_expression": shop("SELECT * FROM shop_trips WHERE NOT passenger_count <= 5"),
    "c5_length": "SELECT p_partkey, p_name FROM part WHERE length(p_name) > 9",
    "c6_apply_defaults": shop(
        "SELECT * REPLACE ('pending' AS status, TIMESTAMP '2025-12-31 00:00:00' AS created_at) FROM shop_orders"
    ),
    "s8_insert_ignore": shop(
        """
SELECT user_id, event_id, event_type FROM events
WHERE user_id NOT IN (SELECT user_id FROM shop_orders WHERE status = 'returned')
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1"""
    ),
    "s9_create_tables": shop(
        " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, '{columns}' AS columns, count(*) AS row_count FROM star_{name}"
            for name, columns in STAR_COLUMNS.items()
        ),
        STAR_TABLES,
    ),
}
