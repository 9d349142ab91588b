"""The shop views as DuckDB SQL, for the oracle side of each query.

Same definitions as ``sources.views`` (FIXTURES.md section 3); every
oracle query is ``WITH <these views> SELECT ...`` over the driver tables.
"""

from __future__ import annotations

def padded_sql(key: str, width: int) -> str:
    """Decimal text filled with zeros to ``width``; longer keys keep all their digits."""
    text = f"CAST({key} AS VARCHAR)"
    return f"lpad({text}, CAST(greatest({width}, length({text})) AS INTEGER), '0')"


EPOCH_SQL = "TIMESTAMP '2024-01-01 00:00:00'"

VIEWS = {
    "shop_categories": f"""
        SELECT CAST(row_number() OVER (ORDER BY p_type) AS BIGINT) AS category_id,
               p_type AS category_name, 'Parts of type ' || lower(p_type) AS description,
               {EPOCH_SQL} AS created_at, {EPOCH_SQL} AS updated_at
        FROM (SELECT DISTINCT p_type FROM part) t""",
    "shop_products": f"""
        SELECT p.p_partkey AS product_id, c.category_id,
               upper(substr(p.p_type, 1, 4)) || '-' || {padded_sql('p.p_partkey', 6)} AS sku,
               p.p_name AS product_name, p.p_brand AS description,
               CAST(p.p_retailprice AS DECIMAL(12,2)) AS price,
               CAST((p.p_partkey * 37) % 101 AS INTEGER) AS stock_qty,
               CAST(p.p_size AS INTEGER) AS reorder_level,
               p.p_partkey % 20 <> 0 AS is_active,
               {EPOCH_SQL} AS created_at, {EPOCH_SQL} AS updated_at
        FROM part p JOIN shop_categories c ON c.category_name = p.p_type""",
    "shop_users": f"""
        SELECT c_custkey AS user_id, c_name AS full_name, lower(c_name) || '@example.com' AS email,
               'seed-hash' AS password_hash, CAST(NULL AS VARCHAR) AS phone,
               c_acctbal > 0 AS is_active, c_custkey = 0 AS is_admin,
               {EPOCH_SQL} AS created_at, {EPOCH_SQL} AS updated_at
        FROM customer""",
    "shop_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS user_id,
               CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'PLACED' WHEN 'P' THEN 'CANCELLED' END
                   AS order_status,
               CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount,
               o_orderdate AS placed_at,
               CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL 1 DAY END AS cancelled_at,
               CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 1 DAY END AS completed_at,
               o_orderdate AS created_at,
               CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS updated_at
        FROM orders""",
    "shop_order_items": f"""
        SELECT l.l_orderkey * 1048576 + row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_partkey)
                   AS order_item_id, l.l_orderkey AS order_id,
               l.l_partkey AS product_id, l.quantity,
               CAST(p.p_retailprice AS DECIMAL(12,2)) AS unit_price,
               CAST(l.quantity * CAST(p.p_retailprice AS DECIMAL(12,2)) AS DECIMAL(12,2)) AS line_total,
               {EPOCH_SQL} AS created_at
        FROM (SELECT l_orderkey, l_partkey, CAST(sum(l_quantity) AS INTEGER) AS quantity
              FROM lineitem GROUP BY l_orderkey, l_partkey) l
        JOIN part p ON p.p_partkey = l.l_partkey""",
    "shop_carts": f"""
        SELECT c_custkey AS cart_id, c_custkey AS user_id, {EPOCH_SQL} AS created_at, {EPOCH_SQL} AS updated_at
        FROM customer""",
    "shop_cart_items": f"""
        SELECT user_id * 2147483648 + k AS cart_item_id, user_id AS cart_id, k AS product_id,
               CAST(sum(event_id % 5 + 1) AS INTEGER) AS quantity,
               {EPOCH_SQL} AS created_at, {EPOCH_SQL} AS updated_at
        FROM (SELECT user_id, event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
              FROM events WHERE event_type = 'click') e
        GROUP BY user_id, k""",
    "shop_cart_commands": """
        SELECT event_id AS seq, user_id,
               CASE event_type WHEN 'click' THEN 'ADD' WHEN 'view' THEN 'SET' WHEN 'error' THEN 'REMOVE'
                               WHEN 'purchase' THEN 'CLEAR' END AS kind,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id,
               CAST(event_id % 5 + 1 AS INTEGER) AS quantity
        FROM events WHERE event_type IN ('click', 'view', 'error', 'purchase')""",
    "shop_wishlist_toggles": """
        SELECT event_id AS seq, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id
        FROM events WHERE event_type = 'view'""",
    "shop_session_events": """
        SELECT seq, session_id, user_id, kind, "at" FROM (
            SELECT event_id AS seq, user_id,
                   CASE event_type WHEN 'signup' THEN 'LOGIN' WHEN 'click' THEN 'USE' ELSE 'LOGOUT' END AS kind,
                   ts AS "at",
                   max(CASE WHEN event_type = 'signup' THEN event_id END)
                       OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                       AS session_id
            FROM events WHERE event_type IN ('signup', 'click', 'error')) s
        WHERE session_id IS NOT NULL""",
    "shop_order_status_log": """
        SELECT order_id * 4 + 1 AS seq, order_id, 'PLACED' AS order_status, placed_at AS "at" FROM shop_orders
        UNION ALL
        SELECT order_id * 4 + 2, order_id, 'PLACED', placed_at + INTERVAL 1 HOUR FROM shop_orders
        UNION ALL
        SELECT order_id * 4 + 3, order_id, order_status, coalesce(completed_at, cancelled_at)
        FROM shop_orders WHERE order_status <> 'PLACED'""",
    "shop_stock_movements": """
        SELECT oi.order_item_id * 2 AS movement_id, oi.product_id, o.placed_at AS "at", -oi.quantity AS delta,
               'ORDER_PLACED_STOCK_REDUCTION' AS reason, oi.order_id AS related_order_id
        FROM shop_order_items oi JOIN shop_orders o ON o.order_id = oi.order_id
        UNION ALL
        SELECT oi.order_item_id * 2 + 1, oi.product_id, o.cancelled_at, oi.quantity,
               'ORDER_CANCELLED_RESTOCK', oi.order_id
        FROM shop_order_items oi JOIN shop_orders o ON o.order_id = oi.order_id
        WHERE o.order_status = 'CANCELLED'""",
    "shop_opening_stock": """
        SELECT product_id, stock_qty * 10 AS stock FROM shop_products""",
}


def with_views(select_sql: str) -> str:
    """Prefix ``select_sql`` with every shop view as a CTE (unused ones cost nothing)."""
    ctes = ",\n".join(f"{name} AS ({body}\n)" for name, body in VIEWS.items())
    return f"WITH {ctes}\n{select_sql}"
