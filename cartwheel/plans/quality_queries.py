"""Declared constraints over staged loads that break them, with an oracle written out rule by rule.

The staged tables are stand-ins made from the driver's tables: sign-ups,
cart lines, orders, status history and sessions as an import finds them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as H
from ..sources.views import epoch, json_k
from .registry import register


def staged(v) -> dict:
    """Staged rows in the declared schemas, beside the stored parents."""
    c, o, e = v.raw("customer"), v.raw("orders"), v.raw("events")
    k = F.col("c_custkey")
    users = c.select(
        (k - F.when(k % 50 == 1, 1).otherwise(0)).alias("user_id"), F.when(k % 11 != 0, F.col("c_name")).alias("full_name"),
        F.when(k % 7 == 0, F.col("c_name")).otherwise(F.concat("c_name", F.lit("@example.com"))).alias("email"),
        F.lit("staged").alias("password_hash"), F.when(k % 5 == 0, F.concat("c_name", F.lit("-"), "c_mktsegment")).alias("phone"),
        F.lit(True).alias("is_active"), F.lit(False).alias("is_admin"), epoch().alias("created_at"), epoch().alias("updated_at"))
    items = e.filter("event_type = 'click'").select(
        F.col("event_id").alias("cart_item_id"), F.col("user_id").alias("cart_id"), (json_k() * 30).alias("product_id"),
        (F.col("event_id") % 5).cast("int").alias("quantity"), F.col("ts").alias("created_at"),
        F.when(F.col("event_id") % 13 != 0, F.col("ts")).alias("updated_at"))
    status = F.when(F.col("o_orderpriority") == "5-LOW", "LOST").when(F.col("o_orderstatus") == "P", "CANCELLED") \
        .when(F.col("o_orderstatus") == "F", "COMPLETED").otherwise("PLACED")
    key = F.col("o_orderkey")
    orders = o.select(
        key.alias("order_id"), F.col("o_custkey").alias("user_id"), status.alias("order_status"),
        F.when(key % 17 == 0, -F.col("o_totalprice")).otherwise(F.col("o_totalprice")).cast("decimal(12,2)").alias("total_amount"),
        F.col("o_orderdate").alias("placed_at"), F.when((F.col("o_orderstatus") == "P") & (key % 3 != 0), F.col("o_orderdate")).alias("cancelled_at"),
        F.when((F.col("o_orderstatus") == "F") & (key % 4 != 0), F.col("o_orderdate")).alias("completed_at"),
        F.col("o_orderdate").alias("created_at"), F.col("o_orderdate").alias("updated_at"))
    history = o.select(
        key.alias("audit_id"), (key * 2).alias("order_id"), F.lit(None).cast("string").alias("old_status"),
        F.when(key % 19 != 0, F.concat("o_orderpriority", F.lit(" of this"))).alias("new_status"), F.lit("STAGED").alias("note"),
        F.col("o_orderdate").alias("changed_at"))
    sessions = e.filter("event_type = 'signup'").select(
        F.col("event_id").alias("session_id"), (F.col("user_id") * 40).alias("user_id"), F.concat(F.lit("t"), F.col("event_id") % 97).alias("token_hash"),
        F.col("ts").alias("expires_at"), F.lit(None).cast("timestamp_ntz").alias("revoked_at"), F.lit(None).cast("timestamp_ntz").alias("last_used_at"),
        F.when(F.col("event_id") % 6 != 0, F.col("ts")).alias("created_at"))
    return {"users": users, "carts": v.carts, "products": v.products, "cart_items": items, "orders": orders, "order_audit": history, "user_sessions": sessions}


def _staged_violations(v):
    """Violations of the staged tables only; carts and products are the stored parents."""
    own = ["users", "cart_items", "orders", "order_audit", "user_sessions"]
    return H.check_constraints(staged(v)).filter(F.col("table_name").isin(own))


register("staged_violations", """
    , su AS (SELECT c_custkey - CASE WHEN c_custkey % 50 = 1 THEN 1 ELSE 0 END AS user_id,
                    CASE WHEN c_custkey % 11 <> 0 THEN c_name END AS full_name,
                    CASE WHEN c_custkey % 7 = 0 THEN c_name ELSE c_name || '@example.com' END AS email,
                    CASE WHEN c_custkey % 5 = 0 THEN c_name || '-' || c_mktsegment END AS phone FROM customer),
      si AS (SELECT event_id, user_id AS cart_id, 30 * CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id,
                    event_id % 5 AS quantity, CASE WHEN event_id % 13 <> 0 THEN ts END AS updated_at
             FROM events WHERE event_type = 'click'),
      so AS (SELECT o_orderkey AS order_id, o_custkey AS user_id,
                    CASE WHEN o_orderpriority = '5-LOW' THEN 'LOST' WHEN o_orderstatus = 'P' THEN 'CANCELLED'
                         WHEN o_orderstatus = 'F' THEN 'COMPLETED' ELSE 'PLACED' END AS st,
                    CASE WHEN o_orderkey % 17 = 0 THEN -o_totalprice ELSE o_totalprice END AS total,
                    o_orderstatus = 'P' AND o_orderkey % 3 <> 0 AS has_cancelled, o_orderstatus = 'F' AND o_orderkey % 4 <> 0 AS has_completed
             FROM orders),
      sh AS (SELECT o_orderkey AS audit_id, o_orderkey * 2 AS order_id,
                    CASE WHEN o_orderkey % 19 <> 0 THEN o_orderpriority || ' of this' END AS new_status FROM orders),
      ss AS (SELECT event_id AS session_id, user_id * 40 AS user_id, 't' || CAST(event_id % 97 AS VARCHAR) AS token_hash,
                    CASE WHEN event_id % 6 <> 0 THEN ts END AS created_at FROM events WHERE event_type = 'signup'),
      told AS (
        SELECT 'users' AS table_name, 'NOT_NULL' AS rule, CAST(user_id AS VARCHAR) AS key, 'full_name' AS detail FROM su WHERE full_name IS NULL
        UNION ALL SELECT 'users', 'CHECK', CAST(user_id AS VARCHAR), 'users_email_format_chk' FROM su WHERE email NOT LIKE '_%@%'
        UNION ALL SELECT 'users', 'VARCHAR', CAST(user_id AS VARCHAR), 'phone > 20' FROM su WHERE length(phone) > 20
        UNION ALL SELECT 'users', 'PRIMARY_KEY', CAST(user_id AS VARCHAR), 'user_id rows=' || CAST(count(*) AS VARCHAR)
                  FROM su GROUP BY user_id HAVING count(*) > 1
        UNION ALL SELECT 'users', 'UNIQUE', email, 'email rows=' || CAST(count(*) AS VARCHAR) FROM su GROUP BY email HAVING count(*) > 1
        UNION ALL SELECT 'cart_items', 'NOT_NULL', CAST(event_id AS VARCHAR), 'updated_at' FROM si WHERE updated_at IS NULL
        UNION ALL SELECT 'cart_items', 'NOT_NULL', CAST(event_id AS VARCHAR), 'product_id' FROM si WHERE product_id IS NULL
        UNION ALL SELECT 'cart_items', 'CHECK', CAST(event_id AS VARCHAR), 'cart_items_quantity_chk' FROM si WHERE quantity <= 0
        UNION ALL SELECT 'cart_items', 'UNIQUE', CAST(cart_id AS VARCHAR) || ',' || CAST(product_id AS VARCHAR),
                         'cart_id,product_id rows=' || CAST(count(*) AS VARCHAR)
                  FROM si WHERE product_id IS NOT NULL GROUP BY cart_id, product_id HAVING count(*) > 1
        UNION ALL SELECT 'cart_items', 'FOREIGN_KEY', CAST(event_id AS VARCHAR), 'cart_id=' || CAST(cart_id AS VARCHAR) || ' not in carts'
                  FROM si WHERE cart_id NOT IN (SELECT c_custkey FROM customer)
        UNION ALL SELECT 'cart_items', 'FOREIGN_KEY', CAST(event_id AS VARCHAR), 'product_id=' || CAST(product_id AS VARCHAR) || ' not in products'
                  FROM si WHERE product_id NOT IN (SELECT p_partkey FROM part)
        UNION ALL SELECT 'orders', 'CHECK', CAST(order_id AS VARCHAR), 'orders_status_chk' FROM so WHERE st = 'LOST'
        UNION ALL SELECT 'orders', 'CHECK', CAST(order_id AS VARCHAR), 'orders_total_nonnegative_chk' FROM so WHERE total < 0
        UNION ALL SELECT 'orders', 'CHECK', CAST(order_id AS VARCHAR), 'orders_cancelled_time_chk' FROM so WHERE st = 'CANCELLED' AND NOT has_cancelled
        UNION ALL SELECT 'orders', 'CHECK', CAST(order_id AS VARCHAR), 'orders_completed_time_chk' FROM so WHERE st = 'COMPLETED' AND NOT has_completed
        UNION ALL SELECT 'orders', 'FOREIGN_KEY', CAST(order_id AS VARCHAR), 'user_id=' || CAST(user_id AS VARCHAR) || ' not in users'
                  FROM so WHERE user_id NOT IN (SELECT user_id FROM su)
        UNION ALL SELECT 'order_audit', 'NOT_NULL', CAST(audit_id AS VARCHAR), 'new_status' FROM sh WHERE new_status IS NULL
        UNION ALL SELECT 'order_audit', 'VARCHAR', CAST(audit_id AS VARCHAR), 'new_status > 20' FROM sh WHERE length(new_status) > 20
        UNION ALL SELECT 'order_audit', 'FOREIGN_KEY', CAST(audit_id AS VARCHAR), 'order_id=' || CAST(order_id AS VARCHAR) || ' not in orders'
                  FROM sh WHERE order_id NOT IN (SELECT order_id FROM so)
        UNION ALL SELECT 'user_sessions', 'NOT_NULL', CAST(session_id AS VARCHAR), 'created_at' FROM ss WHERE created_at IS NULL
        UNION ALL SELECT 'user_sessions', 'UNIQUE', token_hash, 'token_hash rows=' || CAST(count(*) AS VARCHAR) FROM ss GROUP BY token_hash HAVING count(*) > 1
        UNION ALL SELECT 'user_sessions', 'FOREIGN_KEY', CAST(session_id AS VARCHAR), 'user_id=' || CAST(user_id AS VARCHAR) || ' not in users'
                  FROM ss WHERE user_id NOT IN (SELECT user_id FROM su))
    SELECT * FROM told""")(_staged_violations)
