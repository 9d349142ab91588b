"""H6 and A7 over the shop views: request rules and delete closures, with hand-written oracles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.deletion import delete_closure
from ..operators.requests import accepted, broken_rules
from ..sources.views import json_k
from .queries import _inv_audit, _sessions, SQL_INV_AUDIT, SQL_SESSIONS
from .registry import register

NEW_KEYS = 1_000_000_000


def requests(v) -> dict[str, tuple[DataFrame, str]]:
    """Requests of every kind from the raw tables, with texts and numbers inside and outside of their bounds."""
    p, c, e = v.raw("part"), v.raw("customer"), v.raw("events")
    k, u, i = F.col("p_partkey"), F.col("c_custkey"), F.col("event_id")
    product = p.select(
        k.alias("id"), F.when(k % 59 != 0, k % 7 - 1).alias("category_id"),
        F.when(k % 50 == 0, F.repeat("p_name", F.lit(10))).when(k % 61 != 0, F.expr("substring(p_type, 1, CAST(p_partkey % 9 AS INT))")).alias("sku"),
        F.when(k % 11 == 0, F.substring("p_name", 1, 1)).when(k % 13 == 0, F.repeat("p_name", F.lit(30))).when(k % 29 != 0, F.col("p_name")).alias("product_name"),
        F.when(k % 17 == 0, F.repeat("p_name", F.lit(400))).when(k % 3 == 0, F.col("p_brand")).alias("description"),
        F.when(k % 101 == 0, F.lit(float("nan"))).when(k % 103 != 0, F.col("p_retailprice") * (k % 10 - 1)).alias("price"),
        F.when(k % 67 != 0, F.col("p_size") - 5).alias("stock_qty"), F.when(k % 4 != 0, F.col("p_size") - 3).alias("reorder_level"))
    name = F.expr("substring(c_name, 1, CAST(c_custkey % 20 AS INT))")
    register_ = c.select(
        u.alias("id"), F.when(u % 23 == 0, F.repeat("c_name", F.lit(9))).when(u % 19 != 0, name).alias("name"),
        F.when(u % 31 == 0, F.repeat("c_name", F.lit(20))).when(u % 3 == 0, F.concat(name, F.lit("@x"))).when(u % 37 != 0, F.col("c_name")).alias("email"),
        F.when(u % 41 == 0, F.repeat("c_name", F.lit(15))).when(u % 43 != 0, F.expr("substring(c_name, 1, CAST(c_custkey % 11 AS INT))")).alias("password"),
        F.when(u % 5 == 0, F.concat("c_name", F.lit("-123"))).when(u % 5 == 1, F.col("c_name")).alias("phone"))
    login = register_.select("id", "email", "password")
    cart = e.select(i.alias("id"), F.when(i % 9 != 0, F.col("user_id")).alias("user_id"), F.when(i % 7 != 0, json_k()).alias("product_id"),
                    F.when(i % 13 != 0, (i % 5 - 1).cast("int")).alias("quantity"))
    bal = F.col("c_acctbal")
    search = c.select(u.alias("id"), F.when(u % 6 == 0, F.repeat("c_name", (u % 8 + 2).cast("int"))).when(u % 2 == 0, F.col("c_name")).alias("search"),
                      F.when(u % 4 != 1, bal).alias("min_price"), F.when(u % 4 != 2, bal + 500).alias("max_price"))
    return {"product": product, "register": register_, "login": login, "cart_add": cart.select("id", "product_id", "quantity"),
            "cart_add_for_user": cart, "cart_update": cart.select("id", "quantity"), "search": search}


SQL_REQUESTS = """
    , product AS (
        SELECT p_partkey AS id, CASE WHEN p_partkey % 59 <> 0 THEN p_partkey % 7 - 1 END AS category_id,
               CASE WHEN p_partkey % 50 = 0 THEN repeat(p_name, 10) WHEN p_partkey % 61 <> 0 THEN substr(p_type, 1, p_partkey % 9) END AS sku,
               CASE WHEN p_partkey % 11 = 0 THEN substr(p_name, 1, 1) WHEN p_partkey % 13 = 0 THEN repeat(p_name, 30)
                    WHEN p_partkey % 29 <> 0 THEN p_name END AS product_name,
               CASE WHEN p_partkey % 17 = 0 THEN repeat(p_name, 400) WHEN p_partkey % 3 = 0 THEN p_brand END AS description,
               CASE WHEN p_partkey % 101 = 0 THEN 'NaN'::DOUBLE WHEN p_partkey % 103 <> 0 THEN p_retailprice * (p_partkey % 10 - 1) END AS price,
               CASE WHEN p_partkey % 67 <> 0 THEN p_size - 5 END AS stock_qty, CASE WHEN p_partkey % 4 <> 0 THEN p_size - 3 END AS reorder_level
        FROM part),
      register AS (
        SELECT c_custkey AS id,
               CASE WHEN c_custkey % 23 = 0 THEN repeat(c_name, 9) WHEN c_custkey % 19 <> 0 THEN substr(c_name, 1, c_custkey % 20) END AS name,
               CASE WHEN c_custkey % 31 = 0 THEN repeat(c_name, 20) WHEN c_custkey % 3 = 0 THEN substr(c_name, 1, c_custkey % 20) || '@x'
                    WHEN c_custkey % 37 <> 0 THEN c_name END AS email,
               CASE WHEN c_custkey % 41 = 0 THEN repeat(c_name, 15) WHEN c_custkey % 43 <> 0 THEN substr(c_name, 1, c_custkey % 11) END AS password,
               CASE WHEN c_custkey % 5 = 0 THEN c_name || '-123' WHEN c_custkey % 5 = 1 THEN c_name END AS phone
        FROM customer),
      cart AS (
        SELECT event_id AS id, CASE WHEN event_id % 9 <> 0 THEN user_id END AS user_id,
               CASE WHEN event_id % 7 <> 0 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS product_id,
               CASE WHEN event_id % 13 <> 0 THEN event_id % 5 - 1 END AS quantity
        FROM events),
      search AS (
        SELECT c_custkey AS id, CASE WHEN c_custkey % 6 = 0 THEN repeat(c_name, c_custkey % 8 + 2) WHEN c_custkey % 2 = 0 THEN c_name END AS search,
               CASE WHEN c_custkey % 4 <> 1 THEN c_acctbal END AS min_price, CASE WHEN c_custkey % 4 <> 2 THEN c_acctbal + 500 END AS max_price
        FROM customer),
      bad_register AS (
        SELECT id, [CASE WHEN name IS NULL THEN 1 END, CASE WHEN length(name) < 2 THEN 2 END, CASE WHEN length(name) > 120 THEN 3 END,
                    CASE WHEN email IS NULL THEN 4 END, CASE WHEN length(email) < 6 THEN 5 END, CASE WHEN length(email) > 255 THEN 6 END,
                    CASE WHEN password IS NULL THEN 7 END, CASE WHEN length(password) < 6 THEN 8 END, CASE WHEN length(password) > 200 THEN 9 END,
                    CASE WHEN length(phone) > 20 THEN 10 END] AS places, email FROM register),
      told_register AS (
        SELECT id, unnest(CASE WHEN len(list_filter(places, lambda x: x IS NOT NULL)) > 0 THEN list_filter(places, lambda x: x IS NOT NULL)
                               WHEN strpos(email, '@') = 0 THEN [11] ELSE [] END) AS place FROM bad_register),
      register_rules(place, field, rule, message) AS (VALUES
        (1, 'name', 'required', 'name is required'), (2, 'name', 'min_length', 'name must have at least 2 characters'),
        (3, 'name', 'max_length', 'name must have at most 120 characters'), (4, 'email', 'required', 'email is required'),
        (5, 'email', 'min_length', 'email must have at least 6 characters'), (6, 'email', 'max_length', 'email must have at most 255 characters'),
        (7, 'password', 'required', 'password is required'), (8, 'password', 'min_length', 'password must have at least 6 characters'),
        (9, 'password', 'max_length', 'password must have at most 200 characters'), (10, 'phone', 'max_length', 'phone must have at most 20 characters'),
        (11, 'email', 'contains', 'email must contain @'))
"""

#: (request kind, rows, condition, place, field, rule, message) of every broken rule but those of registrations.
BROKEN_SQL = [
    ("login", "register", "email IS NULL", 1, "email", "required", "email is required"),
    ("login", "register", "length(email) < 6", 2, "email", "min_length", "email must have at least 6 characters"),
    ("login", "register", "length(email) > 255", 3, "email", "max_length", "email must have at most 255 characters"),
    ("login", "register", "password IS NULL", 4, "password", "required", "password is required"),
    ("login", "register", "length(password) < 6", 5, "password", "min_length", "password must have at least 6 characters"),
    ("login", "register", "length(password) > 200", 6, "password", "max_length", "password must have at most 200 characters"),
    ("cart_add", "cart", "product_id IS NULL", 1, "product_id", "required", "product_id is required"),
    ("cart_add", "cart", "quantity IS NULL", 2, "quantity", "required", "quantity is required"),
    ("cart_add", "cart", "quantity < 1", 3, "quantity", "above", "quantity must be greater than 0"),
    ("cart_add_for_user", "cart", "user_id IS NULL", 1, "user_id", "required", "user_id is required"),
    ("cart_add_for_user", "cart", "product_id IS NULL", 2, "product_id", "required", "product_id is required"),
    ("cart_add_for_user", "cart", "quantity IS NULL", 3, "quantity", "required", "quantity is required"),
    ("cart_add_for_user", "cart", "quantity < 1", 4, "quantity", "above", "quantity must be greater than 0"),
    ("cart_update", "cart", "quantity IS NULL", 1, "quantity", "required", "quantity is required"),
    ("cart_update", "cart", "quantity < 1", 2, "quantity", "above", "quantity must be greater than 0"),
    ("product", "product", "category_id IS NULL", 1, "category_id", "required", "category_id is required"),
    ("product", "product", "category_id < 1", 2, "category_id", "above", "category_id must be greater than 0"),
    ("product", "product", "sku IS NULL", 3, "sku", "required", "sku is required"),
    ("product", "product", "length(sku) < 3", 4, "sku", "min_length", "sku must have at least 3 characters"),
    ("product", "product", "length(sku) > 60", 5, "sku", "max_length", "sku must have at most 60 characters"),
    ("product", "product", "product_name IS NULL", 6, "product_name", "required", "product_name is required"),
    ("product", "product", "length(product_name) < 2", 7, "product_name", "min_length", "product_name must have at least 2 characters"),
    ("product", "product", "length(product_name) > 160", 8, "product_name", "max_length", "product_name must have at most 160 characters"),
    ("product", "product", "length(description) > 2000", 9, "description", "max_length", "description must have at most 2000 characters"),
    ("product", "product", "price IS NULL", 10, "price", "required", "price is required"),
    ("product", "product", "isnan(price) OR NOT price > 0", 11, "price", "above", "price must be greater than 0"),
    ("product", "product", "stock_qty IS NULL", 12, "stock_qty", "required", "stock_qty is required"),
    ("product", "product", "stock_qty < 0", 13, "stock_qty", "at_least", "stock_qty must be at least 0"),
    ("product", "product", "reorder_level < 0", 14, "reorder_level", "at_least", "reorder_level must be at least 0"),
    ("search", "search", "length(search) > 120", 1, "search", "max_length", "search must have at most 120 characters"),
    ("search", "search", "min_price < 0", 2, "min_price", "at_least", "min_price must be at least 0"),
    ("search", "search", "max_price < 0", 3, "max_price", "at_least", "max_price must be at least 0"),
]

SQL_BROKEN = SQL_REQUESTS + """
    SELECT 'register' AS request_kind, id AS request_id, CAST(place AS INTEGER) AS place, field, rule, message
    FROM told_register JOIN register_rules USING (place)""" + "".join(
    f" UNION ALL SELECT '{kind}', id, {place}, '{field}', '{rule}', '{message}' FROM {rows} WHERE {condition}\n"
    for kind, rows, condition, place, field, rule, message in BROKEN_SQL)


@register("request_violations", SQL_BROKEN)
def _broken(v):
    """Every rule that a request of any kind breaks."""
    return reduce(DataFrame.unionByName, [broken_rules(df, kind, "id") for kind, df in requests(v).items()])


register("requests_accepted", SQL_REQUESTS + """
    SELECT 'product' AS request_kind, id AS request_id FROM product
    WHERE category_id > 0 AND length(sku) BETWEEN 3 AND 60 AND length(product_name) BETWEEN 2 AND 160 AND coalesce(length(description), 0) <= 2000
      AND price > 0 AND NOT isnan(price) AND stock_qty >= 0 AND coalesce(reorder_level, 5) >= 0
    UNION ALL SELECT 'register', id FROM register
    WHERE length(name) BETWEEN 2 AND 120 AND length(email) BETWEEN 6 AND 255 AND length(password) BETWEEN 6 AND 200
      AND coalesce(length(phone), 0) <= 20 AND email LIKE '%@%'
    UNION ALL SELECT 'search', id FROM search
    WHERE coalesce(length(search), 0) <= 120 AND coalesce(min_price, 0) >= 0 AND coalesce(max_price, 0) >= 0""")(
    lambda v: reduce(DataFrame.unionByName, [accepted(requests(v)[kind], kind).select(F.lit(kind).alias("request_kind"), F.col("id").alias("request_id"))
                                             for kind in ("product", "register", "search")]))


# ------------------------------------------------------------- delete closure
def tables(v) -> dict[str, DataFrame]:
    """The ten tables; categories and products that nothing refers to yet, and a stock audit of which only the restocks are kept."""
    fresh = lambda df, key: df.filter(F.col(key) % 10 == 0).withColumn(key, F.col(key) + NEW_KEYS)
    return {
        "users": v.users.select("user_id"), "carts": v.carts.select("cart_id", "user_id"), "user_sessions": _sessions(v).select("session_id", "user_id"),
        "categories": v.categories.select("category_id").unionByName(fresh(v.categories.select("category_id"), "category_id")),
        "products": v.products.select("product_id", "category_id").unionByName(fresh(v.products.select("product_id", "category_id"), "product_id")),
        "cart_items": v.cart_items.select("cart_item_id", "cart_id", "product_id"), "orders": v.orders.select("order_id", "user_id"),
        "order_items": v.order_items.select("order_item_id", "order_id", "product_id"),
        "inventory_audit": _inv_audit(v).filter("change_qty > 0").select("audit_id", "product_id", "related_order_id"),
        "order_audit": v.order_status_log.select(F.col("seq").alias("audit_id"), "order_id"),
    }


def _closure(root, condition):
    def build(v):
        t = tables(v)
        return delete_closure(t, root, t[root].filter(condition))
    return build


SQL_TABLES = f"""
    , inv_audit AS ({SQL_INV_AUDIT}),
      all_categories AS (SELECT category_id FROM shop_categories
                         UNION ALL SELECT category_id + 1000000000 FROM shop_categories WHERE category_id % 10 = 0),
      all_products AS (SELECT product_id, category_id FROM shop_products
                       UNION ALL SELECT product_id + 1000000000, category_id FROM shop_products WHERE product_id % 10 = 0),
      restocks AS (SELECT * FROM inv_audit WHERE change_qty > 0)"""

register("delete_closure_users", SQL_SESSIONS + """
    , ids AS (SELECT user_id FROM shop_users WHERE user_id % 3 <> 1),
      gone AS (SELECT user_id FROM ids WHERE NOT EXISTS (SELECT 1 FROM shop_orders o WHERE o.user_id = ids.user_id))
    SELECT 'users' AS table_name, CAST(user_id AS VARCHAR) AS key, CASE WHEN user_id IN (SELECT user_id FROM gone) THEN 'DELETED' ELSE 'BLOCKED' END AS action FROM ids
    UNION ALL SELECT 'carts', CAST(cart_id AS VARCHAR), 'DELETED' FROM shop_carts JOIN gone USING (user_id)
    UNION ALL SELECT 'user_sessions', CAST(session_id AS VARCHAR), 'DELETED' FROM sess JOIN gone USING (user_id)
    UNION ALL SELECT 'cart_items', CAST(cart_item_id AS VARCHAR), 'DELETED' FROM shop_cart_items i JOIN shop_carts c ON c.cart_id = i.cart_id
              JOIN gone ON gone.user_id = c.user_id""")(_closure("users", "user_id % 3 <> 1"))

register("delete_closure_carts", """
    SELECT 'carts' AS table_name, CAST(cart_id AS VARCHAR) AS key, 'DELETED' AS action FROM shop_carts WHERE cart_id % 2 = 0
    UNION ALL SELECT 'cart_items', CAST(cart_item_id AS VARCHAR), 'DELETED' FROM shop_cart_items
              WHERE cart_id % 2 = 0 AND cart_id IN (SELECT cart_id FROM shop_carts)""")(_closure("carts", "cart_id % 2 = 0"))

register("delete_closure_categories", SQL_TABLES + """
    SELECT 'categories' AS table_name, CAST(c.category_id AS VARCHAR) AS key,
           CASE WHEN EXISTS (SELECT 1 FROM all_products p WHERE p.category_id = c.category_id) THEN 'BLOCKED' ELSE 'DELETED' END AS action
    FROM all_categories c""")(_closure("categories", "true"))

register("delete_closure_products", SQL_TABLES + """
    SELECT 'products' AS table_name, CAST(p.product_id AS VARCHAR) AS key,
           CASE WHEN p.product_id IN (SELECT product_id FROM shop_cart_items) OR p.product_id IN (SELECT product_id FROM shop_order_items)
                  OR p.product_id IN (SELECT product_id FROM restocks) THEN 'BLOCKED' ELSE 'DELETED' END AS action
    FROM all_products p""")(_closure("products", "true"))

register("delete_closure_orders", SQL_TABLES + """
    , ids AS (SELECT order_id, order_id IN (SELECT related_order_id FROM restocks) AS held FROM shop_orders)
    SELECT 'orders' AS table_name, CAST(order_id AS VARCHAR) AS key, CASE WHEN held THEN 'BLOCKED' ELSE 'DELETED' END AS action FROM ids
    UNION ALL SELECT 'order_items', CAST(order_item_id AS VARCHAR), 'DELETED' FROM shop_order_items JOIN ids USING (order_id) WHERE NOT held
    UNION ALL SELECT 'order_audit', CAST(l.order_id * 4 + s AS VARCHAR), 'DELETED'
              FROM shop_orders l JOIN ids USING (order_id), (VALUES (1), (2), (3)) AS steps(s)
              WHERE NOT held AND (s < 3 OR l.order_status <> 'PLACED')""")(_closure("orders", "true"))
