"""Set-wise table maintenance (upserts, key resolution, cascades)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.views import epoch


def first_per_key(source: DataFrame, keys: list[str], order: str = "seq") -> DataFrame:
    """First row per key in ``order`` as a partial aggregate (min_by), not a window."""
    others = [c for c in source.columns if c not in keys]
    g = source.groupBy(*keys).agg(F.min_by(F.struct(*others), F.col(order)).alias("_r"))
    return g.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others])


def insert_ignore(target: DataFrame, source: DataFrame, keys: list[str], order: str = "seq") -> DataFrame:
    """A2: INSERT ... ON CONFLICT DO NOTHING.

    Target rows are kept; of the new keys the first source row wins.
    Returns the new table (target columns).
    """
    new = first_per_key(source, keys, order).join(target.select(*keys), keys, "left_anti")
    return target.unionByName(new.select(*target.columns), allowMissingColumns=False)


def assert_unique_keys(source: DataFrame, keys: list[str]) -> None:
    """Raise if a key occurs twice (a bounded probe job)."""
    dup = source.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).count()
    if dup:
        raise ValueError(f"ON CONFLICT DO UPDATE cannot affect a row twice: duplicate keys {keys} in source")


def upsert(target: DataFrame, source: DataFrame, keys: list[str], set_cols: list[str],
           touch: str | None = "updated_at", as_of=None, check: bool = True) -> DataFrame:
    """A3 (+A8): INSERT ... ON CONFLICT (keys) DO UPDATE SET col = EXCLUDED.col.

    Matched rows take ``set_cols`` from the source and ``touch`` = as_of;
    unmatched source rows are inserted; other target rows are unchanged.
    Duplicate source keys are an error, as in SQL.
    """
    if check:
        assert_unique_keys(source, keys)
    now = F.lit(as_of).cast("timestamp_ntz") if as_of is not None else epoch()
    s = source.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in source.columns if c not in keys],
                      F.lit(True).alias("_in_s"))
    t = target.withColumn("_in_t", F.lit(True))
    j = t.join(s, keys, "full_outer")
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in set_cols:
            out.append(F.when(F.col("_in_s").isNotNull(), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c))
        elif c == touch:
            src_val = F.col(f"_s_{c}") if c in source.columns else now
            out.append(F.when(F.col("_in_t").isNotNull() & F.col("_in_s").isNotNull(), now)
                       .when(F.col("_in_t").isNull(), src_val).otherwise(F.col(c)).alias(c))
        elif c in source.columns:
            out.append(F.when(F.col("_in_t").isNotNull(), F.col(c)).otherwise(F.col(f"_s_{c}")).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def resolve_keys(df: DataFrame, dim: DataFrame, natural_key: str, id_col: str, on_missing: str = "strict",
                 df_key: str | None = None):
    """A4: natural key -> surrogate id.

    ``strict`` (scalar-subquery behaviour): returns (resolved, unresolved),
    unresolved rows would violate NOT NULL.  ``drop`` (inner-join
    behaviour): unknown keys silently disappear.
    """
    k = df_key or natural_key
    d = dim.select(F.col(natural_key).alias(k), id_col)
    if on_missing == "drop":
        return df.join(d, k, "inner")
    j = df.join(d, k, "left")
    return j.filter(F.col(id_col).isNotNull()), j.filter(F.col(id_col).isNull()).drop(id_col)


def build_order_items(headers: DataFrame, lines: DataFrame, products: DataFrame) -> DataFrame:
    """A5: header x its lines (order_id, sku, quantity) x products, price snapshot.

    Lines name their order, so the reference's ``ON TRUE`` pairing of one
    header with a VALUES list becomes an equi-join; unknown SKUs drop out.
    """
    j = (lines.join(headers.select("order_id"), "order_id")
         .join(products.select("sku", "product_id", F.col("price").alias("unit_price")), "sku"))
    return j.select("order_id", "product_id", "quantity", "unit_price",
                    (F.col("quantity") * F.col("unit_price")).cast("decimal(12,2)").alias("line_total"))


def ensure_carts(users: DataFrame, carts: DataFrame, as_of=None) -> DataFrame:
    """One empty cart for every user lacking one (cart_id = user_id)."""
    now = F.lit(as_of).cast("timestamp_ntz") if as_of is not None else epoch()
    missing = users.select("user_id").join(carts.select("user_id"), "user_id", "left_anti")
    new = missing.select(F.col("user_id").alias("cart_id"), "user_id", now.alias("created_at"),
                         now.alias("updated_at"))
    return carts.select("cart_id", "user_id", "created_at", "updated_at").unionByName(new)


def add_column_if_missing(df: DataFrame, col: str, type_: str, default) -> DataFrame:
    """ALTER TABLE ... ADD COLUMN IF NOT EXISTS col type DEFAULT default."""
    if col in df.columns:
        return df
    return df.withColumn(col, F.lit(default).cast(type_))


def cascade_delete_users(user_ids: DataFrame, users: DataFrame, carts: DataFrame, cart_items: DataFrame,
                         sessions: DataFrame, orders: DataFrame) -> DataFrame:
    """What deleting ``user_ids`` does, as (table_name, key, action).

    Users with orders are RESTRICTed (BLOCKED, nothing of theirs goes);
    the others are deleted with their carts, cart items and sessions
    (CASCADE).  Nothing is deleted here: the report drives the rewrite.
    """
    ids = user_ids.select("user_id").distinct().join(users.select("user_id"), "user_id", "left_semi")
    blocked = ids.join(orders.select("user_id"), "user_id", "left_semi")
    gone = ids.join(blocked, "user_id", "left_anti")
    gone_carts = carts.select("cart_id", "user_id").join(gone, "user_id", "left_semi")
    parts = [
        blocked.select(F.lit("users").alias("table_name"), F.col("user_id").cast("string").alias("key"),
                       F.lit("BLOCKED").alias("action")),
        gone.select(F.lit("users").alias("table_name"), F.col("user_id").cast("string").alias("key"),
                    F.lit("DELETED").alias("action")),
        gone_carts.select(F.lit("carts").alias("table_name"), F.col("cart_id").cast("string").alias("key"),
                          F.lit("DELETED").alias("action")),
        cart_items.join(gone_carts.select("cart_id"), "cart_id", "left_semi").select(
            F.lit("cart_items").alias("table_name"), F.col("cart_item_id").cast("string").alias("key"),
            F.lit("DELETED").alias("action")),
        sessions.join(gone, "user_id", "left_semi").select(
            F.lit("user_sessions").alias("table_name"), F.col("session_id").cast("string").alias("key"),
            F.lit("DELETED").alias("action")),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def cascade_delete_orders(order_ids: DataFrame, orders: DataFrame, order_items: DataFrame,
                          order_audit: DataFrame, inventory_audit: DataFrame) -> DataFrame:
    """A7 for orders: items and status history cascade; an order named by a
    stock-audit row is RESTRICTed (BLOCKED)."""
    ids = order_ids.select("order_id").distinct().join(orders.select("order_id"), "order_id", "left_semi")
    blocked = ids.join(inventory_audit.select(F.col("related_order_id").alias("order_id")), "order_id", "left_semi")
    gone = ids.join(blocked, "order_id", "left_anti")
    parts = [
        blocked.select(F.lit("orders").alias("table_name"), F.col("order_id").cast("string").alias("key"),
                       F.lit("BLOCKED").alias("action")),
        gone.select(F.lit("orders").alias("table_name"), F.col("order_id").cast("string").alias("key"),
                    F.lit("DELETED").alias("action")),
        order_items.join(gone, "order_id", "left_semi").select(
            F.lit("order_items").alias("table_name"), F.col("order_item_id").cast("string").alias("key"),
            F.lit("DELETED").alias("action")),
        order_audit.join(gone, "order_id", "left_semi").select(
            F.lit("order_audit").alias("table_name"), F.col("audit_id").cast("string").alias("key"),
            F.lit("DELETED").alias("action")),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def delete_products(product_ids: DataFrame, products: DataFrame, cart_items: DataFrame, order_items: DataFrame,
                    inventory_audit: DataFrame) -> DataFrame:
    """A7 for products: any reference (cart, order line, stock audit) RESTRICTs."""
    ids = product_ids.select("product_id").distinct().join(products.select("product_id"), "product_id", "left_semi")
    refs = (cart_items.select("product_id").unionByName(order_items.select("product_id"))
            .unionByName(inventory_audit.select("product_id")))
    blocked = ids.join(refs, "product_id", "left_semi")
    return ids.join(blocked.withColumn("_b", F.lit(True)), "product_id", "left").select(
        F.lit("products").alias("table_name"), F.col("product_id").cast("string").alias("key"),
        F.when(F.col("_b"), "BLOCKED").otherwise("DELETED").alias("action"))


def touch_updated_at(df: DataFrame, changed, as_of, col: str = "updated_at") -> DataFrame:
    """Set ``col`` to ``as_of`` on rows where ``changed`` (a Column) holds."""
    return df.withColumn(col, F.when(changed, F.lit(as_of).cast("timestamp_ntz")).otherwise(F.col(col)))
