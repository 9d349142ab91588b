"""Admin analytics and report feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import MONEY_SUM

# Statuses that count as sales.
LIVE_STATUSES = ("PLACED", "COMPLETED")


def _live_orders(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("order_status").isin(*LIVE_STATUSES))


def top_products(order_items: DataFrame, orders: DataFrame, products: DataFrame, k: int = 10) -> DataFrame:
    """Units and revenue per product over live orders, top ``k``.

    Lines are semi-joined to live orders and aggregated per product
    (partial aggregation before the shuffle), names are joined to the
    aggregate only, and the limit is a TakeOrderedAndProject.
    """
    sold = order_items.join(_live_orders(orders).select("order_id"), "order_id", "left_semi")
    agg = sold.groupBy("product_id").agg(
        F.sum("quantity").cast("bigint").alias("units_sold"),
        F.sum("line_total").cast(MONEY_SUM).alias("revenue"))
    named = agg.join(products.select("product_id", "product_name"), "product_id")
    return (named.orderBy(F.desc("units_sold"), F.desc("revenue"), F.asc("product_id"))
            .limit(k).select("product_id", "product_name", "units_sold", "revenue"))


def completed_revenue(orders: DataFrame) -> DataFrame:
    """COALESCE(SUM(total_amount), 0) over COMPLETED orders."""
    return (orders.filter(F.col("order_status") == "COMPLETED")
            .agg(F.coalesce(F.sum("total_amount"), F.lit(0)).cast(MONEY_SUM)
                 .alias("total_revenue_completed_orders")))


def low_stock(products: DataFrame, categories: DataFrame | None = None, limit: int | None = None) -> DataFrame:
    """Products at or under their reorder level (active or not).

    With ``categories`` the category name is attached (API form, usually
    ``limit=50``); without, the plain report / cursor rows.
    """
    low = products.filter(F.col("stock_qty") <= F.col("reorder_level"))
    cols = ["product_id", "sku", "product_name", "stock_qty", "reorder_level"]
    if categories is not None:
        low = low.join(categories.select("category_id", "category_name"), "category_id")
        cols = ["product_id", "sku", "product_name", "category_name", "stock_qty", "reorder_level"]
    out = low.select(*cols).orderBy("stock_qty", "product_name", "product_id")
    return out.limit(limit) if limit is not None else out


def purchase_history(users: DataFrame, orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Per user (all users) live order count, units and spend.

    Lines are pre-aggregated per order, so the per-user aggregate counts
    each order once and needs no COUNT(DISTINCT).
    """
    per_order = order_items.groupBy("order_id").agg(
        F.sum("quantity").alias("units"), F.sum("line_total").alias("spent"))
    live = _live_orders(orders).select("order_id", "user_id").join(per_order, "order_id", "left")
    per_user = live.groupBy("user_id").agg(
        F.count("order_id").alias("n"), F.sum("units").alias("units"), F.sum("spent").alias("spent"))
    out = users.select("user_id", "full_name").join(per_user, "user_id", "left").select(
        "user_id", "full_name",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("total_orders"),
        F.coalesce("units", F.lit(0)).cast("bigint").alias("total_items_bought"),
        F.coalesce("spent", F.lit(0)).cast(MONEY_SUM).alias("total_spent"))
    return out.orderBy(F.desc("total_spent"), F.desc("total_orders"), F.asc("user_id"))


def customer_spend(users: DataFrame, orders: DataFrame) -> DataFrame:
    spend = _live_orders(orders).groupBy("user_id").agg(F.sum("total_amount").alias("s"))
    return users.select("user_id", "full_name").join(spend, "user_id", "left").select(
        "user_id", "full_name", F.coalesce("s", F.lit(0)).cast(MONEY_SUM).alias("customer_spend"))


def above_average_spenders(users: DataFrame, orders: DataFrame) -> DataFrame:
    """E5: users whose spend is strictly above the mean over all users.

    The mean includes zero spenders.  ``spend > total / n`` is evaluated as
    ``spend * n > total`` in exact decimals; total and n are uncorrelated
    scalar subqueries over the same per-user aggregate (one global
    two-stage aggregate, no join against the per-user rows).
    """
    per_user = customer_spend(users, orders)
    total = per_user.select(F.sum("customer_spend")).scalar()
    n = per_user.select(F.count(F.lit(1))).scalar()
    return (per_user.filter(F.col("customer_spend") * n > total)
            .orderBy(F.desc("customer_spend"), F.asc("user_id")))


def admin_summary(users: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """One row of store counters.

    One conditional aggregate per table (orders scanned once instead of
    five times), combined as scalar subqueries on a one-row frame.
    """
    o = orders.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count(F.when(F.col("order_status") == "PLACED", 1)).alias("placed_orders"),
        F.count(F.when(F.col("order_status") == "COMPLETED", 1)).alias("completed_orders"),
        F.count(F.when(F.col("order_status") == "CANCELLED", 1)).alias("cancelled_orders"),
        F.coalesce(F.sum(F.when(F.col("order_status").isin(*LIVE_STATUSES), F.col("total_amount"))),
                   F.lit(0)).cast(MONEY_SUM).alias("gross_revenue"))
    u = users.agg(F.count(F.lit(1)).alias("total_users"))
    p = products.agg(F.count(F.when(F.col("stock_qty") <= F.col("reorder_level"), 1)).alias("low_stock_products"))
    return u.select(
        "total_users",
        o.select("total_orders").scalar().alias("total_orders"),
        o.select("placed_orders").scalar().alias("placed_orders"),
        o.select("completed_orders").scalar().alias("completed_orders"),
        o.select("cancelled_orders").scalar().alias("cancelled_orders"),
        o.select("gross_revenue").scalar().alias("gross_revenue"),
        p.select("low_stock_products").scalar().alias("low_stock_products"))


def inventory_audit_feed(audit: DataFrame, products: DataFrame | None = None, n: int = 25) -> DataFrame:
    """Latest ``n`` stock changes, newest first (ties: audit_id desc).

    The top-n is taken before the name join, so only n rows meet the
    products side (product_id is a declared foreign key, checked by H3).
    """
    latest = audit.orderBy(F.desc("changed_at"), F.desc("audit_id")).limit(n)
    if products is None:
        return latest.select("audit_id", "product_id", "old_stock", "new_stock", "change_qty", "reason", "changed_at")
    named = latest.join(products.select("product_id", "product_name"), "product_id")
    return named.select("audit_id", "product_id", "product_name", "old_stock", "new_stock", "change_qty",
                        "reason", "related_order_id", "changed_at").orderBy(F.desc("changed_at"), F.desc("audit_id"))


def order_audit_feed(order_audit: DataFrame, n: int = 25) -> DataFrame:
    """Latest ``n`` order status changes."""
    return (order_audit.orderBy(F.desc("changed_at"), F.desc("audit_id")).limit(n)
            .select("audit_id", "order_id", "old_status", "new_status", "note", "changed_at"))
