"""Cart lines and summaries (C3, the command fold, is in cart_fold)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import MONEY_SUM


def cart_lines(users: DataFrame, carts: DataFrame, cart_items: DataFrame, products: DataFrame) -> DataFrame:
    """One row per cart item with price, stock and line total, by name."""
    lines = (cart_items.select("cart_item_id", "cart_id", "product_id", "quantity")
             .join(carts.select("cart_id", "user_id"), "cart_id")
             .join(users.select("user_id", "full_name"), "user_id")
             .join(products.select("product_id", "sku", "product_name", "price", "stock_qty"), "product_id"))
    return lines.select(
        "user_id", "full_name", "cart_id", "cart_item_id", "product_id", "sku", "product_name", "price",
        "stock_qty", "quantity", (F.col("price") * F.col("quantity")).cast(MONEY_SUM).alias("line_total"),
    ).orderBy("user_id", "product_name", "product_id")


def cart_summary(users: DataFrame, carts: DataFrame, cart_items: DataFrame, products: DataFrame,
                 nested: bool = False) -> DataFrame:
    """Per user the cart id, number of lines (not units) and total.

    Users without a cart get NULL / 0 / 0.  ``nested=True`` adds the items
    array ordered by product name; it is bounded by one line per product
    (UNIQUE(cart_id, product_id)).
    """
    lines = cart_items.select("cart_id", "cart_item_id", "product_id", "quantity").join(
        products.select("product_id", "sku", "product_name", "price", "stock_qty"), "product_id")
    lines = lines.withColumn("line_total", (F.col("price") * F.col("quantity")).cast(MONEY_SUM))
    aggs = [F.count(F.lit(1)).alias("n"), F.sum("line_total").alias("total")]
    if nested:
        aggs.append(F.array_sort(F.collect_list(F.struct(
            "product_name", "cart_item_id", "product_id", "sku", "price", "stock_qty", "quantity",
            "line_total"))).alias("items"))
    per_cart = lines.groupBy("cart_id").agg(*aggs)
    u = users.select("user_id").join(carts.select("cart_id", "user_id"), "user_id", "left")
    out = u.join(per_cart, "cart_id", "left")
    cols = ["user_id", "cart_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("item_count"),
            F.coalesce("total", F.lit(0)).cast(MONEY_SUM).alias("total_amount")]
    if nested:
        cols.append(F.coalesce("items", F.array()).alias("items"))
    return out.select(*cols)


def checkout_preview(summary: DataFrame) -> DataFrame:
    """C4: summary with the empty-cart flag the checkout page shows."""
    return summary.withColumn("can_checkout", F.col("item_count") > 0)
