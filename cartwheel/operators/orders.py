"""Order pricing, history, totals, stock as of a time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import line_total
from ..schemas import MONEY, MONEY_SUM

ITEM_FIELDS = ["order_item_id", "product_id", "product_name", "quantity", "unit_price", "line_total"]


def price_orders(requests: DataFrame, carts: DataFrame, cart_items: DataFrame, products: DataFrame):
    """Turn place-order requests (seq, user_id) into headers and lines.

    The first request of a user prices the cart at current prices (price
    snapshot); the cart is then empty, so later requests of the same user
    see EMPTY_CART.  Outcomes: OK, NO_CART, EMPTY_CART.  The order id of an
    accepted request is its ``seq``.
    """
    first = requests.groupBy("user_id").agg(F.min("seq").alias("_first_seq"))
    lines = (cart_items.select("cart_id", "product_id", "quantity")
             .join(products.select("product_id", F.col("price").alias("unit_price")), "product_id"))
    per_cart = lines.groupBy("cart_id").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.col("quantity") * F.col("unit_price")).cast(MONEY).alias("_total"))
    r = (requests.select("seq", "user_id").join(first, "user_id")
         .join(carts.select("user_id", "cart_id"), "user_id", "left")
         .join(per_cart, "cart_id", "left"))
    outcome = (F.when(F.col("cart_id").isNull(), "NO_CART")
               .when(F.col("_n").isNull() | (F.col("seq") != F.col("_first_seq")), "EMPTY_CART")
               .otherwise("OK"))
    headers = r.select("seq", "user_id", "cart_id", outcome.alias("outcome"),
                       F.when(outcome == "OK", F.col("_total")).alias("total_amount"),
                       F.when(outcome == "OK", F.col("_n")).cast("bigint").alias("line_count"))
    ok = headers.filter(F.col("outcome") == "OK").select(F.col("seq").alias("order_id"), "cart_id")
    order_lines = ok.join(lines, "cart_id").select(
        "order_id", "product_id", "quantity", "unit_price", line_total().alias("line_total"))
    return headers, order_lines


def stock_as_of(stock0: DataFrame, movements: DataFrame, as_of=None) -> DataFrame:
    """On-hand stock per product after every movement at or before ``as_of``."""
    mv = movements if as_of is None else movements.filter(F.col("at") <= F.lit(as_of).cast("timestamp_ntz"))
    net = mv.groupBy("product_id").agg(F.sum("delta").alias("_net"))
    return stock0.join(net, "product_id", "left").select(
        "product_id", (F.col("stock") + F.coalesce("_net", F.lit(0))).cast("bigint").alias("stock"))


def _nested_items(order_items: DataFrame, products: DataFrame) -> DataFrame:
    lines = order_items.select("order_item_id", "order_id", "product_id", "quantity", "unit_price", "line_total") \
        .join(products.select("product_id", "product_name"), "product_id", "left")
    return lines.groupBy("order_id").agg(
        F.count("order_item_id").alias("item_count"),
        F.array_sort(F.collect_list(F.struct(*ITEM_FIELDS))).alias("items"))


def order_history(orders: DataFrame, order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Per order the header, line count and items ordered by item id.

    Orders without lines get 0 and [].  Items per order are bounded by one
    line per product (UNIQUE(order_id, product_id)).
    """
    o = orders.select("order_id", "user_id", "order_status", "total_amount", "placed_at", "cancelled_at",
                      "completed_at")
    out = o.join(_nested_items(order_items, products), "order_id", "left")
    return out.select(
        "order_id", "user_id", "order_status", "total_amount", "placed_at", "cancelled_at", "completed_at",
        F.coalesce("item_count", F.lit(0)).cast("bigint").alias("item_count"),
        F.coalesce("items", F.array().cast(out.schema["items"].dataType)).alias("items"),
    ).orderBy("user_id", F.desc("placed_at"), F.desc("order_id"))


def items_digest(items_col: str = "items") -> F.Column:
    """Flat text form of the items array, ``id:product:name:quantity:price:total`` in item-id order."""
    fields = ("order_item_id", "product_id", "product_name", "quantity", "unit_price", "line_total")
    return F.array_join(F.transform(F.col(items_col), lambda x: F.concat_ws(":", *[x[f].cast("string") for f in fields])), ",")


def order_detail(orders: DataFrame, order_items: DataFrame, products: DataFrame, requests) -> DataFrame:
    """D6 for requested (user_id, order_id) pairs the user owns.

    ``requests`` is a (user_id, order_id) tuple (filters pushed into both
    scans) or a DataFrame of such pairs (semi-joins).
    """
    if isinstance(requests, DataFrame):
        pairs = requests.select("user_id", "order_id").distinct()
        o = orders.join(pairs, ["user_id", "order_id"], "left_semi")
        oi = order_items.join(pairs.select("order_id"), "order_id", "left_semi")
    else:
        uid, oid = requests
        o = orders.filter((F.col("user_id") == uid) & (F.col("order_id") == oid))
        oi = order_items.filter(F.col("order_id") == oid)
    return order_history(o, oi, products)


def order_list(users: DataFrame, orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Orders of existing users with their number of lines, newest first."""
    lines = order_items.groupBy("order_id").agg(F.count("order_item_id").alias("_n"))
    # lines first: stored by order, headers and counts meet without a shuffle
    o = orders.join(lines, "order_id", "left").join(users.select("user_id"), "user_id")
    return o.select("order_id", "user_id", "order_status", "total_amount", "placed_at",
                    F.coalesce("_n", F.lit(0)).cast("bigint").alias("item_lines")) \
        .orderBy("user_id", F.desc("placed_at"), F.desc("order_id"))


def recompute_totals(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """total_amount = COALESCE(SUM(line_total), 0) for every order."""
    sums = order_items.groupBy("order_id").agg(F.sum("line_total").alias("_sum"))
    o = orders.join(sums, "order_id", "left")
    return o.withColumn("total_amount", F.coalesce("_sum", F.lit(0)).cast(MONEY)).drop("_sum")


def with_line_total(order_items: DataFrame) -> DataFrame:
    """(re)compute the generated column line_total."""
    return order_items.withColumn("line_total", line_total())


def sum_money(col: str) -> F.Column:
    return F.sum(col).cast(MONEY_SUM)
