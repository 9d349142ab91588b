"""Shop tables derived from the driver's TPC-H-like tables.

The mapping (FIXTURES.md section 3) is a test-data fixture: in production
the shop tables are stored and read with ``load_table``.  Each view is a
lazy DataFrame; Catalyst prunes the columns and pushes filters of whatever
operator consumes it into the parquet scan.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import padded
from ..schemas import MONEY
from .tables import read_raw

# Timestamp given to dimension rows that have no natural time.
EPOCH = "2024-01-01 00:00:00"
# Seq of an order command = day number * SEQ_DAY + order key (a total order
# without a global sort); cancels one day later.
SEQ_DAY = 1_000_000_000_000
# Opening stock of order admission = stock_qty * OPENING_FACTOR.
OPENING_FACTOR = 10


# An order line's id = order key * LINES + its place among the order's
# products; a cart line's id = user key * KEYS + product key.  Neither wraps
# or repeats as long as an order has fewer than LINES products and product
# keys stay below KEYS.
LINES = 1 << 20
KEYS = 1 << 31


def epoch() -> F.Column:
    return F.expr(f"TIMESTAMP_NTZ '{EPOCH}'")


def json_k(col: str = "props") -> F.Column:
    return F.get_json_object(F.col(col), "$.k").cast("bigint")


class ShopViews:
    """Lazily built shop views over one ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return read_raw(self.spark, self.sf_dir, name)

    @cached_property
    def categories(self) -> DataFrame:
        types = self.raw("part").select(F.col("p_type").alias("category_name")).distinct()
        # Global rank over the distinct type domain (a handful of rows).
        rank = F.row_number().over(Window.orderBy("category_name")).cast("bigint")
        return types.select(
            rank.alias("category_id"), "category_name",
            F.concat(F.lit("Parts of type "), F.lower("category_name")).alias("description"),
            epoch().alias("created_at"), epoch().alias("updated_at"))

    @cached_property
    def products(self) -> DataFrame:
        part = self.raw("part")
        cats = self.categories.select("category_id", F.col("category_name").alias("p_type"))
        key = F.col("p_partkey")
        return part.join(cats, "p_type").select(
            key.alias("product_id"), "category_id",
            F.concat(F.upper(F.substring("p_type", 1, 4)), F.lit("-"),
                     padded(key, 6)).alias("sku"),
            F.col("p_name").alias("product_name"), F.col("p_brand").alias("description"),
            F.col("p_retailprice").cast(MONEY).alias("price"),
            ((key * 37) % 101).cast("int").alias("stock_qty"),
            F.col("p_size").cast("int").alias("reorder_level"),
            (key % 20 != 0).alias("is_active"),
            epoch().alias("created_at"), epoch().alias("updated_at"))

    @cached_property
    def users(self) -> DataFrame:
        c = self.raw("customer")
        return c.select(
            F.col("c_custkey").alias("user_id"), F.col("c_name").alias("full_name"),
            F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
            F.lit("seed-hash").alias("password_hash"), F.lit(None).cast("string").alias("phone"),
            (F.col("c_acctbal") > 0).alias("is_active"), (F.col("c_custkey") == 0).alias("is_admin"),
            epoch().alias("created_at"), epoch().alias("updated_at"))

    @cached_property
    def orders(self) -> DataFrame:
        o = self.raw("orders")
        status = (F.when(F.col("o_orderstatus") == "F", "COMPLETED")
                  .when(F.col("o_orderstatus") == "O", "PLACED")
                  .when(F.col("o_orderstatus") == "P", "CANCELLED"))
        next_day = F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")
        return o.select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
            status.alias("order_status"), F.col("o_totalprice").cast(MONEY).alias("total_amount"),
            F.col("o_orderdate").alias("placed_at"),
            F.when(F.col("o_orderstatus") == "P", next_day).alias("cancelled_at"),
            F.when(F.col("o_orderstatus") == "F", next_day).alias("completed_at"),
            F.col("o_orderdate").alias("created_at"),
            F.coalesce(F.when(F.col("o_orderstatus") != "O", next_day), F.col("o_orderdate")).alias("updated_at"))

    @cached_property
    def order_items(self) -> DataFrame:
        from ..plans.strategy import size_shuffles
        # a task's share of the lines stays the same however many there are (the count reads footers only)
        size_shuffles(self.spark, self.raw("lineitem").count())
        # dealt by order: the sums and the places within an order share one shuffle
        lines = (self.raw("lineitem").select("l_orderkey", "l_partkey", "l_quantity").repartition("l_orderkey")
                 .groupBy("l_orderkey", "l_partkey")
                 .agg(F.sum("l_quantity").cast("int").alias("quantity")))
        place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_partkey"))
        lines = lines.withColumn("order_item_id", F.col("l_orderkey") * LINES + place)
        price = self.raw("part").select(F.col("p_partkey").alias("l_partkey"),
                                        F.col("p_retailprice").cast(MONEY).alias("unit_price"))
        return lines.join(price, "l_partkey").select(
            "order_item_id",
            F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
            "quantity", "unit_price",
            (F.col("quantity") * F.col("unit_price")).cast(MONEY).alias("line_total"),
            epoch().alias("created_at"))

    @cached_property
    def carts(self) -> DataFrame:
        return self.users.select(F.col("user_id").alias("cart_id"), "user_id",
                                 epoch().alias("created_at"), epoch().alias("updated_at"))

    @cached_property
    def cart_items(self) -> DataFrame:
        """Stored cart contents: click events summed per (user, product)."""
        e = self.raw("events").filter(F.col("event_type") == "click")
        g = (e.select("user_id", json_k().alias("product_id"), ((F.col("event_id") % 5) + 1).alias("q"))
             .groupBy("user_id", "product_id").agg(F.sum("q").cast("int").alias("quantity")))
        return g.select((F.col("user_id") * KEYS + F.col("product_id")).alias("cart_item_id"),
                        F.col("user_id").alias("cart_id"), "product_id", "quantity",
                        epoch().alias("created_at"), epoch().alias("updated_at"))

    # ---- command logs -------------------------------------------------
    @cached_property
    def cart_commands(self) -> DataFrame:
        e = self.raw("events")
        kind = (F.when(F.col("event_type") == "click", "ADD").when(F.col("event_type") == "view", "SET")
                .when(F.col("event_type") == "error", "REMOVE").when(F.col("event_type") == "purchase", "CLEAR"))
        return (e.filter(F.col("event_type").isin("click", "view", "error", "purchase"))
                .select(F.col("event_id").alias("seq"), "user_id", kind.alias("kind"),
                        json_k().alias("product_id"), ((F.col("event_id") % 5) + 1).cast("int").alias("quantity")))

    @cached_property
    def wishlist_toggles(self) -> DataFrame:
        e = self.raw("events").filter(F.col("event_type") == "view")
        return e.select(F.col("event_id").alias("seq"), "user_id", json_k().alias("product_id"))

    @cached_property
    def session_events(self) -> DataFrame:
        from ..plans.strategy import running_total
        e = self.raw("events").filter(F.col("event_type").isin("signup", "click", "error"))
        kind = (F.when(F.col("event_type") == "signup", "LOGIN").when(F.col("event_type") == "click", "USE")
                .otherwise("LOGOUT"))
        ev = e.select(F.col("event_id").alias("seq"), "user_id", kind.alias("kind"), F.col("ts").alias("at"),
                      F.when(F.col("event_type") == "signup", F.col("event_id")).alias("login_id"))
        # latest LOGIN at or before each row: a per-user running max (hot users split)
        ev = running_total(ev, ["user_id"], ["seq"], "login_id", "session_id", agg="max")
        return (ev.filter(F.col("session_id").isNotNull())
                .select("seq", "session_id", "user_id", "kind", "at"))

    @cached_property
    def order_commands(self) -> DataFrame:
        o = self.raw("orders")
        day = F.datediff(F.to_date("o_orderdate"), F.lit("1970-01-01").cast("date")).cast("bigint")
        return o.select((day * SEQ_DAY + F.col("o_orderkey")).alias("seq"),
                        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"))

    @cached_property
    def order_command_lines(self) -> DataFrame:
        return self.order_items.select("order_id", "product_id", "quantity")

    @cached_property
    def cancel_commands(self) -> DataFrame:
        o = self.raw("orders").filter(F.col("o_orderstatus") == "P")
        day = F.datediff(F.to_date("o_orderdate"), F.lit("1970-01-01").cast("date")).cast("bigint")
        return o.select(((day + 1) * SEQ_DAY + F.col("o_orderkey")).alias("seq"),
                        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"))

    @cached_property
    def adjustments(self) -> DataFrame:
        """Manual stock corrections from error events, spread over the days of the orders."""
        e = self.raw("events").filter(F.col("event_type") == "error")
        k = F.col("event_id")
        reason = F.when(k % 3 == 0, F.lit("  ")).when(k % 3 == 1, F.concat(F.lit(" recount "), (k % 5).cast("string")))
        return e.select(((F.lit(8100) + k % 2300) * SEQ_DAY + SEQ_DAY // 2 + k).alias("seq"), (json_k() * 3).alias("product_id"),
                        (k % 7 - 4).cast("int").alias("delta"), reason.alias("reason"))

    @cached_property
    def opening_stock(self) -> DataFrame:
        return self.products.select("product_id", (F.col("stock_qty") * OPENING_FACTOR).alias("stock"))

    @cached_property
    def order_status_log(self) -> DataFrame:
        """Status writes per order: created PLACED, a total update that keeps
        PLACED one hour later, then the terminal status if any."""
        o = self.orders
        created = o.select((F.col("order_id") * 4 + 1).alias("seq"), "order_id",
                           F.lit("PLACED").alias("order_status"), F.col("placed_at").alias("at"))
        touched = o.select((F.col("order_id") * 4 + 2).alias("seq"), "order_id",
                           F.lit("PLACED").alias("order_status"),
                           (F.col("placed_at") + F.expr("INTERVAL 1 HOUR")).alias("at"))
        final = o.filter(F.col("order_status") != "PLACED").select(
            (F.col("order_id") * 4 + 3).alias("seq"), "order_id", "order_status",
            F.coalesce("completed_at", "cancelled_at").alias("at"))
        return created.unionByName(touched).unionByName(final)

    @cached_property
    def stock_movements(self) -> DataFrame:
        """Unconditional ledger: every order line takes its stock at placing,
        cancelled orders put it back a day later."""
        oi = self.order_items.select("order_item_id", "order_id", "product_id", "quantity")
        hdr = self.orders.select("order_id", "order_status", "placed_at", "cancelled_at")
        lines = oi.join(hdr, "order_id")
        take = lines.select(
            (F.col("order_item_id") * 2).alias("movement_id"), "product_id",
            F.col("placed_at").alias("at"), (-F.col("quantity")).alias("delta"),
            F.lit("ORDER_PLACED_STOCK_REDUCTION").alias("reason"), F.col("order_id").alias("related_order_id"))
        back = lines.filter(F.col("order_status") == "CANCELLED").select(
            (F.col("order_item_id") * 2 + 1).alias("movement_id"), "product_id",
            F.col("cancelled_at").alias("at"), F.col("quantity").alias("delta"),
            F.lit("ORDER_CANCELLED_RESTOCK").alias("reason"), F.col("order_id").alias("related_order_id"))
        return take.unionByName(back)
