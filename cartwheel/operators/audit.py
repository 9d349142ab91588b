"""Change capture derived set-wise from movements and status writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.strategy import running_total


def inventory_audit(stock0: DataFrame, movements: DataFrame, order: tuple[str, ...] = ("at", "movement_id"),
                    id_col: str = "movement_id") -> DataFrame:
    """one audit row per stock change (zero changes leave no row).

    ``movements`` has product_id, delta, reason, related_order_id, at and
    the ``order`` columns; ``stock0`` has product_id, stock.  new_stock is
    the opening stock plus a per-product running sum (two-level prefix
    scan, so a product with a third of all movements is still split).
    """
    mv = movements.filter(F.col("delta") != 0)
    mv = running_total(mv, ["product_id"], list(order), "delta", "_cum")
    j = mv.join(stock0.select("product_id", F.col("stock").alias("_open")), "product_id")
    new = (F.col("_open") + F.col("_cum")).cast("int")
    return j.select(
        F.col(id_col).alias("audit_id"), "product_id",
        (new - F.col("delta")).cast("int").alias("old_stock"), new.alias("new_stock"),
        F.col("delta").cast("int").alias("change_qty"), "reason", "related_order_id",
        F.col("at").alias("changed_at"))


def present_stock(stock0: DataFrame, movements: DataFrame) -> DataFrame:
    """(product_id, stock) after all movements; one partial sum per product."""
    net = movements.groupBy("product_id").agg(F.sum("delta").alias("_net"))
    return stock0.join(net, "product_id", "left").select(
        "product_id", (F.col("stock") + F.coalesce("_net", F.lit(0))).alias("stock"))


def newest_inventory_audit(present: DataFrame, movements: DataFrame, n: int,
                           order: tuple[str, ...] = ("at", "movement_id"), id_col: str = "movement_id") -> DataFrame:
    """The newest ``n`` rows of F1, found from the end.

    The newest n movements of stored products are a top-n; the stock after
    each is the ``present`` stock (product_id, stock after all movements)
    less the deltas that follow, all of which are among these n rows.  No
    window runs over the history.
    """
    newest_first = [F.col(c).desc() for c in order]
    mv = movements.filter(F.col("delta") != 0).join(present.select("product_id"), "product_id", "left_semi")
    newest = mv.orderBy(*newest_first).limit(n)
    later = Window.partitionBy("product_id").orderBy(*newest_first).rowsBetween(Window.unboundedPreceding, -1)
    newest = newest.withColumn("_later", F.coalesce(F.sum("delta").over(later), F.lit(0)))
    j = newest.join(present, "product_id")
    new = (F.col("stock") - F.col("_later")).cast("int")
    return j.select(
        F.col(id_col).alias("audit_id"), "product_id",
        (new - F.col("delta")).cast("int").alias("old_stock"), new.alias("new_stock"),
        F.col("delta").cast("int").alias("change_qty"), "reason", "related_order_id",
        F.col("at").alias("changed_at"))


def order_status_audit(status_log: DataFrame) -> DataFrame:
    """status history rows: the first write of an order (old NULL,
    ORDER_CREATED) and later writes that change the status
    (ORDER_STATUS_UPDATED).  Writes keeping the status leave no row.

    One window over an order's writes, which are few: a status leaves PLACED
    once, so no order holds a share of the log that grows with it.
    """
    by_order = Window.partitionBy("order_id").orderBy("seq")
    log = status_log.withColumn("_prev", F.lag(F.struct("order_status")).over(by_order))
    prev = F.col("_prev.order_status")
    first = F.col("_prev").isNull()
    keep = first | ~prev.eqNullSafe(F.col("order_status"))
    return log.filter(keep).select(
        F.col("seq").alias("audit_id"), "order_id",
        F.when(first, F.lit(None).cast("string")).otherwise(prev).alias("old_status"),
        F.col("order_status").alias("new_status"),
        F.when(first, "ORDER_CREATED").otherwise("ORDER_STATUS_UPDATED").alias("note"),
        F.col("at").alias("changed_at"))


def assert_non_negative(audit_or_stock: DataFrame, col: str = "new_stock") -> DataFrame:
    """rows whose stock is below zero (empty when the invariant holds)."""
    return audit_or_stock.filter(F.col(col) < 0)
