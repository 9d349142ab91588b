"""Wishlist membership folded from toggles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.strategy import running_total


def wishlist_state(toggles: DataFrame) -> DataFrame:
    """Per (user, product) membership = odd number of toggles.

    Ids that are not positive integers are ignored.  Members are ordered
    per user by their last activation (re-adding moves to the end); the
    position is a per-user running count over members (hot users split).
    """
    t = toggles.filter(F.col("product_id").isNotNull() & (F.col("product_id") > 0))
    g = t.groupBy("user_id", "product_id").agg(F.count(F.lit(1)).alias("toggles"),
                                               F.max("seq").alias("added_seq"))
    members = g.filter(F.col("toggles") % 2 == 1).withColumn("_one", F.lit(1))
    ranked = running_total(members, ["user_id"], ["added_seq"], "_one", "position")
    return ranked.select("user_id", "product_id", F.col("position").cast("bigint").alias("position"),
                         "added_seq", F.col("toggles").cast("bigint").alias("toggles"))
