"""Cart state folded from ADD / SET / REMOVE / CLEAR commands.

Per (user, product) the commands form a state machine over the quantity q
in the cart, against a stock snapshot s of the product:

* ADD x: x > 0, user exists and is active, product exists and is active,
  q + x <= s; then q += x.
* SET x: x > 0, the item exists (q > 0), x <= s; then q = x (no active check).
* REMOVE: q = 0; outcome says whether the item existed.
* CLEAR (checkout): q = 0 for every product of the user.

Set-wise: REMOVE, CLEAR and an accepted SET are *reset points* whose
resulting q is known.  Whether a SET is accepted is decidable up front: in
a stretch that starts empty, the first ADD with x <= s always fits, so the
item exists before a SET iff such an ADD (or a stored quantity, or an
earlier accepted SET) precedes it in its stretch.  Between reset points
only ADDs remain, which is single-resource admission with a known opening
room (s - q); that runs on ``admit_commands`` (exact, hot keys split).
A CLEAR is never spread over products: the number of a user's CLEARs before
a command (one running count for each user) is part of its segment's key.
Stored cart lines without a command stay in the state unless a CLEAR follows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.strategy import running_total
from ..session import cut_lineage
from .admission import admit_commands


def fold_cart(commands: DataFrame, users: DataFrame, products: DataFrame, cart_items: DataFrame | None = None,
              carts: DataFrame | None = None):
    """-> (outcomes(seq, user_id, kind, product_id, outcome), cart_state(user_id, product_id, quantity))."""
    cmd = commands.select("seq", "user_id", "kind", "product_id", "quantity")
    clears = cmd.filter(F.col("kind") == "CLEAR").select("seq", "user_id")
    epochs = clears.groupBy("user_id").agg(F.count(F.lit(1)).alias("_epochs"))
    # epoch = the user's CLEARs before the command
    cmd = cmd.withColumn("_clear", F.when(F.col("kind") == "CLEAR", 1).otherwise(0))
    cmd = running_total(cut_lineage(cmd), ["user_id"], ["seq"], "_clear", "_epoch", inclusive=False)
    rows = cmd.filter(F.col("kind") != "CLEAR").withColumn("_epoch", F.coalesce("_epoch", F.lit(0))).drop("_clear")

    u = users.select("user_id", F.col("is_active").alias("_u_active"))
    p = products.select("product_id", F.col("stock_qty").alias("s"), F.col("is_active").alias("_p_active"))
    rows = rows.join(u, "user_id", "left").join(p, "product_id", "left")
    if cart_items is not None:
        q0 = cart_items.join(carts.select("cart_id", "user_id"), "cart_id").select(
            "user_id", "product_id", F.col("quantity").alias("q0"))
        rows = rows.join(q0, ["user_id", "product_id"], "left")
    else:
        rows = rows.withColumn("q0", F.lit(None).cast("int"))
    rows = rows.withColumn("q0", F.coalesce("q0", F.lit(0)))
    x, s, kind = F.col("quantity"), F.col("s"), F.col("kind")

    static = (F.when(kind == "ADD", F.when(x.isNull() | (x <= 0), "INVALID_QUANTITY")
                     .when(F.col("_u_active").isNull() | ~F.col("_u_active"), "USER_INACTIVE")
                     .when(F.col("_p_active").isNull() | ~F.col("_p_active"), "PRODUCT_UNAVAILABLE")
                     .when(x > s, "INSUFFICIENT_STOCK"))
              .when(kind == "SET", F.when(x.isNull() | (x <= 0), "INVALID_QUANTITY")
                    .when(s.isNull(), "NOT_FOUND")))
    rows = rows.withColumn("static", static)
    key = ["user_id", "product_id", "_epoch"]
    # stretch = number of REMOVEs of the epoch before (inclusive: a reset opens a new stretch)
    rows = rows.withColumn("_reset", F.when(kind == "REMOVE", 1).otherwise(0))
    # the stored quantity counts in the first epoch only
    rows = rows.withColumn("q0", F.when(F.col("_epoch") == 0, F.col("q0")).otherwise(0))
    # an ADD that certainly fits an empty stretch proves existence for later SETs
    rows = rows.withColumn("_fits", F.when((kind == "ADD") & F.col("static").isNull(), 1).otherwise(0))
    # each prefix scan reads its input three times (counts, slices, rows):
    # cut lineage between them so plans stay linear in the number of steps
    rows = cut_lineage(rows)
    rows = cut_lineage(running_total(rows, key, ["seq"], ["_reset"], ["_stretch"], inclusive=True))
    rows = cut_lineage(running_total(rows, key + ["_stretch"], ["seq"], ["_fits"], ["_fit_before"],
                                     inclusive=False))
    exists = (F.coalesce("_fit_before", F.lit(0)) > 0) | ((F.col("_stretch") == 0) & (F.col("q0") > 0))
    set_ok = (kind == "SET") & F.col("static").isNull() & exists & (x <= s)
    rows = rows.withColumn("static", F.when((kind == "SET") & F.col("static").isNull() & ~set_ok,
                                            F.when(~exists, "NOT_FOUND").otherwise("INSUFFICIENT_STOCK"))
                           .otherwise(F.col("static")))
    rows = rows.withColumn("_set_ok", set_ok.cast("int"))
    # segment = stretch plus accepted SETs before (inclusive)
    rows = cut_lineage(running_total(rows, key + ["_stretch"], ["seq"], ["_set_ok"], ["_sets"], inclusive=True))
    seg_key = F.concat_ws(":", "user_id", "product_id", "_epoch", "_stretch", "_sets")
    rows = rows.withColumn("seg", seg_key)
    # opening q of each segment: q0 (first stretch, no SET), 0 after a reset, x after an accepted SET
    opener = rows.filter((F.col("_set_ok") == 1) | (F.col("_reset") == 1)).select(
        "seg", F.when(F.col("_set_ok") == 1, x).otherwise(0).alias("_open_q"))
    firsts = rows.select("seg", *key, "_stretch", "_sets", "q0", "s").distinct()
    segs = firsts.join(opener, "seg", "left").select(
        "seg", *key, "s",
        F.coalesce("_open_q", F.when((F.col("_stretch") == 0) & (F.col("_sets") == 0), F.col("q0")),
                   F.lit(0)).alias("open_q"))
    adds = rows.filter((kind == "ADD") & F.col("static").isNull())
    stock0 = segs.select(F.col("seg").alias("product_id"), (F.col("s") - F.col("open_q")).alias("stock"))
    orders = adds.select("seq", F.col("seq").alias("order_id"), "user_id")
    lines = adds.select(F.col("seq").alias("order_id"), F.col("seg").alias("product_id"), "quantity")
    dec, _, _ = admit_commands(stock0, orders, lines)
    add_ok = dec.select("seq", (F.col("outcome") == "PLACED").alias("_add_ok"))
    rows = cut_lineage(rows.join(add_ok, "seq", "left"))
    # quantity at the end of every segment
    gained = rows.filter(F.col("_add_ok")).groupBy("seg").agg(F.sum("quantity").alias("_gain"))
    seg_end = segs.join(gained, "seg", "left").select(
        "seg", *key, (F.col("open_q") + F.coalesce("_gain", F.lit(0))).alias("end_q"))
    # REMOVE existed iff the segment before it ended with q > 0
    seg_order = rows.groupBy("seg", *key).agg(F.min("seq").alias("_first"))
    seg_order = running_total(seg_order.withColumn("_w", F.struct("_first", "seg")), key, ["_first"], "_w", "_pw",
                              inclusive=False, agg="max").withColumn("_prev", F.col("_pw.seg"))
    outcome = (F.when(F.col("static").isNotNull(), F.col("static"))
               .when(kind == "ADD", F.when(F.col("_add_ok"), "ADDED").otherwise("INSUFFICIENT_STOCK"))
               .when(kind == "SET", "UPDATED"))
    rem = (rows.filter(kind == "REMOVE").select("seq", "seg", "q0")
           .join(seg_order.select("seg", "_prev"), "seg")
           .join(seg_end.select(F.col("seg").alias("_prev"), "end_q"), "_prev", "left")
           .select("seq", F.when(F.col("_prev").isNull(), F.col("q0") > 0).otherwise(F.col("end_q") > 0)
                   .alias("_had")))
    rem = rem.select("seq", F.when(F.col("_had"), "REMOVED").otherwise("NOT_FOUND").alias("_rem"))
    out = rows.join(rem, "seq", "left").select(
        "seq", "user_id", "kind", "product_id", F.coalesce(outcome, F.col("_rem")).alias("outcome"))
    out = out.unionByName(
        clears.select("seq", "user_id", F.lit("CLEAR").alias("kind"), F.lit(None).cast("bigint").alias("product_id"),
                      F.lit("CLEARED").alias("outcome")))
    # what is left: the last segment of each line, if no CLEAR of the user came after it
    last = seg_order.groupBy("user_id", "product_id").agg(F.max(F.struct("_first", "seg", "_epoch")).alias("_l"))
    state = (last.select("user_id", "product_id", F.col("_l.seg").alias("seg"), F.col("_l._epoch").alias("_epoch"))
             .join(epochs, "user_id", "left").filter(F.col("_epoch") == F.coalesce("_epochs", F.lit(0)))
             .join(seg_end.select("seg", "end_q"), "seg")
             .filter(F.col("end_q") > 0)
             .select("user_id", "product_id", F.col("end_q").cast("int").alias("quantity")))
    if cart_items is not None:
        # stored lines that no command touched stay, unless the user's cart was cleared
        untouched = (q0.join(last.select("user_id", "product_id"), ["user_id", "product_id"], "left_anti")
                     .join(epochs, "user_id", "left_anti").filter(F.col("q0") > 0))
        state = state.unionByName(untouched.select("user_id", "product_id", F.col("q0").cast("int").alias("quantity")))
    return out, state
