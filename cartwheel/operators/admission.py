"""Exact all-or-nothing order admission against stock, set-wise.

Commands (orders, cancels, stock adjustments) take effect in ``seq`` order.
An order is admitted only if every line fits the stock at that moment;
admitted orders take stock, an effective cancel puts it back, an
adjustment is refused if it would make stock negative.  Sequential replay
is a loop over commands; here it is a handful of Spark rounds:

* one sorted scan per product walks its undecided rows in ``seq`` order
  with a lower and an upper bound of the true stock.  A line above the
  upper bound refuses its command, a line within the lower bound fits.  A
  line that may or may not fit lowers the lower bound to what is left if it
  is taken; where all other lines of its command are known to fit, it also
  lowers the upper bound, as it is then taken whenever the stock allows;
* one window per command turns the marks of its lines into a verdict:
  refused by any line, admitted when all fit;
* repeat.  The earliest undecided command has exact bounds, so every
  round decides at least one command, and the answer equals the
  sequential one.

What a decided command did to the stock is carried by the next undecided
row of the product, so each round reads only what is undecided.  A product
with very many rows is scanned in chunks, whose first bounds come from sums
over the chunks before.  Rounds are cut from lineage with a reliable
checkpoint into the shared checkpoint folder; the only driver-side value is
the number of undecided lines.
"""

from __future__ import annotations

import logging
import sys
from functools import reduce

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import movement_reason
from ..plans.strategy import hot_keys, in_chunks
from ..session import cut_lineage

log = logging.getLogger(__name__)
# the scan travels to the workers by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])

UNDECIDED, ACCEPTED, REJECTED = 0, 1, 2
# The command that stands for all orders admitted before the log begins.
BEFORE = -(2 ** 63)
# A command without a seq takes effect after all that have one.
LATE = 2 ** 62


def _empty_adjustments(spark, product_type: str):
    return spark.createDataFrame([], f"seq BIGINT, product_id {product_type}, delta INT, reason STRING")


def _empty_cancels(spark):
    return spark.createDataFrame([], "seq BIGINT, order_id BIGINT, user_id BIGINT")


# Columns of the working rows that the scan hands on as they are: ``own`` marks
# lines that ask for stock, ``last`` those whose command's other lines all fit.
ROW = ["product_id", "chunk", "hot", "seq", "dep", "own", "need", "up", "st", "last"]


def _scan(batches):
    """One walk over each product's rows (``first`` marks the first of a product or chunk), in seq order.

    Yields the undecided rows, each with the stock change ``pre`` decided
    since the row before, and whether its line is known to ``fit`` or is
    refused (``rej``).  Decided rows stay only where the product is ``hot``:
    there the next chunk needs them in its first bounds.
    """
    lo = hi = acc = 0
    for batch in batches:
        cols = [batch.column(n).to_numpy(zero_copy_only=False).tolist()
                for n in ("first", "lo0", "hi0", "hot", "st", "own", "need", "up", "pre", "fit", "last")]
        keep, pres, fits, rejs = [], [], [], []
        for i, (first, lo0, hi0, hot, st, own, need, up, pre, fit, last) in enumerate(zip(*cols, strict=True)):
            if first:
                lo, hi, acc = lo0, hi0, 0
            change = acc + pre if st != ACCEPTED else acc + pre + up - need
            if st != UNDECIDED and not hot:
                acc = change
                continue
            acc = 0
            lo, hi = lo + change, hi + change
            if change < 0 and lo < 0:
                lo = min(0, hi)  # whatever was taken was there
            keep.append(i)
            rejs.append(st == UNDECIDED and own and need > hi)
            pres.append(change if st == UNDECIDED else pre)
            fits.append(fit or st == UNDECIDED and own and need <= lo)
            if st != UNDECIDED or rejs[-1]:
                continue
            if not own:
                hi += up
            elif fits[-1]:
                lo = max(lo, need) - need
                if last:
                    hi -= need
            else:
                lo = min(lo, 0)
                if last:
                    hi = max(hi - need, need - 1)
        if keep:
            rows = batch.select(ROW).take(pa.array(keep, pa.int64()))
            marks = [pa.array(pres, pa.int64()), pa.array(fits, pa.bool_()), pa.array(rejs, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*rows.columns, *marks], names=[*ROW, "pre", "fit", "rej"])


def _round(work: DataFrame, any_hot: bool) -> DataFrame:
    """The undecided rows of ``work`` after one scan per product and one verdict per command."""
    rows = work.withColumn("lo0", F.lit(0).cast("long")).withColumn("hi0", F.lit(0).cast("long"))
    if any_hot:
        # first bounds of a chunk: sums over the chunks before, a few rows a hot product
        done, open_ = F.col("st") == ACCEPTED, F.col("st") == UNDECIDED
        moved = F.col("up") - F.col("need")
        sums = work.filter("hot").groupBy("product_id", "chunk").agg(
            F.sum(F.col("pre") + F.when(done, moved).when(open_ & F.col("own"), -F.col("need")).otherwise(0)).alias("least"),
            F.sum(F.col("pre") + F.when(done, moved).when(open_ & ~F.col("own"), F.col("up")).otherwise(0)).alias("most"))
        before = Window.partitionBy("product_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
        starts = sums.select("product_id", "chunk", F.sum("least").over(before).alias("least"), F.sum("most").over(before).alias("most"))
        rows = work.join(F.broadcast(starts), ["product_id", "chunk"], "left").withColumn(
            "hi0", F.coalesce("most", F.lit(0))).withColumn(
            "lo0", F.coalesce(F.least(F.greatest("least", F.lit(0)), "most"), F.lit(0))).drop("least", "most")
    by_product = Window.partitionBy("product_id", "chunk").orderBy("seq", "dep", "own")
    rows = rows.withColumn("first", F.row_number().over(by_product) == 1)
    kept = rows.select(*ROW, "pre", "fit").schema
    marked = rows.mapInArrow(_scan, kept.add("rej", "boolean"))
    # verdict of each undecided command over its lines
    by_command = Window.partitionBy("dep")
    line = F.col("own") & (F.col("st") == UNDECIDED)
    open_lines = F.sum((line & ~F.col("fit")).cast("int")).over(by_command)
    refused = F.max((line & F.col("rej")).cast("int")).over(by_command)
    return marked.withColumn("_open", open_lines).withColumn("_refused", refused).select(
        *[c for c in ROW if c not in ("st", "last")],
        F.when(F.col("st") != UNDECIDED, F.col("st")).when(F.col("_refused") == 1, REJECTED)
        .when(F.col("_open") == 0, ACCEPTED).otherwise(UNDECIDED).cast("int").alias("st"),
        (F.col("_open") - (line & ~F.col("fit")).cast("int") == 0).alias("last"), "pre", "fit")


def admit_commands(stock0: DataFrame, orders: DataFrame, order_lines: DataFrame,
                   cancels: DataFrame | None = None, adjustments: DataFrame | None = None,
                   rounds_out: list | None = None, standing: DataFrame | None = None):
    """D2 (+D3 cancel, +D4 adjust) -> (decisions, movements, final_stock).

    stock0(product_id, stock); orders(seq, order_id, user_id);
    order_lines(order_id, product_id, quantity); cancels(seq, order_id,
    user_id); adjustments(seq, product_id, delta, reason).  ``seq`` values
    are unique over all commands.  standing(order_id, user_id, open): orders
    admitted before the log begins; their stock is already taken, and a
    cancel of an open one (whose lines stand in ``order_lines``) puts it back.

    decisions(seq, kind, ref_id, user_id, outcome): ORDER -> PLACED /
    INSUFFICIENT_STOCK / UNKNOWN_PRODUCT / EMPTY_ORDER / INVALID_QUANTITY; CANCEL -> CANCELLED /
    NOT_FOUND / NOT_OWNER / NOT_PLACED; ADJUST -> APPLIED / ZERO_DELTA /
    UNKNOWN_PRODUCT / NEGATIVE_STOCK.
    movements(movement_id, product_id, seq, at (NULL), delta, reason,
    related_order_id): accepted stock changes, ready for F1.
    final_stock(product_id, stock).
    Should commands share a ``seq`` after all, they are decided as one;
    those without one take effect last, by order id.
    """
    spark = stock0.sparkSession
    cancels = cancels if cancels is not None else _empty_cancels(spark)
    adjustments = adjustments if adjustments is not None else _empty_adjustments(
        spark, stock0.schema["product_id"].dataType.simpleString())
    known = stock0.select("product_id")

    # ---- static facts -------------------------------------------------
    lines = cut_lineage(order_lines.groupBy("order_id", "product_id").agg(F.sum("quantity").alias("q")))
    line_facts = (lines.join(known.withColumn("_known", F.lit(True)), "product_id", "left")
                  .groupBy("order_id").agg(F.count(F.lit(1)).alias("_nlines"),
                                           F.count(F.when(F.col("_known").isNull(), 1)).alias("_unknown"),
                                           F.count(F.when(F.col("q").isNull() | (F.col("q") <= 0), 1)).alias("_badq")))
    numbered = orders.withColumn("cmd", F.coalesce("seq", F.lit(LATE) + F.pmod("order_id", F.lit(LATE // 2))))
    o = numbered.select("seq", "cmd", "order_id", "user_id").join(line_facts, "order_id", "left")
    o_static = (F.when(F.col("_nlines").isNull(), "EMPTY_ORDER")
                .when(F.col("_badq") > 0, "INVALID_QUANTITY")
                .when(F.col("_unknown") > 0, "UNKNOWN_PRODUCT"))
    o = o.withColumn("static", o_static)

    a = adjustments.select("seq", "product_id", "delta", "reason").join(
        known.withColumn("_known", F.lit(True)), "product_id", "left")
    a_static = (F.when(F.col("delta").isNull() | (F.col("delta") == 0), "ZERO_DELTA")
                .when(F.col("_known").isNull(), "UNKNOWN_PRODUCT"))
    late = F.lit(LATE + LATE // 2) + F.pmod(F.xxhash64("product_id", "delta", "reason"), F.lit(LATE // 2))
    a = a.withColumn("static", a_static).withColumn("cmd", F.coalesce("seq", late))

    # first owner-matching cancel after its order is the effective one
    placed = orders.select(F.col("seq").alias("o_seq"), "order_id", F.col("user_id").alias("o_user"), F.lit(True).alias("o_open"))
    if standing is not None:
        placed = placed.unionByName(standing.select(F.lit(BEFORE).alias("o_seq"), "order_id", F.col("user_id").alias("o_user"), F.col("open").alias("o_open")))
    c = cancels.select("seq", "order_id", F.col("user_id").alias("c_user")).join(placed, "order_id", "left")
    eligible = F.col("o_seq").isNotNull() & (F.col("seq") > F.col("o_seq")) & (F.col("c_user") == F.col("o_user")) & F.col("o_open")
    first_cancel = c.filter(eligible).groupBy("order_id").agg(F.min("seq").alias("_eff_seq"))
    c = c.join(first_cancel, "order_id", "left")

    # ---- ledger: (product, seq) rows, with the command they depend on ---
    fair = o.filter(F.col("static").isNull()).select("seq", "cmd", "order_id")
    ol = fair.join(lines, "order_id")
    undo = c.filter(F.col("seq") == F.col("_eff_seq")).select("seq", F.col("o_seq").alias("dep"), "order_id")
    undo = undo.filter(F.col("dep") == BEFORE).unionByName(undo.join(fair.select("order_id"), "order_id", "left_semi").filter(F.col("dep") != BEFORE))
    none = F.lit(0).cast("long")
    ledger = (ol.select("product_id", "seq", F.col("cmd").alias("dep"), F.lit(True).alias("own"), F.col("q").cast("long").alias("need"),
                        none.alias("up"), F.lit(UNDECIDED).alias("st"), F.lit(None).cast("string").alias("reason"),
                        F.col("order_id").alias("related_order_id"))
              .unionByName(undo.join(lines, "order_id").select(
                  "product_id", "seq", F.when(F.col("dep") == BEFORE, F.col("seq")).otherwise(F.col("dep")).alias("dep"),
                  F.lit(False).alias("own"), none.alias("need"), F.col("q").cast("long").alias("up"),
                  F.when(F.col("dep") == BEFORE, ACCEPTED).otherwise(UNDECIDED).alias("st"),
                  F.lit(None).cast("string").alias("reason"), F.col("order_id").alias("related_order_id")))
              .unionByName(a.filter(F.col("static").isNull()).select(
                  "product_id", "seq", F.col("cmd").alias("dep"), (F.col("delta") < 0).alias("own"),
                  F.when(F.col("delta") < 0, -F.col("delta")).otherwise(0).cast("long").alias("need"),
                  F.when(F.col("delta") > 0, F.col("delta")).otherwise(0).cast("long").alias("up"),
                  F.when(F.col("delta") > 0, ACCEPTED).otherwise(UNDECIDED).alias("st"),
                  "reason", F.lit(None).cast(orders.schema["order_id"].dataType).alias("related_order_id"))))
    ledger = cut_lineage(ledger)
    opening = stock0.select("product_id", F.col("stock").cast("long").alias("stock"))

    # ---- working rows: the opening stock stands before all, rows of one command and product are one
    start = opening.groupBy("product_id").agg(F.max("stock").alias("pre")).select(
        "product_id", F.lit(BEFORE).alias("seq"), F.lit(BEFORE).alias("dep"), F.lit(False).alias("own"), F.lit(ACCEPTED).alias("st"),
        none.alias("need"), none.alias("up"), F.coalesce("pre", none).alias("pre"))
    moves = ledger.groupBy("product_id", F.coalesce("seq", "dep").alias("seq"), "dep", "own", "st").agg(
        F.coalesce(F.sum("need"), none).alias("need"), F.coalesce(F.sum("up"), none).alias("up"))
    # products with very many ledger rows, found once for all rounds
    hot = cut_lineage(hot_keys(ledger, ["product_id"], "seq"))
    any_hot = not hot.isEmpty()
    every = moves.withColumn("pre", none).unionByName(start).withColumn("fit", F.lit(False))
    lines_of = Window.partitionBy("dep")
    every = every.withColumn("last", F.sum((F.col("own") & (F.col("st") == UNDECIDED)).cast("int")).over(lines_of) == 1)
    work = cut_lineage(in_chunks(every, ["product_id"], "seq", hot).withColumnsRenamed({"__rt_chunk": "chunk", "__rt_hot": "hot"}))
    rounds, passed = 0, [work]
    undecided = ledger.filter(F.col("own") & (F.col("st") == UNDECIDED)).count()
    while undecided > 0:
        rounds += 1
        work = cut_lineage(_round(work, any_hot))
        passed.append(work)
        undecided = work.filter(F.col("own") & (F.col("st") == UNDECIDED)).count()
        log.info("admission round %d: %d lines undecided", rounds, undecided)
    if rounds_out is not None:
        rounds_out.append(rounds)

    # ---- outcomes -----------------------------------------------------
    final_st = reduce(DataFrame.unionByName, [w.filter(F.col("own") & (F.col("st") != UNDECIDED)).select(F.col("dep").alias("cmd"), "st")
                                              for w in passed]).distinct()
    od = o.join(final_st, "cmd", "left").select(
        "seq", F.lit("ORDER").alias("kind"), F.col("order_id").alias("ref_id"), "user_id",
        F.coalesce("static", F.when(F.col("st") == ACCEPTED, "PLACED").otherwise("INSUFFICIENT_STOCK")).alias("outcome"))
    ad = a.join(final_st, "cmd", "left").select(
        "seq", F.lit("ADJUST").alias("kind"), F.col("product_id").cast("bigint").alias("ref_id"),
        F.lit(None).cast("bigint").alias("user_id"),
        F.coalesce("static", F.when((F.col("delta") > 0) | (F.col("st") == ACCEPTED), "APPLIED").otherwise("NEGATIVE_STOCK")).alias("outcome"))
    ord_st = final_st.select(F.col("cmd").alias("o_seq"), F.col("st").alias("o_st"))
    cj = c.join(ord_st, "o_seq", "left").withColumn("o_st", F.when(F.col("o_seq") == BEFORE, ACCEPTED).otherwise(F.col("o_st")))
    exists = F.col("o_seq").isNotNull() & (F.col("seq") > F.col("o_seq")) & (F.col("o_st") == ACCEPTED)
    cancel_outcome = (F.when(~exists | F.col("o_st").isNull(), "NOT_FOUND")
                      .when(F.col("c_user") != F.col("o_user"), "NOT_OWNER")
                      .when(F.col("seq") == F.col("_eff_seq"), "CANCELLED")
                      .otherwise("NOT_PLACED"))
    cd = cj.select("seq", F.lit("CANCEL").alias("kind"), F.col("order_id").alias("ref_id"),
                   F.col("c_user").alias("user_id"), cancel_outcome.alias("outcome"))
    decisions = od.unionByName(cd).unionByName(ad)

    acc = ledger.drop("st").join(final_st.filter(F.col("st") == ACCEPTED).select(F.col("cmd").alias("dep")), "dep", "left_semi").unionByName(
        ledger.filter(F.col("st") == ACCEPTED).drop("st"))
    movements = acc.select(
        F.xxhash64("seq", "product_id").alias("movement_id"),
        "product_id", "seq", F.lit(None).cast("timestamp_ntz").alias("at"), (F.col("up") - F.col("need")).cast("int").alias("delta"),
        movement_reason(F.when(F.col("related_order_id").isNull(), "ADJUST").when(F.col("up") > 0, "CANCEL")
                        .otherwise("ORDER"), "reason").alias("reason"),
        "related_order_id")
    net = movements.groupBy("product_id").agg(F.sum("delta").alias("_net"))
    final_stock = opening.join(net, "product_id", "left").select(
        "product_id", (F.col("stock") + F.coalesce("_net", F.lit(0))).alias("stock"))
    return decisions, movements, final_stock
