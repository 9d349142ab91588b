"""The trigger side effects re-aimed as Structured Streaming jobs.

* J2 ``order_audit_updates``: F3 with the last status of every order as a
  state value; a timer drops that of a closed order.
* J3 ``session_updates``: G5 with one state value a session and an event-time
  timer at its expiry.
* J4 ``cart_updates``: C3 with the cart lines of every user as map state.
* J1 ``start_inventory_stream``: D2 + F1 per micro-batch (``foreachBatch``);
  orders span products, so the state is a table of changed keys by batch.

J2-J4 are plain streaming DataFrames over Spark's own state and checkpoint
(the RocksDB state store, set by ``build_session``); any exactly-once sink
can take them.  Commands arrive in commit order: a batch is applied after
the one before it and ``seq`` orders commands inside a batch (an older seq
arriving later is applied late, not inserted back).  The commands of one key
and micro-batch meet in one task, as Spark's keyed state has it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from ..operators.admission import admit_commands
from ..operators.audit import inventory_audit
from ..session import cut_lineage

AUDIT_SCHEMA = ("audit_id LONG, order_id LONG, old_status STRING, new_status STRING, note STRING, "
                "changed_at TIMESTAMP_NTZ")
# Statuses after which an order does not change any more.
CLOSED = ("CANCELLED", "COMPLETED")
DAY_MS = 24 * 3600 * 1000


class _OrderAudit(StatefulProcessor):
    """The last status of an order; that of a closed order is dropped by a timer."""

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "status STRING, until LONG")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known, now = self.last.get(), timerValues.getCurrentWatermarkInMs()
        if known and known[1] is not None:
            self.handle.deleteTimer(known[1])
            known = known if known[1] > now else None  # its timer is due
        log = pd.concat(list(rows)).sort_values("seq")
        old = log["order_status"].shift(1)
        old.iloc[0] = known[0] if known else None
        last = log["order_status"].iloc[-1]
        changed = old.isna() | (old != log["order_status"])
        until = int(log["at"].max().timestamp() * 1000) + self.keep_ms if last in CLOSED else None
        if until is not None and until <= now:
            self.last.clear()
        else:
            self.last.update((last, until))
            if until is not None:
                self.handle.registerTimer(until)
        note = old.isna().map({True: "ORDER_CREATED", False: "ORDER_STATUS_UPDATED"})
        out = pd.DataFrame({"audit_id": log["seq"], "order_id": log["order_id"], "old_status": old.astype(object).where(old.notna(), None),
                            "new_status": log["order_status"], "note": note, "changed_at": log["at"]})
        yield out[changed]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        yield from ()

    def close(self) -> None:
        pass


def order_audit_updates(status_stream: DataFrame, keep_ms: int = 30 * DAY_MS, watermark: str = "30 days") -> DataFrame:
    """Streaming F3 over (seq, order_id, order_status, at); append mode.

    A closed order's status is forgotten once the watermark passes its last
    write by ``keep_ms``; a write after that starts a new history.  As in all of Spark's
    event-time state, a write later than ``watermark`` is left out.
    """
    log = status_stream.withColumn("_t", F.col("at").cast("timestamp")).withWatermark("_t", watermark)
    return log.groupBy("order_id").transformWithStateInPandas(_OrderAudit(keep_ms), AUDIT_SCHEMA, "Append", "EventTime")


SESSION_COLUMNS = ["session_id", "user_id", "expires_at", "revoked_at", "last_used_at", "refused_uses", "closed"]
SESSION_SCHEMA = ("session_id LONG, user_id LONG, expires_at TIMESTAMP_NTZ, revoked_at TIMESTAMP_NTZ, "
                  "last_used_at TIMESTAMP_NTZ, refused_uses LONG, closed BOOLEAN")
# times as microseconds since 1970
SESSION_STATE = "user_id LONG, expires LONG, revoked LONG, used LONG, refused LONG"


def _micros(t) -> int | None:
    return None if t is None or pd.isna(t) else pd.Timestamp(t).value // 1000


def _time(us: int | None):
    return pd.NaT if us is None else pd.Timestamp(us, unit="us")


def _told(sid: int, state, closed: bool) -> pd.DataFrame:
    user, expires, revoked, used, refused = state
    row = (sid, user, _time(expires), _time(revoked), _time(used), refused, closed)
    return pd.DataFrame([row], columns=SESSION_COLUMNS).astype({"user_id": "Int64", "expires_at": "datetime64[us]", "revoked_at": "datetime64[us]",
                                                                "last_used_at": "datetime64[us]"})


class _Sessions(StatefulProcessor):
    def __init__(self, ttl_hours: int):
        self.ttl = pd.Timedelta(hours=ttl_hours)

    def init(self, handle) -> None:
        self.handle = handle
        self.session = handle.getValueState("session", SESSION_STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        sid, state = int(key[0]), self.session.get()
        log = pd.concat(list(rows)).sort_values("seq")
        login, use = log["kind"] == "LOGIN", log["kind"] == "USE"
        user, expires, revoked, used, refused = state or (None, None, None, None, 0)
        if state is None and not login.any():
            # the session is closed and forgotten: its uses are all refused, told in a row of their own
            if use.any():
                yield _told(sid, (None, None, None, None, int(use.sum())), True)
            return
        until = (log["at"] + self.ttl).where(login).ffill().fillna(_time(expires))
        log, login, use, until = (x[until.notna()] for x in (log, login, use, until))
        logout = log["kind"] == "LOGOUT"
        gone = (logout.cumsum() - logout > 0) | (revoked is not None)  # logged out before the row
        good = use & (log["at"] < until) & ~gone
        if login.any():
            user = int(log["user_id"][login].iloc[-1])
        if revoked is None and logout.any():
            revoked = _micros(log["at"][logout].iloc[0])
        if good.any():
            used = max(_micros(log["at"][good].max()), used if used is not None else -(2 ** 62))
        old, expires = expires, _micros(until.iloc[-1])
        state = (user, expires, revoked, used, int(refused + (use & ~good).sum()))
        closed = expires // 1000 <= timerValues.getCurrentWatermarkInMs()  # no timer can be set in the watermark's past
        if old is not None and (closed or old != expires):
            self.handle.deleteTimer(old // 1000)
        if closed:
            self.session.clear()
        else:
            self.session.update(state)
            self.handle.registerTimer(expires // 1000)
        yield _told(sid, state, closed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        state = self.session.get()
        if state is not None:
            self.session.clear()
            yield _told(int(key[0]), state, True)

    def close(self) -> None:
        pass


def session_updates(event_stream: DataFrame, ttl_hours: int = 24, watermark: str = "1 hour") -> DataFrame:
    """Streaming G5 over (seq, session_id, user_id, kind, at); update mode.

    A session's state lives until the watermark passes its expiry; then a
    final row with ``closed`` = true is emitted and the state is dropped.
    Uses that arrive after that are refused: they come as a closed row without
    a user, whose ``refused_uses`` add to the session's.
    """
    ev = event_stream.withColumn("_t", F.col("at").cast("timestamp")).withWatermark("_t", watermark)
    return ev.groupBy("session_id").transformWithStateInPandas(_Sessions(ttl_hours), SESSION_SCHEMA, "Update", "EventTime")


CART_SCHEMA = "seq LONG, user_id LONG, kind STRING, product_id LONG, outcome STRING, step LONG, quantity INT"


class _Cart(StatefulProcessor):
    """The cart of a user: quantity by product, and how many commands were applied."""

    def init(self, handle) -> None:
        self.lines = handle.getMapState("lines", "product_id LONG", "quantity INT")
        self.steps = handle.getValueState("steps", "n LONG")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        step = (self.steps.get() or (0,))[0]
        held: dict[int, int] = {}  # lines that this batch has touched
        cleared = False
        for r in sorted(rows, key=lambda r: r.seq):
            step += 1
            if r.kind == "CLEAR":
                held, cleared = {}, True
                yield Row(seq=r.seq, user_id=key[0], kind=r.kind, product_id=None, outcome="CLEARED", step=step, quantity=None)
                continue
            p = r.product_id
            if p not in held:
                known = not cleared and p is not None and self.lines.containsKey((p,))
                held[p] = self.lines.getValue((p,))[0] if known else 0
            outcome, held[p] = self.applied(r, held[p])
            yield Row(seq=r.seq, user_id=key[0], kind=r.kind, product_id=p, outcome=outcome, step=step, quantity=held[p])
        if cleared:
            self.lines.clear()
        for p, q in held.items():
            if q > 0:
                self.lines.updateValue((p,), (q,))
            elif not cleared and p is not None and self.lines.containsKey((p,)):
                self.lines.removeKey((p,))
        self.steps.update((step,))

    @staticmethod
    def applied(r: Row, q: int) -> tuple[str, int]:
        """Outcome of a command on a line of quantity ``q``, and the quantity after it."""
        if r.kind == "REMOVE":
            return ("REMOVED" if q > 0 else "NOT_FOUND"), 0
        if r.quantity is None or r.quantity <= 0:
            return "INVALID_QUANTITY", q
        if r.kind == "ADD":
            if not r.user_active:
                return "USER_INACTIVE", q
            if not r.product_active:
                return "PRODUCT_UNAVAILABLE", q
            return ("INSUFFICIENT_STOCK", q) if q + r.quantity > r.stock else ("ADDED", q + r.quantity)
        if r.stock is None or q == 0:
            return "NOT_FOUND", q
        return ("INSUFFICIENT_STOCK", q) if r.quantity > r.stock else ("UPDATED", r.quantity)

    def close(self) -> None:
        pass


def cart_updates(command_stream: DataFrame, users: DataFrame, products: DataFrame) -> DataFrame:
    """Streaming C3 over (seq, user_id, kind, product_id, quantity); append mode.

    One row for each command: its outcome, ``step`` (the user's commands
    so far) and the line's quantity after it.  ``users`` and ``products`` are
    tables read anew by each micro-batch.  Only touched users take part in a batch.
    """
    u = users.select("user_id", F.col("is_active").alias("user_active"))
    p = products.select("product_id", F.col("stock_qty").alias("stock"), F.col("is_active").alias("product_active"))
    known = (command_stream.select("seq", "user_id", "kind", "product_id", "quantity").join(u, "user_id", "left").join(p, "product_id", "left"))
    return known.groupBy("user_id").transformWithState(_Cart(), CART_SCHEMA, "Append", "None")


def cart_of(updates: DataFrame) -> DataFrame:
    """user_id, product_id, quantity: the carts after the rows that ``cart_updates`` has given so far."""
    last = updates.filter("kind <> 'CLEAR'").groupBy("user_id", "product_id").agg(F.max(F.struct("step", "quantity")).alias("l"))
    clears = updates.filter("kind = 'CLEAR'").groupBy("user_id").agg(F.max("step").alias("cleared"))
    return (last.join(clears, "user_id", "left").filter(F.col("l.step") > F.coalesce("cleared", F.lit(0)))
            .filter("l.quantity > 0").select("user_id", "product_id", F.col("l.quantity").alias("quantity")))


def start_cart_stream(command_stream: DataFrame, users: DataFrame, products: DataFrame, out: str, checkpoint: str, trigger: dict | None = None):
    """J4 with Spark's parquet file sink at ``out``; ``cart_of`` of that table are the carts."""
    w = cart_updates(command_stream, users, products).writeStream.format("parquet").outputMode("append")
    return w.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start(out)


# ---------------------------------------------------------------- inventory
#: A batch whose number is a multiple of this writes its whole state, the others the changed keys.
WHOLE_EVERY = 20
STATE = {"stock": ("product_id", "product_id LONG, stock LONG"),
         "orders": ("order_id", "order_id LONG, user_id LONG, open BOOLEAN, lines ARRAY<STRUCT<product_id: LONG, quantity: INT>>")}


def _latest(spark: SparkSession, root: str, name: str, first: int, end: int) -> DataFrame:
    """The last row of every key among the state rows that the batches first .. end - 1 have written."""
    key, schema = STATE[name]
    parts = [spark.read.schema(schema).parquet(f"{root}/{name}/batch={b}").withColumn("batch", F.lit(b)) for b in range(first, end)]
    if not parts:
        return spark.createDataFrame([], schema)
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    names = [c for c in rows.columns if c not in (key, "batch")]
    return rows.groupBy(key).agg(F.max_by(F.struct(*names), "batch").alias("s")).select(key, "s.*")


def inventory_state(spark: SparkSession, out_root: str, name: str, batches: int) -> DataFrame:
    """``stock`` (product_id, stock) or ``orders`` (order_id, user_id, open, lines) after the first ``batches`` batches."""
    return _latest(spark, out_root.rstrip("/"), name, max(0, (batches - 1) // WHOLE_EVERY * WHOLE_EVERY), batches)


def start_inventory_stream(command_stream: DataFrame, opening_stock: DataFrame, out_root: str,
                           checkpoint: str, trigger: dict | None = None):
    """Admission + inventory audit per micro-batch.

    ``command_stream`` rows: seq, kind (ORDER/CANCEL/ADJUST), order_id,
    user_id, product_id, quantity (ORDER rows carry one line each), reason.
    Batch N overwrites the partition ``batch=N`` of decisions/, audit/, stock/
    and orders/ under ``out_root`` (a shared folder on a cluster) and reads
    only partitions before N, so a batch that Spark's checkpoint replays gives
    the same files again.  stock/ and orders/ hold the keys that the batch has
    changed, and all keys every ``WHOLE_EVERY`` batches.  Orders admitted in
    earlier batches enter as decided: their stock stays taken whatever seq
    comes later, a cancel of an open one puts it back, a second one finds it closed.
    """
    root = out_root.rstrip("/")

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = cut_lineage(batch)
        if batch_id:
            stock0, orders0 = (inventory_state(spark, root, name, batch_id) for name in ("stock", "orders"))
        else:
            stock0, orders0 = opening_stock.select(F.col("product_id").cast("long"), F.col("stock").cast("long")), _latest(spark, root, "orders", 0, 0)
        o = batch.filter(F.col("kind") == "ORDER")
        orders = o.groupBy("order_id").agg(F.min("seq").alias("seq"), F.first("user_id").alias("user_id"))
        lines = o.select("order_id", "product_id", "quantity")
        cancels = batch.filter(F.col("kind") == "CANCEL").select("seq", "order_id", "user_id")
        adjust = batch.filter(F.col("kind") == "ADJUST").select("seq", "product_id", F.col("quantity").alias("delta"), "reason")
        standing = cut_lineage(orders0.join(cancels.select("order_id").distinct(), "order_id", "left_semi"))
        old_lines = standing.filter("open").select("order_id", F.inline("lines"))
        decisions, moves, final = admit_commands(stock0, orders, lines.unionByName(old_lines), cancels, adjust, standing=standing.drop("lines"))
        decisions, moves = cut_lineage(decisions), cut_lineage(moves)

        def write(df: DataFrame, name: str) -> None:
            df.write.mode("overwrite").parquet(f"{root}/{name}/batch={batch_id}")

        write(decisions, "decisions")
        write(inventory_audit(stock0, moves, order=("seq", "movement_id")), "audit")
        closed = decisions.filter(F.col("outcome") == "CANCELLED").select(F.col("ref_id").alias("order_id"), "user_id")
        held = lines.groupBy("order_id").agg(F.collect_list(F.struct("product_id", "quantity")).alias("lines"))
        opened = (decisions.filter(F.col("outcome") == "PLACED").select(F.col("ref_id").alias("order_id"), "user_id")
                  .join(closed, "order_id", "left_anti").join(held, "order_id").select("order_id", "user_id", F.lit(True).alias("open"), "lines"))
        none = F.lit(None).cast(opened.schema["lines"].dataType)
        changed = opened.unionByName(closed.select("order_id", "user_id", F.lit(False).alias("open"), none.alias("lines")))
        if batch_id % WHOLE_EVERY:
            final = final.join(moves.select("product_id").distinct(), "product_id", "left_semi")
        else:
            changed = orders0.join(changed, "order_id", "left_anti").unionByName(changed)
        write(final, "stock")
        write(changed, "orders")

    w = command_stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()
