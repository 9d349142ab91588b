"""Streaming = batch: J1-J4 over a log split into micro-batches."""

import datetime as dt
import os

from pyspark.sql import functions as F

from cartwheel.operators.accounts import fold_sessions, start_sessions
from cartwheel.operators.admission import admit_commands
from cartwheel.operators.audit import order_status_audit
from cartwheel.streaming import (cart_of, inventory_state, jobs, order_audit_updates, session_updates, start_cart_stream,
                                 start_inventory_stream)
from tests.conftest import SF001


def _write_parts(df, root, key, n):
    for i in range(n):
        df.filter(F.col(key) == i).drop(key).coalesce(1).write.parquet(f"{root}/part{i:03d}")
    return [f"{root}/part{i:03d}" for i in range(n)]


def _stream_dir(spark, root, schema):
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true").parquet(root))


def test_order_audit_stream_equals_batch(spark, tmp_path):
    from cartwheel.sources.views import ShopViews
    log = ShopViews(spark, SF001).order_status_log
    staged = log.withColumn("_b", (F.col("seq") % 4) - 1)      # created / touched / final writes
    _write_parts(staged, str(tmp_path / "in"), "_b", 3)
    stream = _stream_dir(spark, str(tmp_path / "in"), log.schema)
    q = (order_audit_updates(stream, watermark="10000 days").writeStream.format("memory").queryName("audit_out")
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted(tuple(r) for r in spark.table("audit_out").collect())
    want = sorted(tuple(r) for r in order_status_audit(log).select(
        "audit_id", "order_id", "old_status", "new_status", "note", "changed_at").collect())
    assert got == want


def test_session_stream_equals_batch(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    h = dt.timedelta(hours=1)
    ev = [(10, 10, 7, "LOGIN", t0), (11, 11, 8, "LOGIN", t0 + h), (12, 10, 7, "USE", t0 + 2 * h),
          (13, 10, 7, "USE", t0 + 3 * h), (14, 10, 7, "LOGOUT", t0 + 4 * h), (15, 10, 7, "USE", t0 + 5 * h),
          (16, 11, 8, "USE", t0 + 30 * h)]
    df = spark.createDataFrame([e + (i // 3,) for i, e in enumerate(ev)],
                               "seq LONG, session_id LONG, user_id LONG, kind STRING, at TIMESTAMP_NTZ, _b INT")
    _write_parts(df, str(tmp_path / "in"), "_b", 3)
    schema = "seq LONG, session_id LONG, user_id LONG, kind STRING, at TIMESTAMP_NTZ"
    stream = _stream_dir(spark, str(tmp_path / "in"), schema)
    q = (session_updates(stream).writeStream.format("memory").queryName("sess_out").outputMode("update")
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    rows = spark.table("sess_out").collect()
    last = {}
    for r in rows:
        last[r.session_id] = r
    logins = df.filter(F.col("kind") == "LOGIN").select("seq", "user_id", "at", F.lit("t").alias("token"))
    want = {r.session_id: r for r in fold_sessions(start_sessions(logins, "test secret"), df.drop("_b")).collect()}
    for sid, w in want.items():
        g = last[sid]
        assert (g.revoked_at, g.last_used_at, g.refused_uses) == (w.revoked_at, w.last_used_at, w.refused_uses)


COMMANDS = "seq LONG, kind STRING, order_id LONG, user_id LONG, product_id LONG, quantity INT, reason STRING"


def _inventory(spark, tmp_path, stock0, rows):
    """Decisions by seq and the stock after the last batch."""
    df = spark.createDataFrame(rows, COMMANDS + ", _b INT")
    n = max(r[-1] for r in rows) + 1
    _write_parts(df, str(tmp_path / "in"), "_b", n)
    out = str(tmp_path / "out")
    opening = spark.createDataFrame(list(stock0.items()), "product_id BIGINT, stock BIGINT")
    start_inventory_stream(_stream_dir(spark, str(tmp_path / "in"), COMMANDS), opening, out, str(tmp_path / "ck")).awaitTermination()
    decisions = {r.seq: r.outcome for b in range(n) for r in spark.read.parquet(f"{out}/decisions/batch={b}").collect()}
    return decisions, {r.product_id: r.stock for r in inventory_state(spark, out, "stock", n).collect()}, out


def test_inventory_stream_equals_batch(spark, tmp_path):
    rows = [(1, "ORDER", 100, 7, 1, 3, None, 0), (1, "ORDER", 100, 7, 2, 1, None, 0),
            (2, "ORDER", 101, 8, 1, 3, None, 0), (3, "CANCEL", 100, 7, None, None, None, 1),
            (4, "ORDER", 102, 8, 1, 4, None, 1), (5, "ADJUST", None, None, 2, -2, " fix ", 1)]
    _, got, out = _inventory(spark, tmp_path, {1: 5, 2: 3}, rows)
    stock0 = spark.createDataFrame([(1, 5), (2, 3)], "product_id BIGINT, stock BIGINT")
    df = spark.createDataFrame(rows, COMMANDS + ", _b INT")
    orders = df.filter(F.col("kind") == "ORDER").groupBy("order_id").agg(F.min("seq").alias("seq"),
                                                                      F.first("user_id").alias("user_id"))
    _, _, final = admit_commands(stock0, orders, df.filter(F.col("kind") == "ORDER").select(
        "order_id", "product_id", "quantity"), df.filter(F.col("kind") == "CANCEL").select(
        "seq", "order_id", "user_id"), df.filter(F.col("kind") == "ADJUST").select(
        "seq", "product_id", F.col("quantity").alias("delta"), "reason"))
    assert got == {r.product_id: r.stock for r in final.collect()} == {1: 1, 2: 1}
    back = [r for r in spark.read.parquet(f"{out}/audit/batch=1").collect() if r.related_order_id == 100]
    assert sorted((r.product_id, r.change_qty, r.reason) for r in back) == [(1, 3, "ORDER_CANCELLED_RESTOCK"), (2, 1, "ORDER_CANCELLED_RESTOCK")]


def test_orders_of_earlier_batches_are_decided(spark, tmp_path):
    """A late, older seq does not take the stock of an admitted order; a second cancel finds the order closed."""
    rows = [(10, "ORDER", 1, 7, 1, 4, None, 0), (5, "ORDER", 2, 8, 1, 3, None, 1), (11, "CANCEL", 1, 9, None, None, None, 1),
            (12, "CANCEL", 1, 7, None, None, None, 2), (6, "ORDER", 3, 8, 1, 5, None, 2), (13, "CANCEL", 1, 7, None, None, None, 3),
            (14, "CANCEL", 2, 8, None, None, None, 3), (15, "ORDER", 4, 8, 1, 5, None, 3), (16, "CANCEL", 4, 8, None, None, None, 3)]
    got, stock, _ = _inventory(spark, tmp_path, {1: 5}, rows)
    assert got == {10: "PLACED", 5: "INSUFFICIENT_STOCK", 11: "NOT_OWNER", 12: "CANCELLED", 6: "INSUFFICIENT_STOCK", 13: "NOT_PLACED",
                   14: "NOT_FOUND", 15: "PLACED", 16: "CANCELLED"}
    assert stock == {1: 5}


def test_inventory_state_is_changed_keys(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "WHOLE_EVERY", 2)
    rows = [(b + 1, "ORDER", b + 1, 7, b % 3, 1, None, b) for b in range(5)] + [(20, "CANCEL", 1, 7, None, None, None, 4)]
    _, stock, out = _inventory(spark, tmp_path, {0: 9, 1: 9, 2: 9, 3: 9}, rows)
    assert stock == {0: 8, 1: 7, 2: 8, 3: 9}
    assert [spark.read.parquet(f"{out}/stock/batch={b}").count() for b in range(5)] == [4, 1, 4, 1, 4]
    assert {r.order_id: r.open for r in inventory_state(spark, out, "orders", 5).collect()} == {1: False, 2: True, 3: True, 4: True, 5: True}
    assert not [f for _, _, files in os.walk(out) for f in files if f == "_COMMITTED"]


def test_cart_stream_equals_batch(spark, tmp_path):
    import random

    from cartwheel.operators.cart_fold import fold_cart
    from tests.test_cart_fold import random_cart_log
    cmds, users, products = random_cart_log(random.Random(11), n=40)
    cols = "seq BIGINT, user_id BIGINT, kind STRING, product_id BIGINT, quantity INT"
    df = spark.createDataFrame(cmds, cols)
    staged = df.withColumn("_b", (F.col("seq") > 60).cast("int") + (F.col("seq") > 130).cast("int"))   # batches in seq order
    _write_parts(staged, str(tmp_path / "in"), "_b", 3)
    u = spark.createDataFrame(list(users.items()), "user_id BIGINT, is_active BOOLEAN")
    p = spark.createDataFrame([(k, s, a) for k, (s, a) in products.items()],
                              "product_id BIGINT, stock_qty INT, is_active BOOLEAN")
    out = str(tmp_path / "out")
    start_cart_stream(_stream_dir(spark, str(tmp_path / "in"), cols), u, p, out, str(tmp_path / "ck")).awaitTermination()
    told = spark.read.parquet(out)
    want_out, want_state = fold_cart(df, u, p)
    assert {r.seq: r.outcome for r in told.collect()} == {r.seq: r.outcome for r in want_out.collect()} and told.count() == len(cmds)
    carts = {(r.user_id, r.product_id): r.quantity for r in want_state.collect()}
    assert {(r.user_id, r.product_id): r.quantity for r in cart_of(told).collect()} == carts
    kept = spark.read.format("statestore").option("stateVarName", "lines").load(str(tmp_path / "ck"))
    assert _lines(kept) == carts


def _lines(state):
    """(user, product) -> quantity of the map state of the carts."""
    if "map_value" in state.columns:
        return {(r.key[0], k[0]): v[0] for r in state.collect() for k, v in r.map_value.items()}
    return {(r.key[0], r.user_map_key[0]): r.user_map_value[0] for r in state.collect()}


def test_state_of_closed_orders_expires(spark, tmp_path):
    t0, day = dt.datetime(2024, 1, 1), dt.timedelta(days=1)
    schema = "seq LONG, order_id LONG, order_status STRING, at TIMESTAMP_NTZ"
    log = [(1, 1, "PLACED", t0, 0), (2, 2, "PLACED", t0, 0), (3, 1, "COMPLETED", t0 + day, 1), (4, 3, "PLACED", t0 + 9 * day, 2),
           (5, 2, "PLACED", t0 + 9 * day, 2), (6, 1, "COMPLETED", t0 + 10 * day, 3)]
    _write_parts(spark.createDataFrame(log, schema + ", _b INT"), str(tmp_path / "in"), "_b", 4)
    q = (order_audit_updates(_stream_dir(spark, str(tmp_path / "in"), schema), keep_ms=2 * jobs.DAY_MS, watermark="1 day").writeStream.format("memory")
         .queryName("audit_ttl").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    assert q.awaitTermination(120)
    assert sorted((r.audit_id, r.old_status, r.new_status) for r in spark.table("audit_ttl").collect()) == [
        (1, None, "PLACED"), (2, None, "PLACED"), (3, "PLACED", "COMPLETED"), (4, None, "PLACED"), (6, None, "COMPLETED")]
    state = spark.read.format("statestore").option("stateVarName", "last").load(str(tmp_path / "ck"))
    assert {r.key[0]: r.value[0] for r in state.collect()} == {1: "COMPLETED", 2: "PLACED", 3: "PLACED"}


def test_session_stream_after_expiry(spark, tmp_path):
    """A use behind the watermark and one after the state is gone: refused, and the stream goes on."""
    t0, h = dt.datetime(2024, 1, 1), dt.timedelta(hours=1)
    ev = [(1, 1, 7, "LOGIN", t0), (2, 2, 8, "LOGIN", t0 + 48 * h), (3, 1, 7, "USE", t0 + 49 * h), (4, 1, 7, "USE", t0 + 50 * h)]
    schema = "seq LONG, session_id LONG, user_id LONG, kind STRING, at TIMESTAMP_NTZ"
    df = spark.createDataFrame([e + (i,) for i, e in enumerate(ev)], schema + ", _b INT")
    _write_parts(df, str(tmp_path / "in"), "_b", 4)
    q = (session_updates(_stream_dir(spark, str(tmp_path / "in"), schema)).writeStream.format("memory").queryName("sess_late")
         .outputMode("update").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    rows = [r for r in spark.table("sess_late").collect() if r.session_id == 1]
    known = [r for r in rows if r.user_id is not None]
    late = sum(r.refused_uses for r in rows if r.user_id is None)
    logins = df.filter(F.col("kind") == "LOGIN").select("seq", "user_id", "at", F.lit("t").alias("token"))
    want = {r.session_id: r for r in fold_sessions(start_sessions(logins, "test secret"), df.drop("_b")).collect()}[1]
    assert known[-1].closed and known[-1].refused_uses + late == want.refused_uses == 2
    assert known[-1].last_used_at is None and known[-1].expires_at == want.expires_at
    state = spark.read.format("statestore").option("stateVarName", "session").load(str(tmp_path / "ck"))
    assert [r.key[0] for r in state.collect()] == [2]  # the expired session is forgotten
