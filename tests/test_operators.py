"""Small-fixture unit tests of single operators and expressions."""

import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cartwheel.functions.scalars import movement_reason, rating_expr, stars_expr, token_hash
from cartwheel.operators import catalog as B
from cartwheel.operators import maintenance as A
from cartwheel.operators.accounts import find_users
from cartwheel.operators.wishlist import wishlist_state


def test_rating_and_stars(spark):
    df = spark.range(1, 13).select(F.col("id").alias("product_id"))
    rows = {r.product_id: (r.rating, r.stars) for r in
            df.select("product_id", rating_expr().alias("rating")).withColumn("stars", stars_expr()).collect()}
    for pid, (rating, stars) in rows.items():
        want = 3.8 + ((pid * 37) % 12) / 10
        assert abs(float(rating) - want) < 1e-9
        assert stars.count("★") == int(want + 0.5 + 1e-9) and len(stars) == 5
    got = B.filter_min_rating(B.with_rating(df), 4.5).collect()
    assert {r.product_id for r in got} == {p for p in range(1, 13) if 3.8 + ((p * 37) % 12) / 10 >= 4.5 - 1e-9}


def test_classifier_keywords(spark):
    df = spark.createDataFrame([(1, "x-1", "Gadgets", "USB Electric fan", None),
                                (2, " sport-9", None, "thing", None),
                                (3, "Q-1", "Misc", "Yoga Mat", "for the kitchen"),
                                (4, "Q-2", "Misc", "thing", None)],
                               "product_id LONG, sku STRING, category_name STRING, product_name STRING, description STRING")
    from cartwheel.functions.scalars import classify_expr
    got = {r.product_id: r.k for r in df.select("product_id", classify_expr().alias("k")).collect()}
    assert got == {1: "electronics", 2: "sports", 3: "home", 4: None}


def test_paginate_clamps(spark):
    df = spark.range(20).select(F.col("id").alias("product_id"))
    page = B.paginate(df, [F.col("product_id")], 99, size=9).collect()
    assert [r.product_id for r in page] == [18, 19] and page[0].page == 3 and page[0].total_pages == 3
    assert B.paginate(df.filter("false"), [F.col("product_id")], 5).count() == 0


def test_movement_reason(spark):
    df = spark.createDataFrame([("ORDER", None), ("CANCEL", None), ("ADJUST", "  "), ("ADJUST", " audit fix "),
                                ("OTHER", None)], "kind STRING, reason STRING")
    got = [r[0] for r in df.select(movement_reason()).collect()]
    assert got == ["ORDER_PLACED_STOCK_REDUCTION", "ORDER_CANCELLED_RESTOCK", "MANUAL_ADJUSTMENT", "audit fix",
                   "STOCK_UPDATED"]


def test_token_hash_matches_hashlib(spark):
    got = spark.createDataFrame([("abc",)], "token STRING").select(token_hash("token", "s3")).first()[0]
    assert got == hashlib.sha256(b"abc:s3").hexdigest()


def test_wishlist_toggles(spark):
    t = spark.createDataFrame([(1, 7, 5), (2, 7, 6), (3, 7, 5), (4, 7, 5), (5, 7, 0), (6, 7, -3), (7, 7, None),
                               (8, 7, 9)], "seq LONG, user_id LONG, product_id LONG")
    got = [(r.product_id, r.position) for r in wishlist_state(t).orderBy("position").collect()]
    assert got == [(6, 1), (5, 2), (9, 3)]   # 5 re-added at seq 4 moves behind 6


def test_insert_ignore_and_upsert(spark):
    tgt = spark.createDataFrame([(1, 10, 2, dt.datetime(2024, 1, 1))], "cart_id LONG, product_id LONG, quantity INT, "
                                                                       "updated_at TIMESTAMP_NTZ")
    src = spark.createDataFrame([(5, 1, 10, 9, dt.datetime(2024, 1, 2)), (6, 1, 11, 3, dt.datetime(2024, 1, 2)),
                                 (7, 1, 11, 4, dt.datetime(2024, 1, 3))],
                                "seq LONG, cart_id LONG, product_id LONG, quantity INT, updated_at TIMESTAMP_NTZ")
    ins = {(r.cart_id, r.product_id): r.quantity for r in
           A.insert_ignore(tgt, src, ["cart_id", "product_id"]).collect()}
    assert ins == {(1, 10): 2, (1, 11): 3}
    with pytest.raises(ValueError):
        A.upsert(tgt, src.drop("seq"), ["cart_id", "product_id"], ["quantity"])
    one = src.filter("seq <> 7").drop("seq")
    up = {(r.cart_id, r.product_id): (r.quantity, r.updated_at) for r in
          A.upsert(tgt, one, ["cart_id", "product_id"], ["quantity"], as_of="2024-05-05 00:00:00").collect()}
    assert up == {(1, 10): (9, dt.datetime(2024, 5, 5)), (1, 11): (3, dt.datetime(2024, 1, 2))}


def test_resolve_keys_strict_and_drop(spark):
    prods = spark.createDataFrame([("A-1", 1), ("B-2", 2)], "sku STRING, product_id LONG")
    lines = spark.createDataFrame([("A-1", 3), ("Z-9", 1)], "sku STRING, quantity INT")
    ok, missing = A.resolve_keys(lines, prods, "sku", "product_id")
    assert [r.sku for r in ok.collect()] == ["A-1"] and [r.sku for r in missing.collect()] == ["Z-9"]
    assert A.resolve_keys(lines, prods, "sku", "product_id", "drop").count() == 1


def test_add_column_if_missing(spark):
    df = spark.createDataFrame([(1,)], "user_id LONG")
    out = A.add_column_if_missing(df, "is_admin", "boolean", False)
    assert out.first().is_admin is False
    assert A.add_column_if_missing(out, "is_admin", "boolean", True).first().is_admin is False


def test_find_users_case_folded(spark):
    users = spark.createDataFrame([(1, "A", "a@x.io", "h", True, False), (2, "B", "b@x.io", "h", True, True)],
                                  "user_id LONG, full_name STRING, email STRING, password_hash STRING, "
                                  "is_active BOOLEAN, is_admin BOOLEAN")
    look = spark.createDataFrame([("A@X.IO",)], "email STRING")
    assert [r.user_id for r in find_users(users, look).collect()] == [1]
    assert [r.user_id for r in find_users(users, spark.createDataFrame([(2,)], "user_id LONG"), by="id").collect()] == [2]


def test_search_like_keeps_wildcards(spark):
    p = spark.createDataFrame([(1, 1, "a_b", Decimal("1.00"), 1, True), (2, 1, "axb", Decimal("2.00"), 0, True),
                               (3, 1, "a%b", Decimal("3.00"), 1, False)],
                              "product_id LONG, category_id LONG, product_name STRING, price DECIMAL(12,2), "
                              "stock_qty INT, is_active BOOLEAN")
    p = p.withColumn("sku", F.lit("S")).withColumn("description", F.lit(None).cast("string")) \
         .withColumn("reorder_level", F.lit(1))
    c = spark.createDataFrame([(1, "C")], "category_id LONG, category_name STRING")
    assert {r.product_id for r in B.search_products(p, c, search="A_B").collect()} == {1, 2}
    assert {r.product_id for r in B.search_products(p, c, search="").collect()} == {1, 2}
    assert {r.product_id for r in B.search_products(p, c, min_price=1.5, in_stock_only=True).collect()} == set()


def test_cascade_delete_orders_and_products(spark):
    orders = spark.createDataFrame([(1,), (2,)], "order_id LONG")
    items = spark.createDataFrame([(11, 1, 5), (21, 2, 6)], "order_item_id LONG, order_id LONG, product_id LONG")
    oaudit = spark.createDataFrame([(100, 1), (200, 2)], "audit_id LONG, order_id LONG")
    iaudit = spark.createDataFrame([(5, 2)], "product_id LONG, related_order_id LONG")
    rep = {(r.table_name, r.key, r.action) for r in A.cascade_delete_orders(orders, orders, items, oaudit, iaudit).collect()}
    assert rep == {("orders", "2", "BLOCKED"), ("orders", "1", "DELETED"), ("order_items", "11", "DELETED"),
                   ("order_audit", "100", "DELETED")}
    prods = spark.createDataFrame([(5,), (6,), (7,)], "product_id LONG")
    carts = spark.createDataFrame([(7,)], "product_id LONG").limit(0)
    rep = {(r.key, r.action) for r in A.delete_products(prods, prods, carts, items, iaudit).collect()}
    assert rep == {("5", "BLOCKED"), ("6", "BLOCKED"), ("7", "DELETED")}


def test_touch_and_pseudonymise(spark):
    from cartwheel.operators.accounts import pseudonymise_token
    df = spark.createDataFrame([(1, "t1", dt.datetime(2024, 1, 1)), (2, "t2", dt.datetime(2024, 1, 1))],
                               "id LONG, token STRING, updated_at TIMESTAMP_NTZ")
    out = A.touch_updated_at(df, F.col("id") == 2, "2024-03-03 00:00:00").orderBy("id").collect()
    assert [r.updated_at for r in out] == [dt.datetime(2024, 1, 1), dt.datetime(2024, 3, 3)]
    h = pseudonymise_token(df, "token", "k", out="token_hash").orderBy("id").first()
    assert h.token_hash == hashlib.sha256(b"t1:k").hexdigest() and h.token == "t1"


def test_keys_past_the_padding_keep_all_digits(spark):
    from cartwheel.functions.scalars import padded
    got = [r[0] for r in spark.createDataFrame([(7,), (1234567,), (1234568,)], "k BIGINT").select(padded("k", 6)).collect()]
    assert got == ["000007", "1234567", "1234568"]


def test_line_ids_do_not_collide(spark, tmp_path):
    from cartwheel.sources.views import ShopViews
    spark.createDataFrame([(1, 2_000_000, 1.0), (3, 1, 2.0), (1, 1, 3.0), (1, 2_000_000, 1.0)], "l_orderkey BIGINT, l_partkey BIGINT, l_quantity DOUBLE") \
        .write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, 900.0), (2_000_000, 901.0)], "p_partkey BIGINT, p_retailprice DOUBLE").write.parquet(f"{tmp_path}/part.parquet")
    rows = ShopViews(spark, str(tmp_path)).order_items.collect()
    assert len(rows) == 3 and len({r.order_item_id for r in rows}) == 3


def test_search_takes_a_backslash_as_an_escape(spark):
    from cartwheel.operators.catalog import search_products
    p = spark.createDataFrame([(1, "S1", "a b", "d", 5, 1, 1, 1, True), (2, "S2", "50% off", "d", 5, 1, 1, 1, True), (3, "S3", "505 off", "d", 5, 1, 1, 1, True)],
                              "product_id BIGINT, sku STRING, product_name STRING, description STRING, price INT, stock_qty INT, reorder_level INT, category_id BIGINT, is_active BOOLEAN")
    c = spark.createDataFrame([(1, "c")], "category_id BIGINT, category_name STRING")
    ids = lambda s: sorted(r.product_id for r in search_products(p, c, search=s).collect())
    assert ids("a\\ b") == [1] and ids("50\\%") == [2] and ids("50%") == [2, 3]


def test_many_order_lines_are_dealt_to_more_tasks(spark, monkeypatch):
    """A task's share of the lines stays the same however many there are; few lines change no setting."""
    from cartwheel.plans import strategy
    from cartwheel.sources import ShopViews
    from tests.conftest import SF001
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.enabled")
    was = {n: spark.conf.get(n) for n in names}
    few = ShopViews(spark, SF001).order_items
    assert {n: spark.conf.get(n) for n in names} == was
    want = {r.order_item_id: r.asDict() for r in few.collect()}
    monkeypatch.setattr(strategy, "ROWS_PER_TASK", 250)
    monkeypatch.setattr(strategy, "TASK_BYTES", 4096)
    spark.conf.set(names[2], "false")  # the lines of the smallest tables are below the least size of a partition
    try:
        v = ShopViews(spark, SF001)
        lines = v.raw("lineitem").count()
        items = v.order_items
        assert int(spark.conf.get(names[0])) == -(-lines // 250) > 4
        assert int(spark.conf.get(names[1])) == 4096
        rows = items.withColumn("_task", F.spark_partition_id()).collect()
        share = {}
        for r in rows:
            share[r._task] = share.get(r._task, 0) + 1
        assert max(share.values()) < 4 * 250
        assert {r.order_item_id: {k: x for k, x in r.asDict().items() if k != "_task"} for r in rows} == want
        # finer settings stay
        spark.conf.set(names[0], "5000")
        ShopViews(spark, SF001).order_items
        assert spark.conf.get(names[0]) == "5000"
    finally:
        for n, x in was.items():
            spark.conf.set(n, x)
