"""Plan shape checks: pushdown, top-k, no Python in batch operators, no cartesian products."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwheel.operators import analytics as E
from cartwheel.operators import audit as AU
from cartwheel.operators import catalog as B
from cartwheel.operators import quality as H
from cartwheel.plans.strategy import running_total, top_k_per_group
from cartwheel.sources import ShopViews, load_table, write_table
from tests.conftest import SF001

import __spark_entry__ as ent


def plan(df) -> str:
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def views(spark):
    return ShopViews(spark, SF001)


def test_search_filters_reach_the_scan(spark, views, tmp_path):
    write_table(views.products, str(tmp_path / "products"))
    products = load_table(spark, "products", str(tmp_path / "products"))
    df = B.search_products(products, views.categories, category_id=2, in_stock_only=True, min_price=910)
    p = plan(df)
    assert "EqualTo(is_active,true)" in p and "EqualTo(category_id,2)" in p and "GreaterThan(stock_qty,0)" in p
    assert "GreaterThanOrEqual(price,910" in p


def test_top_products_is_take_ordered(views):
    assert "TakeOrderedAndProject" in plan(E.top_products(views.order_items, views.orders, views.products))


def test_above_average_has_no_cartesian_product(views):
    p = plan(E.above_average_spenders(views.users, views.orders))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


@pytest.mark.parametrize("name", ["top_products", "purchase_history", "related_products", "inventory_audit",
                                  "order_status_audit", "wishlist_state", "fold_sessions", "classify_products",
                                  "product_ratings", "constraint_violations", "ingest_products_accepted"])
def test_no_python_udf_in_batch_operators(spark, name):
    p = plan(ent.queries()[name](spark, SF001))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p


def test_running_total_chunked_equals_window(spark):
    rng = random.Random(3)
    rows = [(rng.choice([1, 1, 1, 1, 2, 3]), s, rng.randint(-5, 9)) for s in rng.sample(range(10_000), 400)]
    df = spark.createDataFrame(rows, "k BIGINT, seq BIGINT, v BIGINT")
    w = Window.partitionBy("k").orderBy("seq")
    want = {(r.k, r.seq): (r.a, r.b) for r in df.select(
        "k", "seq", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("a"),
        F.max("v").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("b")).collect()}
    got_a = running_total(df, ["k"], ["seq"], "v", "a", chunk_rows=17)
    got = running_total(got_a, ["k"], ["seq"], "v", "b", inclusive=False, agg="max", chunk_rows=17)
    assert {(r.k, r.seq): (r.a, r.b) for r in got.collect()} == want


def test_top_k_per_group_matches_row_number(spark):
    rng = random.Random(5)
    df = spark.createDataFrame([(rng.choice([1, 1, 1, 2]), i, rng.random()) for i in range(300)],
                               "g BIGINT, id BIGINT, x DOUBLE")
    got = {(r.g, r.rn, r.id) for r in top_k_per_group(df, ["g"], [F.col("x"), F.col("id")], 4, 8).collect()}
    w = Window.partitionBy("g").orderBy("x", "id")
    want = {(r.g, r.rn, r.id) for r in df.withColumn("rn", F.row_number().over(w)).filter("rn <= 4").collect()}
    assert got == want


def test_running_total_splits_null_keys_and_keeps_null_orders_first(spark):
    rows = [(None, None, 5), (1, None, 5)] + [(k, s, 1) for k in (None, 1) for s in range(9)]
    df = spark.createDataFrame(rows, "k BIGINT, seq BIGINT, v BIGINT")
    got = running_total(df, ["k"], ["seq"], "v", "total", chunk_rows=3)
    want = [(k, s, 5 if s is None else 6 + s) for k, s, _ in rows]
    assert sorted(((r.k, r.seq, r.total) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_newest_audit_rows_need_no_window_over_history(spark):
    rng = random.Random(11)
    start = dt.datetime(2024, 1, 1)
    moves = [(i, rng.choice([1, 1, 1, 2, 3, 99]), start + dt.timedelta(hours=rng.randint(0, 40)), rng.randint(-2, 2), "r", i)
             for i in range(300)]
    mv = spark.createDataFrame(moves, "movement_id BIGINT, product_id BIGINT, at TIMESTAMP_NTZ, delta INT, reason STRING, "
                                      "related_order_id BIGINT")
    stock0 = spark.createDataFrame([(1, 10), (2, 0), (3, 7), (4, 1)], "product_id BIGINT, stock INT")
    for n in (1, 25, 1000):
        newest = AU.newest_inventory_audit(AU.present_stock(stock0, mv), mv, n)
        whole = AU.inventory_audit(stock0, mv).orderBy(F.desc("changed_at"), F.desc("audit_id")).limit(n)
        assert newest.columns == whole.columns
        assert sorted(map(tuple, newest.collect())) == sorted(map(tuple, whole.collect()))
    p = newest._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("Window [") == 1 and p.index("Window [") < p.index("GlobalLimit")  # over the n rows alone


def test_keys_of_all_tables_meet_in_one_aggregate(spark):
    pairs = spark.createDataFrame([("x,y", "z", 1), ("x", "y,z", 1), ("a", "b", 2), ("a", "b", None), (None, "b", 3), (None, "b", 4)],
                                  "p STRING, q STRING, n INT")
    found = H.repeated_keys([("t", pairs, ["p", "q"], "UNIQUE"), ("t", pairs, ["n"], "PRIMARY_KEY"),
                             ("u", pairs.select(F.col("n").cast("bigint").alias("m")), ["m"], "UNIQUE")])
    assert sorted(map(tuple, found.collect())) == [
        ("t", "PRIMARY_KEY", "1", "n rows=2"), ("t", "UNIQUE", "a,b", "p,q rows=2"), ("u", "UNIQUE", "1", "m rows=2")]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [number") == 1


def test_references_are_one_join_and_read_parents_once(spark, views):
    tables = {n: getattr(views, n) for n in ("users", "products", "categories", "carts", "cart_items", "orders", "order_items")}
    p = H.reference_violations(tables)._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("Join LeftOuter") == 1 and p.count("Join LeftAnti") == 0
