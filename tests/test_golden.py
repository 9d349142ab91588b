"""Golden values worked out by hand from the reference's seed (FIXTURES.md section 2)."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import analytics as E
from cartwheel.operators import audit as AU
from cartwheel.operators import cart as C
from cartwheel.operators import catalog as B
from cartwheel.operators import orders as D
from cartwheel.operators import quality as H
from cartwheel.operators.admission import admit_commands
from tests.seed import seed_tables


@pytest.fixture(scope="module")
def seed(spark):
    return seed_tables(spark)


def test_recompute_totals(seed):
    zero = seed["orders"].withColumn("total_amount", F.lit(0).cast("decimal(12,2)"))
    got = {r.order_id: r.total_amount for r in D.recompute_totals(zero, seed["order_items"]).collect()}
    assert got == {1: Decimal("5994.00"), 2: Decimal("8996.00"), 3: Decimal("6396.00")}


def test_completed_revenue(seed):
    assert E.completed_revenue(seed["orders"]).first()[0] == Decimal("14990.00")


def test_admin_summary(seed):
    r = E.admin_summary(seed["users"], seed["orders"], seed["products"]).first()
    assert (r.total_users, r.total_orders, r.placed_orders, r.completed_orders, r.cancelled_orders,
            r.gross_revenue, r.low_stock_products) == (10, 3, 1, 2, 0, Decimal("21386.00"), 0)


def test_top_products(seed):
    rows = E.top_products(seed["order_items"], seed["orders"], seed["products"]).collect()
    skus = {r.product_id: r.sku for r in seed["products"].collect()}
    got = [(skus[r.product_id], r.units_sold, r.revenue) for r in rows]
    assert got == [("FASH-001", 3, Decimal("1497.00")), ("BOOK-001", 2, Decimal("1598.00")),
                   ("BEAU-002", 2, Decimal("998.00")), ("BEAU-001", 2, Decimal("698.00")),
                   ("HOME-003", 1, Decimal("6999.00")), ("FASH-003", 1, Decimal("3199.00")),
                   ("ELEC-002", 1, Decimal("2899.00")), ("SPORT-002", 1, Decimal("2499.00")),
                   ("SPORT-004", 1, Decimal("999.00"))]


def test_low_stock_none(seed):
    assert E.low_stock(seed["products"]).count() == 0


def test_purchase_history(seed):
    rows = E.purchase_history(seed["users"], seed["orders"], seed["order_items"]).collect()
    top = [(r.full_name, r.total_orders, r.total_items_bought, r.total_spent) for r in rows[:3]]
    assert top == [("Diana Lee", 1, 4, Decimal("8996.00")), ("Ethan Brown", 1, 4, Decimal("6396.00")),
                   ("Charlie Davis", 1, 6, Decimal("5994.00"))]
    assert all((r.total_orders, r.total_items_bought, r.total_spent) == (0, 0, Decimal("0.00")) for r in rows[3:])
    assert len(rows) == 10


def test_above_average_spenders(seed):
    rows = E.above_average_spenders(seed["users"], seed["orders"]).collect()
    assert [r.full_name for r in rows] == ["Diana Lee", "Ethan Brown", "Charlie Davis"]


def test_cart_lines_and_summary(seed):
    lines = C.cart_lines(seed["users"], seed["carts"], seed["cart_items"], seed["products"]).collect()
    alice = [(r.product_name, r.quantity, r.price) for r in lines if r.user_id == 1]
    assert alice == [("Advanced SQL Patterns", 1, Decimal("999.00")), ("Wireless Mouse", 2, Decimal("799.00"))]
    s = {r.user_id: (r.item_count, r.total_amount) for r in
         C.cart_summary(seed["users"], seed["carts"], seed["cart_items"], seed["products"], nested=True).collect()}
    assert s[1] == (2, Decimal("2597.00")) and s[2] == (2, Decimal("2598.00")) and s[3] == (0, Decimal("0.00"))


def test_featured(seed):
    rows = B.featured_products(seed["products"], seed["categories"]).collect()
    assert [(r.sku, r.price) for r in rows] == [("ELEC-004", Decimal("7499.00")), ("HOME-003", Decimal("6999.00")),
                                                ("ELEC-003", Decimal("5499.00")), ("FASH-003", Decimal("3199.00"))]


def test_classifier_uses_sku_prefix(seed):
    keys = {r.sku: r.category_key for r in B.classify_products(seed["products"], seed["categories"]).collect()}
    assert keys["ELEC-001"] == "electronics" and keys["BOOK-003"] == "books" and keys["BEAU-004"] == "beauty"


def test_seed_orders_take_stock_and_audit(spark, seed):
    stock0 = seed["products"].select("product_id", F.col("stock_qty").cast("long").alias("stock"))
    orders = seed["orders"].select(F.col("order_id").alias("seq"), "order_id", "user_id")
    lines = seed["order_items"].select("order_id", "product_id", "quantity")
    dec, moves, final = admit_commands(stock0, orders, lines)
    assert {r.outcome for r in dec.collect()} == {"PLACED"}
    skus = {r.product_id: r.sku for r in seed["products"].collect()}
    after = {skus[r.product_id]: r.stock for r in final.collect()}
    want = {"ELEC-002": 49, "BOOK-001": 73, "FASH-001": 117, "HOME-003": 17, "BEAU-002": 60, "SPORT-004": 54,
            "FASH-003": 32, "SPORT-002": 24, "BEAU-001": 83}
    assert {k: after[k] for k in want} == want
    audit = AU.inventory_audit(stock0, moves, order=("seq", "movement_id")).collect()
    assert len(audit) == 9
    assert {r.reason for r in audit} == {"ORDER_PLACED_STOCK_REDUCTION"}
    assert all(r.change_qty < 0 and r.related_order_id is not None for r in audit)


def test_order_status_audit_seed(spark, seed):
    log = seed["orders"].select(F.col("order_id").alias("seq"), "order_id", "order_status",
                                F.col("placed_at").alias("at"))
    rows = AU.order_status_audit(log).collect()
    assert sorted((r.old_status, r.new_status, r.note) for r in rows) == [
        (None, "COMPLETED", "ORDER_CREATED"), (None, "COMPLETED", "ORDER_CREATED"), (None, "PLACED", "ORDER_CREATED")]


def test_seed_has_no_violations(seed):
    assert H.check_constraints(seed).count() == 0


@pytest.mark.parametrize("table,bad", [
    ("users", {"email": "alice@example.com"}),           # duplicate email
    ("products", {"category_id": 99999, "sku": "NEW-1"}),  # missing category
    ("products", {"price": Decimal("0.00"), "sku": "NEW-2"}),  # CHECK price > 0
    ("orders", {"order_status": "SHIPPED", "total_amount": Decimal("0.00")}),  # status domain
    ("users", {"full_name": "x" * 121, "email": "x@y.z"}),  # VARCHAR(120)
])
def test_one_violation_each(spark, seed, table, bad):
    df = seed[table]
    first = df.limit(1)
    changed = first.select(*[F.lit(bad[c]).cast(df.schema[c].dataType).alias(c) if c in bad else F.col(c)
                             for c in df.columns])
    key = df.columns[0]
    changed = changed.withColumn(key, F.lit(10_000).cast("bigint"))
    tables = dict(seed)
    tables[table] = df.unionByName(changed)
    got = H.check_constraints(tables).collect()
    assert len(got) == 1 and got[0].table_name == table
