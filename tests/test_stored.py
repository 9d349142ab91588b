"""Stored tables are read back under their declared schema and co-located."""

import re

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import analytics as E
from cartwheel.operators import orders as D
from cartwheel.schemas import schema
from cartwheel.sources import ShopViews, store_tables, stored_table
from tests.conftest import SF001
from tests.test_plans import plan

NAMES = ("orders", "order_items", "users", "products", "categories")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    v = ShopViews(spark, SF001)
    store_tables({n: getattr(v, n) for n in NAMES}, str(tmp_path_factory.mktemp("stored")), "test_shop", 4)
    yield v, {n: stored_table(spark, n, "test_shop") for n in NAMES}
    for n in NAMES:
        spark.sql(f"DROP TABLE test_shop_{n}")


def reports(t):
    return {"D6": D.order_history(t["orders"], t["order_items"], t["products"]),
            "D8": D.order_list(t["users"], t["orders"], t["order_items"]),
            "D9": D.recompute_totals(t["orders"], t["order_items"]),
            "E1": E.top_products(t["order_items"], t["orders"], t["products"]),
            "E4": E.purchase_history(t["users"], t["orders"], t["order_items"])}


def test_tables_come_back_whole_and_typed(stored):
    v, t = stored
    for n in NAMES:
        assert [(f.name, f.dataType) for f in t[n].schema] == [(f.name, f.dataType) for f in schema(n)]
        assert t[n].exceptAll(getattr(v, n).select(t[n].columns)).count() == 0
        assert t[n].count() == getattr(v, n).count()


@pytest.mark.parametrize("report", ["D6", "D8", "D9", "E1", "E4"])
def test_reports_do_not_shuffle_by_order(spark, stored, report):
    v, t = stored
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    # no table is small enough to be sent whole, as at scale; D6 joins names by product
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold if report == "D6" else "-1")
    try:
        p = plan(reports(t)[report])
        assert not re.search(r"hashpartitioning\(order_id", p), p
        assert "Bucketed: true" in p
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_reports_equal_those_over_views(stored):
    v, t = stored
    views = {n: getattr(v, n) for n in NAMES}
    for name, df in reports(t).items():
        want = reports(views)[name]
        got = df.select(*[F.col(c).cast("string") for c in want.columns]).collect()
        assert sorted(map(repr, got)) == sorted(map(repr, want.select(
            *[F.col(c).cast("string") for c in want.columns]).collect())), name


def test_the_prefix_is_a_word(spark):
    with pytest.raises(ValueError):
        stored_table(spark, "orders", "a.b; drop")
