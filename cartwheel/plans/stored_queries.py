"""Order reports over stored, bucketed tables (A10 written, A1 read back).

Orders and order items are written by ``store_tables`` into the shared
checkpoint folder, dealt by order, and read back co-located: the header and
line joins and the sums per order need no shuffle of the lines.
"""

from __future__ import annotations

import uuid

from ..operators import analytics as E
from ..operators import orders as D
from ..session import ensure_checkpoint_dir
from ..sources.tables import store_tables, stored_table
from . import queries as Q
from .registry import REGISTRY, register


def stored_orders(v):
    """(orders, order_items) of the views, written and read back."""
    prefix = f"stored_{uuid.uuid4().hex}"
    root = f"{ensure_checkpoint_dir(v.spark).rstrip('/')}/cartwheel-stored/{prefix}"
    tables = {"orders": v.orders, "order_items": v.order_items}
    # read after the views have sized the shuffles
    buckets = int(v.spark.conf.get("spark.sql.shuffle.partitions"))
    store_tables(tables, root, prefix, buckets)
    return stored_table(v.spark, "orders", prefix), stored_table(v.spark, "order_items", prefix)


def _history(v):
    orders, items = stored_orders(v)
    return Q._flat_history(D.order_history(orders, items, v.products))


def _list(v):
    orders, items = stored_orders(v)
    return D.order_list(v.users, orders, items)


def _top_products(v):
    orders, items = stored_orders(v)
    return E.top_products(items, orders, v.products)


def _purchases(v):
    orders, items = stored_orders(v)
    return E.purchase_history(v.users, orders, items)


# the rows are those of the same reports over unstored tables
for _name, _fn in (("order_history", _history), ("order_list", _list), ("top_products", _top_products),
                   ("purchase_history", _purchases)):
    register(f"stored_{_name}", sql=REGISTRY[_name][1], whole_sql=True)(_fn)
