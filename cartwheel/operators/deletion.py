"""What deleting rows does to the tables that refer to them.

Foreign keys are data.  Deletions run from the roots down the CASCADE keys
(to a fixed point, so keys may form cycles); a row that refers to a deleted
row by a RESTRICT key and is not deleted itself blocks every root that
reaches the deleted row, and nothing that only a blocked root reaches goes.
The roots left are the largest set that can be deleted together: where a
blocking row lies among the reached rows, blocks are followed until no more
root is blocked.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


class ForeignKey(NamedTuple):
    child: str
    column: str
    parent: str
    on_delete: str


# The keys of the shop tables and their foreign keys.
PRIMARY_KEYS = {
    "users": "user_id", "categories": "category_id", "products": "product_id", "carts": "cart_id", "cart_items": "cart_item_id",
    "orders": "order_id", "order_items": "order_item_id", "inventory_audit": "audit_id", "order_audit": "audit_id", "user_sessions": "session_id",
}
FOREIGN_KEYS = [
    ForeignKey("products", "category_id", "categories", "RESTRICT"),
    ForeignKey("carts", "user_id", "users", "CASCADE"),
    ForeignKey("cart_items", "cart_id", "carts", "CASCADE"),
    ForeignKey("cart_items", "product_id", "products", "RESTRICT"),
    ForeignKey("orders", "user_id", "users", "RESTRICT"),
    ForeignKey("order_items", "order_id", "orders", "CASCADE"),
    ForeignKey("order_items", "product_id", "products", "RESTRICT"),
    ForeignKey("inventory_audit", "product_id", "products", "RESTRICT"),
    ForeignKey("inventory_audit", "related_order_id", "orders", "RESTRICT"),
    ForeignKey("order_audit", "order_id", "orders", "CASCADE"),
    ForeignKey("user_sessions", "user_id", "users", "CASCADE"),
]


def _order(root: str, cascades: Sequence[ForeignKey]) -> list[str] | None:
    """The tables that deletions from ``root`` reach, parents first; None if their keys form a cycle."""
    reach, todo = {root}, [root]
    while todo:
        parent = todo.pop()
        for k in cascades:
            if k.parent == parent and k.child not in reach:
                reach.add(k.child)
                todo.append(k.child)
    order: list[str] = []
    while len(order) < len(reach):
        free = [t for t in sorted(reach - set(order)) if all(k.parent in order for k in cascades if k.child == t and k.parent in reach)]
        if not free:
            return None
        order += free
    return order


def _children(tables: dict[str, DataFrame], keys: dict[str, str], k: ForeignKey, of: DataFrame) -> DataFrame:
    """key and root of the rows of ``k.child`` that refer to the (key, root) rows ``of``."""
    child = tables[k.child].select(F.col(keys[k.child]).cast("long").alias("key"), F.col(k.column).cast("long").alias("__ref"))
    return child.join(of.select(F.col("key").alias("__ref"), "root"), "__ref").select("key", "root")


def _reached(tables: dict[str, DataFrame], keys: dict[str, str], root: str, ids: DataFrame, cascades: Sequence[ForeignKey]) -> dict[str, DataFrame]:
    """table -> (key, root): the rows that the deletion of each root reaches."""
    order = _order(root, cascades)
    if order is not None:  # one pass, parents first
        found = {root: ids}
        for table in order[1:]:
            parts = [_children(tables, keys, k, found[k.parent]) for k in cascades if k.child == table and k.parent in found]
            every = reduce(DataFrame.unionByName, parts)
            found[table] = every.distinct() if len(parts) > 1 else every
        return found
    found, new = {root: cut_lineage(ids)}, {}
    new[root] = found[root]
    while new:
        below: dict[str, list[DataFrame]] = {}
        for k in cascades:
            if k.parent in new:
                below.setdefault(k.child, []).append(_children(tables, keys, k, new[k.parent]))
        new = {}
        for table, parts in below.items():
            rows = reduce(DataFrame.unionByName, parts).distinct()
            if table in found:
                rows = rows.join(found[table], ["key", "root"], "left_anti")
            rows = cut_lineage(rows)
            if not rows.isEmpty():
                new[table] = rows
                found[table] = rows if table not in found else found[table].unionByName(rows)
    return found


def delete_closure(tables: dict[str, DataFrame], root: str, ids: DataFrame, keys: dict[str, str] = PRIMARY_KEYS,
                   foreign: Sequence[ForeignKey] = tuple(FOREIGN_KEYS)) -> DataFrame:
    """table_name, key (text), action: BLOCKED for roots that must stay, DELETED for every row that goes.

    ``ids`` has the root table's key column; ids that do not exist and
    repeated ones do nothing.  Nothing is deleted here: the report drives the rewrite.
    Only ids travel; every step is a join on one key.
    """
    cascades = [k for k in foreign if k.on_delete == "CASCADE"]
    known = tables[root].select(F.col(keys[root]).cast("long").alias("key"))
    roots = ids.select(F.col(keys[root]).cast("long").alias("key")).distinct().join(known, "key", "left_semi")
    found = _reached(tables, keys, root, roots.select("key", F.col("key").alias("root")), cascades)
    refusing = [k for k in foreign if k.on_delete != "CASCADE" and k.parent in found]
    inner = any(k.child in found for k in refusing)
    blocked = None
    while True:
        live = found if blocked is None else {t: d.join(blocked, "root", "left_anti") for t, d in found.items()}
        parts = []
        for k in refusing:
            rows = _children(tables, keys, k, live[k.parent])
            if k.child in live:  # rows that go as well do not block
                rows = rows.join(live[k.child].select("key").distinct(), "key", "left_anti")
            parts.append(rows.select("root"))
        more = reduce(DataFrame.unionByName, parts).distinct() if parts else roots.select(F.col("key").alias("root")).limit(0)
        if not inner:
            blocked = more
            break
        more = cut_lineage(more)
        if more.isEmpty():
            blocked = more if blocked is None else blocked
            break
        blocked = more if blocked is None else cut_lineage(blocked.unionByName(more))
    out = [blocked.select(F.lit(root).alias("table_name"), F.col("root").cast("string").alias("key"), F.lit("BLOCKED").alias("action"))]
    for table, rows in found.items():
        gone = rows.join(blocked, "root", "left_anti").select("key").distinct()  # several roots may reach a row
        out.append(gone.select(
            F.lit(table).alias("table_name"), F.col("key").cast("string").alias("key"), F.lit("DELETED").alias("action")))
    return reduce(DataFrame.unionByName, out)
