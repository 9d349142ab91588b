"""Field rules one by one, and delete closures against a plain walk."""

import random

import pytest

from cartwheel.operators.deletion import FOREIGN_KEYS, PRIMARY_KEYS, ForeignKey, delete_closure
from cartwheel.operators.requests import RULES, accepted, broken_rules, with_broken_rules

PRODUCT = "id LONG, category_id LONG, sku STRING, product_name STRING, description STRING, price DOUBLE, stock_qty INT, reorder_level INT"
GOOD = (1, 1, "abc", "ab", None, 0.01, 0, None)


@pytest.mark.parametrize("changed, told", [
    ({}, []), ({"category_id": 0}, [("category_id", "above")]), ({"category_id": None}, [("category_id", "required")]),
    ({"sku": "ab"}, [("sku", "min_length")]), ({"sku": "a" * 60}, []), ({"sku": "a" * 61}, [("sku", "max_length")]),
    ({"product_name": "é"}, [("product_name", "min_length")]), ({"product_name": "🙂" * 160}, []), ({"product_name": "🙂" * 161}, [("product_name", "max_length")]),
    ({"description": "x" * 2000}, []), ({"description": "x" * 2001}, [("description", "max_length")]),
    ({"price": 0.0}, [("price", "above")]), ({"price": float("nan")}, [("price", "above")]), ({"price": float("inf")}, []), ({"price": None}, [("price", "required")]),
    ({"stock_qty": -1}, [("stock_qty", "at_least")]), ({"reorder_level": -1}, [("reorder_level", "at_least")]),
    ({"sku": "", "price": -1.0, "stock_qty": None}, [("sku", "min_length"), ("price", "above"), ("stock_qty", "required")]),
])
def test_product_rules(spark, changed, told):
    names = [c.split()[0] for c in PRODUCT.split(", ")]
    row = tuple({**dict(zip(names, GOOD)), **changed}[n] for n in names)
    df = spark.createDataFrame([row], PRODUCT)
    got = broken_rules(df, "product", "id").collect()
    assert [(r.field, r.rule) for r in got] == told and [r.place for r in got] == sorted(r.place for r in got)
    assert accepted(df, "product").count() == (not told) and accepted(df, "product").columns == df.columns


def test_an_email_without_at_is_told_last(spark):
    df = spark.createDataFrame([(1, "Al", "nobody.example", "secret", None), (2, "A", "nobody.example", "secret", None), (3, "Al", "a@b.example", "secret", "1" * 21),
                                (4, None, None, None, None), (5, "Al", "@bcdef", "123456", "")], "id INT, name STRING, email STRING, password STRING, phone STRING")
    got = {}
    for r in broken_rules(df, "register", "id").collect():
        got.setdefault(r.request_id, []).append((r.field, r.rule))
    assert got == {1: [("email", "contains")], 2: [("name", "min_length")], 3: [("phone", "max_length")],
                   4: [("name", "required"), ("email", "required"), ("password", "required")]}


def test_rules_take_one_pass(spark):
    df = spark.createDataFrame([GOOD], PRODUCT)
    plan = with_broken_rules(df, "product")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan and "Union" not in plan
    assert broken_rules(df.limit(0), "product", "id").count() == 0
    assert set(RULES) == {"register", "login", "cart_add", "cart_add_for_user", "cart_update", "product", "search"}


def plain(rows, keys, foreign, root, ids):
    """rows: table -> list of dicts.  The largest set of roots that can go together, by dropping blocked ones."""
    ids = {i for i in ids if any(r[keys[root]] == i for r in rows[root])}

    def reach(start):
        found, todo = {(root, start)}, [(root, start)]
        while todo:
            table, key = todo.pop()
            for k in foreign:
                if k.parent == table and k.on_delete == "CASCADE":
                    for r in rows[k.child]:
                        if r[k.column] == key and (k.child, r[keys[k.child]]) not in found:
                            found.add((k.child, r[keys[k.child]]))
                            todo.append((k.child, r[keys[k.child]]))
        return found

    reached = {i: reach(i) for i in ids}
    live = set(ids)
    while True:
        gone = set().union(*[reached[i] for i in live]) if live else set()
        held = {(k.parent, r[k.column]) for k in foreign if k.on_delete != "CASCADE" for r in rows[k.child] if (k.child, r[keys[k.child]]) not in gone}
        blocked = {i for i in live if reached[i] & held}
        if not blocked:
            return sorted([(t, str(k), "DELETED") for t, k in gone] + [(root, str(i), "BLOCKED") for i in ids - live])
        live -= blocked


def frames(spark, rows, keys, foreign):
    out = {}
    for table, key in keys.items():
        columns = [key, *sorted({k.column for k in foreign if k.child == table})]
        out[table] = spark.createDataFrame([tuple(r[c] for c in columns) for r in rows[table]], ", ".join(f"{c} LONG" for c in columns))
    return out


def filled(rng, keys, foreign, n, null=0.2):
    rows = {}
    for table, key in keys.items():
        columns = {k.column for k in foreign if k.child == table}
        rows[table] = [{key: i, **{c: None if rng.random() < null else rng.randrange(n) for c in columns}} for i in range(rng.randrange(n))]
    return rows


@pytest.mark.parametrize("root", ["users", "carts", "categories", "products", "orders"])
def test_shop_tables_equal_a_plain_walk(spark, root):
    rng = random.Random(root)
    for n in (6, 25):
        rows = filled(rng, PRIMARY_KEYS, FOREIGN_KEYS, n)
        ids = [rng.randrange(n + 3) for _ in range(n)] * 2
        got = delete_closure(frames(spark, rows, PRIMARY_KEYS, FOREIGN_KEYS), root, spark.createDataFrame([(i,) for i in ids], f"{PRIMARY_KEYS[root]} LONG"))
        assert sorted(tuple(r) for r in got.collect()) == plain(rows, PRIMARY_KEYS, FOREIGN_KEYS, root, ids)


CYCLES = [
    ([ForeignKey("node", "up", "node", "CASCADE")], {"node": "id"}),
    ([ForeignKey("a", "b_id", "b", "CASCADE"), ForeignKey("b", "a_id", "a", "CASCADE"), ForeignKey("c", "a_id", "a", "RESTRICT")], {"a": "id", "b": "id", "c": "id"}),
    ([ForeignKey("node", "up", "node", "CASCADE"), ForeignKey("node", "friend", "node", "RESTRICT")], {"node": "id"}),
    ([ForeignKey("a", "r", "root", "CASCADE"), ForeignKey("b", "r", "root", "CASCADE"), ForeignKey("c", "a_id", "a", "CASCADE"),
      ForeignKey("c", "b_id", "b", "CASCADE"), ForeignKey("b", "c_id", "c", "RESTRICT")], {"root": "id", "a": "id", "b": "id", "c": "id"}),
]


@pytest.mark.parametrize("case", range(len(CYCLES)))
def test_cycles_and_inner_blocks_equal_a_plain_walk(spark, case):
    foreign, keys = CYCLES[case]
    root = next(iter(keys))
    rng = random.Random(case)
    for n in (5, 12):
        rows = filled(rng, keys, foreign, n, 0.4)
        ids = [i for i in range(n) if rng.random() < 0.5]
        got = delete_closure(frames(spark, rows, keys, foreign), root, spark.createDataFrame([(i,) for i in ids], "id LONG"), keys, foreign)
        assert sorted(tuple(r) for r in got.collect()) == plain(rows, keys, foreign, root, ids)
