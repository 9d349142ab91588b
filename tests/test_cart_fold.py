"""C3 cart fold against a sequential replay."""

import random

import pytest

from cartwheel.operators.cart_fold import fold_cart
from tests.models import replay_cart


def random_cart_log(rng, n=50):
    users = {1: True, 2: True, 3: False}
    products = {10: (rng.randint(0, 9), True), 11: (rng.randint(3, 12), True), 12: (5, False)}
    cmds = []
    for seq in rng.sample(range(1, 5 * n), n):
        kind = rng.choices(["ADD", "SET", "REMOVE", "CLEAR"], [0.55, 0.2, 0.15, 0.1])[0]
        cmds.append((seq, rng.choice([1, 1, 2, 3]), kind, rng.choice([10, 10, 11, 12, 13]),
                     rng.choice([0, 1, 2, 3, 4, 7])))
    return cmds, users, products


def run(spark, cmds, users, products):
    c = spark.createDataFrame(cmds, "seq BIGINT, user_id BIGINT, kind STRING, product_id BIGINT, quantity INT")
    u = spark.createDataFrame(list(users.items()), "user_id BIGINT, is_active BOOLEAN")
    p = spark.createDataFrame([(k, s, a) for k, (s, a) in products.items()],
                              "product_id BIGINT, stock_qty INT, is_active BOOLEAN")
    out, state = fold_cart(c, u, p)
    return ({r.seq: r.outcome for r in out.collect()},
            {(r.user_id, r.product_id): r.quantity for r in state.collect()})


@pytest.mark.parametrize("seed", range(3))
def test_cart_fold_matches_replay(spark, seed):
    cmds, users, products = random_cart_log(random.Random(seed))
    want, want_state = replay_cart(cmds, users, products)
    got, state = run(spark, cmds, users, products)
    assert got == want
    assert state == want_state


def test_stored_lines_stay_unless_cleared(spark):
    users, products = {1: True, 2: True, 3: True}, {10: (9, True), 11: (9, True)}
    stored = [(1, 10, 3), (1, 11, 2), (2, 10, 2), (3, 11, 1)]
    cmds = [(1, 1, "ADD", 10, 2), (2, 3, "CLEAR", None, None), (3, 1, "REMOVE", 11, None), (4, 1, "ADD", 11, 1)]
    c = spark.createDataFrame(cmds, "seq BIGINT, user_id BIGINT, kind STRING, product_id BIGINT, quantity INT")
    u = spark.createDataFrame(list(users.items()), "user_id BIGINT, is_active BOOLEAN")
    p = spark.createDataFrame([(k, s, a) for k, (s, a) in products.items()], "product_id BIGINT, stock_qty INT, is_active BOOLEAN")
    carts = spark.createDataFrame([(100 + i, i) for i in users], "cart_id BIGINT, user_id BIGINT")
    items = spark.createDataFrame([(100 + i, k, q) for i, k, q in stored], "cart_id BIGINT, product_id BIGINT, quantity INT")
    out, state = fold_cart(c, u, p, items, carts)
    assert {r.seq: r.outcome for r in out.collect()} == {1: "ADDED", 2: "CLEARED", 3: "REMOVED", 4: "ADDED"}
    assert {(r.user_id, r.product_id): r.quantity for r in state.collect()} == {(1, 10): 5, (1, 11): 1, (2, 10): 2}


def test_many_clears_and_products_stay_linear(spark):
    cmds, seq = [], 0
    for k in range(40):
        for p in range(30):
            seq += 1
            cmds.append((seq, 1, "ADD", p, 1))
        seq += 1
        cmds.append((seq, 1, "CLEAR", None, None))
    users, products = {1: True}, {p: (1, True) for p in range(30)}
    got, state = run(spark, cmds, users, products)
    assert set(got.values()) == {"ADDED", "CLEARED"} and len(got) == len(cmds) and state == {}
