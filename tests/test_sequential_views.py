"""Brute force on the whole sf0.001 tables: set-wise admission and cart fold
against the sequential Python replays."""

from pyspark.sql import functions as F

from cartwheel.operators.admission import admit_commands
from cartwheel.operators.cart_fold import fold_cart
from cartwheel.sources.views import ShopViews
from tests.conftest import SF001
from tests.models import replay_admission, replay_cart


def test_admission_on_views_equals_replay(spark):
    v = ShopViews(spark, SF001)
    stock0 = {r.product_id: r.stock for r in v.opening_stock.collect()}
    orders = [(r.seq, r.order_id, r.user_id) for r in v.order_commands.collect()]
    lines = {}
    for r in v.order_command_lines.collect():
        lines.setdefault(r.order_id, {})[r.product_id] = lines.get(r.order_id, {}).get(r.product_id, 0) + r.quantity
    cancels = [(r.seq, r.order_id, r.user_id) for r in v.cancel_commands.collect()]
    want, want_stock = replay_admission(stock0, orders, lines, cancels, [])
    dec, _, final = admit_commands(v.opening_stock, v.order_commands, v.order_command_lines, v.cancel_commands)
    assert {r.seq: r.outcome for r in dec.collect()} == want
    assert {r.product_id: r.stock for r in final.collect()} == want_stock


def test_cart_fold_on_views_equals_replay(spark):
    v = ShopViews(spark, SF001)
    cmds = [(r.seq, r.user_id, r.kind, r.product_id, r.quantity) for r in v.cart_commands.collect()]
    users = {r.user_id: r.is_active for r in v.users.collect()}
    products = {r.product_id: (r.stock_qty, r.is_active) for r in v.products.collect()}
    want, want_state = replay_cart(cmds, users, products)
    out, state = fold_cart(v.cart_commands, v.users, v.products)
    assert {r.seq: r.outcome for r in out.collect()} == want
    assert {(r.user_id, r.product_id): r.quantity for r in state.collect()} == want_state
