"""Sequential reference models (plain Python replays) for the set-wise operators."""

from __future__ import annotations


def replay_admission(stock0: dict, orders: list, lines: dict, cancels: list, adjustments: list):
    """orders: [(seq, order_id, user_id)], lines: {order_id: {product: qty}},
    cancels: [(seq, order_id, user_id)], adjustments: [(seq, product, delta)].
    Returns ({seq: outcome}, final stock)."""
    stock = dict(stock0)
    placed = {}   # order_id -> (user, status, lines)
    out = {}
    cmds = ([(s, "O", oid, u) for s, oid, u in orders] + [(s, "C", oid, u) for s, oid, u in cancels]
            + [(s, "A", p, d) for s, p, d in adjustments])
    for seq, kind, ref, arg in sorted(cmds):
        if kind == "O":
            ls = lines.get(ref, {})
            if not ls:
                out[seq] = "EMPTY_ORDER"
            elif any(q <= 0 for q in ls.values()):
                out[seq] = "INVALID_QUANTITY"
            elif any(p not in stock for p in ls):
                out[seq] = "UNKNOWN_PRODUCT"
            elif all(q <= stock[p] for p, q in ls.items()):
                for p, q in ls.items():
                    stock[p] -= q
                placed[ref] = [arg, "PLACED", ls]
                out[seq] = "PLACED"
            else:
                out[seq] = "INSUFFICIENT_STOCK"
        elif kind == "C":
            o = placed.get(ref)
            if o is None:
                out[seq] = "NOT_FOUND"
            elif o[0] != arg:
                out[seq] = "NOT_OWNER"
            elif o[1] != "PLACED":
                out[seq] = "NOT_PLACED"
            else:
                for p, q in o[2].items():
                    stock[p] += q
                o[1] = "CANCELLED"
                out[seq] = "CANCELLED"
        else:
            if arg is None or arg == 0:
                out[seq] = "ZERO_DELTA"
            elif ref not in stock:
                out[seq] = "UNKNOWN_PRODUCT"
            elif stock[ref] + arg < 0:
                out[seq] = "NEGATIVE_STOCK"
            else:
                stock[ref] += arg
                out[seq] = "APPLIED"
    return out, stock


def replay_cart(commands: list, users: dict, products: dict, q0: dict | None = None):
    """commands: [(seq, user, kind, product, qty)]; users: {id: active};
    products: {id: (stock, active)}; q0: {(user, product): qty}.
    Returns ({seq: outcome}, {(user, product): qty})."""
    cart = dict(q0 or {})
    out = {}
    for seq, u, kind, p, x in sorted(commands):
        if kind == "ADD":
            if x is None or x <= 0:
                out[seq] = "INVALID_QUANTITY"
            elif not users.get(u, False):
                out[seq] = "USER_INACTIVE"
            elif p not in products or not products[p][1]:
                out[seq] = "PRODUCT_UNAVAILABLE"
            elif cart.get((u, p), 0) + x > products[p][0]:
                out[seq] = "INSUFFICIENT_STOCK"
            else:
                cart[(u, p)] = cart.get((u, p), 0) + x
                out[seq] = "ADDED"
        elif kind == "SET":
            if x is None or x <= 0:
                out[seq] = "INVALID_QUANTITY"
            elif p not in products or cart.get((u, p), 0) <= 0:
                out[seq] = "NOT_FOUND"
            elif x > products[p][0]:
                out[seq] = "INSUFFICIENT_STOCK"
            else:
                cart[(u, p)] = x
                out[seq] = "UPDATED"
        elif kind == "REMOVE":
            out[seq] = "REMOVED" if cart.pop((u, p), 0) > 0 else "NOT_FOUND"
        else:
            for key in [k for k in cart if k[0] == u]:
                del cart[key]
            out[seq] = "CLEARED"
    return out, {k: v for k, v in cart.items() if v > 0}
