"""The reference's demo seed as Spark tables (golden fixture).

Ids follow insertion order, as the serial keys would; times are relative
to a fixed AS_OF.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from cartwheel.sources.tables import conform

AS_OF = dt.datetime(2024, 6, 1, 12, 0, 0)

# Seed users (name, email, phone); the first one is the admin.
USERS = [
    ("Alice Johnson", "alice@example.com", "9876543201"),
    ("Bob Smith", "bob@example.com", "9876543202"),
    ("Charlie Davis", "charlie@example.com", "9876543203"),
    ("Diana Lee", "diana@example.com", "9876543204"),
    ("Ethan Brown", "ethan@example.com", "9876543205"),
    ("Farah Khan", "farah@example.com", "9876543206"),
    ("George Miller", "george@example.com", "9876543207"),
    ("Hina Patel", "hina@example.com", "9876543208"),
    ("Ishan Verma", "ishan@example.com", "9876543209"),
    ("Julia Wilson", "julia@example.com", "9876543210"),
]

# Seed categories (name, description).
CATEGORIES = [
    ("Electronics", "Electronic gadgets and devices"),
    ("Home Essentials", "Household and kitchen needs"),
    ("Books", "Fiction, non-fiction, and learning resources"),
    ("Fashion", "Clothing and accessories"),
    ("Sports", "Fitness and sports gear"),
    ("Beauty", "Skincare and personal care products"),
]

# Seed products (category, sku, name, description, price, stock, reorder level).
PRODUCTS = [
    ("Electronics", "ELEC-001", "Wireless Mouse", "Ergonomic 2.4GHz mouse", "799.00", 80, 10),
    ("Electronics", "ELEC-002", "Mechanical Keyboard", "Backlit keyboard with blue switches", "2899.00", 50, 8),
    ("Electronics", "ELEC-003", "Noise Cancelling Headphones", "Over-ear ANC headphones", "5499.00", 35, 6),
    ("Electronics", "ELEC-004", "Portable SSD 1TB", "USB-C high-speed external SSD", "7499.00", 26, 5),
    ("Home Essentials", "HOME-001", "Non-Stick Frying Pan", "Induction friendly 28cm pan", "1399.00", 65, 10),
    ("Home Essentials", "HOME-002", "Electric Kettle", "1.5L auto cut-off kettle", "1699.00", 42, 8),
    ("Home Essentials", "HOME-003", "Vacuum Cleaner", "Bagless high suction vacuum", "6999.00", 18, 4),
    ("Home Essentials", "HOME-004", "Water Bottle Set", "Steel bottle set of 3", "899.00", 90, 12),
    ("Books", "BOOK-001", "Database Systems Fundamentals", "Introductory DBMS textbook", "799.00", 75, 10),
    ("Books", "BOOK-002", "Advanced SQL Patterns", "Practical SQL optimization guide", "999.00", 52, 8),
    ("Books", "BOOK-003", "Python for Backend Development", "Build APIs with modern Python", "699.00", 60, 10),
    ("Books", "BOOK-004", "Data Modeling in Practice", "Real-world data modeling techniques", "849.00", 40, 7),
    ("Fashion", "FASH-001", "Cotton T-Shirt", "Regular fit unisex tee", "499.00", 120, 15),
    ("Fashion", "FASH-002", "Denim Jeans", "Slim-fit stretch denim", "1599.00", 58, 10),
    ("Fashion", "FASH-003", "Running Shoes", "Lightweight cushioned shoes", "3199.00", 33, 6),
    ("Fashion", "FASH-004", "Leather Wallet", "Bi-fold genuine leather wallet", "1199.00", 44, 7),
    ("Sports", "SPORT-001", "Yoga Mat", "Anti-slip 6mm mat", "899.00", 70, 10),
    ("Sports", "SPORT-002", "Dumbbell Pair 10kg", "Rubber-coated dumbbells", "2499.00", 25, 5),
    ("Sports", "SPORT-003", "Badminton Racket", "Carbon fiber performance racket", "1899.00", 30, 5),
    ("Sports", "SPORT-004", "Football", "Match-quality size 5 football", "999.00", 55, 8),
    ("Beauty", "BEAU-001", "Face Wash", "Gentle daily cleanser", "349.00", 85, 12),
    ("Beauty", "BEAU-002", "Sunscreen SPF 50", "Broad spectrum UVA/UVB protection", "499.00", 62, 10),
    ("Beauty", "BEAU-003", "Vitamin C Serum", "Brightening antioxidant serum", "799.00", 38, 6),
    ("Beauty", "BEAU-004", "Body Lotion", "Hydrating lotion for dry skin", "449.00", 77, 10),
]

# Seed cart items (email, sku, quantity).
CART_ITEMS = [("alice@example.com", "ELEC-001", 2), ("alice@example.com", "BOOK-002", 1),
              ("bob@example.com", "SPORT-001", 1), ("bob@example.com", "HOME-002", 1)]

# Seed orders (email, status, placed days ago, completed days ago, [(sku, qty)]).
ORDERS = [
    ("charlie@example.com", "COMPLETED", 10, 9, [("ELEC-002", 1), ("BOOK-001", 2), ("FASH-001", 3)]),
    ("diana@example.com", "COMPLETED", 5, 4, [("HOME-003", 1), ("BEAU-002", 2), ("SPORT-004", 1)]),
    ("ethan@example.com", "PLACED", 1, None, [("FASH-003", 1), ("SPORT-002", 1), ("BEAU-001", 2)]),
]


def seed_tables(spark) -> dict:
    t = AS_OF
    uid = {e: i + 1 for i, (_, e, _) in enumerate(USERS)}
    cid = {n: i + 1 for i, (n, _) in enumerate(CATEGORIES)}
    pid = {p[1]: i + 1 for i, p in enumerate(PRODUCTS)}
    price = {p[1]: Decimal(p[4]) for p in PRODUCTS}
    users = [(uid[e], n, e, "seed", ph, True, e == "alice@example.com", t, t) for n, e, ph in USERS]
    cats = [(cid[n], n, d, t, t) for n, d in CATEGORIES]
    prods = [(pid[s], cid[c], s, n, d, Decimal(pr), st, ro, True, t, t) for c, s, n, d, pr, st, ro in PRODUCTS]
    carts = [(i, i, t, t) for i in range(1, len(USERS) + 1)]
    items = [(i + 1, uid[e], pid[s], q, t, t) for i, (e, s, q) in enumerate(CART_ITEMS)]
    orders, lines = [], []
    for oid, (e, status, placed, done, ls) in enumerate(ORDERS, start=1):
        total = sum(price[s] * q for s, q in ls)
        orders.append((oid, uid[e], status, total, t - dt.timedelta(days=placed), None,
                       t - dt.timedelta(days=done) if done else None, t, t))
        for s, q in ls:
            lines.append((len(lines) + 1, oid, pid[s], q, price[s], price[s] * q, t))
    mk = {
        "users": (users, "user_id BIGINT, full_name STRING, email STRING, password_hash STRING, phone STRING, "
                         "is_active BOOLEAN, is_admin BOOLEAN, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ"),
        "categories": (cats, "category_id BIGINT, category_name STRING, description STRING, "
                             "created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ"),
        "products": (prods, "product_id BIGINT, category_id BIGINT, sku STRING, product_name STRING, "
                            "description STRING, price DECIMAL(12,2), stock_qty INT, reorder_level INT, "
                            "is_active BOOLEAN, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ"),
        "carts": (carts, "cart_id BIGINT, user_id BIGINT, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ"),
        "cart_items": (items, "cart_item_id BIGINT, cart_id BIGINT, product_id BIGINT, quantity INT, "
                              "created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ"),
        "orders": (orders, "order_id BIGINT, user_id BIGINT, order_status STRING, total_amount DECIMAL(12,2), "
                           "placed_at TIMESTAMP_NTZ, cancelled_at TIMESTAMP_NTZ, completed_at TIMESTAMP_NTZ, "
                           "created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ"),
        "order_items": (lines, "order_item_id BIGINT, order_id BIGINT, product_id BIGINT, quantity INT, "
                               "unit_price DECIMAL(12,2), line_total DECIMAL(12,2), created_at TIMESTAMP_NTZ"),
    }
    return {k: conform(spark.createDataFrame(rows, ddl), k) for k, (rows, ddl) in mk.items()}
