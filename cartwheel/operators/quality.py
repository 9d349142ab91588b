"""H1-H8: declared constraints run as data-quality checks.

``check_constraints`` returns one DataFrame (table_name, rule, key, detail).
Row-level rules of a table (NOT NULL, CHECK, VARCHAR(n)) are evaluated in
one scan per table: every row yields an array of violation structs that is
exploded; the keys of all tables are one aggregate, all foreign keys one
join (NULL references pass, as in SQL).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import VARCHAR_LIMITS, not_null_columns

# Declared keys, foreign keys and CHECK constraints of the schema.
PRIMARY_KEYS = {
    "users": ["user_id"], "categories": ["category_id"], "products": ["product_id"], "carts": ["cart_id"],
    "cart_items": ["cart_item_id"], "orders": ["order_id"], "order_items": ["order_item_id"],
    "inventory_audit": ["audit_id"], "order_audit": ["audit_id"], "user_sessions": ["session_id"],
}
UNIQUE_KEYS = {
    "users": [["email"]], "categories": [["category_name"]], "products": [["sku"]], "carts": [["user_id"]],
    "cart_items": [["cart_id", "product_id"]], "order_items": [["order_id", "product_id"]],
    "user_sessions": [["token_hash"]],
}
FOREIGN_KEYS = [
    ("products", "category_id", "categories", "category_id"),
    ("carts", "user_id", "users", "user_id"),
    ("cart_items", "cart_id", "carts", "cart_id"),
    ("cart_items", "product_id", "products", "product_id"),
    ("orders", "user_id", "users", "user_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("inventory_audit", "product_id", "products", "product_id"),
    ("inventory_audit", "related_order_id", "orders", "order_id"),
    ("order_audit", "order_id", "orders", "order_id"),
    ("user_sessions", "user_id", "users", "user_id"),
]


# CHECK constraints of the schema as SQL text (as declared);
# a row violates one when the condition is FALSE (NULL passes).
CHECKS = {
    "users": [("users_email_format_chk", "POSITION('@' IN email) > 1")],
    "products": [("products_price_chk", "price > 0"),
                 ("products_stock_nonnegative_chk", "stock_qty >= 0"),
                 ("products_reorder_nonnegative_chk", "reorder_level >= 0")],
    "cart_items": [("cart_items_quantity_chk", "quantity > 0")],
    "orders": [("orders_status_chk", "order_status IN ('PLACED', 'CANCELLED', 'COMPLETED')"),
               ("orders_total_nonnegative_chk", "total_amount >= 0"),
               ("orders_cancelled_time_chk",
                "(order_status = 'CANCELLED' AND cancelled_at IS NOT NULL) OR order_status <> 'CANCELLED'"),
               ("orders_completed_time_chk",
                "(order_status = 'COMPLETED' AND completed_at IS NOT NULL) OR order_status <> 'COMPLETED'")],
    "order_items": [("order_items_quantity_chk", "quantity > 0"), ("order_items_price_chk", "unit_price > 0")],
}


def _checks(table: str) -> list[tuple[str, Column]]:
    return [(name, F.expr(cond)) for name, cond in CHECKS.get(table, [])]


def _key_text(cols: list[str]) -> Column:
    return F.concat_ws(",", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in cols])


def row_violations(table: str, df: DataFrame) -> DataFrame:
    """H1, H4, H5 for one table in a single pass."""
    items = []
    for col in not_null_columns(table):
        if col in df.columns:
            items.append(F.when(F.col(col).isNull(), F.struct(F.lit("NOT_NULL").alias("rule"),
                                                              F.lit(col).alias("detail"))))
    for name, cond in _checks(table):
        items.append(F.when(~cond, F.struct(F.lit("CHECK").alias("rule"), F.lit(name).alias("detail"))))
    for col, n in VARCHAR_LIMITS.get(table, {}).items():
        if col in df.columns:
            items.append(F.when(F.length(col) > n, F.struct(F.lit("VARCHAR").alias("rule"),
                                                            F.lit(f"{col} > {n}").alias("detail"))))
    if not items:
        return None
    pk = PRIMARY_KEYS[table]
    v = df.select(_key_text(pk).alias("key"), F.explode(F.filter(F.array(*items), lambda x: x.isNotNull())).alias("v"))
    return v.select(F.lit(table).alias("table_name"), F.col("v.rule").alias("rule"), "key",
                    F.col("v.detail").alias("detail"))


def key_violations(table: str, df: DataFrame, keys: list[str], rule: str) -> DataFrame:
    """H2 for one key: values held by more than one row (NULLs never collide)."""
    return repeated_keys([(table, df, keys, rule)])


def _named(number: Column, names: list[str]) -> Column:
    """The name a running number stands for."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), number + 1)


def repeated_keys(rules: list[tuple[str, DataFrame, list[str], str]]) -> DataFrame:
    """H2 for many keys (table, rows, key columns, rule name) in one aggregate.

    Rules over the same DataFrame share one read of it.  What is shuffled is
    the rule's number and the key: whole numbers as they are, other keys as text.
    """
    frames, by_frame = [], {}
    for number, (_, df, keys, _) in enumerate(rules):
        by_frame.setdefault(id(df), (df, []))[1].append((number, keys))
    for df, own in by_frame.values():
        types = dict(df.dtypes)
        structs = []
        for number, keys in own:
            whole = len(keys) <= 2 and all(types[k] in ("bigint", "int") for k in keys)
            complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
            none, longs = F.lit(None).cast("bigint"), [F.col(k).cast("bigint") for k in keys]
            structs.append(F.when(complete, F.struct(
                F.lit(number).alias("number"), (longs[0] if whole else none).alias("a"),
                (longs[1] if whole and len(keys) == 2 else none).alias("b"),
                (F.lit(None).cast("string") if whole else F.concat_ws(",", *[F.col(k).cast("string") for k in keys])).alias("text"),
                # tells ('x,y', 'z') from ('x', 'y,z')
                (F.lit(None).cast("string") if whole or len(keys) == 1 else F.concat_ws(
                    ",", *[F.length(F.col(k).cast("string")).cast("string") for k in keys])).alias("cuts"))))
        frames.append(df.select(F.explode(F.array(*structs)).alias("k")).filter(F.col("k").isNotNull()).select("k.*"))
    dup = _union(frames).groupBy("number", "a", "b", "text", "cuts").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    number = F.col("number")
    return dup.select(
        _named(number, [t for t, _, _, _ in rules]).alias("table_name"), _named(number, [r for _, _, _, r in rules]).alias("rule"),
        F.coalesce("text", F.concat_ws(",", F.col("a").cast("string"), F.col("b").cast("string"))).alias("key"),
        F.concat(_named(number, [",".join(k) + " rows=" for _, _, k, _ in rules]), F.col("_n").cast("string")).alias("detail"))


def reference_violations(tables: dict[str, DataFrame]) -> DataFrame | None:
    """H3: references to a missing parent row, all foreign keys in one join.

    Each child table is read once for all its references, each parent once
    for its key; a reference of a table that is not given, or to one, is
    not judged.
    """
    edges = [(c, col, p) for c, col, p, _ in FOREIGN_KEYS if c in tables and p in tables and col in tables[c].columns]
    if not edges:
        return None
    parents = sorted({p for _, _, p in edges})
    refs = []
    for child in dict.fromkeys(c for c, _, _ in edges):
        structs = [F.when(F.col(col).isNotNull(), F.struct(
            F.lit(i).alias("edge"), F.lit(parents.index(p)).alias("parent"), F.col(col).cast("bigint").alias("ref")))
            for i, (c, col, p) in enumerate(edges) if c == child]
        held = tables[child].select(F.col(PRIMARY_KEYS[child][0]).alias("key"), F.explode(F.array(*structs)).alias("r"))
        refs.append(held.filter(F.col("r").isNotNull()).select("key", "r.*"))
    stored = [tables[p].select(F.lit(i).alias("parent"), F.col(PRIMARY_KEYS[p][0]).cast("bigint").alias("ref"))
              for i, p in enumerate(parents)]
    # a left join whose partner is missing: an anti-join would be pushed below
    # the union and read the parents once for every child
    found = _union(stored).withColumn("_found", F.lit(True))
    told = _union(refs).join(found, ["parent", "ref"], "left").filter(F.col("_found").isNull())
    edge = F.col("edge")
    return told.select(
        _named(edge, [c for c, _, _ in edges]).alias("table_name"), F.lit("FOREIGN_KEY").alias("rule"),
        F.coalesce(F.col("key").cast("string"), F.lit("NULL")).alias("key"),
        F.concat(_named(edge, [col + "=" for _, col, _ in edges]), F.col("ref").cast("string"),
                 _named(edge, [f" not in {p}" for _, _, p in edges])).alias("detail"))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def order_total_mismatches(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """H7: orders whose stored total differs from the sum of their lines."""
    sums = order_items.groupBy("order_id").agg(F.sum("line_total").alias("_s"))
    o = orders.join(sums, "order_id", "left").withColumn("_s", F.coalesce("_s", F.lit(0)))
    bad = o.filter(F.col("total_amount") != F.col("_s"))
    return bad.select(F.lit("orders").alias("table_name"), F.lit("TOTAL_MISMATCH").alias("rule"),
                      F.col("order_id").cast("string").alias("key"),
                      F.concat(F.lit("stored="), F.col("total_amount").cast("string"), F.lit(" lines="),
                               F.col("_s").cast("decimal(18,2)").cast("string")).alias("detail"))


def stock_mismatches(current: DataFrame, opening: DataFrame, audit: DataFrame) -> DataFrame:
    """H8: products whose stock differs from opening + sum of audited changes.

    ``current`` and ``opening`` have product_id, stock.
    """
    net = audit.groupBy("product_id").agg(F.sum("change_qty").alias("_net"))
    j = current.join(opening.select("product_id", F.col("stock").alias("_open")), "product_id", "left") \
        .join(net, "product_id", "left")
    exp = F.coalesce("_open", F.lit(0)) + F.coalesce("_net", F.lit(0))
    bad = j.filter(F.col("stock") != exp)
    return bad.select(F.lit("products").alias("table_name"), F.lit("STOCK_MISMATCH").alias("rule"),
                      F.col("product_id").cast("string").alias("key"),
                      F.concat(F.lit("stock="), F.col("stock").cast("string"), F.lit(" expected="),
                               exp.cast("string")).alias("detail"))


def check_constraints(tables: dict[str, DataFrame]) -> DataFrame:
    """H1-H5 (+ H7 when orders and order_items are given) over ``tables``.

    Each table is read once for its row rules, once for all its keys and
    once for all its references; the keys of all tables meet in one
    aggregate, the references in one join.
    """
    known = {name: df for name, df in tables.items() if name in PRIMARY_KEYS}
    parts = [rv for rv in (row_violations(name, df) for name, df in known.items()) if rv is not None]
    keys = [(name, df, k, rule) for name, df in known.items()
            for k, rule in [(PRIMARY_KEYS[name], "PRIMARY_KEY")] + [(u, "UNIQUE") for u in UNIQUE_KEYS.get(name, [])]]
    if keys:
        parts.append(repeated_keys(keys))
    refs = reference_violations(known)
    if refs is not None:
        parts.append(refs)
    if "orders" in tables and "order_items" in tables:
        parts.append(order_total_mismatches(tables["orders"], tables["order_items"]))
    return _union(parts)


def constraint_sql(tables: dict[str, str]) -> str:
    """The same H1-H5 and H7 rule set as one SQL query (tables: name -> relation).

    Used as the independent oracle of ``check_constraints`` on another engine.
    """
    parts = []
    for name, rel in tables.items():
        if name not in PRIMARY_KEYS:
            continue
        cols = _sql_cols(name)
        key = _sql_key(PRIMARY_KEYS[name])
        for col in not_null_columns(name):
            if col in cols:
                parts.append(f"SELECT '{name}' AS table_name, 'NOT_NULL' AS rule, {key} AS key, '{col}' AS detail "
                             f"FROM {rel} WHERE {col} IS NULL")
        for cname, cond in CHECKS.get(name, []):
            parts.append(f"SELECT '{name}', 'CHECK', {key}, '{cname}' FROM {rel} WHERE NOT ({cond})")
        for col, n in VARCHAR_LIMITS.get(name, {}).items():
            if col in cols:
                parts.append(f"SELECT '{name}', 'VARCHAR', {key}, '{col} > {n}' FROM {rel} WHERE length({col}) > {n}")
        for keys, rule in [(PRIMARY_KEYS[name], "PRIMARY_KEY")] + [(k, "UNIQUE") for k in UNIQUE_KEYS.get(name, [])]:
            nn = " AND ".join(f"{k} IS NOT NULL" for k in keys)
            parts.append(f"SELECT '{name}', '{rule}', {_sql_key(keys)}, '{','.join(keys)} rows=' || CAST(count(*) AS VARCHAR) "
                         f"FROM {rel} WHERE {nn} GROUP BY {', '.join(keys)} HAVING count(*) > 1")
    for child, col, parent, pcol in FOREIGN_KEYS:
        if child in tables and parent in tables:
            key = _sql_key(PRIMARY_KEYS[child], "c")
            parts.append(f"SELECT '{child}', 'FOREIGN_KEY', {key}, '{col}=' || CAST(c.{col} AS VARCHAR) || ' not in {parent}' "
                         f"FROM {tables[child]} c WHERE c.{col} IS NOT NULL AND NOT EXISTS "
                         f"(SELECT 1 FROM {tables[parent]} p WHERE p.{pcol} = c.{col})")
    if "orders" in tables and "order_items" in tables:
        parts.append(
            "SELECT 'orders', 'TOTAL_MISMATCH', CAST(o.order_id AS VARCHAR), 'stored=' || CAST(o.total_amount AS VARCHAR) "
            "|| ' lines=' || CAST(CAST(coalesce(s.s, 0) AS DECIMAL(18,2)) AS VARCHAR) "
            f"FROM {tables['orders']} o LEFT JOIN (SELECT order_id, sum(line_total) AS s FROM {tables['order_items']} "
            "GROUP BY order_id) s ON s.order_id = o.order_id WHERE o.total_amount <> coalesce(s.s, 0)")
    return "\nUNION ALL\n".join(parts)


def _sql_cols(name: str) -> set[str]:
    from ..schemas import schema
    return {f.name for f in schema(name).fields}


def _sql_key(cols: list[str], alias: str | None = None) -> str:
    pre = f"{alias}." if alias else ""
    return "concat_ws(',', " + ", ".join(f"coalesce(CAST({pre}{c} AS VARCHAR), 'NULL')" for c in cols) + ")"
