"""Column expressions (JVM-side, inside whole-stage codegen; no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import MONEY


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def rating_expr(product_id="product_id") -> Column:
    """Derived rating ``3.8 + ((id * 37) mod 12) / 10`` as DECIMAL(2,1).

    ``%`` keeps the dividend's sign, like the script it mirrors.  The
    decimal equals the displayed one-decimal value, and compares the same
    at the offered thresholds 4.0 and 4.5.
    """
    return ((F.lit(38) + (_c(product_id) * 37) % 12) / 10).cast("decimal(2,1)")


def stars_expr(rating="rating") -> Column:
    """Half-up rounded rating as five filled/empty stars."""
    n = F.floor(_c(rating) + F.lit(0.5)).cast("int")
    return F.concat(F.repeat(F.lit("★"), n), F.repeat(F.lit("☆"), F.lit(5) - n))


def stock_badge(stock="stock_qty", reorder="reorder_level") -> Column:
    """Stock label."""
    return (F.when(_c(stock) <= 0, "Out of stock")
            .when(_c(stock) <= _c(reorder), "Low stock")
            .otherwise("In stock"))


def line_total(quantity="quantity", unit_price="unit_price") -> Column:
    """Generated column quantity * unit_price as NUMERIC(12,2)."""
    return (_c(quantity) * _c(unit_price)).cast(MONEY)


def strip_ws(col) -> Column:
    """Strip leading/trailing whitespace (not only spaces)."""
    return F.regexp_replace(_c(col), r"^\s+|\s+$", "")


# SKU prefixes and keywords of the product classifier, in the
# order they are tried (first match wins).
SKU_PREFIXES = [
    ("ELEC-", "electronics"), ("HOME-", "home"), ("BOOK-", "books"),
    ("FASH-", "fashion"), ("SPORT-", "sports"), ("BEAU-", "beauty"),
]
KEYWORDS = [
    ("electronics", ["electr"]),
    ("home", ["home", "kitchen"]),
    ("books", ["book", "sql", "dbms"]),
    ("fashion", ["fashion", "shirt", "jeans", "shoes"]),
    ("sports", ["sport", "yoga", "racket", "football"]),
    ("beauty", ["beauty", "serum", "sunscreen", "lotion"]),
]


def classify_expr(sku="sku", category_name="category_name", product_name="product_name",
                  description="description") -> Column:
    """Category key from the SKU prefix, else from keywords, else NULL."""
    norm_sku = F.upper(F.trim(F.coalesce(_c(sku), F.lit(""))))
    text = F.lower(F.concat_ws(" ", F.coalesce(_c(category_name), F.lit("")),
                               F.coalesce(_c(product_name), F.lit("")),
                               F.coalesce(_c(description), F.lit(""))))
    expr = None
    for prefix, key in SKU_PREFIXES:
        cond = norm_sku.startswith(prefix)
        expr = F.when(cond, key) if expr is None else expr.when(cond, key)
    for key, words in KEYWORDS:
        cond = None
        for w in words:
            c = text.contains(w)
            cond = c if cond is None else (cond | c)
        expr = expr.when(cond, key)
    return expr.otherwise(F.lit(None).cast("string"))


# Stock-movement reasons.
REASON_ORDER = "ORDER_PLACED_STOCK_REDUCTION"
REASON_CANCEL = "ORDER_CANCELLED_RESTOCK"
REASON_MANUAL = "MANUAL_ADJUSTMENT"
REASON_DEFAULT = "STOCK_UPDATED"


def movement_reason(kind="kind", text="reason") -> Column:
    """reason recorded for a stock movement of ``kind`` ORDER/CANCEL/ADJUST."""
    manual = F.coalesce(F.nullif(F.trim(_c(text)), F.lit("")), F.lit(REASON_MANUAL))
    return (F.when(_c(kind) == "ORDER", REASON_ORDER)
            .when(_c(kind) == "CANCEL", REASON_CANCEL)
            .when(_c(kind) == "ADJUST", manual)
            .otherwise(REASON_DEFAULT))


def padded(key, width: int) -> Column:
    """Decimal text of ``key``, filled with zeros to ``width``; longer keys keep all their digits."""
    text = _c(key).cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def token_hash(token, secret: str | Column) -> Column:
    """SHA-256 hex of ``token:secret``."""
    sec = secret if isinstance(secret, Column) else F.lit(secret)
    return F.sha2(F.concat_ws(":", _c(token), sec), 256)
