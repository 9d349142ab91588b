"""Catalog listing, search, derived display fields, ingestion."""

from __future__ import annotations

import re
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import classify_expr, rating_expr, stars_expr, stock_badge, strip_ws
from ..plans.strategy import top_k_per_group
from ..schemas import MONEY

# Whitelisted sorts of the product search (unknown -> name_asc).
SORTS = {
    "name_asc": ("product_name", True),
    "name_desc": ("product_name", False),
    "price_asc": ("price", True),
    "price_desc": ("price", False),
    "stock_desc": ("stock_qty", False),
}
PAGE_SIZE = 9
SEARCH_COLUMNS = ["product_id", "sku", "product_name", "description", "price", "stock_qty", "reorder_level",
                  "category_id", "category_name"]


def list_categories(categories: DataFrame) -> DataFrame:
    """B1."""
    return categories.select("category_id", "category_name", "description").orderBy("category_name", "category_id")


def catalog_listing(products: DataFrame, categories: DataFrame) -> DataFrame:
    """B2: every product (active or not) with its category, by name."""
    return (products.join(categories.select("category_id", "category_name"), "category_id")
            .select("product_id", "sku", "product_name", "category_name", "price", "stock_qty", "is_active")
            .orderBy("product_name", "product_id"))


def sort_columns(sort: str | None):
    col, asc = SORTS.get(sort or "name_asc", SORTS["name_asc"])
    return [F.col(col).asc() if asc else F.col(col).desc(), F.col("product_id").asc()]


def search_products(products: DataFrame, categories: DataFrame, *, category_id: int | None = None,
                    search: str | None = None, in_stock_only: bool = False, sort: str | None = None,
                    min_price: float | None = None, max_price: float | None = None,
                    ordered: bool = True) -> DataFrame:
    """Active products under optional AND-ed predicates.

    Predicates are plain column filters, so they reach the parquet scan
    when ``products`` is a stored table.  ``search`` is a LIKE pattern
    ``%lower(search)%`` without escaping: ``%`` and ``_`` typed by the user
    stay wildcards.  An empty string is no filter.
    """
    p = products.filter(F.col("is_active"))
    if category_id is not None:
        p = p.filter(F.col("category_id") == F.lit(category_id))
    if search:
        # a backslash before an ordinary character stands for that character
        pattern = re.sub(r"\\(.)", lambda m: m[0] if m[1] in "%_\\" else m[1], f"%{search.lower()}%", flags=re.DOTALL)
        p = p.filter(F.lower("product_name").like(pattern))
    if in_stock_only:
        p = p.filter(F.col("stock_qty") > 0)
    # bounds arrive as floats; their shortest decimal form compares the same
    # way with 2-decimal prices and keeps the predicate pushable
    if min_price is not None:
        p = p.filter(F.col("price") >= F.lit(Decimal(repr(float(min_price)))))
    if max_price is not None:
        p = p.filter(F.col("price") <= F.lit(Decimal(repr(float(max_price)))))
    out = p.join(categories.select("category_id", "category_name"), "category_id").select(*SEARCH_COLUMNS)
    return out.orderBy(*sort_columns(sort)) if ordered else out


def with_rating(products: DataFrame, id_col: str = "product_id") -> DataFrame:
    """Rating (DECIMAL(2,1)) and its star row."""
    return products.withColumn("rating", rating_expr(id_col)).withColumn("stars", stars_expr("rating"))


def filter_min_rating(df: DataFrame, min_rating: float | None) -> DataFrame:
    """Keep rating >= ``min_rating``; no filter when unset."""
    if not min_rating:
        return df
    return df.filter(F.col("rating") >= F.lit(min_rating).cast("decimal(3,1)"))


def with_stock_badge(products: DataFrame) -> DataFrame:
    """B6."""
    return products.withColumn("stock_badge", stock_badge())


def page_count(n_rows: int, size: int = PAGE_SIZE) -> int:
    return max(1, -(-n_rows // size))


def paginate(df: DataFrame, order: list, page: int, size: int = PAGE_SIZE) -> DataFrame:
    """One page of ``df`` in ``order``; page clamped to [1, pages].

    The row count is one small aggregate; the page itself is an
    ``orderBy().offset().limit()`` (a top-(offset+size), not a full sort).
    Adds ``page``, ``total_pages`` and ``total_count``.
    """
    n = df.count()
    pages = page_count(n, size)
    page = min(max(1, int(page)), pages)
    start = (page - 1) * size
    return (df.orderBy(*order).offset(start).limit(size)
            .withColumn("page", F.lit(page)).withColumn("total_pages", F.lit(pages))
            .withColumn("total_count", F.lit(n).cast("bigint")))


def product_detail(products: DataFrame, categories: DataFrame, ids) -> DataFrame:
    """Detail rows for the active products among ``ids``.

    ``ids`` is a list (pushed into the scan as an IN filter) or a DataFrame
    with a ``product_id`` column (semi-join).
    """
    p = products.filter(F.col("is_active"))
    if isinstance(ids, DataFrame):
        p = p.join(ids.select("product_id").distinct(), "product_id", "left_semi")
    else:
        p = p.filter(F.col("product_id").isin(list(ids)))
    out = p.join(categories.select("category_id", "category_name"), "category_id")
    return with_rating(out.select(*SEARCH_COLUMNS))


def related_products(products: DataFrame, k: int = 3) -> DataFrame:
    """For every active product, the first ``k`` other active products of
    its category in the default (name) order.

    Only the first k+1 of each category can be anybody's answer, so those
    are found once (skew-safe two-stage top-k) and paired with each product
    of the category (at most k+1 partners each).  A partner's position is its
    rank in the category, less one if the product itself stands before it.
    """
    active = products.filter(F.col("is_active")).select("product_id", "category_id", "product_name", "price")
    order = [F.col("product_name").asc(), F.col("product_id").asc()]
    head = top_k_per_group(active, ["category_id"], order, k + 1, salt_col="product_id", rank_col="head_rank")
    head = head.select("category_id", F.col("product_id").alias("related_id"),
                       F.col("product_name").alias("related_name"), F.col("price").alias("related_price"),
                       "head_rank")
    own = head.select(F.col("related_id").alias("product_id"), F.col("head_rank").alias("own_rank"))
    pairs = (active.select("product_id", "category_id").join(own, "product_id", "left")
             .join(head, "category_id").filter(F.col("related_id") != F.col("product_id")))
    before = F.when(F.col("own_rank") < F.col("head_rank"), 1).otherwise(0)
    return (pairs.withColumn("position", (F.col("head_rank") - before).cast("int")).filter(F.col("position") <= k)
            .select("product_id", "position", "related_id", "related_name", "related_price"))


def featured_products(products: DataFrame, categories: DataFrame, k: int = 4) -> DataFrame:
    """In stock, active, dearest ``k``."""
    return search_products(products, categories, in_stock_only=True, sort="price_desc").limit(k)


def classify_products(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Rule-based category key per product."""
    p = products.join(categories.select("category_id", "category_name"), "category_id", "left")
    return p.select("product_id", "sku", "product_name",
                    classify_expr("sku", "category_name", "product_name", "description").alias("category_key"))


def ingest_products(batch: DataFrame, products: DataFrame, categories: DataFrame):
    """Admit a batch of new products -> (accepted, rejected).

    ``batch`` has seq, category_id, sku, product_name, description, price,
    stock_qty, reorder_level, is_active.  Checks, in order: request field
    rules on the raw values, empty after normalisation, unknown category,
    SKU already stored or taken by an earlier row of the batch.
    """
    b = batch.select(
        "seq", "category_id", F.col("sku").alias("raw_sku"), F.col("product_name").alias("raw_name"),
        F.col("description").alias("raw_description"), "price", "stock_qty",
        F.coalesce("reorder_level", F.lit(5)).alias("reorder_level"),
        F.coalesce("is_active", F.lit(True)).alias("is_active"),
        F.upper(strip_ws("sku")).alias("sku"), strip_ws("product_name").alias("product_name"),
        F.nullif(strip_ws(F.coalesce("description", F.lit(""))), F.lit("")).alias("description"))
    known_cat = categories.select("category_id", F.lit(True).alias("_cat_ok"))
    stored = products.select("sku", F.lit(True).alias("_sku_taken"))
    b = b.join(known_cat, "category_id", "left").join(stored, "sku", "left")
    L = F.length
    static = (F.when(F.col("category_id").isNull() | (F.col("category_id") <= 0), "category_id must be > 0")
              .when(F.col("raw_sku").isNull() | (L("raw_sku") < 3) | (L("raw_sku") > 60), "sku length must be 3..60")
              .when(F.col("raw_name").isNull() | (L("raw_name") < 2) | (L("raw_name") > 160),
                    "product_name length must be 2..160")
              .when(L(F.coalesce("raw_description", F.lit(""))) > 2000, "description longer than 2000")
              .when(F.col("price").isNull() | (F.col("price") <= 0), "price must be > 0")
              .when(F.col("stock_qty").isNull() | (F.col("stock_qty") < 0), "stock_qty must be >= 0")
              .when(F.col("reorder_level") < 0, "reorder_level must be >= 0")
              .when(F.col("sku") == "", "SKU is required.")
              .when(F.col("product_name") == "", "Product name is required."))
    b = b.withColumn("_static", static)
    candidate = F.col("_static").isNull() & F.col("_sku_taken").isNull() & F.col("_cat_ok").isNotNull()
    # the first candidate of a SKU takes it: a partial minimum, joined back
    first = b.filter(candidate).groupBy("sku").agg(F.min("seq").alias("_taken_at"))
    b = b.join(first, "sku", "left")
    # a unique violation is raised before the foreign-key check
    reason = (F.when(F.col("_static").isNotNull(), F.col("_static"))
              .when(F.col("_sku_taken").isNotNull() | (F.col("_taken_at") < F.col("seq")), "SKU already exists.")
              .when(F.col("_cat_ok").isNull(), "Invalid category selected."))
    b = b.withColumn("reject_reason", reason)
    accepted = b.filter(F.col("reject_reason").isNull()).select(
        "seq", "category_id", "sku", "product_name", "description", F.col("price").cast(MONEY).alias("price"),
        F.col("stock_qty").cast("int").alias("stock_qty"), F.col("reorder_level").cast("int").alias("reorder_level"),
        "is_active")
    rejected = b.filter(F.col("reject_reason").isNotNull()).select("seq", "raw_sku", "reject_reason")
    return accepted, rejected
