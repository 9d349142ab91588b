"""A1 / A10: read a table under its declared schema, write results."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import schema

# Keys by which each stored table is dealt into buckets: the key its joins and sums meet on.
LAYOUT = {
    "users": ["user_id"], "carts": ["user_id"], "cart_items": ["cart_id"], "products": ["product_id"],
    "orders": ["order_id"], "order_items": ["order_id"], "inventory_audit": ["product_id"],
    "order_audit": ["order_id"], "user_sessions": ["user_id"],
}


def read_raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; column pruning and filters reach the parquet scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def conform(df: DataFrame, name: str) -> DataFrame:
    """Project ``df`` onto the declared schema of ``name``.

    Missing nullable columns become NULL, every column is cast to its
    declared type (DECIMAL(12,2) money is enforced here); extra columns
    are dropped.
    """
    cols = []
    have = set(df.columns)
    for f in schema(name).fields:
        if f.name in have:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.nullable:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            raise ValueError(f"{name}: required column {f.name} missing")
    return df.select(*cols)


def load_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A1: read a stored shop table and enforce its declared types."""
    return conform(spark.read.parquet(path), name)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                bucket_by: tuple[int, list[str]] | None = None, table: str | None = None,
                mode: str = "overwrite") -> None:
    """A10: persist a result.

    ``partition_by`` gives directory partitions (pruned by filters on read);
    ``bucket_by=(n, keys)`` with ``table`` writes a bucketed table so later
    joins and aggregations on ``keys`` skip the shuffle.
    """
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        if not table:
            raise ValueError("bucketed output needs a table name")
        n, keys = bucket_by
        w.bucketBy(n, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    else:
        w.parquet(path)


def stored_name(prefix: str, name: str) -> str:
    if not re.fullmatch(r"\w+", prefix):
        raise ValueError("the prefix of stored tables is a plain word")
    return f"{prefix}_{name}"


def store_tables(tables: dict[str, DataFrame], root: str, prefix: str, buckets: int) -> None:
    """A10 for tables that are joined: each under its declared schema, bucketed by ``LAYOUT``.

    All tables get the same number of buckets, so tables of one key are read
    back co-located.  Rows are dealt to the buckets before they are written:
    one file a bucket, whatever the number of tasks was.  Size ``buckets`` so
    that one holds 128-256 MB of the largest table.  Tables without a key in
    ``LAYOUT`` are written plainly.
    """
    for name, df in tables.items():
        df, path, keys = conform(df, name), f"{root.rstrip('/')}/{name}", LAYOUT.get(name)
        if keys:
            write_table(df.repartition(buckets, *keys), path, bucket_by=(buckets, keys), table=stored_name(prefix, name))
        else:
            df.write.mode("overwrite").option("path", path).saveAsTable(stored_name(prefix, name))


def stored_table(spark: SparkSession, name: str, prefix: str) -> DataFrame:
    """A1 for a table of ``store_tables``: the schema is the catalog's, so no
    footer is read to find it, and the casts to the declared types fall away."""
    return conform(spark.table(stored_name(prefix, name)), name)
