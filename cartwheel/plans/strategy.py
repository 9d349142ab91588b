"""Physical-strategy helpers: checked broadcasts, sized shuffles and skew-safe prefix scans."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows one task may scan for one key before the key is split into chunks.
ROWS_PER_CHUNK = 1_000_000


# Order lines one task of a shuffle should hold, and the shuffled bytes up to
# which adaptive execution may join small partitions where there are many lines.
ROWS_PER_TASK = 500_000
TASK_BYTES = 8 << 20


def size_shuffles(spark, rows: int) -> int:
    """Sizes the session's shuffles for ``rows`` rows, so that a task's memory does not grow with the input.

    A fixed number of partitions gives each task a fixed share of the input,
    and so does adaptive execution, which by default joins partitions until
    there are about as many as cores.  Input that needs no more tasks than
    there are cores changes nothing; settings that are finer already stay.
    Returns the number of tasks ``rows`` need.
    """
    tasks = -(-rows // ROWS_PER_TASK)
    if tasks > spark.sparkContext.defaultParallelism:
        if int(spark.conf.get("spark.sql.shuffle.partitions")) < tasks:
            spark.conf.set("spark.sql.shuffle.partitions", str(tasks))
        number, unit = re.match(r"\s*(\d+)\s*([a-z]?)", spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes").lower()).groups()
        if int(number) << {"k": 10, "m": 20, "g": 30, "t": 40}.get(unit, 0) > TASK_BYTES:
            spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(TASK_BYTES))
    return tasks


def rows_per_chunk(spark) -> int:
    return int(spark.conf.get("cartwheel.skew.rowsPerChunk", str(ROWS_PER_CHUNK)))


def _order_number(df: DataFrame, col: str) -> Column:
    first = F.col(col)
    if dict(df.dtypes)[col].startswith("timestamp"):
        first = F.unix_micros(first.cast("timestamp"))
    return first.cast("double")


def hot_keys(df: DataFrame, key: list[str], order_col: str, chunk_rows: int | None = None) -> DataFrame:
    """Keys with more than ``chunk_rows`` rows, their chunk count and order range.

    At most N / chunk_rows rows.  Computed once, it can be reused by every
    ``running_total`` over a subset of ``df`` (iterative operators).
    """
    limit = chunk_rows or rows_per_chunk(df.sparkSession)
    first = _order_number(df, order_col)
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("__rt_n"), F.min(first).alias("__rt_lo"),
                                 F.max(first).alias("__rt_hi"))
            .filter(F.col("__rt_n") > limit)
            .select(*key, F.ceil(F.col("__rt_n") / limit).alias("__rt_m"), "__rt_lo", "__rt_hi"))


def _join_small(df: DataFrame, small: DataFrame, key: list[str]) -> DataFrame:
    """Left join with a small table by ``key``; NULLs are equal."""
    named = small.select(*[F.col(k).alias(f"__rt_key{i}") for i, k in enumerate(key)],
                         *[c for c in small.columns if c not in key])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__rt_key{i}")) for i, k in enumerate(key)])
    return df.join(F.broadcast(named), same, "left").drop(*[f"__rt_key{i}" for i in range(len(key))])


def in_chunks(df: DataFrame, key: list[str], order_col: str, hot: DataFrame) -> DataFrame:
    """``df`` with ``__rt_hot`` and ``__rt_chunk``: the rows of a ``hot_keys`` key cut by ranges of ``order_col``, other keys in one chunk."""
    first = _order_number(df, order_col)
    part = F.floor((first - F.col("__rt_lo")) * F.col("__rt_m") / (F.col("__rt_hi") - F.col("__rt_lo") + 1))
    chunk = F.when(F.col("__rt_m").isNull() | part.isNull(), F.lit(0)).otherwise(F.least(F.col("__rt_m") - 1, part)).cast("long")
    c = _join_small(df, hot, key).withColumn("__rt_chunk", chunk).withColumn("__rt_hot", F.col("__rt_m").isNotNull())
    return c.drop("__rt_m", "__rt_lo", "__rt_hi")


def running_total(df: DataFrame, key: list[str], order: list[str], value, out,
                  inclusive: bool = True, agg: str = "sum", chunk_rows: int | None = None,
                  hot: DataFrame | None = None) -> DataFrame:
    """Per-key running ``agg`` (sum or max) of ``value`` in ``order``, safe for hot keys.

    A plain ``Window.partitionBy(key)`` puts every row of a key in one task;
    if one key holds a third of the data that task holds a third of the
    data.  Here:

    1. a partial aggregate counts rows per key and keeps the *hot* keys
       (more than ``chunk_rows`` rows) with the min/max of the first order
       column; at most N / chunk_rows rows, so broadcasting them is safe;
    2. a hot key's rows are cut into ceil(n / chunk_rows) chunks by ranges
       of the first order column (monotone in the order, deterministic);
       other keys are a single chunk;
       NULL keys form one key and are split too, and NULL order values
       stand first, as in a plain window;
    3. the window runs per (key, chunk), i.e. on at most ~chunk_rows rows;
    4. per-chunk totals of hot keys (a few rows per hot key) are
       prefix-combined and broadcast back as offsets.

    ``inclusive=False`` covers strictly earlier rows only.  The first order
    column must be numeric or a timestamp.  ``value``/``out`` may be lists
    (several running aggregates share one pass).  ``hot`` may pass a
    ``hot_keys`` table computed once over a superset of ``df``.
    """
    values = [value] if isinstance(value, str) else list(value)
    outs = [out] if isinstance(out, str) else list(out)
    fn = {"sum": F.sum, "max": F.max}[agg]
    if hot is None:
        hot = hot_keys(df, key, order[0], chunk_rows)
    c = in_chunks(df, key, order[0], hot)
    end = 0 if inclusive else -1
    w = Window.partitionBy(*key, "__rt_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
    local = c.select("*", *[fn(v).over(w).alias(f"__rt_local{i}") for i, v in enumerate(values)])
    slices = c.filter(F.col("__rt_hot")).groupBy(*key, "__rt_chunk").agg(
        *[fn(v).alias(f"__rt_slice{i}") for i, v in enumerate(values)])
    prev = Window.partitionBy(*key).orderBy("__rt_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select(*key, "__rt_chunk", *[fn(f"__rt_slice{i}").over(prev).alias(f"__rt_offset{i}")
                                              for i in range(len(values))])
    joined = _join_small(local, offsets, key + ["__rt_chunk"])
    for i, o in enumerate(outs):
        lo, off = F.col(f"__rt_local{i}"), F.col(f"__rt_offset{i}")
        both = off + lo if agg == "sum" else F.greatest(off, lo)
        joined = joined.withColumn(o, F.when(off.isNull(), lo).when(lo.isNull(), off).otherwise(both))
    drop = ["__rt_chunk", "__rt_hot"] + [f"__rt_local{i}" for i in range(len(values))] + [f"__rt_offset{i}" for i in range(len(values))]
    return joined.drop(*drop)


def top_k_per_group(df: DataFrame, group: list[str], order: list, k: int, salt_buckets: int = 16,
                    salt_col: str | None = None, rank_col: str = "rn") -> DataFrame:
    """First ``k`` rows per group in ``order`` with a ``rank_col`` 1..k.

    Two stages so a hot group is never ranked in one task: rows are ranked
    within (group, salt) where salt spreads a group over ``salt_buckets``
    tasks, only each salt's first k survive, then the survivors (at most
    salt_buckets * k per group) are ranked per group.
    """
    salt_src = F.col(salt_col) if salt_col else F.xxhash64(*[F.col(c) for c in df.columns])
    salted = df.withColumn("_salt", F.pmod(salt_src, F.lit(salt_buckets)))
    w1 = Window.partitionBy(*group, "_salt").orderBy(*order)
    pre = salted.withColumn("_r1", F.row_number().over(w1)).filter(F.col("_r1") <= k).drop("_r1", "_salt")
    w2 = Window.partitionBy(*group).orderBy(*order)
    return pre.withColumn(rank_col, F.row_number().over(w2)).filter(F.col(rank_col) <= k)
