"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Rows of equal text form a group that stays in one shard.  Items are sorted
by size and each enters the bin with the least remaining capacity that still
holds it, found in a balanced tree of the remaining capacities; a bin is
opened when none holds it.  For a given number of shards the least capacity
that needs no more bins is taken.

Groups larger than a grain (a fixed share of a shard) are items of their
own; their number is bounded by that share.  Smaller groups are gathered by
the hash of their text into blocks of geometrically falling sizes, which are
the remaining items.  So the packing sees a bounded number of items whatever
the number of documents, and a small corpus, where every group exceeds the
grain, is packed group by group.

Defined cases: null texts count no bytes and form one group apart from the
empty text; a group larger than a fair share gets a shard of its own;
repeated rows (also repeated ids) are rows of their own; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

#: A group above a shard's capacity divided by this is an item of its own.
GRAIN = 512
#: Levels of block sizes, each half as large as the one before.
LEVELS = 9
#: Blocks of a level for each shard.
BLOCKS = 16
#: Shards of one call; for more, shard again within a shard.
MOST_SHARDS = 4_096
#: Rows numbered together, at most about this many or this share of all rows.
NUMBERED_ROWS, NUMBERED_SHARE = 100_000, 4_096


class CapacityTree:
    """Treap of (remaining capacity, bin): insert, remove and the least entry that holds a size."""

    def __init__(self, seed: int = 1):
        self.root, self.random = None, random.Random(seed)

    def _merge(self, a, b):
        if not a or not b:
            return a or b
        if a[1] > b[1]:
            a[3] = self._merge(a[3], b)
            return a
        b[2] = self._merge(a, b[2])
        return b

    def _split(self, node, key):
        """Entries below ``key``, and the others."""
        if not node:
            return None, None
        if node[0] < key:
            node[3], right = self._split(node[3], key)
            return node, right
        left, node[2] = self._split(node[2], key)
        return left, node

    def insert(self, key: tuple[int, int]) -> None:
        left, right = self._split(self.root, key)
        self.root = self._merge(self._merge(left, [key, self.random.random(), None, None]), right)

    def take(self, size: int) -> tuple[int, int] | None:
        """Removes and returns the tightest entry that holds ``size``."""
        left, right = self._split(self.root, (size, -1))
        if not right:
            self.root = left
            return None
        node, above = right, None
        while node[2]:
            above, node = node, node[2]
        if above:
            above[2] = node[3]
        else:
            right = node[3]
        self.root = self._merge(left, right)
        return node[0]


def best_fit_decreasing(sizes: list[int], capacity: int, most_bins: int | None = None) -> list[int] | None:
    """The bin of each item; None as soon as more than ``most_bins`` are needed.

    An item larger than the capacity gets a bin of its own.  Equal sizes keep
    their order, equal remaining capacities go to the earlier bin.
    """
    tree, bins, at = CapacityTree(), 0, [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda j: (-sizes[j], j)):
        held = tree.take(sizes[i])
        if held is None:
            if most_bins is not None and bins >= most_bins:
                return None
            held, bins = (max(capacity, sizes[i]), bins), bins + 1
        at[i] = held[1]
        tree.insert((held[0] - sizes[i], held[1]))
    return at


def pack(sizes: list[int], bins: int) -> list[int]:
    """Items into ``bins`` bins of near equal sizes: the least capacity whose best-fit-decreasing packing fits.

    An item that is a fair share of what is left, or more, is put into a bin
    of its own first; the others share the bins that remain.
    """
    order = sorted(range(len(sizes)), key=lambda j: (-sizes[j], j))
    at, first, left = [0] * len(sizes), 0, sum(sizes)
    while first < len(order) and bins - first > 1 and sizes[order[first]] * (bins - first) >= left:
        at[order[first]] = first
        left -= sizes[order[first]]
        first += 1
    some = order[first:]
    if not some:
        return at
    open_bins, own = bins - first, [sizes[j] for j in some]
    low = max(-(-left // open_bins), own[0])
    high = -(-left // open_bins) + own[0]  # if an item fitted nowhere, the bins would hold more than all items
    while low < high:
        middle = (low + high) // 2
        if best_fit_decreasing(own, middle, open_bins) is None:
            low = middle + 1
        else:
            high = middle
    for j, b in zip(some, best_fit_decreasing(own, low, open_bins)):
        at[j] = first + b
    return at


def _block(group) -> F.Column:
    """Block name of a small group: level by leading zero bits of its hash, then evenly within the level."""
    h = F.xxhash64(group)
    level = F.least(F.lit(LEVELS - 1), F.lit(63) - F.length(F.regexp_replace(F.bin(h.bitwiseAND(F.lit(2 ** 63 - 1))), "^0+", "")))
    return level, F.xxhash64(group, F.lit("block"))


def shard(docs: DataFrame, shards: int | None = None, capacity: int | None = None, doc_id: str = "doc_id",
          text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot: every row's shard and its gapless place there.

    Give ``shards`` for that many shards of near equal bytes, or ``capacity``
    for the least number of shards of that many bytes each.  Size is the
    UTF-8 length plus 8.
    """
    if (shards is None) == (capacity is None):
        raise ValueError("give either shards or capacity")
    spark, text_col = docs.sparkSession, F.col(text)
    rows = cut_lineage(docs.select(
        F.col(doc_id).alias("doc_id"), (F.coalesce(F.octet_length(text_col), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(text_col, F.lit("")).cast("binary")).alias("text_crc32"),
        F.coalesce(F.sha2(text_col, 256), F.lit("null")).alias("group"), F.monotonically_increasing_id().alias("row")))
    count, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    shards_at_least = shards or max(1, -(-total // capacity))
    if shards_at_least > MOST_SHARDS:
        raise ValueError(f"more than {MOST_SHARDS} shards; shard in two steps")
    grain = max(1, -(-total // shards_at_least) // GRAIN)
    level, spread = _block("group")
    block = F.concat_ws("-", F.lit("block"), level, F.pmod(spread, F.lit(BLOCKS * shards_at_least)))
    groups = rows.groupBy("group").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    named = groups.withColumn("item", F.when(F.col("bytes") > grain, F.col("group")).otherwise(block))
    # at most GRAIN large groups and BLOCKS * LEVELS blocks for each shard
    items = named.groupBy("item").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).orderBy("item").collect()
    sizes = [r["bytes"] for r in items]
    at = pack(sizes, shards) if shards else best_fit_decreasing(sizes, capacity)
    share = max(1, min(NUMBERED_ROWS, -(-count // NUMBERED_SHARE)))
    table = [(r["item"], b, -(-r["n"] // share)) for r, b in zip(items, at)]
    schema = T.StructType([T.StructField("item", T.StringType()), T.StructField("shard", T.IntegerType()), T.StructField("parts", T.LongType())])
    large = spark.createDataFrame([t for t in table if not t[0].startswith("block-")], schema)
    blocks = spark.createDataFrame([t for t in table if t[0].startswith("block-")], schema)
    # both tables are bounded by the packing's item count, see above
    placed = (rows.join(F.broadcast(large), rows["group"] == large["item"], "left").withColumn("block", block)
              .join(F.broadcast(blocks.select(F.col("item").alias("block"), F.col("shard").alias("block_shard"), F.col("parts").alias("block_parts"))), "block", "left")
              .select("doc_id", "size", "text_crc32", "row", F.coalesce("item", "block").alias("item"),
                      F.when(F.col("item").isNotNull(), F.col("shard")).otherwise(F.col("block_shard")).alias("shard"),
                      F.when(F.col("item").isNotNull(), F.col("parts")).otherwise(F.col("block_parts")).alias("parts")))
    placed = placed.withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")))
    # a slot is the rows of the shard's earlier parts, then the place within the part
    counts = placed.groupBy("shard", "item", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("item", "part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n", "shard")
    place = Window.partitionBy("item", "part").orderBy("row")
    numbered = placed.withColumn("place", F.row_number().over(place) - 1)
    return (numbered.join(offsets, ["item", "part"])
            .select("doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("place")).cast("long").alias("slot")))
