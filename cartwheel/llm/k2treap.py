"""Ranked lexical search by K2-treaps over the grid of terms and documents.

Terms are the maximal runs of ASCII letters and digits and of all other
characters beyond ASCII; A-Z are lower-cased.  Every document gives its
postings of the queries' terms in one pass over its text; what the impacts
need of the whole corpus (documents with a term, terms with repeats, and the
documents of each term) is counted from all documents.

Documents are dealt over shards of about ``POSTINGS`` postings.  A shard is a
grid, its rows the terms by falling weight, its columns the documents, each
cell an impact.  The grid is kept as a compressed quadtree: every cell of
every level has four bits that tell which quarters hold anything, a rank
that leads to them, and the largest impact within.  A query follows the rows of
all its terms at once, over ranges of documents: the largest impacts of
the rows' cells add up to a bound of every score in the range, the ranges
with the best bounds are halved first, and it ends when no bound reaches the
k-th best score.  A range of one document has its exact score.  The shards'
best are merged by rank.

Integers of 64 bits throughout; ``div`` rounds down.  Terms are told apart by
128-bit hashes, among those of the queries by 64 bits, which is checked.

Defined cases: a null text has no terms; rows that share a document id are
documents of their own; rows that share an item id are one item with the
terms of all of them; null ids are ids (a null document id comes last among
equal scores); an item without a known term has no rows; very long texts are
taken whole; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .words import SpanHasher, mix, spans
from .worker import bounded_batches, cached, discard, slices, text_buffers

#: Postings of a shard and items of a block, on average.
POSTINGS, ITEMS = 1 << 20, 2_048
#: Ranges halved in one go, from the first step to the later ones.
FEW, MANY = 16, 512
_BITS = np.array([bin(x).count("1") for x in range(16)], np.int64)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Which bytes belong to terms, and all bytes with A-Z lower-cased."""
    byte = np.arange(256)
    upper = (byte >= ord("A")) & (byte <= ord("Z"))
    lower = np.where(upper, byte + 32, byte).astype(np.uint8)
    return upper | ((byte >= ord("a")) & (byte <= ord("z"))) | ((byte >= ord("0")) & (byte <= ord("9"))) | (byte >= 128), lower


def counted(column) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, two hashes, occurrences) of the distinct terms of each text, by text; and all terms of each text."""
    data, offsets = text_buffers(column)
    inside, lower = cached("k2treap:bytes", _tables)
    data = lower[data]
    start, end, text = spans(inside[data], offsets)
    g, h = (SpanHasher(data, seed)(start, end) for seed in (3, 4))
    total = np.bincount(text, minlength=len(offsets) - 1)
    key = mix(g + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    k, t, x, y = key[order], text[order], g[order], h[order]
    new = np.ones(len(k), bool)
    new[1:] = (t[1:] != t[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    if (new[1:] & (k[1:] == k[:-1])).any():  # two terms share a sort key: sort by the terms themselves
        order = np.lexsort((h, g, text))
        t, x, y = text[order], g[order], h[order]
        new[1:] = (t[1:] != t[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    first = np.flatnonzero(new)
    tf = np.diff(np.append(first, len(t)))
    by_text = np.argsort(t[first], kind="stable")
    first, tf = first[by_text], tf[by_text]
    return t[first], x[first], y[first], tf, total


def _item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """item_id, g, h of the distinct terms of every item."""
    source = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            owner, g, h, _, _ = counted(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("item_id").take(pa.array(owner)), pa.array(g.view(np.int64)), pa.array(h.view(np.int64))],
                                             names=["item_id", "g", "h"])

    return source.mapInArrow(run, f"item_id {source.schema['item_id'].dataType.simpleString()}, g long, h long").distinct()


def _postings(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc (a number of the row), doc_id, n, g, h, tf of every distinct term of every row.

    A row without ``doc`` tells of a slice of the texts how many have terms (n)
    and all their terms (tf).
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        names = ["doc", "doc_id", "n", "g", "h", "tf"]
        for part in slices(batches, "text"):
            owner, g, h, tf, total = counted(part.column("text"))
            yield pa.RecordBatch.from_arrays([
                pa.array(base + owner), part.column("doc_id").take(pa.array(owner)), pa.array(total[owner]),
                pa.array(g.view(np.int64)), pa.array(h.view(np.int64)), pa.array(tf)], names=names)
            yield pa.RecordBatch.from_arrays([
                pa.nulls(1, pa.int64()), pa.nulls(1, part.schema.field("doc_id").type), pa.array([int((total > 0).sum())]),
                pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([int(total.sum())])], names=names)
            base += part.num_rows

    return source.mapInArrow(run, f"doc long, doc_id {source.schema['doc_id'].dataType.simpleString()}, n long, g long, h long, tf long")


def _spread(x: np.ndarray) -> np.ndarray:
    """The bits of 32-bit numbers moved to the even places."""
    x = x.astype(np.uint64)
    # The usual masks of Morton codes.
    for shift, m in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(m)
    return x


class Treap:
    """Compressed quadtree over the non-empty cells of a grid, with the largest weight of every cell of every level."""

    def __init__(self, row: np.ndarray, column: np.ndarray, weight: np.ndarray):
        self.depth = max(1, int(max(row.max(), column.max())).bit_length()) if len(row) else 1
        code = (_spread(row) << np.uint64(1)) | _spread(column)
        order = np.argsort(code)
        code, best = code[order], weight[order].astype(np.int64)
        quarters, largest = [np.zeros(len(best), np.uint8)], [best]
        for _ in range(self.depth):
            above = code >> np.uint64(2)
            new = np.flatnonzero(np.concatenate([[True], above[1:] != above[:-1]])) if len(above) else np.empty(0, np.int64)
            bit = (np.uint8(1) << (code & np.uint64(3)).astype(np.uint8))
            quarters.append(np.bitwise_or.reduceat(bit, new) if len(new) else bit)
            best = np.maximum.reduceat(best, new) if len(new) else best
            largest.append(best)
            code = above[new]
        # cells of all levels from the root on; one more stands for all empty ones
        self.quarters = np.concatenate([*quarters[::-1], np.zeros(1, np.uint8)])
        self.largest = np.concatenate([*largest[::-1], np.zeros(1, np.int64)])
        self.empty = len(self.largest) - 1
        some = _BITS[self.quarters]
        self.first = np.cumsum(some) - some + 1 if self.empty else np.zeros(1, np.int64)
        self.root = 0 if self.empty else self.empty

    def halve(self, cell: np.ndarray, rows: np.ndarray, level: np.ndarray, half: int) -> np.ndarray:
        """The cells of ``rows`` (ranges x rows) in the lower or upper half of their ranges of columns."""
        bit = (rows[None, :] >> (self.depth - 1 - level)[:, None]) & 1
        have, quarter = self.quarters[cell], (2 * bit + half).astype(np.uint8)
        below = _BITS[have & ((np.uint8(1) << quarter) - np.uint8(1))]
        return np.where((have >> quarter) & 1, self.first[cell] + below, self.empty)

    def best(self, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(columns, sums over ``rows``) of the columns with the k highest sums above 0; all that share the k-th sum."""
        rows = rows[rows >> self.depth == 0]  # rows beyond the grid hold nothing
        bound = np.array([self.largest[np.full(len(rows), self.root)].sum()])
        cell, level, column = np.full((1, len(rows)), self.root), np.zeros(1, np.int64), np.zeros(1, np.int64)
        found, score = np.empty(0, np.int64), np.empty(0, np.int64)
        bar, width = 1, FEW
        while len(bound):
            alive = bound >= bar
            if not alive.all():
                bound, cell, level, column = bound[alive], cell[alive], level[alive], column[alive]
                if not len(bound):
                    break
            take = np.argpartition(-bound, width - 1)[:width] if len(bound) > width else np.arange(len(bound))
            c, lv, col = cell[take], level[take], column[take]
            rest = np.ones(len(bound), bool)
            rest[take] = False
            halves = [self.halve(c, rows, lv, half) for half in (0, 1)]
            c, lv, col = np.concatenate(halves), np.concatenate([lv, lv]) + 1, np.concatenate([2 * col, 2 * col + 1])
            b = self.largest[c].sum(axis=1)
            ends = (lv == self.depth) & (b >= bar)
            if ends.any():
                found, score = np.append(found, col[ends]), np.append(score, b[ends])
                if len(score) >= k:
                    bar = max(bar, int(np.partition(score, len(score) - k)[len(score) - k]))
                    stay = score >= bar
                    found, score = found[stay], score[stay]
            go = (lv < self.depth) & (b >= bar)
            bound, cell = np.append(bound[rest], b[go]), np.concatenate([cell[rest], c[go]])
            level, column = np.append(level[rest], lv[go]), np.append(column[rest], col[go])
            width = min(2 * width, MANY)
        return found, score


def impacts(weight: np.ndarray, tf: np.ndarray, n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """weight * ((10^9 tf) div (1000 tf + 20 m)), m = 50 + (50 n documents) div terms."""
    m = 100 - 50 + (50 * n * documents) // terms
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def _search(posts: pa.Table, asked: pa.Table, k: int, documents: int, terms: int) -> pa.Table:
    """item_id, doc_id, score of every asked item's best documents of one shard."""
    item, doc = asked.column("item_id"), posts.column("doc_id")
    g, w = asked["g"].to_numpy(), asked["w"].to_numpy()
    known, at = np.unique(g, return_index=True)
    by_weight = np.argsort(-w[at], kind="stable")
    row_of = np.empty(len(known), np.int64)
    row_of[by_weight] = np.arange(len(known))
    pg = posts["g"].to_numpy()
    place = np.minimum(np.searchsorted(known, pg), len(known) - 1)
    mine = known[place] == pg
    place = place[mine]
    _, first, column = np.unique(posts["doc"].to_numpy()[mine], return_index=True, return_inverse=True)
    first = np.flatnonzero(mine)[first]
    weight = impacts(w[at][place], posts["tf"].to_numpy()[mine], posts["n"].to_numpy()[mine], documents, terms)
    treap = Treap(row_of[place], column, weight)
    number = pa.compute.rank(item.combine_chunks() if isinstance(item, pa.ChunkedArray) else item, tiebreaker="dense").to_numpy()
    order = np.argsort(number, kind="stable")
    edge = np.flatnonzero(np.concatenate([[True], np.diff(number[order]) != 0]))
    items, places, scores = [], [], []
    ids = doc.combine_chunks() if isinstance(doc, pa.ChunkedArray) else doc
    for a, b in zip(edge, np.append(edge[1:], len(order))):
        rows = row_of[np.searchsorted(known, g[order[a:b]])]
        found, score = treap.best(rows, k)
        if len(found) > k:  # more share the k-th score: the smallest ids stay
            by_id = pa.compute.rank(ids.take(pa.array(first[found])), tiebreaker="first", null_placement="at_end").to_numpy()
            keep = np.lexsort((by_id, -score))[:k]
            found, score = found[keep], score[keep]
        items.append(np.full(len(found), order[a]))
        places.append(first[found])
        scores.append(score)
    none = np.empty(0, np.int64)
    return pa.table({"item_id": item.take(pa.array(np.concatenate([none, *items]))), "doc_id": doc.take(pa.array(np.concatenate([none, *places]))),
                     "score": pa.array(np.concatenate([none, *scores]))})


def search(docs: DataFrame, items: DataFrame, k: int = 50, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text",
           item_text: str = "text") -> DataFrame:
    """item_id, rank (from 1), doc_id, score of every item's ``k`` highest-scoring documents with a score above 0.

    Items are asked in blocks of about ``ITEMS``; for each block a shard's
    treap is built of the block's terms, which costs little beside its queries.
    """
    bounded_batches(docs.sparkSession)
    asked = cut_lineage(_item_terms(items, item_id, item_text))
    vocabulary = asked.select(F.col("g").alias("vg"), F.col("h").alias("vh")).distinct()
    if not vocabulary.groupBy("vg").count().filter("count > 1").isEmpty():
        raise ValueError("two terms of the items share a 64-bit hash")
    every = _postings(docs, doc_id, text)
    posts = cut_lineage(every.join(vocabulary, (F.col("g") == F.col("vg")) & (F.col("h") == F.col("vh")), "left")
                        .filter("vg is not null or doc is null").drop("vg", "vh", "h"))
    summary = posts.agg(F.coalesce(F.sum(F.when(F.col("doc").isNull(), F.col("n"))), F.lit(0)).alias("documents"),
                        F.coalesce(F.sum(F.when(F.col("doc").isNull(), F.col("tf"))), F.lit(0)).alias("terms"),
                        F.count("doc").alias("postings")).first()
    documents, terms = summary["documents"], summary["terms"]
    shards = -(-summary["postings"] // POSTINGS) or 1
    blocks = -(-asked.select("item_id").distinct().count() // ITEMS) or 1
    df = posts.filter("doc is not null").groupBy("g").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(documents) + 2).cast("double") / (2 * F.col("df") + 1).cast("double"))).cast("long")
    weighed = asked.join(df, "g").select("item_id", "g", weight.alias("w"))
    every_number = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int")
    right = weighed.withColumn("block", block).withColumn("shard", every_number(shards))
    left = (posts.filter("doc is not null").withColumn("shard", F.pmod(F.xxhash64("doc"), F.lit(shards)).cast("int"))
            .withColumn("block", every_number(blocks)))

    def run(posts: pa.Table, asked: pa.Table) -> pa.Table:
        if not posts.num_rows or not asked.num_rows:
            return pa.table({"item_id": asked["item_id"].slice(0, 0), "doc_id": posts["doc_id"].slice(0, 0), "score": pa.array([], pa.int64())})
        return _search(posts, asked, k, documents, terms)

    kind = lambda df, c: df.schema[c].dataType.simpleString()
    best = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(
        run, f"item_id {kind(asked, 'item_id')}, doc_id {kind(posts, 'doc_id')}, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    out = cut_lineage(ranked.select("item_id", "rank", "doc_id", "score"))
    discard(asked, posts)
    return out
