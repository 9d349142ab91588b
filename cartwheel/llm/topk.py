"""Exact top-k by inner product: MaxScore over sharded postings.

Every dimension is a term and a vector's component its weight.  Within a
shard a term's posting list holds the vectors whose component has the sign
of the query's, by falling impact; its score bound is the largest product.
Terms are sorted by bound; the ones whose bounds together stay below the
current k-th score are non-essential: a vector found in no essential list
cannot enter the result.  The essential lists are traversed, and the other
terms are probed for a vector only while its score and the bounds that are
left still reach the k-th score.  Shards are merged at the end.

Defined cases: vectors that are null or hold a null, NaN or infinite
component take no part, nor does a row without id; integer components and
scores that 64 bits cannot hold count as the nearest they can, all sums are
exact (in wider integers where 64 bits might not do); where lengths differ
the missing components count as 0; equal scores go to the smaller id;
repeated rows are candidates of their own, but a query meets no row of its
own id; rows that share a query's id all ask, and the id's result is the best
of all their answers; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LIMIT = 2 ** 63 - 1
#: Candidates of one shard and queries of one block; a task holds one of each.
SHARD_ROWS = 16_384
BLOCK_QUERIES = 1_024


class Shard:
    """Postings of one shard's vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids = ids
        self.terms = np.ascontiguousarray(vectors.T)  # one row of weights per term
        self.order = np.argsort(self.terms, axis=1, kind="stable")
        self.high, self.low = self.terms.max(axis=1), self.terms.min(axis=1)
        self.lists = {1: np.packbits(self.terms > 0, axis=1), -1: np.packbits(self.terms < 0, axis=1)}

    def best(self, query_id: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(id, score) of the k best rows, ties to smaller ids."""
        n, own = len(self.ids), self.ids == query_id
        bound = np.maximum(query * self.high, query * self.low)
        bound = np.maximum(bound, 0)
        terms = np.argsort(-bound, kind="stable")
        terms = terms[query[terms] != 0]
        rest = np.append(np.cumsum(bound[terms][::-1])[::-1], 0)  # rest[j]: bounds of terms j and later
        # a first k-th score from the heads of the strongest lists
        heads = {int(i) for t in terms[:4] for i in (self.order[t, -8 * k:] if query[t] > 0 else self.order[t, :8 * k])}
        heads = np.array(sorted(i for i in heads if not own[i]), np.int64)
        floor = None
        if len(heads) >= k:
            floor = np.sort(query @ self.terms[:, heads])[-k]
        if floor is None or floor <= 0 or not len(terms):
            essential, rows = len(terms), np.arange(n)  # rows without any match score 0 or less and still compete
        else:
            essential = int(np.searchsorted(-rest, -floor, side="right"))  # rest[essential] < floor
            some = terms[:essential]
            bits = np.zeros(self.lists[1].shape[1], np.uint8)
            for sign in (1, -1):
                own_sign = some[np.sign(query[some]) == sign]
                if len(own_sign):
                    bits |= np.bitwise_or.reduce(self.lists[sign][own_sign], axis=0)
            rows = np.flatnonzero(np.unpackbits(bits, count=n))
        rows = rows[~own[rows]]
        part = terms[:essential]
        whole = len(rows) > n // 2
        score = (query[part] @ self.terms[part])[rows] if whole else query[part] @ self.terms[np.ix_(part, rows)]
        at = essential
        while at < len(terms):  # probe what is left while it can still reach the k-th score
            if len(rows) >= k:
                floor = max(floor, np.partition(score + self._least(query, terms[at:]), -k)[-k])
            keep = score + rest[at] >= floor
            rows, score = rows[keep], score[keep]
            step = terms[at:at + 8]
            score = score + query[step] @ self.terms[np.ix_(step, rows)]
            at += len(step)
        if len(rows) > k:
            keep = score >= np.partition(score, -k)[-k]
            rows, score = rows[keep], score[keep]
        first = np.lexsort((self.ids[rows], -score))[:k]
        return [(int(self.ids[rows[i]]), int(score[i])) for i in first]

    def _least(self, query: np.ndarray, terms: np.ndarray):
        """The least that the given terms can add to any row."""
        return np.minimum(query[terms] * self.high[terms], query[terms] * self.low[terms]).sum()


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of equal width, short ones filled with zeros."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    out = np.zeros((len(flat), width), np.int64)
    lengths = np.diff(flat.offsets.to_numpy())
    rows = np.repeat(np.arange(len(flat)), lengths)
    cols = np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[rows, cols] = flat.flatten().to_numpy(zero_copy_only=False)
    return out


def search_block(candidates: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """The k best candidates of every query of a block, as rows query_id, vec_id, score."""
    found: list[tuple[int, int, int]] = []
    if candidates.num_rows and queries.num_rows:
        longest = [int(np.diff(t["vector"].combine_chunks().offsets.to_numpy()).max()) for t in (candidates, queries)]
        x, q = (_matrix(t["vector"], max(*longest, 1)) for t in (candidates, queries))
        most = int(np.abs(x).max()) * int(np.abs(q).max()) * x.shape[1]
        kind = np.float64 if most < 2 ** 52 else np.int64 if most < 2 ** 60 else object  # sums of all of these are exact
        x, q = x.astype(kind), q.astype(kind)
        shard = Shard(candidates["vec_id"].to_numpy(), x)
        for query_id, row in zip(queries["vec_id"].to_pylist(), q):
            found += [(query_id, i, max(-LIMIT, min(LIMIT, s))) for i, s in shard.best(query_id, row, k)]
    cols = list(zip(*found)) or [(), (), ()]
    return pa.table([pa.array(c, pa.int64()) for c in cols], names=["query_id", "vec_id", "score"])


def integer_vectors(df: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """vec_id and the components turned into floor(scale * x); rows that take no part are left out."""
    x = F.col(vector)
    finite = F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v.cast("double")) < F.lit(float("inf"))), F.lit(False)))
    whole = F.transform(x, lambda v: F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.floor(v.cast("double") * scale))).cast("long"))
    return (df.select(F.col(vec_id).cast("long").alias("vec_id"), x.alias(vector))
            .filter(F.col("vec_id").isNotNull() & x.isNotNull() & finite).select("vec_id", whole.alias("vector")))


def top_k(df: DataFrame, is_query: Callable[[Column], Column], k: int = 5, vec_id: str = "vec_id",
          vector: str = "embedding", scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest inner products of every query row, exactly.

    The query set is stated by ``is_query`` on the id.  Candidates are dealt
    evenly over shards of ``SHARD_ROWS`` and queries over blocks, so a task
    holds one shard and one block whatever the table's size.
    """
    vectors = integer_vectors(df, vec_id, vector, scale)
    asking = vectors.filter(is_query(F.col("vec_id")))
    rows, asks = df.count(), df.filter(is_query(F.col(vec_id).cast("long"))).count()
    shards, blocks = max(1, -(-rows // SHARD_ROWS)), max(1, -(-asks // BLOCK_QUERIES))
    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards)).cast("int"))
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asking = (asking.withColumn("block", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)).cast("int"))
              .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))

    def search(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        return search_block(candidates, queries, k)

    found = (dealt.groupBy("shard", "block").cogroup(asking.groupBy("shard", "block"))
             .applyInArrow(search, "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
