"""Near-duplicate documents by BagMinHash signatures, banding and exact multiset overlap.

A document is the multiset of its runs of ``SHINGLE`` words; the weight of a
shingle is its count.  BagMinHash: the weight axis is cut into the dyadic
intervals [0,1), [1,2), [2,4), [4,8), ...; each interval of each shingle has
a Poisson process of its own, whose rate is the interval's length and whose
points come in rising time from hashes of (shingle, interval, point).  A
point lies at a hashed unit of its interval and counts for a document whose
weight exceeds it; it falls into one hashed register.  A register keeps its
earliest point, so two registers agree with a probability of exactly the
weighted Jaccard similarity.  Points are drawn only until they are later than every register,
which costs little more than one point for each shingle.

Registers are banded; texts that share a band are candidates.  In each round
every text that lies outside the largest class of one of its buckets is
compared with one hashed text of such a class, exactly on the shingle counts,
so a round compares no more pairs than there are texts; buckets whose texts are
already linked are done, and a few rounds leave little.  Of the rest every
text is compared exactly with the other classes of its buckets (large ones in
blocks), so no candidate link between different texts is lost.  Classes are
the connected components of the links.

Defined cases: a text of fewer than ``SHINGLE`` words is one shingle; texts
without words are alone, also among themselves; equal texts are one class;
rows that share an id are one class; rows without an id are alone (class
null); repeated rows are answered alike; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .components import components, partial_labels
from .words import SpanHasher, Words, mix
from .worker import bounded_batches, discard, release, slices, text_buffers

SHINGLE = 5
SIMILARITY = 0.8
#: A pair of similarity 0.8 shares no band with probability (1 - 0.8^6)^26 = 0.0004.
BANDS, ROWS = 26, 6
REGISTERS = BANDS * ROWS
SLICE_BYTES, SLICE_ROWS = 1 << 19, 4_096
#: Rounds of pivots go on while more pairs would be left than this many for each posting
#: and the last round has linked at least this share of its pairs.
LEFT_PAIRS, PRODUCTIVE = 2, 0.1
#: Rounds of pivots at most; what is open then is compared as the rest.
ROUNDS = 8
#: At most so many texts are compared pair by pair; of more, texts of a block.
FEW, BLOCK = 8, 512
_GOLDEN = 0x9E3779B97F4A7C15


def bags(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle hash, count) of the distinct shingles, sorted by text and hash."""
    h = words.hashes(0)
    at, g = words.shingles(h, SHINGLE)
    text = words.text[at]
    for size in range(1, SHINGLE):  # short texts are one shingle
        short = np.flatnonzero(words.count == size)
        if len(short):
            text, g = np.concatenate([text, short]), np.concatenate([g, words.runs(h, words.first[short], size)])
    order = np.lexsort((g, text))
    text, g = text[order], g[order]
    new = np.ones(len(g), bool)
    new[1:] = (text[1:] != text[:-1]) | (g[1:] != g[:-1])
    first = np.flatnonzero(new)
    return text[first], g[first], np.diff(np.append(first, len(g)))


def signatures(text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, texts: int, registers: int = REGISTERS) -> np.ndarray:
    """texts x registers hashes of the earliest points; 0 for texts without shingles."""
    # one process for each interval that a weight reaches: interval 0 is [0,1), interval j is [2^(j-1), 2^j)
    top = np.zeros(len(weight), np.int64)
    big = weight > 1
    top[big] = np.floor(np.log2(weight[big] - 0.5)).astype(np.int64) + 1
    owner = np.repeat(np.arange(len(weight)), top + 1)
    level = np.arange(len(owner)) - np.repeat(np.cumsum(top + 1) - top - 1, top + 1)
    low = np.where(level == 0, 0, 1 << np.maximum(level - 1, 0))
    length = np.where(level == 0, 1, low)
    doc, units = text[owner], weight[owner] - low
    base = mix(shingle[owner] + (level.astype(np.uint64) + np.uint64(1)) * np.uint64(_GOLDEN))
    times, winners = np.full(texts * registers, np.inf), np.zeros(texts * registers, np.uint64)
    clock, point = np.zeros(len(owner)), 0
    while len(owner):
        # many processes: one point at a time; few: a run of points at once
        run = 1 if len(owner) > 20_000 else 8 if len(owner) > 2_000 else 64
        steps = np.arange(point + 1, point + 1 + run, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)
        h = mix(base[:, None] + steps[None, :])
        wait = -np.log(((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / length[:, None]
        wait[:, 0] += clock
        at = np.cumsum(wait, axis=1)
        bound = times.reshape(texts, registers).max(axis=1)[doc]
        k, j = np.nonzero(at <= bound[:, None])
        if len(k):
            t, g = at[k, j], mix(h[k, j] ^ np.uint64(0xA0761D6478BD642F))
            inside = ((g >> np.uint64(32)) % length[k].astype(np.uint64)).astype(np.int64) < units[k]
            register = (g & np.uint64(0xFFFFFFFF)) % np.uint64(registers)
            place, t, h = doc[k[inside]] * registers + register[inside].astype(np.int64), t[inside], h[k, j][inside]
            np.minimum.at(times, place, t)
            won = times[place] == t
            winners[place[won]] = h[won]
        bound = times.reshape(texts, registers).max(axis=1)[doc]
        keep = at[:, -1] <= bound
        clock, point = at[keep, -1], point + run
        doc, units, base, length, owner = doc[keep], units[keep], base[keep], length[keep], owner[keep]
    return winners.reshape(texts, registers)


def band_hashes(registers: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """texts x bands hashes of the bands' registers."""
    parts = registers.reshape(len(registers), bands, rows)
    out = np.repeat(np.arange(1, bands + 1, dtype=np.uint64)[None, :], len(registers), axis=0)
    for r in range(rows):
        out = mix(out * np.uint64(_GOLDEN) + parts[:, :, r])
    return out


def _pack(hashes: np.ndarray, counts: np.ndarray) -> bytes:
    return hashes.tobytes() + counts.astype(np.uint32).tobytes()


def _unpack(bag: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(bag) // 12
    return np.frombuffer(bag, np.uint64, n), np.frombuffer(bag, np.uint32, n, 8 * n)


def overlap(a: bytes, b: bytes) -> float:
    """Weighted Jaccard similarity of two packed bags (sorted hashes, then counts)."""
    (g, v), (h, w) = _unpack(a), _unpack(b)
    _, i, j = np.intersect1d(g, h, assume_unique=True, return_indices=True)
    both = int(np.minimum(v[i], w[j]).sum(dtype=np.int64))
    return both / (int(v.sum(dtype=np.int64)) + int(w.sum(dtype=np.int64)) - both)


def _signed(docs: DataFrame) -> DataFrame:
    """id, fingerprint of the text (two longs, null without words), number of shingles and band hashes of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE_BYTES, SLICE_ROWS):
            data, offsets = text_buffers(part.column("text"))
            words = Words(data, offsets)
            registers = signatures(*bags(words), len(offsets) - 1)
            some = words.count > 0
            hashed = band_hashes(registers).view(np.int64)
            bands = pa.ListArray.from_arrays(pa.array(np.arange(len(hashed) + 1) * BANDS, pa.int32()), pa.array(hashed.reshape(-1)))
            prints = [pa.array(SpanHasher(data, seed)(offsets[:-1], offsets[1:]).view(np.int64), mask=~some) for seed in (6, 7)]
            size = pa.array(np.maximum(words.count - SHINGLE + 1, 1))
            yield pa.RecordBatch.from_arrays([part.column("id"), *prints, size, bands], names=["id", "p", "q", "size", "bands"])

    return docs.mapInArrow(run, "id long, p long, q long, size long, bands array<long>")


def _bag_table(docs: DataFrame) -> DataFrame:
    """id and packed bag of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE_BYTES, SLICE_ROWS):
            text, h, count = bags(Words(*text_buffers(part.column("text"))))
            edge = np.searchsorted(text, np.arange(part.num_rows + 1))
            packed = [_pack(h[a:b], count[a:b]) for a, b in zip(edge[:-1], edge[1:])]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(packed, pa.binary())], names=["id", "bag"])

    return docs.mapInArrow(run, "id long, bag binary")


def _verify(pairs: DataFrame, bag: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose bags are similar enough.  Either side may be one hot document: plain joins, split when skewed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [overlap(x, y) >= similarity for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    with_x = pairs.join(bag.select(F.col("id").alias("a"), F.col("bag").alias("x")), "a")
    with_y = with_x.join(bag.select(F.col("id").alias("b"), F.col("bag").alias("y")), "b")
    return with_y.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _sizes_fit(similarity: float) -> Column:
    """Bags of too different sizes cannot be similar enough."""
    return F.least("size", "so") + 1e-6 >= F.greatest("size", "so") * similarity


def _linked(members: pa.Table, asks: pa.Table, similarity: float) -> pa.Table:
    """For every asking bag one member that is similar enough, if there is one; exact, by postings of the members' shingles."""
    found = []
    if members.num_rows and asks.num_rows:
        unpacked = [_unpack(x) for x in members["bag"].to_pylist()]
        owner = np.repeat(np.arange(len(unpacked)), [len(h) for h, _ in unpacked])
        h, c = np.concatenate([h for h, _ in unpacked]), np.concatenate([c for _, c in unpacked]).astype(np.int64)
        order = np.argsort(h, kind="stable")
        h, c, owner = h[order], c[order], owner[order]
        total = np.bincount(owner, weights=c, minlength=len(unpacked))
        nodes = members["node"].to_pylist()
        for node, packed in zip(asks["node"].to_pylist(), asks["bag"].to_pylist()):
            g, w = _unpack(packed)
            low, high = np.searchsorted(h, g), np.searchsorted(h, g, side="right")
            n = high - low
            at = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
            both = np.bincount(owner[at], weights=np.minimum(c[at], np.repeat(w, n)), minlength=len(unpacked))
            near = np.flatnonzero(both / (total + w.sum(dtype=np.int64) - both) >= similarity)
            if len(near):
                found.append((node, min(nodes[k] for k in near)))
    return pa.table([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["a", "b"])


def _among(texts: pa.Table, similarity: float) -> pa.Table:
    """Links between the similar texts of different classes of a block, no more than join them."""
    nodes, kinds = texts["node"].to_pylist(), texts["class"].to_pylist()
    unpacked = [_unpack(x) for x in texts["bag"].to_pylist()]
    h, c = np.concatenate([h for h, _ in unpacked]), np.concatenate([c for _, c in unpacked]).astype(np.int64)
    owner = np.repeat(np.arange(len(unpacked)), [len(g) for g, _ in unpacked])
    total = np.bincount(owner, weights=c, minlength=len(unpacked))
    order = np.argsort(h, kind="stable")
    h, c, owner = h[order], c[order], owner[order]
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while up.get(x, x) != x:
            up[x] = x = up.get(up[x], up[x])
        return x

    found = []
    for k, (g, w) in enumerate(unpacked):
        low, high = np.searchsorted(h, g), np.searchsorted(h, g, side="right")
        n = high - low
        at = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        both = np.bincount(owner[at], weights=np.minimum(c[at], np.repeat(w, n)), minlength=len(unpacked))
        for o in np.flatnonzero(both / (total + total[k] - both) >= similarity).tolist():
            a, b = root(kinds[k]), root(kinds[o])
            if a != b:
                up[a] = b
                found.append((min(nodes[k], nodes[o]), max(nodes[k], nodes[o])))
    return pa.table([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["a", "b"])


def _rest(rows: DataFrame, labelled: DataFrame, bag: DataFrame, similarity: float) -> DataFrame:
    """Links between the different classes that share a bucket.

    A text outside its bucket's largest class asks that class, and texts
    outside it ask each other.  Few texts answer pair by pair.  More are
    asked as a whole, in blocks: the members of a class and the texts that
    ask it are dealt over a grid of blocks of about ``BLOCK`` each, and so are a
    bucket's texts outside the class among themselves; a block gives no more
    links than it has texts, so a dense group costs no row for each pair.
    """
    outside = cut_lineage(rows.filter("class <> main"))
    members = labelled.select("node", "class", "size").distinct()
    asks = outside.select("node", F.col("main").alias("class"), F.col("size").alias("so")).distinct()
    count = cut_lineage(members.groupBy("class").agg(F.count(F.lit(1)).alias("m")).join(
        asks.groupBy("class").agg(F.count(F.lit(1)).alias("q")), "class"))
    pair = lambda x, y: [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]
    few = (asks.withColumnRenamed("node", "o").join(count.filter(F.col("m") <= FEW), "class")
           .join(members, "class").filter(_sizes_fit(similarity)).select(*pair("node", "o")))
    met = cut_lineage(outside.groupBy("band").agg(F.count(F.lit(1)).alias("m")).filter("m > 1"))
    sparse = outside.join(met.filter(F.col("m") <= FEW).select("band"), "band")
    other = sparse.select("band", F.col("node").alias("o"), F.col("class").alias("co"), F.col("size").alias("so"))
    among = sparse.join(other, "band").filter((F.col("class") < F.col("co")) & _sizes_fit(similarity)).select(*pair("node", "o"))
    by_pair = _verify(cut_lineage(few.unionByName(among).distinct()), bag, similarity)

    every = lambda n: F.explode(F.sequence(F.lit(0), n.cast("int") - 1))
    packed = bag.select(F.col("id").alias("node"), "bag")
    dense = (outside.join(met.filter(F.col("m") > FEW), "band").withColumn("parts", F.ceil(F.col("m") / BLOCK))
             .withColumn("i", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")).withColumn("j", every(F.col("parts")))
             .select("band", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), "node", "class"))

    def around(texts: pa.Table) -> pa.Table:
        return _among(texts, similarity)

    by_bucket = dense.join(packed, "node").groupBy("band", "i", "j").applyInArrow(around, "a long, b long")

    grid = count.filter(F.col("m") > FEW).select("class", F.ceil(F.col("m") / BLOCK).alias("pm"), F.ceil(F.col("q") / BLOCK).alias("pq"))
    held = (members.join(grid, "class").withColumn("i", F.pmod(F.xxhash64("node"), F.col("pm")).cast("int"))
            .withColumn("j", every(F.col("pq"))).join(packed, "node").select("class", "i", "j", "node", "bag"))
    asking = (asks.join(grid, "class").withColumn("j", F.pmod(F.xxhash64("node"), F.col("pq")).cast("int"))
              .withColumn("i", every(F.col("pm"))).join(packed, "node")
              .select(*[F.col(c).alias(c) for c in ("class", "i", "j", "node", "bag")]))  # columns of their own, apart from those of held

    def block(members: pa.Table, asks: pa.Table) -> pa.Table:
        return _linked(members, asks, similarity)

    by_block = held.groupBy("class", "i", "j").cogroup(asking.groupBy("class", "i", "j")).applyInArrow(block, "a long, b long")
    links = cut_lineage(by_pair.unionByName(by_block).unionByName(by_bucket))
    discard(outside, count, met)
    return links


def classes(docs: DataFrame, similarity: float = SIMILARITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and class_id of every row: the least id among the documents it is linked with, also over others."""
    spark = docs.sparkSession
    bounded_batches(spark)
    given = docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    signed = cut_lineage(_signed(given))
    # distinct texts, each by its least id; a text with very many copies meets as partial minima
    texts = cut_lineage(signed.filter("id is not null and p is not null").groupBy("p", "q")
                        .agg(F.min("id").alias("node"), F.any_value("size").alias("size"), F.any_value("bands").alias("bands")))
    # ids with several texts link these texts
    several = (signed.filter("id is not null and p is not null").groupBy("id")
               .agg(F.min(F.struct("p", "q")).alias("lo"), F.max(F.struct("p", "q")).alias("hi")).filter("lo <> hi").select("id"))
    copies = cut_lineage(signed.join(several, "id").join(texts.select("p", "q", "node"), ["p", "q"])
                         .select(F.col("id").alias("a"), F.col("node").alias("b")).distinct())
    posting = texts.select("node", "size", F.explode("bands").alias("band"))
    shared = cut_lineage(posting.groupBy("band").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo <> hi").select("band"))
    posting = cut_lineage(posting.join(shared, "band").distinct())
    release(spark)
    candidate = cut_lineage(posting.select(F.col("node").alias("id")).distinct())
    wanted = given.join(candidate, "id", "left_semi").groupBy("id", F.xxhash64("text")).agg(F.first("text").alias("text"))
    bag = cut_lineage(_bag_table(wanted.select("id", "text")))
    release(spark)

    links, tried, salt, more = [copies], [], 0, True
    labelled = posting.withColumn("class", F.col("node"))
    while True:
        # buckets with more than one class: their largest class (of equals that of the first pivot), a hashed text of it, and their pairs of different classes
        draw = F.min(F.struct(F.xxhash64("node", F.lit(salt)).alias("h"), F.col("node").alias("o"), F.col("size").alias("so"))).alias("pivot")
        per = labelled.groupBy("band", "class").agg(F.count(F.lit(1)).alias("n"), draw)
        buckets = cut_lineage(per.groupBy("band").agg(
            F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("s"), F.count(F.lit(1)).alias("classes"),
            F.max_by(F.struct(F.col("class").alias("main"), "pivot"), F.struct("n", F.bitwise_not("pivot.h"))).alias("top")).filter("classes > 1"))
        size = buckets.agg(F.sum("n").alias("n"), F.sum((F.col("n") * F.col("n") - F.col("s")) / 2).alias("pairs")).first()
        if not size["n"]:
            break
        rows = labelled.join(buckets.select("band", "top.main", "top.pivot.*"), "band")
        if size["pairs"] <= LEFT_PAIRS * size["n"] or not more or salt == ROUNDS:
            break
        # every text outside its bucket's largest class is compared with one text of such a class
        wide = (rows.filter((F.col("class") != F.col("main")) & _sizes_fit(similarity))
                .select("node", "h", "o", F.least("node", "o").alias("a"), F.greatest("node", "o").alias("b")))
        for t in tried:
            wide = wide.join(t, ["a", "b"], "left_anti")
        pairs = wide.groupBy("node").agg(F.min(F.struct("h", "o")).alias("near")).select("node", F.col("near.o").alias("o"))
        pairs = cut_lineage(pairs.select(F.least("node", "o").alias("a"), F.greatest("node", "o").alias("b")).distinct())
        found = cut_lineage(_verify(pairs, bag, similarity))
        discard(buckets)
        release(spark)
        links.append(found)
        tried.append(pairs)
        asked = pairs.count()
        more = 0 < asked and found.count() >= PRODUCTIVE * asked
        labelled = posting.join(partial_labels(reduce(DataFrame.unionByName, links)), "node", "left").select(
            "band", "node", "size", F.coalesce("class", "node").alias("class"))
        salt += 1
    if size["n"]:
        links.append(_rest(rows.select("band", "node", "class", "size", "main"), labelled, bag, similarity))
    named = components(reduce(DataFrame.unionByName, links))
    discard(bag, posting, shared)
    by_text = cut_lineage(texts.join(named, "node", "left").select("p", "q", F.coalesce("class", "node").alias("by_text")))
    answered = signed.select("id", "p", "q").join(by_text, ["p", "q"], "left")
    return answered.select(F.col("id").alias(doc_id), F.when(F.col("id").isNotNull(), F.coalesce("by_text", "id")).alias("class_id"))


def without_duplicates(docs: DataFrame, similarity: float = SIMILARITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with the least id of each class, with all their columns.

    Of rows that share that id one stays for each text (they are told apart by
    nothing else); rows without an id stay.
    """
    columns = docs.columns
    others = cut_lineage(classes(docs, similarity, doc_id, text).filter(F.col(doc_id) != F.col("class_id")).select(doc_id).distinct())
    several = cut_lineage(docs.filter(F.col(doc_id).isNotNull()).groupBy(doc_id).count().filter("count > 1").select(doc_id))
    kept = docs.join(others, doc_id, "left_anti").select(*columns)
    if several.isEmpty():
        return kept
    # only rows whose id repeats are gathered, by id and text
    twice = kept.join(several, doc_id, "left_semi").select(*columns)
    one = twice.groupBy(F.col(doc_id).alias("__id"), F.sha2(text, 256).alias("__text")).agg(F.min_by(F.struct(*columns), F.xxhash64(*columns)).alias("__row"))
    return kept.join(several, doc_id, "left_anti").select(*columns).unionByName(one.select("__row.*"))
