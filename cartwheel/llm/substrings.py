"""Exact removal of word windows that repeat across documents, found by difference-cover anchors.

A difference cover D modulo a period P contains, for any two places i and j,
a shift below P that moves both into D.  So if only the runs of ``L`` words
that start at places in D are hashed, any ``L + P - 1`` equal words in two
documents share an anchor at the same distance from their starts, whatever
their places.  Anchors that occur in two documents are then extended: only
the windows that contain such an anchor are hashed in full (96 bits), and a
window is repeated if its words also start in a document with a smaller id.

Both exchanges work alike.  A task hashes a slice of texts and settles what
the slice shows by itself; of a hash it sends one entry, from the smallest
document of the slice, so a hash that fills the corpus costs one entry for
each slice.  Entries travel packed by bucket; the buckets grow in number
with the input, and each answers only to the documents that have to know.

Defined cases: null and empty texts have no words; documents shorter than a
window lose nothing; rows without an id neither lose words nor make others
lose any; rows that share an id are one document to each other (no smaller
id), each row is judged by its own text; repeated rows are answered alike;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .words import Words, mix
from .worker import bounded_batches, discard, release, slices, text_buffers

#: Words of a window.
WINDOW = 13
#: Period and difference cover: the differences of 0, 1 and 3 are all residues modulo 7.
PERIOD, COVER = 7, (0, 1, 3)
#: Hashes settled and packed together, and text bytes for each bucket of the exchanges.
PACKED_HASHES, BUCKET_BYTES = 500_000, 12 << 20

SCHEMA = "bucket int, id long, fp long, ids binary, fps binary, refs binary, places binary, hashes binary, extras binary"
NAMES = ["bucket", "id", "fp", "ids", "fps", "refs", "places", "hashes", "extras"]
TYPES = [pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 6]


def anchors(words: Words, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of the anchors of all texts that are at least a window long."""
    at = np.arange(max(0, len(words.text) - window + PERIOD))
    text = words.text[:len(at)]
    cover = np.zeros(PERIOD, bool)
    cover[list(COVER)] = True
    at = at[cover[(at - words.first[text]) % PERIOD]]
    text = words.text[at]
    at = at[(words.text[at + window - PERIOD] == text) & (words.count[text] >= window)]
    return at, words.runs(words.hashes(1), at, window - PERIOD + 1, 1)


def runs_of(*columns: np.ndarray) -> np.ndarray:
    """Edges of the runs of equal rows, 0 and the length included."""
    n = len(columns[0])
    new = np.zeros(n + 1, bool)
    new[0] = new[n] = True
    for c in columns:
        new[1:n] |= c[1:] != c[:-1]
    return np.flatnonzero(new) if n else np.zeros(1, np.int64)


class Hashed:
    """Hashes of word runs with where they were found: id, fingerprint of the text, place in the text."""

    def __init__(self, h, extra, ids, fps, place):
        self.columns = h, extra, ids, fps, place
        self.h, self.extra, self.ids, self.fps, self.place = self.columns

    @classmethod
    def of(cls, part: pa.RecordBatch, words: Words, at: np.ndarray, h: np.ndarray, extra: np.ndarray | None = None) -> Hashed:
        text = words.text[at]
        extra = np.zeros(len(at), np.uint32) if extra is None else (extra >> np.uint64(32)).astype(np.uint32)
        return cls(h, extra, part.column("id").to_numpy()[text], part.column("fp").to_numpy()[text], (at - words.first[text]).astype(np.uint32))

    def __getitem__(self, which) -> Hashed:
        return Hashed(*[c[which] for c in self.columns])

    @staticmethod
    def join(parts: list[Hashed]) -> Hashed:
        return Hashed(*[np.concatenate(c) for c in zip(*[p.columns for p in parts])])

    def settle(self, rule: Callable) -> tuple[np.ndarray, np.ndarray]:
        """(which are repeated by what is seen here, one place of each hash in each text of its smallest id).

        ``rule`` decides from the smallest and largest document of a hash and
        the own one.
        """
        order = np.lexsort((self.place, self.fps, self.ids, self.extra, self.h))
        d, fps = self.ids[order], self.fps[order]
        edges = runs_of(self.h[order], self.extra[order])
        size = np.diff(edges)
        found = np.zeros(len(order), bool)
        least = np.repeat(d[edges[:-1]], size)
        found[order] = rule(least, np.repeat(d[edges[1:] - 1], size), d)
        sent = d == least  # rows that share the id have texts of their own, each of which is to be told
        sent[1:] &= fps[1:] != fps[:-1]
        sent[edges[:-1]] = True
        return found, order[sent]


def in_two_documents(least, most, own):
    return least != most


def in_smaller_document(least, most, own):
    return least < own


def _pack(parts: Iterator[Hashed], buckets: int, rule: Callable, with_extra: bool) -> Iterator[pa.RecordBatch]:
    """Rows of some slices: for each bucket its entries, for each document its settled places."""

    def rows_of(seen: Hashed) -> pa.RecordBatch:
        rows = []
        settled, sent = seen.settle(rule)
        entries = seen[np.sort(sent)]
        bucket = ((entries.h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        entries, bucket = entries[order], bucket[order]
        edges = runs_of(bucket)
        for a, b in zip(edges[:-1], edges[1:]):
            e = entries[a:b]
            docs = runs_of(e.ids, e.fps)
            refs = np.repeat(np.arange(len(docs) - 1, dtype=np.uint32), np.diff(docs))
            rows.append((int(bucket[a]), None, None, e.ids[docs[:-1]].tobytes(), e.fps[docs[:-1]].tobytes(), refs.tobytes(),
                         e.place.tobytes(), e.h.tobytes(), e.extra.tobytes() if with_extra else None))
        for id_, fp, places in by_document(seen[settled]):
            rows.append((None, id_, fp, None, None, None, places, None, None))
        columns = list(zip(*rows)) or [()] * len(NAMES)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, TYPES)], names=NAMES)

    waiting, n = [], 0
    for part in parts:
        waiting.append(part)
        n += len(part.h)
        if n >= PACKED_HASHES:
            yield rows_of(Hashed.join(waiting))
            waiting, n = [], 0
    if n:
        yield rows_of(Hashed.join(waiting))


def by_document(found: Hashed) -> Iterator[tuple[int, int, bytes]]:
    """(id, fingerprint, packed places) of each document."""
    found = found[np.lexsort((found.place, found.fps, found.ids))]
    edges = runs_of(found.ids, found.fps)
    for a, b in zip(edges[:-1], edges[1:]):
        yield int(found.ids[a]), int(found.fps[a]), found.place[a:b].tobytes()


def _answers(packed: DataFrame, rule: Callable, parts: int) -> DataFrame:
    """id, fp, places (a list of packed places): what the slices settled and what their entries show together."""

    def decide(table: pa.Table) -> pa.Table:
        seen = []
        for r in table.to_pylist():
            refs = np.frombuffer(r["refs"], np.uint32)
            h = np.frombuffer(r["hashes"], np.uint64)
            extra = np.frombuffer(r["extras"], np.uint32) if r["extras"] is not None else np.zeros(len(h), np.uint32)
            seen.append(Hashed(h, extra, np.frombuffer(r["ids"], np.int64)[refs], np.frombuffer(r["fps"], np.int64)[refs], np.frombuffer(r["places"], np.uint32)))
        seen = Hashed.join(seen)
        found = seen[seen.settle(rule)[0]]
        to = (mix(found.ids.view(np.uint64)) % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((found.place, found.fps, found.ids, to))
        found, to = found[order], to[order]
        edges = runs_of(to)
        rows = [(int(to[a]), found.ids[a:b].tobytes(), found.fps[a:b].tobytes(), found.place[a:b].tobytes()) for a, b in zip(edges[:-1], edges[1:])]
        columns = list(zip(*rows)) or [()] * 4
        return pa.table([pa.array(c, t) for c, t in zip(columns, [pa.int32()] + [pa.binary()] * 3)], names=["part", "ids", "fps", "places"])

    def gather(table: pa.Table) -> pa.Table:
        read = lambda name, kind: np.concatenate([np.frombuffer(b, kind) for b in table[name].to_pylist()])
        place = read("places", np.uint32)
        found = Hashed(place, place, read("ids", np.int64), read("fps", np.int64), place)
        columns = list(zip(*by_document(found))) or [()] * 3
        return pa.table([pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int64(), pa.binary()])], names=["id", "fp", "places"])

    told = packed.filter("bucket is not null").groupBy("bucket").applyInArrow(decide, "part int, ids binary, fps binary, places binary")
    told = told.groupBy("part").applyInArrow(gather, "id long, fp long, places binary")
    own = packed.filter("bucket is null").select("id", "fp", "places")
    return own.unionByName(told).groupBy("id", "fp").agg(F.collect_list("places").alias("places"))


def _marked(words: Words, column, at: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which of the places ``at`` have a hash that occurs at a told place of the same text."""
    out = np.zeros(len(at), bool)
    bounds = np.searchsorted(at, words.first)
    for i in np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False)):
        mine = slice(bounds[i], bounds[i + 1])
        told = np.concatenate([np.frombuffer(b, np.uint32) for b in column[int(i)].as_py()]).astype(np.int64) + words.first[i]
        k = np.searchsorted(at[mine], told)
        k = k[k < bounds[i + 1] - bounds[i]]
        out[mine][k] = True
        out[mine] |= np.isin(h[mine], np.unique(h[mine][k]))  # the same words again in this text
    return out


def _windows(words: Words, marked_anchors: np.ndarray, window: int) -> np.ndarray:
    """First words of the windows that contain a marked anchor."""
    some = np.zeros(len(words.text) + 1, np.int32)
    text = words.text[marked_anchors]
    low = np.maximum(marked_anchors - (PERIOD - 1), words.first[text])
    high = np.minimum(marked_anchors, words.first[text + 1] - window)
    ok = high >= low
    np.add.at(some, low[ok], 1)
    np.add.at(some, high[ok] + 1, -1)
    return np.flatnonzero(np.cumsum(some[:-1]) > 0)


def _kept(words: Words, offsets: np.ndarray, gone: np.ndarray) -> pa.Array:
    """The words that stay, joined by one space, as one string for each text."""
    stays = np.flatnonzero(~gone)
    inside = np.zeros(len(words.data) + 1, np.int8)
    inside[words.start[stays]] += 1
    inside[words.end[stays]] -= 1
    keep = np.cumsum(inside[:-1]) > 0
    later = stays[1:][words.text[stays[1:]] == words.text[stays[:-1]]]
    blank = words.start[later] - 1  # the byte before a word that is not its text's first is white space
    keep[blank] = True
    out = words.data.copy()
    out[blank] = 32
    bounds = np.concatenate([[0], np.cumsum(keep)])[offsets].astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(bounds), pa.py_buffer(out[keep])).cast(pa.string())


def remove_repeats(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text",
                   outputs: tuple[str, ...] = ("kept", "spans")) -> DataFrame:
    """doc_id, n_words, n_removed and the asked outputs of every row.

    ``kept`` is the text of the words that stay, joined by one space;
    ``spans`` are the removed runs of words as (first, end) pairs.  ``window``
    must be at least the period.
    """
    if window < PERIOD:
        raise ValueError(f"a window has at least {PERIOD} words")
    spark = docs.sparkSession
    bounded_batches(spark)
    base = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    base = base.withColumn("fp", F.xxhash64("text"))
    known = base.filter(F.col("id").isNotNull()).withColumn("id", F.col("id").cast("long"))
    size = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))

    def find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def hashed():
            for part in slices(batches, "text"):
                words = Words(*text_buffers(part.column("text")))
                yield Hashed.of(part, words, *anchors(words, window))
        yield from _pack(hashed(), buckets, in_two_documents, False)

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def hashed():
            for part in slices(batches, "text"):
                words = Words(*text_buffers(part.column("text")))
                at, h = anchors(words, window)
                starts = _windows(words, at[_marked(words, part.column("places"), at, h)], window)
                yield Hashed.of(part, words, starts, *[words.runs(words.hashes(seed), starts, window, seed) for seed in (1, 2)])
        yield from _pack(hashed(), buckets, in_smaller_document, True)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            data, offsets = text_buffers(part.column("text"))
            words = Words(data, offsets)
            gone = np.zeros(len(words.text) + 1, np.int32)
            some = np.flatnonzero(part.column("places").is_valid().to_numpy(zero_copy_only=False))
            if len(some):
                starts = np.concatenate([np.arange(words.first[i], max(words.first[i], words.first[i + 1] - window + 1)) for i in some])
                h = words.runs(words.hashes(1), starts, window, 1)
                found = starts[_marked(words, part.column("places"), starts, h)]
                np.add.at(gone, found, 1)
                np.add.at(gone, found + window, -1)
            gone = np.cumsum(gone[:-1]) > 0
            removed = np.bincount(words.text[gone], minlength=len(offsets) - 1)
            cols = [part.column("id"), pa.array(words.count), pa.array(removed)]
            if "kept" in outputs:
                cols.append(_kept(words, offsets, gone))
            if "spans" in outputs:
                lists = []
                for i in range(len(offsets) - 1):
                    edge = np.diff(np.concatenate([[0], gone[words.first[i]:words.first[i + 1]].astype(np.int8), [0]]))
                    lists.append([{"first": int(a), "end": int(b)} for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))])
                cols.append(pa.array(lists, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))))
            yield pa.RecordBatch.from_arrays(cols, names=names)

    names = ["id", "n_words", "n_removed", *[o for o in ("kept", "spans") if o in outputs]]
    kinds = {"kept": "kept string", "spans": "spans array<struct<first:long,end:long>>"}
    schema = ", ".join([f"id {base.schema['id'].dataType.simpleString()}", "n_words long", "n_removed long", *[kinds[n] for n in names[3:]]])
    packed = cut_lineage(known.mapInArrow(find_anchors, SCHEMA))
    repeated = cut_lineage(_answers(packed, in_two_documents, buckets))
    discard(packed)
    release(spark)
    packed = cut_lineage(known.join(repeated, ["id", "fp"]).select("id", "fp", "text", "places").mapInArrow(extend, SCHEMA))
    release(spark)
    discard(repeated)
    removals = cut_lineage(_answers(packed, in_smaller_document, buckets))
    discard(packed)
    release(spark)
    judged = base.join(removals, ["id", "fp"], "left").select("id", "text", "places")
    return judged.mapInArrow(finish, schema).withColumnRenamed("id", doc_id)
