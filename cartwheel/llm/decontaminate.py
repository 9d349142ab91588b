"""Benchmark decontamination by pigeonhole edit matching.

Texts are normalised: lower case, everything but letters, numbers and
combining marks (by Unicode category) read as one blank.  A test item of n bytes may occur with up to k = n * ERROR_RATE
edits.  Cut into k + 1 pieces, at least one piece of any such occurrence is
untouched, so exact piece hits (an Aho-Corasick automaton over all pieces)
give every candidate place; each is verified with Myers' bit-parallel edit
distance, which also yields where the occurrence begins and ends.

The documents are read once for each block of test items; a block holds a
bounded number of bytes, so what a task is sent does not grow with the
benchmark.

Defined cases: items without a letter or digit, or null, match nothing;
items so short that no edit is allowed must occur exactly, as whole words;
null and empty documents match nothing; of several places in a document the
one with fewest edits is reported, the first of equals; repeated rows are
matched alike, repeated items (same id and text) count once; an empty table
on either side matches nothing; kept columns may have any names but the
output's.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .worker import bounded_batches, cached, slices, text_buffers

#: Edits allowed for each byte of a normalised item.
ERROR_RATE = 0.08
#: Bytes of items searched for in one pass over the documents.
BLOCK_BYTES = 8 << 20

MATCH = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("errors", T.IntegerType()),
                                  T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
ARROW_MATCH = pa.list_(pa.struct([("item_id", pa.int64()), ("errors", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))


def _word_bytes(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to letters, numbers and combining marks."""
    word = np.zeros(256, bool)
    word[48:58] = word[97:123] = True
    out = word[data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        kinds = cached("word characters", lambda: np.array([unicodedata.category(chr(c))[0] in "LNM" for c in range(0x110000)]))
        first = data[lead].astype(np.int64)
        size = 2 + (first >= 0xE0) + (first >= 0xF0)
        code = first & (0x7F >> size)
        for k in (1, 2, 3):
            more = size > k
            code[more] = code[more] << 6 | data[lead[more] + k] & 0x3F
        lead, size = lead[kinds[code]], size[kinds[code]]
        for k in range(4):
            out[lead[size > k] + k] = True
    return out


def normalised(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets, place in the lower-cased bytes) of the texts, each with a blank before and after every word."""
    data, offsets = text_buffers(pc.utf8_lower(column.cast(pa.large_string())))
    is_word = _word_bytes(data)
    # every text is led by a blank and each run of other bytes is one blank; a last blank is added at the end
    before = np.concatenate([[False], is_word[:-1]]) if len(data) else is_word
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    keep = is_word | before
    n = len(offsets) - 1
    kept = np.concatenate([[0], np.cumsum(keep)])
    new = kept[offsets] + 2 * np.arange(n + 1)
    out = np.full(new[-1], 32, np.uint8)
    place = np.zeros(new[-1], np.int64)
    src = np.flatnonzero(keep)
    dst = np.arange(len(src)) + 2 * (np.searchsorted(offsets, src, side="right") - 1) + 1
    out[dst] = np.where(is_word[src], data[src], 32)
    place[dst] = src
    place[new[:-1]] = offsets[:-1]
    place[new[1:] - 1] = offsets[1:]
    return out, new, place


def normal_text(text: str | None) -> bytes:
    data, _, _ = normalised(pa.array([text or ""]))
    return b" ".join(data.tobytes().split())


def myers(pattern: bytes, text: bytes, most: int) -> tuple[int, int] | None:
    """(distance, end) of the place in ``text`` nearest to ``pattern``, the first of equals; None above ``most``."""
    m = len(pattern)
    masks: dict[int, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best = full, 0, m, None
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        x = eq | minus
        d0 = (((x & plus) + plus) ^ plus) | x
        up = minus | (full & ~(d0 | plus))
        down = plus & d0
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up <<= 1
        plus = ((down << 1) | (full & ~(d0 | up))) & full
        minus = up & d0
        if score <= most and (best is None or score < best[0]):
            best = (score, j + 1)
    return best


class Automaton:
    """Pieces of a block of items."""

    def __init__(self, items: list[tuple[int, bytes]], error_rate: float):
        self.items = items
        self.budget = [int(len(t) * error_rate) for _, t in items]
        pieces: dict[bytes, list[tuple[int, int]]] = {}
        for i, (_, t) in enumerate(items):
            parts = self.budget[i] + 1
            cuts = [len(t) * p // parts for p in range(parts + 1)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                key = t[a:b] if self.budget[i] else b" " + t + b" "
                pieces.setdefault(key, []).append((i, a if self.budget[i] else -1))
        self.search = ahocorasick.Automaton()
        for piece, owners in pieces.items():
            self.search.add_word(piece.decode("latin-1"), (len(piece), owners))
        if pieces:
            self.search.make_automaton()
        self.empty = not pieces

    def matches(self, text: bytes) -> list[tuple[int, int, int, int]]:
        """(item, errors, start, end) in the normalised text: the best place of every item."""
        starts: dict[int, list[int]] = {}
        for end, (size, owners) in self.search.iter(text.decode("latin-1")):
            for i, offset in owners:
                starts.setdefault(i, []).append(end + 1 - size - offset)
        out = []
        for i, places in starts.items():
            item, most = self.items[i][1], self.budget[i]
            best = None
            places.sort()
            at = 0
            while at < len(places):
                last = at  # places that can belong to one occurrence are verified together
                while last + 1 < len(places) and places[last + 1] - places[last] <= 2 * most:
                    last += 1
                low, high = max(0, places[at] - most), min(len(text), places[last] + len(item) + most)
                region = text[low:high]
                exact = region.find(item)
                got = (0, exact + len(item)) if exact >= 0 else myers(item, region, most) if most else None
                if got and (best is None or got[0] < best[0]):
                    first = got[1] - len(item) if exact >= 0 else got[1] - myers(item[::-1], region[:got[1]][::-1], most)[1]
                    best = (got[0], low + first, low + got[1])
                    if best[0] == 0:
                        break
                at = last + 1
            if best:
                out.append((i, *best))
        return sorted(out)


def _block(items: list[tuple[int, str]]) -> list[tuple[int, bytes]]:
    return sorted({(i, t) for i, t in ((i, normal_text(t)) for i, t in items) if t}, key=lambda r: (r[0], r[1]))


def find(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None, text: str = "text", item_id: str = "item_id",
         item_text: str = "text", error_rate: float = ERROR_RATE, out: str = "matches") -> DataFrame:
    """``keep`` columns (default doc_id) and the matches of every whole text: item_id, errors, start and end.

    Start and end are byte places in the lower-cased text.  No shuffle: the
    documents are scanned, once for each block of test items.
    """
    keep = keep or ["doc_id"]
    if out in keep:
        raise ValueError("the output's name is among the kept columns")
    spark = docs.sparkSession
    bounded_batches(spark)
    items = benchmark.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).alias("t")).filter("t is not null")
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    source = docs.select(*keep, F.col(text).alias("__text"), F.array().cast(MATCH).alias("__found"))
    fields = source.schema.fields
    schema = T.StructType([*fields[:-2], fields[-2], T.StructField("__found", MATCH)])
    for b in range(blocks):
        # one block of items, bounded by BLOCK_BYTES, goes to the tasks
        rows = items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).collect()
        block = _block([(r["i"], r["t"]) for r in rows])
        shared, key = spark.sparkContext.broadcast(block), hashlib.sha256(repr((error_rate, block)).encode()).hexdigest()

        def run(batches: Iterator[pa.RecordBatch], shared=shared, key=key) -> Iterator[pa.RecordBatch]:
            auto = cached("automaton:" + key, lambda: Automaton(shared.value, error_rate), slot="model")  # one at a time
            for part in slices(batches, "__text"):
                column = part.column(part.num_columns - 2)
                found = part.column(part.num_columns - 1).to_pylist()
                if not auto.empty:
                    data, offsets, place = normalised(pc.fill_null(column, ""))
                    lower = text_buffers(pc.utf8_lower(pc.fill_null(column, "").cast(pa.large_string())))[1]
                    raw = data.tobytes()
                    for k in range(part.num_rows):
                        a, z = int(offsets[k]), int(offsets[k + 1])
                        for i, errors, start, end in auto.matches(raw[a:z]):
                            found[k] = [*found[k], {"item_id": auto.items[i][0], "errors": errors, "start": int(place[a + start] - lower[k]),
                                                    "end": int(place[a + end - 1] + 1 - lower[k])}]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(found, ARROW_MATCH)], names=part.schema.names)

        source = source.mapInArrow(run, schema)
    return source.select(*keep, F.col("__found").alias(out))


def without_matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no test item, with all their columns."""
    return find(docs, benchmark, docs.columns, text, out="__matches", **options).filter(F.size("__matches") == 0).select(*docs.columns)
