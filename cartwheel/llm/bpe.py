"""Byte-level BPE encoding and decoding with forced-boundary splitting.

Two adjacent bytes that occur inside no vocabulary token can never be
merged into one token, so the place between them is a certain cut.  Every
pre-token is split at those cuts; the distinct fragments of a slice of texts
are merged on their own, all at once: in each step every fragment merges its
pair of the lowest rank (the leftmost of equals).  Fragments of more than
``SHORT`` bytes keep their pairs in a heap.  The ids are concatenated; the
result equals encoding the whole text at once.

Defined cases: null text is encoded like the empty text (no ids); very long
texts are encoded whole; repeated rows give repeated results; an empty table
gives an empty result; columns of the input other than the ones asked for
are ignored, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import SpanHasher
from .worker import Table, bounded_batches, cached, decimals, slices, text_buffers

# The pre-token pattern of byte-level BPE and the printable bytes that stand for themselves.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PRINTABLE = [(33, 126), (161, 172), (174, 255)]

#: Longer fragments (in bytes) are merged with a heap.
SHORT = 64
#: Text bytes encoded in one go (a longer text is taken whole).
BATCH_BYTES = 1 << 20

SPACE, LETTER, NUMBER, OTHER = range(4)


def byte_chars() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    own = {b for lo, hi in PRINTABLE for b in range(lo, hi + 1)}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


def _classes() -> np.ndarray:
    """Class of every code point, as the pre-token pattern tells them apart."""
    points = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x110000)]).astype("<u4")
    every = points.tobytes().decode("utf-32-le")
    out = np.full(0x110000, OTHER, np.uint8)
    for pattern, kind in ((r"\s+", SPACE), (r"\p{L}+", LETTER), (r"\p{N}+", NUMBER)):
        for m in regex.finditer(pattern, every):
            out[points[m.start():m.end()]] = kind
    return out


def pretoken_starts(points: np.ndarray, text_starts: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Where the pattern's matches begin, for the code points of texts laid end to end.

    Runs of one class are matches; a blank before a run of another class
    belongs to it; of a longer run of white space only the last character is
    left for what follows; an apostrophe that begins a match takes a
    following s, t, m, d, re, ve or ll with it.
    """
    n = len(points)
    kind = classes[points]
    first = np.zeros(n + 1, bool)
    first[text_starts] = True
    first[n] = True
    begins = first[:-1].copy()
    begins[1:] |= kind[1:] != kind[:-1]
    # white space before something else of the same text: its last character starts a match, and a blank joins the run
    after = np.flatnonzero((kind[1:] != SPACE) & (kind[:-1] == SPACE) & ~first[1:-1]) + 1
    begins[after - 1] = True
    begins[after[points[after - 1] == 0x20]] = False
    quote = np.flatnonzero(points == 0x27)
    if len(quote):
        padded = np.append(points, [0, 0, 0]).astype(np.int64)
        ends = np.append(first, [True, True, True])
        free = quote[begins[quote]]  # begins a match of its own, not joined by a blank
        one, two = padded[free + 1], padded[free + 2]
        near, far = ~ends[free + 1], ~ends[free + 1] & ~ends[free + 2]
        is_in = lambda v, text: np.isin(v, [ord(c) for c in text])
        length = np.where(near & is_in(one, "stmd"), 1, 0)
        pair = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        length = np.where(far & pair, 2, length)
        free, length = free[length > 0], length[length > 0]
        begins[free + 1] = False
        stop = free + 1 + length
        inside = stop < n
        begins[stop[inside]] |= kind[stop[inside]] == LETTER
    return np.flatnonzero(begins)


class Merges:
    """Pairs of ids and what they become, by rank."""

    def __init__(self, pairs: list[tuple[int, int]], made: list[int]):
        key = np.array([(a << 32) | b for a, b in pairs], np.int64)
        first = dict(zip(reversed(key.tolist()), reversed(range(len(key)))))  # a pair that stands twice has its first rank
        self.rank_of = first
        self.made = np.array([*made, 0], np.int64)
        self.key = np.array(sorted(first), np.int64)
        self.rank = np.array([first[k] for k in self.key.tolist()], np.int64)
        self.none = len(made)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; ``none`` where there is no merge."""
        if not len(self.key):
            return np.full(len(left), self.none)
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.rank[at], self.none)

    def together(self, ids: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, start) of fragments after all merges; fragment k begins at start[k], start[-1] is the end."""
        fragment = np.repeat(np.arange(len(start) - 1), np.diff(start))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank = np.full(len(ids), self.none)
        inside = np.flatnonzero(fragment[:-1] == fragment[1:])
        rank[inside] = self.ranks(ids[inside], ids[inside + 1])
        while len(ids):
            first = np.flatnonzero(np.concatenate([[True], fragment[1:] != fragment[:-1]]))
            size = np.diff(np.append(first, len(ids)))
            least = np.minimum.reduceat(rank, first)
            idle = least == self.none
            if idle.any():
                stay = np.repeat(~idle, size)
                done.append((fragment[~stay], ids[~stay]))
                ids, fragment, rank, size, least = ids[stay], fragment[stay], rank[stay], size[~idle], least[~idle]
                if not len(ids):
                    break
            hit = np.flatnonzero(rank == np.repeat(least, size))
            hit = hit[np.concatenate([[True], fragment[hit[1:]] != fragment[hit[:-1]]])]
            ids[hit] = self.made[rank[hit]]
            keep = np.ones(len(ids), bool)
            keep[hit + 1] = False
            hit = hit - np.arange(len(hit))  # one place before each later hit is gone
            ids, fragment, rank = ids[keep], fragment[keep], rank[keep]
            for at in (hit, hit[hit > 0] - 1):
                at = at[at + 1 < len(ids)]
                pair = fragment[at] == fragment[at + 1]
                rank[at] = np.where(pair, self.ranks(ids[at], ids[at + 1]), self.none)
            if len(ids):
                rank[-1] = self.none
        if not done:
            return np.empty(0, np.int64), np.zeros(len(start), np.int64)
        fragment, ids = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(fragment, kind="stable")
        return ids[order], np.searchsorted(fragment[order], np.arange(len(start)))

    def alone(self, ids: list[int]) -> list[int]:
        """One long fragment: pairs wait in a heap, tokens in a linked list."""
        import heapq
        after, before = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]
        rank = lambda i: self.rank_of.get((ids[i] << 32) | ids[after[i]]) if after[i] >= 0 else None
        waiting = [(r, i) for i in range(len(ids)) if (r := rank(i)) is not None]
        heapq.heapify(waiting)
        gone = bytearray(len(ids))
        while waiting:
            r, i = heapq.heappop(waiting)
            if gone[i] or rank(i) != r:
                continue  # an earlier merge has taken one of the two
            j = after[i]
            ids[i], gone[j], after[i] = int(self.made[r]), 1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for k in (i, before[i]):
                if k >= 0 and (r := rank(k)) is not None:
                    heapq.heappush(waiting, (r, k))
        return [t for t, g in zip(ids, gone) if not g]


class Encoded:
    """Texts as places into the ids of distinct fragments."""

    def __init__(self, table: np.ndarray, start: np.ndarray, place: np.ndarray, bounds: np.ndarray):
        self.table, self.start, self.place, self.bounds = table, start, place, bounds
        self.lengths = np.diff(start)

    def counts(self) -> np.ndarray:
        run = np.concatenate([[0], np.cumsum(self.lengths[self.place])])
        return run[self.bounds[1:]] - run[self.bounds[:-1]]

    def flat(self) -> np.ndarray:
        """All ids in order."""
        length = self.lengths[self.place]
        return self.table[np.arange(length.sum()) + np.repeat(self.start[self.place] - np.cumsum(length) + length, length)]


class ByteBPE:
    """One vocabulary file, ready to encode and decode."""

    def __init__(self, vocabulary: str):
        spec = json.loads(vocabulary)
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        if (model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space")
                or spec.get("normalizer") or not pre.get("use_regex", True)):
            raise ValueError("only byte-level BPE vocabularies without a normalizer or prefix space are handled")
        if model.get("dropout") or model.get("ignore_merges") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"):
            raise ValueError("dropout, skipped merges, subword prefixes and word suffixes are not handled")
        if any(t[k] for t in spec["added_tokens"] for k in ("lstrip", "rstrip", "single_word")):
            raise ValueError("added tokens that strip or need word bounds are not handled")
        chars, vocab = byte_chars(), model["vocab"]
        to_byte = {c: b for b, c in enumerate(chars)}
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        token_bytes = {i: bytes(to_byte[c] for c in token) for token, i in vocab.items() if all(c in to_byte for c in token)}
        inside = np.zeros((256, 256), bool)
        for raw in token_bytes.values():
            b = np.frombuffer(raw, np.uint8)
            inside[b[:-1], b[1:]] = True
        token_bytes |= {i: s for s, i in self.special.items()}
        self.tokens = Table([token_bytes.get(i, b"") for i in range(max(token_bytes) + 1)])
        self.digits = decimals(len(self.tokens.length))
        self.forced = ~inside.reshape(-1)
        self.byte_ids = np.array([vocab[c] for c in chars], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges = Merges([(vocab[a], vocab[b]) for a, b in merges], [vocab[a + b] for a, b in merges])
        self.classes = _classes()
        names = sorted(self.special, key=len, reverse=True)
        self.find_special = regex.compile(b"|".join(map(regex.escape, names))).finditer if names else None

    def _merged(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, special: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, start) of the fragments data[start:end]."""
        length = end - start
        alone = length > SHORT
        if special:
            alone |= np.array([special.get(a) == b for a, b in zip(start.tolist(), end.tolist())])
        short = np.flatnonzero(~alone)
        size = length[short]
        run = np.concatenate([[0], np.cumsum(size)])
        ids = self.byte_ids[data[np.arange(run[-1]) + np.repeat(start[short] - run[:-1], size)]]
        ids, first = self.merges.together(ids, run)
        if not alone.any():
            return ids, first
        count = np.zeros(len(start), np.int64)
        count[short] = np.diff(first)
        others = {}
        for k in np.flatnonzero(alone).tolist():
            raw = data[start[k]:end[k]]
            one = special.get(int(start[k])) == int(end[k])
            others[k] = [self.special[raw.tobytes()]] if one else self.merges.alone(self.byte_ids[raw].tolist())
            count[k] = len(others[k])
        begin = np.concatenate([[0], np.cumsum(count)])
        out = np.empty(begin[-1], np.int64)
        out[np.arange(len(ids)) + np.repeat(begin[:-1][short] - first[:-1], np.diff(first))] = ids
        for k, x in others.items():
            out[begin[k]:begin[k + 1]] = x
        return out, begin

    def encode_batch(self, data: np.ndarray, offsets: np.ndarray) -> Encoded:
        """All texts of a buffer of UTF-8 bytes: pre-tokens, forced cuts, distinct fragments, ids."""
        if not len(data):
            return Encoded(np.empty(0, np.int64), np.zeros(1, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64))
        raw = data.tobytes()
        specials = []  # a special token and what follows it start afresh, as texts do
        if self.find_special and any(s in raw for s in self.special):
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                specials += [(a + m.start(), a + m.end()) for m in self.find_special(raw[a:b])]
        points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), "<u4")
        del raw
        lead = np.flatnonzero((data & 0xC0) != 0x80)  # the first byte of every code point
        parts = np.unique(np.concatenate([offsets[:-1], np.array(specials, np.int64).reshape(-1)]))
        parts = parts[parts < len(data)]
        starts = lead[pretoken_starts(points, np.searchsorted(lead, parts), self.classes)]
        del points, lead
        cut = np.zeros(len(data), bool)
        cut[1:] = self.forced[(data[:-1].astype(np.int32) << 8) | data[1:]]
        cut[starts] = True
        for a, b in specials:
            cut[a + 1:b] = False
        start = np.flatnonzero(cut)
        del cut, starts
        end = np.append(start[1:], len(data))
        first, second = (SpanHasher(data, seed)(start, end) for seed in (1, 2))
        _, place, where = np.unique(first, return_index=True, return_inverse=True)
        if not np.array_equal(second, second[place][where]):  # two fragments share a 64-bit hash: tell them apart by both
            _, place, where = np.unique(np.column_stack([first, second]), axis=0, return_index=True, return_inverse=True)
            where = where.reshape(-1)
        ids, begin = self._merged(data, start[place], end[place], dict(specials))
        return Encoded(ids, begin, where, np.searchsorted(start, offsets))

    def encode(self, text: str | None) -> list[int]:
        return self.encode_batch(*text_buffers(pa.array([text], pa.string()))).flat().tolist()

    def written(self, ids: np.ndarray, edge: np.ndarray) -> list[bytes]:
        """The ids of each text in decimal, joined by commas."""
        cells = np.empty((len(ids), self.digits.shape[1] + 1), np.uint8)
        cells[:, :-1], cells[:, -1] = self.digits[ids], ord(",")
        used = cells != 0
        at = np.concatenate([[0], np.cumsum(used.sum(axis=1))])[edge].tolist()
        flat = cells[used].tobytes()
        return [flat[a:max(a, b - 1)] for a, b in zip(at[:-1], at[1:])]

    def spelled(self, ids: np.ndarray, edge: np.ndarray) -> list[bytes]:
        """The bytes of the ids of each text."""
        length = self.tokens.length[ids]
        at = np.concatenate([[0], np.cumsum(length)])[edge].tolist()
        flat = self.tokens.spelled(ids, length).tobytes()
        return [flat[a:b] for a, b in zip(at[:-1], at[1:])]

    def decode(self, ids) -> str:
        return self.spelled(np.array(ids, np.int64), np.array([0, len(ids)]))[0].decode("utf-8", "replace")


#: Output columns that ``encode`` and ``decode`` can give.
KINDS = {"decoded": "string", "ids": "array<int>", "n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def _columns(bpe: ByteBPE, column, outputs: list[str]) -> list[pa.Array]:
    """The asked outputs for a column of texts; decoded bytes are made from the ids."""
    got = bpe.encode_batch(*text_buffers(column))
    made: dict[str, pa.Array] = {"n_tokens": pa.array(got.counts())}
    if set(outputs) == {"n_tokens"}:
        return [made["n_tokens"]]
    edge, ids = np.concatenate([[0], np.cumsum(got.counts())]), got.flat()
    if "ids" in outputs:
        made["ids"] = pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(ids, pa.int32()))
    if "ids_sha256" in outputs:
        made["ids_sha256"] = pa.array([hashlib.sha256(x).hexdigest() for x in bpe.written(ids, edge)], pa.string())
    if "decoded" in outputs or "decoded_sha256" in outputs:
        texts = [x.decode("utf-8", "replace") for x in bpe.spelled(ids, edge)]
        made["decoded"] = pa.array(texts, pa.string())
        if "decoded_sha256" in outputs:
            made["decoded_sha256"] = pa.array([hashlib.sha256(x.encode()).hexdigest() for x in texts], pa.string())
    return [made[o] for o in outputs]


def _run(df: DataFrame, keep: list[str], column: str, vocabulary: str, outputs: list[str], given_ids: bool) -> DataFrame:
    bounded_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)  # one fixed vocabulary file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = shared.value
        bpe = cached("bpe:" + hashlib.sha256(text.encode()).hexdigest(), lambda: ByteBPE(text), slot="model")
        if given_ids:
            for batch in batches:
                texts = [bpe.decode(ids or []) for ids in batch.column("__in").to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=[*keep, *outputs])
            return
        for part in slices(batches, "__in", BATCH_BYTES):
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], *_columns(bpe, part.column("__in"), outputs)], names=[*keep, *outputs])

    source = df.select(*keep, F.col(column).alias("__in"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]]
                       + [f"{o} {KINDS[o]}" for o in outputs])
    return source.mapInArrow(run, schema)


def encode(docs: DataFrame, vocabulary: str, keep: list[str] | None = None, text: str = "text",
           outputs: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default doc_id) and the asked ``outputs`` (default ids) of every whole text.

    ``vocabulary`` is the text of a byte-level BPE vocabulary file.  ``decoded``
    and ``decoded_sha256`` are made from the ids, not from the text.  Output
    names must differ from the kept ones (ValueError).
    """
    keep, outputs = keep or ["doc_id"], outputs or ["ids"]
    if set(keep) & set(outputs):
        raise ValueError("kept columns and outputs share a name")
    return _run(docs, keep, text, vocabulary, outputs, False)


def decode(encoded: DataFrame, vocabulary: str, keep: list[str] | None = None, ids: str = "ids",
           out: str = "decoded") -> DataFrame:
    """``keep`` columns and the texts of an ids column; null ids decode to the empty text."""
    return _run(encoded, keep or ["doc_id"], ids, vocabulary, [out], True)
