"""Two tokenizers of the same texts aligned by their bytes.

Tokenizer A is a byte-level BPE vocabulary and reads a blank and the text;
tokenizer B is a sentencepiece model, which puts that blank itself.  Both
token sequences so stand for the same bytes.  Incidence matrices in
compressed rows (one row for each token of A or B, one column for each byte)
are multiplied row by row by Gustavson's scheme: the product A x B' has an
entry, the number of shared bytes, for every pair of tokens that overlap.
Places where tokens of both end cut a text into groups; incidence
matrices of tokens and groups multiplied the same way link the tokens of a
group (``shared_links``; their number follows from row sums, so no pairs are
written for it).

Each text is tokenized once.  Texts of a task form packs; a pack writes its
texts' pairs of ids and, once, its distinct pairs with the number of
texts that hold them.  The packs' numbers add up to the corpus-wide count
of a pair; the counts go back to the packs that asked, one row for a
pair and pack however many texts hold it, and each pack answers its texts.

Defined cases: a text that is null or empty, or whose tokens' bytes differ
from blank + text (a normalising model, a text with U+2581), has no
tokens: numbers are 0, ``groups`` is empty and its digest too; special
tokens' strings inside texts are plain text; very long texts are taken whole;
repeated rows and null ids are answered row by row; an empty table gives an
empty result; other columns than the kept ones are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .bpe import PATTERN, byte_chars
from .worker import Table, bounded_batches, cached, decimals, discard, slices

#: A pack is closed after so many pairs of a text and a pair of ids.
PACK_PAIRS = 1 << 19
#: Text bytes tokenized in one go (a longer text is taken whole).
SLICE_BYTES = 1 << 19
#: Longer texts go to the tokenizers library, whose pattern engine does not recurse.
LONG_CHARS = 1 << 18


class Csr:
    """A sparse matrix in compressed rows: ``start`` of each row, ``column`` and ``value`` of each entry."""

    def __init__(self, start: np.ndarray, column: np.ndarray, value: np.ndarray, columns: int):
        self.start, self.column, self.value, self.columns = start, column, value, columns

    def rows(self) -> np.ndarray:
        """The row of every entry."""
        return np.repeat(np.arange(len(self.start) - 1), np.diff(self.start))

    def transposed(self) -> Csr:
        row = self.rows()
        if len(self.column) > 1 and (self.column[1:] < self.column[:-1]).any():
            order = np.argsort(self.column, kind="stable")
            row, value, column = row[order], self.value[order], self.column[order]
        else:
            value, column = self.value, self.column
        start = np.concatenate([[0], np.cumsum(np.bincount(column, minlength=self.columns))])
        return Csr(start, row, value, len(self.start) - 1)

    def __matmul__(self, other: Csr) -> Csr:
        """Gustavson: each entry of a row scales the row of ``other`` it names; equal columns are added up."""
        length = np.diff(other.start)[self.column]
        run = np.cumsum(length) - length
        at = np.arange(int(length.sum())) + np.repeat(other.start[self.column] - run, length)
        row, column = np.repeat(self.rows(), length), other.column[at]
        value = np.repeat(self.value, length) * other.value[at]
        key = row * other.columns + column
        if len(key) > 1 and (key[1:] < key[:-1]).any():
            order = np.argsort(key, kind="stable")
            key, value = key[order], value[order]
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
        row, column = key[new] // max(other.columns, 1), key[new] % max(other.columns, 1)
        start = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(self.start) - 1))])
        return Csr(start, column, np.add.reduceat(value, new) if len(new) else value, other.columns)

    def __mul__(self, vector: np.ndarray) -> np.ndarray:
        """The matrix times a column."""
        run = np.concatenate([[0], np.cumsum(self.value * vector[self.column])])
        return run[self.start[1:]] - run[self.start[:-1]]


def byte_incidence(lengths: np.ndarray) -> Csr:
    """Tokens x bytes of tokens that stand one after another."""
    start = np.concatenate([[0], np.cumsum(lengths)])
    return Csr(start, np.arange(start[-1]), np.ones(start[-1], np.int64), int(start[-1]))


def group_incidence(ends: np.ndarray, cuts: np.ndarray) -> Csr:
    """Tokens x groups: a token lies in the group that ends at the first cut not before its own end."""
    return Csr(np.arange(len(ends) + 1), np.searchsorted(cuts, ends), np.ones(len(ends), np.int64), len(cuts))


class Aligned:
    """Texts end to end as tokens of A and B; ``a_of`` and ``b_of`` give the first token of every text."""

    def __init__(self, a: np.ndarray, b: np.ndarray, a_lengths: np.ndarray, b_lengths: np.ndarray, a_of: np.ndarray, b_of: np.ndarray):
        self.a, self.b, self.a_of, self.b_of = a, b, a_of, b_of
        self.by_byte_a, self.by_byte_b = byte_incidence(a_lengths), byte_incidence(b_lengths)
        self.overlap = self.by_byte_a @ self.by_byte_b.transposed()
        self.cuts = np.intersect1d(self.by_byte_a.start[1:], self.by_byte_b.start[1:], assume_unique=True)
        self.in_group_a = group_incidence(self.by_byte_a.start[1:], self.cuts)
        self.in_group_b = group_incidence(self.by_byte_b.start[1:], self.cuts)

    def shared_links(self) -> Csr:
        """Tokens of A x tokens of B of the same group."""
        return self.in_group_a @ self.in_group_b.transposed()

    def shared(self) -> np.ndarray:
        """For each token of A the tokens of B in its group: row sums of ``shared_links``, without its pairs."""
        return self.in_group_a * (self.in_group_b.transposed() * np.ones(len(self.b), np.int64))

    def groups(self) -> np.ndarray:
        """The number of groups of every text."""
        return np.diff(np.searchsorted(self.cuts, self.by_byte_a.start[self.a_of], side="right"))

    def written(self, digits: np.ndarray) -> list[bytes]:
        """Every text's groups as ``a1,a2|b1;a3|b2,b3``.  ``digits``: ids x 5 decimal digits, 0 before the first."""
        ga, gb = self.in_group_a.column, self.in_group_b.column
        n = len(self.a) + len(self.b)
        before_b = np.searchsorted(gb, ga)                      # tokens of B in groups before a token of A
        before_a = np.searchsorted(ga, gb, side="right")        # tokens of A in groups up to a token of B
        at_a, at_b = np.arange(len(self.a)) + before_b, np.arange(len(self.b)) + before_a
        out = np.zeros((n, digits.shape[1] + 1), np.uint8)
        for at, ids, g, last in ((at_a, self.a, ga, b"|"), (at_b, self.b, gb, b";")):
            out[at, :-1] = digits[ids]
            ends = np.ones(len(g), bool)
            ends[:-1] = g[1:] != g[:-1]
            out[at, -1] = np.where(ends, ord(last), ord(","))
        used = out != 0
        edge = np.concatenate([[0], np.cumsum(used.sum(axis=1))])[self.a_of + self.b_of]
        flat = out[used].tobytes()
        return [flat[x:max(x, y - 1)] for x, y in zip(edge[:-1].tolist(), edge[1:].tolist())]


class Pair:
    """Both tokenizers, ready to use."""

    def __init__(self, vocabulary: str, model: bytes):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer
        spec = json.loads(vocabulary)
        to_byte = {c: b for b, c in enumerate(byte_chars())}
        words = {bytes(to_byte[c] for c in token): i for token, i in spec["model"]["vocab"].items()
                 if token not in {t["content"] for t in spec["added_tokens"]}}
        self.library = Tokenizer.from_str(vocabulary)
        self.library.encode_special_tokens = True
        self.library.no_truncation()
        self.library.no_padding()
        # merges in the order of their ids are ranks, as the faster library takes them
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        ranks = [spec["model"]["vocab"][x + y] for x, y in merges]
        plain = all(x < y for x, y in zip(ranks, ranks[1:])) and not spec.get("normalizer") and spec["pre_tokenizer"]["type"] == "ByteLevel" \
            and not spec["pre_tokenizer"].get("add_prefix_space") and spec["pre_tokenizer"].get("use_regex", True)
        self.fast = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=words, special_tokens={}) if plain else None
        raw = [b""] * (max(words.values()) + 1)
        for w, i in words.items():
            raw[i] = w
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = self.pieces.get_piece_size()
        piece = [bytes([int(p[1:-1], 16)]) if self.pieces.is_byte(i) else p.replace("▁", " ").encode()
                 for i, p in enumerate(self.pieces.id_to_piece(list(range(size))))]
        self.a, self.b = Table(raw), Table(piece)
        self.digits = decimals(max(len(raw), size))

    def ids(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Tokens of blank + text by A and of the text by B."""
        first = []
        for t in texts:
            if self.fast is not None and len(t) < LONG_CHARS:
                first.append(self.fast.encode_ordinary(" " + t))
            else:
                first.append(self.library.encode(" " + t, add_special_tokens=False).ids)
        second = self.pieces.encode(texts, num_threads=1) if texts else []
        return [np.array(x, np.int64) for x in first], [np.array(x, np.int64) for x in second]

    def align(self, texts: list[str | None]) -> Aligned:
        """The tokens of texts and their links; texts whose tokens do not spell them have none."""
        some = [i for i, t in enumerate(texts) if t]
        ids_a, ids_b = self.ids([texts[i] for i in some])
        given = [np.frombuffer((" " + texts[i]).encode(), np.uint8) for i in some]
        keep_a, keep_b = [np.empty(0, np.int64)] * len(texts), [np.empty(0, np.int64)] * len(texts)
        for i, x, y, raw in zip(some, ids_a, ids_b, given):
            n, m = self.a.length[x], self.b.length[y]
            if n.sum() == len(raw) == m.sum() and n.all() and m.all() \
                    and np.array_equal(self.a.spelled(x, n), raw) and np.array_equal(self.b.spelled(y, m), raw):
                keep_a[i], keep_b[i] = x, y
        edge = lambda parts: np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        a, b = (np.concatenate([np.empty(0, np.int64), *p]) for p in (keep_a, keep_b))
        return Aligned(a, b, self.a.length[a], self.b.length[b], edge(keep_a), edge(keep_b))


def _pair(vocabulary: str, model: bytes) -> Pair:
    key = hashlib.sha256(vocabulary.encode() + model).hexdigest()
    return cached("alignment:" + key, lambda: Pair(vocabulary, model), slot="model")


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def links(docs: DataFrame, vocabulary: str, model: bytes, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """Kept columns, ids_a, ids_b, and as parallel arrays the links: place_a and place_b of the tokens, shared bytes, and group."""
    bounded_batches(docs.sparkSession)
    spark, keep = docs.sparkSession, list(keep)
    shared = spark.sparkContext.broadcast((vocabulary, model))  # two fixed files
    source = docs.select(*keep, F.col(text).alias("__in"))

    def lists(values: np.ndarray, edge: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(values, pa.int32()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "__in", SLICE_BYTES):
            al = _pair(*shared.value).align(part.column("__in").to_pylist())
            row, col = al.overlap.rows(), al.overlap.column
            edge = np.searchsorted(row, al.a_of)
            text_of = np.searchsorted(al.a_of, row, side="right") - 1
            first_group = np.searchsorted(al.cuts, al.by_byte_a.start[al.a_of], side="right")
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], lists(al.a, al.a_of), lists(al.b, al.b_of), lists(row - al.a_of[text_of], edge),
                 lists(col - al.b_of[text_of], edge), lists(al.overlap.value, edge), lists(al.in_group_a.column[row] - first_group[text_of], edge)],
                names=[*keep, *NAMES])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]] + [f"{n} array<int>" for n in NAMES])
    return source.mapInArrow(run, schema)


#: What ``links`` adds to the kept columns.
NAMES = ["ids_a", "ids_b", "place_a", "place_b", "bytes", "group"]


def _packed(docs: DataFrame, vocabulary: str, model: bytes, keep: list[str], text: str) -> DataFrame:
    """pack, kept columns, numbers, digest, keys and times (pairs of ids and their links) of each row, and one row for each pack (n_a null)."""
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, model))  # two fixed files
    source = docs.select(*keep, F.col(text).alias("__in"))
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_shared"]
    names = ["__pack", *keep, *numbers, "groups_sha256", "__keys", "__times"]
    schema = ", ".join(["__pack long", *[f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]],
                        *[f"{n} long" for n in numbers], "groups_sha256 string, __keys array<long>, __times array<int>"])

    def lists(keys: np.ndarray, times: np.ndarray, edge: np.ndarray) -> list[pa.Array]:
        at = pa.array(edge, pa.int32())
        return [pa.ListArray.from_arrays(at, pa.array(keys, pa.int64())), pa.ListArray.from_arrays(at, pa.array(times, pa.int32()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _pair(*shared.value)
        pack, held, size, kinds = TaskContext.get().partitionId() << 32, [], 0, None

        def closed() -> pa.RecordBatch:
            keys, texts = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array([pack]), *[pa.nulls(1, k) for k in kinds], *[pa.nulls(1, pa.int64())] * 5,
                                               pa.nulls(1, pa.string()), *lists(keys, texts, np.array([0, len(keys)]))], names=names)

        for part in slices(batches, "__in", SLICE_BYTES):
            kinds = [f.type for f in part.schema][:-1]
            al = both.align(part.column("__in").to_pylist())
            row = al.overlap.rows()
            owner = np.searchsorted(al.a_of, row, side="right") - 1
            key = al.a[row] * len(both.b.length) + al.b[al.overlap.column]
            span = len(both.a.length) * len(both.b.length)
            of, times = np.unique(owner * span + key, return_counts=True)
            owners, keys = of // span, of % span
            n = len(al.a_of) - 1
            count = lambda x, edge: np.diff(np.concatenate([[0], np.cumsum(x)])[edge])
            digest = [hashlib.sha256(w).hexdigest() if w else "" for w in al.written(both.digits)]
            columns = [np.diff(al.a_of), np.diff(al.b_of), al.groups(), np.bincount(owner, minlength=n), count(al.shared(), al.a_of)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, pack)), *part.columns[:-1], *[pa.array(c) for c in columns], pa.array(digest, pa.string()),
                 *lists(keys, times, np.searchsorted(owners, np.arange(n + 1)))], names=names)
            held.append(keys)
            size += len(keys)
            if size >= PACK_PAIRS:
                yield closed()
                pack, held, size = pack + 1, [], 0
        if size:
            yield closed()

    return source.mapInArrow(run, schema)


def align(docs: DataFrame, vocabulary: str, model: bytes, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """Kept columns, n_a, n_b, n_groups, n_links, n_shared, n_best, count_sum and groups_sha256 of every row.

    ``vocabulary`` is the text of a byte-level BPE file, ``model`` the bytes of
    a sentencepiece file.  The count of a pair of ids is the number of rows that
    hold it linked; n_best are the links whose count is the highest of their
    id of A, count_sum adds up the counts of all links.
    """
    bounded_batches(docs.sparkSession)
    keep = list(keep)
    width = len(_pair(vocabulary, model).b.length)
    packed = cut_lineage(_packed(docs, vocabulary, model, keep, text))
    asked = packed.filter("n_a is null").select(F.col("__pack").alias("pack"), F.inline(F.arrays_zip(F.col("__keys").alias("key"), F.col("__times").alias("texts"))))
    counts = cut_lineage(asked.groupBy("key").agg(F.sum("texts").alias("count")).withColumn("a", F.floor(F.col("key") / width)))
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))
    known = counts.join(highest, "a").select("key", "count", (F.col("count") == F.col("highest")).alias("best"))
    answers = asked.select("pack", "key").join(known, "key").select("pack", "key", "count", "best")
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_shared"]
    rows = packed.filter("n_a is not null")

    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        keys, times = rows["__keys"].combine_chunks(), rows["__times"].combine_chunks()
        if isinstance(keys, pa.ChunkedArray):
            keys, times = pa.concat_arrays(keys.chunks), pa.concat_arrays(times.chunks)
        edge = keys.offsets.to_numpy().astype(np.int64)
        key, time = keys.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
        edge = edge - edge[0]
        known = answers["key"].to_numpy()
        order = np.argsort(known)
        at = order[np.searchsorted(known, key, sorter=order)] if len(key) else np.empty(0, np.int64)
        best, count = answers["best"].to_numpy().astype(np.int64)[at] * time, answers["count"].to_numpy()[at] * time
        total = lambda x: pa.array(np.diff(np.concatenate([[0], np.cumsum(x)])[edge]), pa.int64())
        return pa.table([*[rows[c] for c in [*keep, *numbers]], total(best), total(count), rows["groups_sha256"]],
                        names=[*keep, *numbers, "n_best", "count_sum", "groups_sha256"])

    schema = ", ".join([*[f"`{c}` {packed.schema[c].dataType.simpleString()}" for c in keep], *[f"{n} long" for n in [*numbers, "n_best", "count_sum"]],
                        "groups_sha256 string"])
    out = cut_lineage(rows.groupBy("__pack").cogroup(answers.groupBy("pack")).applyInArrow(run, schema))
    discard(packed, counts)
    return out
