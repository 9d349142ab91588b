"""Toxicity by gradient-boosted trees over dense text features, with isotonic calibration.

Features of a whole text: densities of a lexicon learnt from the labels
(words and word beginnings that labelled toxic texts favour, after lower
casing, reading look-alike digits as letters and dropping symbols inside
words), nearness of second-person words to lexicon words, capitals,
punctuation, digits, obfuscation and repeated letters.  The trees are fitted
on at most ``SAMPLE_ROWS`` labelled rows; features for the fit come from a
lexicon of the other half of the sample, and the scores are calibrated on
out-of-fold margins by pooling adjacent violators.

Defined cases: null text counts as empty; empty texts get a score too;
without labelled rows of both labels every score is the labels' mean (0
without labels); a document with several labels counts as toxic if any says
so; null labels and ids teach nothing; repeated rows are scored alike; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .words import SpanHasher, Words, spans, word_mask
from .worker import bounded_batches, slices, text_buffers

#: Labelled rows that the classifier is fitted on, at most.
SAMPLE_ROWS = 6_000
#: Entries of the learnt lexicon, at most.
LEXICON_ENTRIES = 600
#: Bytes of a word's beginning that can be lexicon entries; 0 stands for the whole word.
BEGINNINGS = (0, 4, 5, 6)
#: An entry is at least this many times likelier in toxic texts (natural log).
LEAST_LOG_ODDS = 2.0
#: Words counted as near.
NEAR = 8

# Second-person words of the larger European languages.
SECOND_PERSON = ("you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton tes vous votre "
                 "usted ustedes ti tus vosotros os você voi tuo").split()
# Digits and signs read as the letter they look like.
LOOKALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a"}

FEATURES = ["log_words", "hit_density", "hit_weight", "log_hits", "max_weight", "second_person_near", "second_person",
            "capitals", "capital_words", "punctuation", "exclamations", "obfuscated", "repeats", "digits"]


@dataclass
class Lexicon:
    """Sorted hashes of words and word beginnings with their weights."""
    keys: np.ndarray
    weights: np.ndarray

    def __post_init__(self):
        order = np.argsort(self.keys)
        self.keys, self.weights = self.keys[order], self.weights[order]
        self.table = np.zeros(1 << 16, bool)
        self.table[(self.keys & np.uint64(0xFFFF)).astype(np.int64)] = True

    def weight(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes))
        maybe = np.flatnonzero(self.table[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        if len(maybe) and len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, hashes[maybe]), len(self.keys) - 1)
            found = self.keys[at] == hashes[maybe]
            out[maybe[found]] = self.weights[at[found]]
        return out


class Plain:
    """Lower-cased words without symbols, look-alikes read as letters; hashes of words and beginnings."""

    def __init__(self, column):
        data, offsets = text_buffers(pc.utf8_lower(column.cast(pa.large_string())))
        letter = np.zeros(256, bool)
        letter[97:123] = letter[128:] = True
        start, end, text = spans(word_mask(data), offsets)
        signs = np.array([ord(c) for c in LOOKALIKE], np.uint8)
        read = np.arange(256, dtype=np.uint8)
        read[signs] = [ord(c) for c in LOOKALIKE.values()]
        like = np.zeros(256, bool)
        like[signs] = True
        has = np.concatenate([[0], np.cumsum(letter[data], dtype=np.int64)])
        with_letter = has[end] > has[start]  # look-alikes count only in words with a letter
        keep = letter[data]
        if like[data].any():
            of_word = np.zeros(len(data) + 1, np.int32)
            of_word[start[with_letter]] += 1
            of_word[end[with_letter]] -= 1
            keep |= like[data] & (np.cumsum(of_word[:-1]) > 0)
        rank = np.concatenate([[0], np.cumsum(keep, dtype=np.int64)])
        plain = read[data[keep]]
        s, e = rank[start], rank[end]
        some = e > s
        self.text, s, e = text[some], s[some], e[some]
        hasher = SpanHasher(plain, seed=3)
        self.hashes = []
        for size in BEGINNINGS:
            h = hasher(s, e if size == 0 else np.minimum(s + size, e)) + np.uint64(size)
            if size:
                h[e - s <= size] = 0  # the whole word has its own entry
            self.hashes.append(h)


def _second_person() -> np.ndarray:
    return np.sort(Plain(pa.array(SECOND_PERSON)).hashes[0])


def units(column) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text index, hash) of the words and beginnings of each text."""
    plain = Plain(column)
    text = np.tile(plain.text, len(BEGINNINGS))
    h = np.concatenate(plain.hashes)
    text, h = text[h != 0], h[h != 0]
    order = np.lexsort((h, text))
    text, h = text[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (text[1:] != text[:-1]) | (h[1:] != h[:-1])
    return text[new], h[new]


def sketches(column) -> np.ndarray:
    """Least shingle hash of each text, alike in most near copies, so that copies teach once."""
    words = Words(*text_buffers(column))
    at, h = words.shingles(words.hashes(5), 5, 5)
    out = np.full(len(column), np.uint64(0))
    if len(at):
        texts = words.text[at]
        first = np.flatnonzero(np.concatenate([[True], texts[1:] != texts[:-1]]))
        out[texts[first]] = np.minimum.reduceat(h, first)
    short = np.flatnonzero(out == 0)
    if len(short):
        data, offsets = text_buffers(column)
        out[short] = SpanHasher(data, 9)(offsets[short], offsets[short + 1])
    return out


def features(column, lexicon: Lexicon, second: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` for each text."""
    n = len(column)
    data, offsets = text_buffers(column)
    words = Words(data, offsets)
    per_word = lambda mask: np.bincount(words.text, weights=mask, minlength=n)
    n_words = np.maximum(words.count, 1).astype(float)
    size = np.maximum(np.diff(offsets), 1).astype(float)
    upper, digit = (data >= 65) & (data <= 90), (data >= 48) & (data <= 57)
    letters = upper | ((data >= 97) & (data <= 122)) | (data >= 128)
    sign = (data > 32) & (data < 127) & ~letters & ~digit
    run = lambda mask: np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    upper_run, letter_run, digit_run, sign_run = run(upper), run(letters), run(digit), run(sign)
    bang_run = run((data == 33) | (data == 63))
    same = np.zeros(len(data), bool)
    if len(data) > 2:
        same[2:] = (data[2:] == data[1:-1]) & (data[2:] == data[:-2]) & letters[2:]
    s, e = words.start, words.end
    inner = np.minimum(s + 1, e), np.maximum(e - 1, np.minimum(s + 1, e))
    in_letters = letter_run[e] - letter_run[s]
    odd_inside = (sign_run[inner[1]] - sign_run[inner[0]]) + (digit_run[inner[1]] - digit_run[inner[0]])
    same_run = run(same)
    of_text = lambda r: (r[offsets[1:]] - r[offsets[:-1]]).astype(float)
    n_letters = np.maximum(of_text(letter_run), 1)

    plain = Plain(column)
    weight = np.zeros(len(plain.text))
    for h in plain.hashes:
        np.maximum(weight, lexicon.weight(h), out=weight)
    hit = weight > 0
    hits = np.bincount(plain.text, weights=hit, minlength=n)
    strongest = np.zeros(n)
    np.maximum.at(strongest, plain.text[hit], weight[hit])
    at = np.minimum(np.searchsorted(second, plain.hashes[0]), len(second) - 1)
    you = second[at] == plain.hashes[0]
    near = np.zeros(n)
    places, yous = np.flatnonzero(hit), np.flatnonzero(you)
    if len(places) and len(yous):
        k = np.searchsorted(yous, places)
        best = np.full(len(places), NEAR + 1)
        for j in (np.maximum(k - 1, 0), np.minimum(k, len(yous) - 1)):
            close = plain.text[yous[j]] == plain.text[places]
            best = np.where(close, np.minimum(best, np.abs(yous[j] - places)), best)
        np.add.at(near, plain.text[places], np.maximum(0, 1 - best / (NEAR + 1)))
    return np.column_stack([
        np.log1p(words.count), hits / n_words, np.bincount(plain.text, weights=weight, minlength=n) / n_words, np.log1p(hits), strongest,
        near / np.maximum(hits, 1), np.bincount(plain.text, weights=you, minlength=n) / n_words,
        of_text(upper_run) / n_letters, per_word((upper_run[e] - upper_run[s] == in_letters) & (in_letters > 1)) / n_words,
        of_text(sign_run) / size, of_text(bang_run) / n_words, per_word((in_letters > 0) & (odd_inside > 0)) / n_words,
        per_word(same_run[e] - same_run[s] > 0) / n_words, of_text(digit_run) / size])


# ---------------------------------------------------------------- model

class Trees:
    """Gradient-boosted regression trees on the logistic loss, split by histograms of quantile bins."""

    def __init__(self, rounds: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 32, penalty: float = 1.0, least: int = 5):
        self.rounds, self.depth, self.rate, self.bins, self.penalty, self.least = rounds, depth, rate, bins, penalty, least

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = np.column_stack([np.searchsorted(c, v, side="left") for c, v in zip(self.cuts, x.T)])
        rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base, self.trees = float(np.log(rate / (1 - rate))), []
        margin = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-margin))
            tree = self._grow(binned, y - p, np.maximum(p * (1 - p), 1e-6))
            self.trees.append(tree)
            margin += self._leaf(tree, x)
        return self

    def _grow(self, binned, gradient, hessian):
        """Complete tree: (feature, cut) of the inner nodes and values of the leaves; feature -1 goes left."""
        node = np.zeros(len(gradient), np.int64)
        feature, cut = np.full(2 ** self.depth - 1, -1), np.zeros(2 ** self.depth - 1)
        for level in range(self.depth):
            nodes, first = 2 ** level, 2 ** level - 1
            best = np.full(nodes, 1e-6)
            place = np.zeros(nodes, np.int64)
            for f in range(binned.shape[1]):
                width = len(self.cuts[f]) + 1
                if width < 2:
                    continue
                cell = (node - first) * width + binned[:, f]
                g, h, c = (np.bincount(cell, weights=w, minlength=nodes * width).reshape(nodes, width).cumsum(1) for w in (gradient, hessian, None))
                total = [a[:, -1:] for a in (g, h, c)]
                gain = (g[:, :-1] ** 2 / (h[:, :-1] + self.penalty) + (total[0] - g[:, :-1]) ** 2 / (total[1] - h[:, :-1] + self.penalty)
                        - total[0] ** 2 / (total[1] + self.penalty))
                gain[(c[:, :-1] < self.least) | (total[2] - c[:, :-1] < self.least)] = 0
                at = gain.argmax(1)
                better = gain[np.arange(nodes), at] > best
                best[better] = gain[np.arange(nodes), at][better]
                feature[first:first + nodes][better], place[better] = f, at[better]
            for k in range(nodes):
                if feature[first + k] >= 0:
                    cut[first + k] = self.cuts[feature[first + k]][place[k]]
            f = feature[node]
            right = (f >= 0) & (binned[np.arange(len(node)), np.maximum(f, 0)] > place[node - first])
            node = 2 * node + 1 + right
        leaf = node - (2 ** self.depth - 1)
        g = np.bincount(leaf, weights=gradient, minlength=2 ** self.depth)
        h = np.bincount(leaf, weights=hessian, minlength=2 ** self.depth)
        return feature, cut, self.rate * g / (h + self.penalty)

    def _leaf(self, tree, x: np.ndarray) -> np.ndarray:
        feature, cut, value = tree
        node = np.zeros(len(x), np.int64)
        for _ in range(self.depth):
            f = feature[node]
            node = 2 * node + 1 + ((f >= 0) & (x[np.arange(len(x)), np.maximum(f, 0)] > cut[node]))
        return value[node - (2 ** self.depth - 1)]

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.base + sum((self._leaf(t, x) for t in self.trees), np.zeros(len(x)))


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing map from margins to rates of label 1, as points to interpolate between."""
    order = np.argsort(margin, kind="stable")
    blocks: list[list[float]] = []  # sum of labels, rows, first and last margin
    for m, label in zip(margin[order], y[order]):
        blocks.append([label, 1, m, m])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + last[0], blocks[-1][1] + last[1], blocks[-1][2], last[3]]
    rate = [(b[0] + 0.05) / (b[1] + 0.1) for b in blocks]
    points = [(m, r) for b, r in zip(blocks, rate) for m in sorted({b[2], b[3]})]
    return np.array([p[0] for p in points]), np.maximum.accumulate([p[1] for p in points])


@dataclass
class Model:
    """What a fit leaves: all that a score needs."""
    lexicon: Lexicon
    trees: Trees | None
    points: tuple[np.ndarray, np.ndarray] | None
    constant: float = 0.0

    def score(self, column) -> np.ndarray:
        if self.trees is None:
            return np.full(len(column), self.constant)
        return np.interp(self.trees.margin(features(column, self.lexicon, _second_person())), *self.points)


def crc_of_id(doc_id: str) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))


def _lexicon(counts: np.ndarray, totals: np.ndarray) -> Lexicon:
    """From rows (hash, toxic texts, other texts) and the numbers of texts, both without near copies."""
    keys, toxic, other = counts["h"], counts["toxic"], counts["other"]
    weight = np.log((toxic + 0.5) / (totals[1] + 1)) - np.log((other + 0.5) / (totals[0] + 1))
    keep = (toxic >= max(2, 0.015 * totals[1])) & (weight >= LEAST_LOG_ODDS)
    order = np.lexsort((keys[keep], -(toxic * weight)[keep]))[:LEXICON_ENTRIES]
    return Lexicon(keys[keep][order], weight[keep][order])


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
        sample_rows: int = SAMPLE_ROWS) -> Model:
    """Lexicon, trees and calibration from at most ``sample_rows`` labelled texts, drawn by a hash of id and text.

    A text that repeats under one id teaches once.  Of the units that two
    toxic texts share, the ``20 * LEXICON_ENTRIES`` in most texts are weighed
    for the lexicon.
    """
    bounded_batches(docs.sparkSession)
    labelled = (labels.filter(F.col(doc_id).isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col(doc_id).alias("__id"))
                .agg(F.max(label).cast("int").alias("__y")))
    texts = docs.select(F.col(doc_id).alias("__id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("__h", F.xxhash64("__id", "text"))
    # hashes meet the labels, not texts; labels of absent documents take no place in the sample
    taught = texts.select("__id", "__h").distinct().join(labelled, "__id").orderBy("__h", "__id").limit(sample_rows)
    # at most sample_rows rows, so the broadcast is bounded
    rows = (texts.join(F.broadcast(taught), ["__id", "__h"]).groupBy("__id", "__h", "__y").agg(F.min("text").alias("text"))
            .withColumn("half", F.pmod(F.xxhash64("__id", F.lit(1)), F.lit(2)).cast("int")))
    rows = cut_lineage(rows)

    def toxic_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            i, h = units(part.column("text"))
            sketch, half, y = sketches(part.column("text")).view(np.int64), part.column("half").to_numpy(), part.column("__y").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(sketch[i]), pa.array(half[i]), pa.array(y[i])],
                                             names=["h", "sketch", "half", "y"])

    def of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([pa.array(sketches(part.column("text")).view(np.int64)), part.column("half"), part.column("__y")],
                                             names=["sketch", "half", "y"])

    # texts are counted as their words are: near copies once
    distinct = rows.mapInArrow(of_texts, "sketch long, half int, y int").distinct()
    totals = {(r["half"], r["y"]): r["n"] for r in distinct.groupBy("half", "y").agg(F.count(F.lit(1)).alias("n")).collect()}
    per = lambda half, y: sum(n for (a, b), n in totals.items() if b == y and half in (a, None))
    if not per(None, 1) or not per(None, 0):
        return Model(Lexicon(np.empty(0, np.uint64), np.empty(0)), None, None, 1.0 if per(None, 1) else 0.0)
    schema = "h long, sketch long, half int, y int"
    toxic = (rows.filter("__y = 1").mapInArrow(toxic_units, schema).distinct().groupBy("h")
             .agg(F.count_if(F.col("half") == 0).alias("t0"), F.count_if(F.col("half") == 1).alias("t1"))
             .filter(F.col("t0") + F.col("t1") >= 2).orderBy(F.desc(F.col("t0") + F.col("t1")), "h").limit(20 * LEXICON_ENTRIES))
    toxic = cut_lineage(toxic)
    candidates = np.sort(np.array([r["h"] for r in toxic.select("h").collect()], np.int64)).view(np.uint64)
    candidates.sort()

    def other_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            i, h = units(part.column("text"))
            at = np.minimum(np.searchsorted(candidates, h), max(len(candidates) - 1, 0))
            known = candidates[at] == h if len(candidates) else np.zeros(len(h), bool)
            i, h = i[known], h[known]
            sketch, half = sketches(part.column("text")).view(np.int64), part.column("half").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(sketch[i]), pa.array(half[i]), pa.array(np.zeros(len(i), np.int32))],
                                             names=["h", "sketch", "half", "y"])

    other = (rows.filter("__y = 0").mapInArrow(other_units, schema).distinct().groupBy("h")
             .agg(F.count_if(F.col("half") == 0).alias("o0"), F.count_if(F.col("half") == 1).alias("o1")))
    counted = toxic.join(other, "h", "left").na.fill(0).collect()
    h = np.array([r["h"] for r in counted], np.int64).view(np.uint64)
    by_half = {k: np.array([(r[f"t{k}"], r[f"o{k}"]) for r in counted], float).reshape(-1, 2) for k in (0, 1)}

    def lexicon(*halves: int) -> Lexicon:
        both = sum(by_half[k] for k in halves)
        counts = {"h": h, "toxic": both[:, 0], "other": both[:, 1]}
        return _lexicon(counts, np.array([sum(per(k, y) for k in halves) for y in (0, 1)]))

    crossed = {0: lexicon(1), 1: lexicon(0)}  # a half's features never come from its own labels

    def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        second = _second_person()
        for part in slices(batches, "text"):
            half, column = part.column("half").to_numpy(), part.column("text")
            both = [features(column, crossed[k], second) for k in (0, 1)]
            x = np.where((half == 0)[:, None], *both)
            yield pa.RecordBatch.from_arrays([part.column("__id"), part.column("__y"), pa.array(list(x))], names=["id", "y", "x"])

    kind = rows.schema["__id"].dataType.simpleString()
    found = rows.mapInArrow(table, f"id {kind}, y int, x array<double>").orderBy("id", "x").collect()
    x, y = np.array([r["x"] for r in found]), np.array([r["y"] for r in found], float)
    folds = np.random.default_rng(0).integers(0, 3, len(y))
    margin = np.zeros(len(y))
    for k in range(3):
        rest = folds != k
        if rest.any() and 0 < y[rest].mean() < 1:
            margin[~rest] = Trees().fit(x[rest], y[rest]).margin(x[~rest])
    return Model(lexicon(0, 1), Trees().fit(x, y), isotonic(margin, y))


def score(docs: DataFrame, model: Model, keep: list[str] | None = None, text: str = "text", out: str = "score") -> DataFrame:
    """``keep`` columns (default doc_id) and the score of every whole text."""
    bounded_batches(docs.sparkSession)
    keep = keep or ["doc_id"]
    if out in keep:
        raise ValueError("the output's name is among the kept columns")
    names = [*keep, out]
    source = docs.select(*keep, F.col(text).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "__text"):
            cols = [part.column(i) for i in range(part.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(model.score(pc.fill_null(part.column(part.num_columns - 1), "")))], names=names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]) + f", `{out}` double"
    return source.mapInArrow(run, schema)
