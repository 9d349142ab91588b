"""Language identification by a small byte convolutional network.

Every whole text is cut into windows of ``WINDOW`` bytes.  Filters of several
widths slide over the byte embeddings of a window, the largest response of
each filter is kept and a softmax layer gives the window's probabilities;
the text's are the windows' means, weighted by their letters.  The network
is trained in numpy on at most ``SAMPLE_TEXTS`` labelled texts, an equal
number for each language, with at most ``SAMPLE_WINDOWS`` windows of each.

Defined cases: a text that is null, empty or without a letter is ``und`` with
score 0; without a labelled text everything is ``und``; equal probabilities
go to the first language in alphabetical order; repeated rows are answered
alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .worker import bounded_batches, slices, text_buffers

#: Labelled texts the network is trained on, at most, over all languages.
SAMPLE_TEXTS = 1_600
#: Windows of one text in the training, at most.
SAMPLE_WINDOWS = 4
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
UNKNOWN = "und"
#: Windows scored at a time, few enough for the processor's caches.
SCORED = 64


def folded(data: np.ndarray) -> np.ndarray:
    """ASCII capitals as small letters, digits and signs as blanks."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    letter = np.zeros(256, bool)
    letter[97:123] = letter[65:91] = letter[128:] = True
    table[~letter] = 32
    return table[data]


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows of ``WINDOW`` folded bytes, text index): all of every text, the last window filled with blanks."""
    length = np.diff(offsets)
    count = -(-length // WINDOW)
    out = np.full((int(count.sum()), WINDOW), 32, np.uint8)
    text = np.repeat(np.arange(len(length)), count)
    first = np.cumsum(count) - count
    shift = np.repeat(first * WINDOW - offsets[:-1], length)
    out.reshape(-1)[np.arange(len(data)) + shift] = folded(data)
    return out, text


@dataclass
class Network:
    """Trained weights: embedding, filters by width, softmax layer."""
    languages: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]  # width x EMBEDDING x FILTERS
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def fresh(cls, languages: list[str], seed: int = 0) -> Network:
        rng = np.random.default_rng(seed)
        make = lambda *shape: (rng.standard_normal(shape) / np.sqrt(np.prod(shape[:-1]))).astype(np.float32)
        return cls(languages, rng.standard_normal((256, EMBEDDING)).astype(np.float32), [make(w, EMBEDDING, FILTERS) for w in WIDTHS],
                   [np.zeros(FILTERS, np.float32) for _ in WIDTHS], make(FILTERS * len(WIDTHS), len(languages)),
                   np.zeros(len(languages), np.float32))

    def tables(self) -> list[list[np.ndarray]]:
        """Responses of each filter to single bytes and to pairs of bytes, so that a width takes one gather for each pair."""
        made = []
        for f in self.filters:
            single = [self.embedding @ f[j] for j in range(len(f))]
            pairs = [(single[j][:, None] + single[j + 1][None, :]).reshape(65536, -1) for j in range(0, len(f) - 1, 2)]
            made.append(pairs + ([single[-1]] if len(f) % 2 else []))
        return made

    def responses(self, x: np.ndarray, tables=None) -> list[np.ndarray]:
        """For each width: windows x places x filters."""
        tables = tables or self.tables()
        pair = (x[:, :-1].astype(np.int32) << 8) | x[:, 1:]
        got = []
        for width, parts in zip(WIDTHS, tables):
            n = WINDOW - width + 1
            total = None
            for j, t in enumerate(parts):
                place = pair[:, 2 * j:2 * j + n] if len(t) == 65536 else x[:, 2 * j:2 * j + n]
                r = t[place]
                total = r if total is None else np.add(total, r, out=total)
            got.append(total)
        return got

    def hidden(self, x: np.ndarray, tables=None) -> np.ndarray:
        return np.concatenate([np.maximum(r.max(axis=1) + b, 0) for r, b in zip(self.responses(x, tables), self.bias)], axis=1)

    def probabilities(self, x: np.ndarray, tables=None) -> np.ndarray:
        z = self.hidden(x, tables) @ self.out + self.out_bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 4, batch: int = 64, rate: float = 0.01, seed: int = 0) -> Network:
        """Adam on the cross entropy; only the place of a filter's largest response gets its gradient."""
        rng = np.random.default_rng(seed)
        weights = [self.embedding, self.out, self.out_bias, *self.filters, *self.bias]
        moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), batch):
                xb, yb = x[order[at:at + batch]], y[order[at:at + batch]]
                responses = self.responses(xb)
                places = [r.argmax(axis=1) for r in responses]
                tops = [np.take_along_axis(r, p[:, None, :], 1)[:, 0] + b for r, p, b in zip(responses, places, self.bias)]
                hidden = np.maximum(np.concatenate(tops, axis=1), 0)
                z = hidden @ self.out + self.out_bias
                p = np.exp(z - z.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                p[np.arange(len(yb)), yb] -= 1
                p /= len(yb)
                back = (p @ self.out.T) * (hidden > 0)
                to_embedding = np.zeros_like(self.embedding)
                to_filters, to_bias = [], []
                for k, width in enumerate(WIDTHS):
                    g = back[:, k * FILTERS:(k + 1) * FILTERS]
                    gf = np.zeros_like(self.filters[k])
                    for j in range(width):
                        byte = np.take_along_axis(xb, places[k] + j, 1)
                        gf[j] = np.einsum("bf,bfe->ef", g, self.embedding[byte])
                        np.add.at(to_embedding, byte.reshape(-1), (g[:, :, None] * self.filters[k][j].T[None]).reshape(-1, EMBEDDING))
                    to_filters.append(gf)
                    to_bias.append(g.sum(axis=0))
                step += 1
                for w, (m, v), g in zip(weights, moments, [to_embedding, hidden.T @ p, p.sum(axis=0), *to_filters, *to_bias]):
                    m *= 0.9
                    m += 0.1 * g
                    v *= 0.999
                    v += 0.001 * g * g
                    w -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        return self

    def predict(self, column, tables=None) -> tuple[list[str], np.ndarray]:
        """Language and its probability for every text of a column."""
        data, offsets = text_buffers(column)
        x, text = windows(data, offsets)
        n = len(offsets) - 1
        letters = (x != 32).sum(axis=1).astype(float)
        has = has_letter(data, offsets)
        total = np.zeros((n, max(len(self.languages), 1)))
        if self.languages:
            tables = tables or self.tables()
            for at in range(0, len(x), SCORED):
                part = slice(at, at + SCORED)
                p = self.probabilities(x[part], tables) * letters[part, None]
                for k in range(total.shape[1]):
                    total[:, k] += np.bincount(text[part], weights=p[:, k], minlength=n)
        weight = np.bincount(text, weights=letters, minlength=n)
        known = has & (weight > 0) & bool(self.languages)
        total /= np.maximum(weight, 1)[:, None]
        best = total.argmax(axis=1)
        names = [self.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
        return names, np.where(known, np.clip(total.max(axis=1), 0, 1), 0.0)


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text has a letter, by Unicode for those without an ASCII letter."""
    ascii_letter = ((data | 32) >= 97) & ((data | 32) <= 122)
    run = np.concatenate([[0], np.cumsum(ascii_letter)])
    found = run[offsets[1:]] > run[offsets[:-1]]
    for i in np.flatnonzero(~found & (np.diff(offsets) > 0)):
        found[i] = any(c.isalpha() for c in data[offsets[i]:offsets[i + 1]].tobytes().decode("utf-8", "replace"))
    return found


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample_texts: int = SAMPLE_TEXTS,
        seed: int = 0) -> Network:
    """Network of the languages found in ``lang``, from an equal bounded sample of each, drawn by a hash of the id."""
    bounded_batches(docs.sparkSession)
    known = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    known = known.filter(F.col("lang").isNotNull() & F.col("__id").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return Network.fresh([], seed)
    each = max(1, sample_texts // len(languages))
    # twice the wished share by hash; the rest is cut by rank below, where few rows are left
    limits = {k: min(2 ** 31 - 1, int(2 ** 31 * min(1.0, 2 * each / n))) for k, n in counts.items()}
    share = F.create_map([F.lit(v) for kv in limits.items() for v in kv])
    drawn = known.withColumn("h", F.xxhash64("__id")).filter(F.pmod(F.col("h"), F.lit(2 ** 31)) <= share[F.col("lang")])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            x, of_text = windows(*text_buffers(part.column("text")))
            ids, langs = part.column("h").to_pylist(), part.column("lang").to_pylist()
            rows = []
            for i in range(part.num_rows):
                mine = np.flatnonzero(of_text == i)
                mine = mine[(x[mine] != 32).sum(axis=1) >= WINDOW // 8] if len(mine) > 1 else mine
                picked = np.random.default_rng(abs(ids[i])).permutation(mine)[:SAMPLE_WINDOWS]
                rows.append((langs[i], ids[i], x[picked].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.binary()))],
                                             names=["lang", "h", "windows"])

    cuts = drawn.select("lang", "h", "text").mapInArrow(cut, "lang string, h long, windows binary")
    order = Window.partitionBy("lang").orderBy("h", "windows")
    rows = cuts.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= each).orderBy("lang", "r").collect()
    x = np.concatenate([np.frombuffer(r["windows"], np.uint8).reshape(-1, WINDOW) for r in rows])
    y = np.concatenate([np.full(len(r["windows"]) // WINDOW, languages.index(r["lang"])) for r in rows])
    return Network.fresh(languages, seed).train(x, y, seed=seed)


def predict(docs: DataFrame, network: Network, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """``keep`` columns (default doc_id), lang_pred and score of every whole text."""
    bounded_batches(docs.sparkSession)
    keep = keep or ["doc_id"]
    names = [*keep, "lang_pred", "score"]
    if len(set(names)) < len(names):
        raise ValueError("the outputs' names are among the kept columns")
    source = docs.select(*keep, F.col(text).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = network.tables() if network.languages else None
        for part in slices(batches, "__text"):
            lang, score = network.predict(part.column("__text"), tables)
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(lang, pa.string()), pa.array(score)], names=names)

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]] + ["lang_pred string", "score double"])
    return source.mapInArrow(run, schema)
