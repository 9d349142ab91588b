"""Licence scan: a trained paragraph classifier, confirmed against templates, in DataFrame functions only.

A paragraph is what stands between blank lines; lines that hold nothing but
comment marks are blank, and the marks and line breaks inside a paragraph
are no words, so wrapped and commented notices read as they were written.
Every paragraph is read whole, in overlapping windows of ``WINDOW`` words that
start every ``STEP`` words.  A multinomial logistic regression on sparse word
n-grams gives each window a licence family or ``unknown``; its probabilities
are calibrated by a temperature, and the least probability that counts is set
on held-out windows so that at most ``FALSE_ALARMS`` of the unknown ones pass,
unless more than ``MISSED`` of the notices would fail.
A prediction is confirmed when the window shares enough n-grams with one of
the family's templates.  A paragraph's result for a family is its best window.

The model is trained on the driver from the templates (whole, thinned, and
standing among words of the corpus, cut into windows as texts are) and from a
bounded sample of corpus windows as the unknown class.  Scoring takes no join
and no shuffle: n-grams meet the templates' vocabulary, a constant.  Windows without any word that carries
weight are unknown by the model's bias.  Only windows that are told meet in a
shuffle, by their text and paragraph.

Defined cases: null and empty texts have no paragraphs; paragraphs of
unknown family give no row; equal probabilities go to the first family in
alphabetical order and to the earlier window; repeated rows give repeated
results; an empty table gives an empty result; other columns are ignored.
Kept columns must be of a type that can be grouped.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Notices and characteristic paragraphs of public licences.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions "
        "and limitations under the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
        "the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ],
    "BSD": [
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "LGPL": [
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "AGPL": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        "above copyright notice and this permission notice appear in all copies.",
        "Released under the ISC License.",
        "SPDX-License-Identifier: ISC",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "https://creativecommons.org/licenses/by/4.0/",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "https://creativecommons.org/licenses/by-sa/4.0/",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "https://creativecommons.org/licenses/by-nc/4.0/",
    ],
    "CC0": [
        "Released under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "https://creativecommons.org/publicdomain/zero/1.0/",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means.",
        "SPDX-License-Identifier: Unlicense",
    ],
    "Proprietary": [
        "Copyright. All rights reserved.",
        "All rights reserved.",
        "This software is confidential and proprietary. Unauthorized copying, use or distribution of this file, via any medium, is strictly prohibited.",
    ],
}
# Paragraphs that speak of the same things and grant nothing.
LOOKALIKES = [
    "The Apache people have lived in the south west for centuries.", "His driving license was taken away for a year.", "The plate number and licence of the van were noted.",
    "She studied at MIT before she moved to the coast.", "The new version of the software is faster than the old one.", "Permission to enter was granted at the gate.",
    "A copy of the letter was sent to the public library.", "The general public is invited to see the work.", "The rights of the people were reserved to the states.",
    "Free software and free beer are different things.", "The foundation published a report on commercial use of the land.", "The court set the following conditions for his release.",
    "He released the ball under pressure.", "The terms of the contract are subject to change.", "Fee and charge are due on the first of the month.",
    "The author of this book holds a licence to fly.", "Creative people in common rooms share ideas.", "The source of the river was found by chance.",
]

TOKEN = r"[a-z0-9]+(?:\.[0-9]+)*"
#: Between two paragraphs: a blank line, or lines of comment marks only.
BREAK = r"\n[ \t\r\n#*/;%!<>-]*\n"
UNKNOWN = "unknown"
#: Words of a window, and from one window's start to the next.
WINDOW, STEP = 32, 16
#: Corpus documents whose windows teach the unknown class, and windows taken of them, at most.
SAMPLE_DOCUMENTS, SAMPLE_WINDOWS = 300, 3_000
#: Share of unknown held-out windows that may pass the threshold.
FALSE_ALARMS = 0.005
#: Share of held-out notices that the threshold may cost; it comes before ``FALSE_ALARMS``, as corpus windows may hold parts of notices.
MISSED = 0.02
#: Share of the shorter side's n-grams that a confirming template has in common with the window.
CONFIRMING = 0.5
#: N-grams in common with it, at least.
CONFIRMING_GRAMS = 3
#: A word in more than this share of the sampled unknown windows carries no weight.
COMMON = 0.01
#: Decimals of a probability.
DIGITS = 9


def tokens(text: str) -> list[str]:
    return re.findall(TOKEN, text.lower())


def ngrams(words: list[str]) -> list[str]:
    """Distinct words and word pairs."""
    return list(dict.fromkeys([*words, *[f"{a} {b}" for a, b in zip(words, words[1:])]]))


def paragraphs(text: str) -> list[str]:
    return re.split(BREAK, text)


def windows(words: list[str]) -> list[tuple[int, list[str]]]:
    """First word's place and words of every window."""
    return [(s, words[s:s + WINDOW]) for s in range(0, max(len(words) - STEP, 1), STEP)]


@dataclass
class Model:
    families: list[str]  # without unknown, which is the last class of the weights
    vocabulary: dict[str, int]
    words: list[str]  # single words that carry weight, alone or in a pair
    weights: np.ndarray  # n-grams x classes, divided by the temperature
    bias: np.ndarray
    threshold: float

    def probabilities(self, grams: list[str]) -> np.ndarray:
        """Classes' probabilities of a paragraph; the plain form of what ``scan`` does in columns."""
        z = self.bias + sum((self.weights[self.vocabulary[g]] for g in grams if g in self.vocabulary), np.zeros(len(self.bias))) / np.sqrt(max(1, len(grams)))
        z = np.exp(z - z.max())
        return z / z.sum()


def _variants(rng: np.random.Generator, text: str, background: list[str], n: int) -> list[list[str]]:
    """Windows that hold the template's words: alone, thinned, and among words of the corpus."""
    words = tokens(text)
    out = [w for _, w in windows(words)]
    for _ in range(n):
        own = np.array([len(words) <= 8 or rng.random() > 0.05 for _ in words])
        kept = [w for w, k in zip(words, own) if k]
        before, after = ([background[i] for i in rng.integers(0, len(background), rng.integers(0, 2 * WINDOW))] if background else [] for _ in range(2))
        stretch = [*before, *kept, *after]
        for start, w in windows(stretch):
            held = min(start + len(w), len(before) + len(kept)) - max(start, len(before))
            if held >= min(len(kept), STEP):  # of any notice at least one window holds that much
                out.append(w)
    return out


def train(unknown: list[str], seed: int = 0) -> Model:
    """Fitted on the templates' variants and on unknown windows (those that share n-grams as a confirmed notice does are left out)."""
    rng = np.random.default_rng(seed)
    families = sorted(TEMPLATES)
    grams_of = {f: [set(ngrams(tokens(t))) for t in TEMPLATES[f]] for f in families}
    every = [g for f in families for g in grams_of[f]]
    plain = [tokens(p) for p in dict.fromkeys(unknown)]
    plain = [w for w in plain if w and not any(len(both) >= CONFIRMING_GRAMS and len(both) >= CONFIRMING * min(len(g), len(ngrams(w)))
                                               for g in every for both in [g & set(ngrams(w))])]
    background = [x for w in plain for x in w]
    share: dict[str, int] = {}
    for w in plain:
        for x in set(w):
            share[x] = share.get(x, 0) + 1
    common = {x for x, n in share.items() if n > max(1, COMMON * len(plain))} | {"the", "a", "an", "of", "and", "or", "to", "in", "is", "it", "by", "this", "that", "for", "with", "on", "at", "as", "be", "not", "are", "all", "any", "you", "may", "can"}
    words = sorted({x for f in families for t in TEMPLATES[f] for x in tokens(t)} - common)
    known = set(words)
    vocabulary = {g: i for i, g in enumerate(sorted(g for g in set().union(*every) if set(g.split()) & known))}
    rows, labels = [], []
    for k, f in enumerate(families):
        for t in TEMPLATES[f]:
            made = _variants(rng, t, background, 24)
            rows += made
            labels += [k] * len(made)
    others = [*plain, *[tokens(t) for t in LOOKALIKES for _ in range(8)]]
    scraps = []  # template words out of order grant nothing
    for f in families:
        for t in TEMPLATES[f]:
            w = tokens(t)
            scraps += [list(rng.permutation(w))[:max(2, len(w) // 4)] for _ in range(3)]
    rows += others + scraps
    labels += [len(families)] * (len(others) + len(scraps))
    y = np.array(labels)
    x = np.zeros((len(rows), len(vocabulary)), np.float32)
    for i, w in enumerate(rows):
        g = ngrams(w)
        x[i, [vocabulary[a] for a in g if a in vocabulary]] = 1 / np.sqrt(max(1, len(g)))
    held = rng.random(len(rows)) < 0.2
    weights, bias = _regress(x[~held], y[~held], len(families) + 1)
    z = x[held] @ weights + bias
    temperature = min((_loss(z / t, y[held]), t) for t in np.geomspace(0.25, 4, 33))[1]
    p = _softmax(z / temperature)
    alarms = np.sort(p[y[held] == len(families), :-1].max(axis=1))
    notices = p[y[held] < len(families), :-1].max(axis=1)
    alarm = alarms[min(len(alarms) - 1, int(np.ceil(len(alarms) * (1 - FALSE_ALARMS))) - 1)] if len(alarms) else 0.5
    threshold = float(max(0.5, min(alarm, np.quantile(notices, MISSED) if len(notices) else 1.0)))
    weights, bias = _regress(x, y, len(families) + 1)
    bias[-1] = max(bias[-1], bias[:-1].max())  # a paragraph without a weighted word is unknown
    return Model(families, vocabulary, words, weights / temperature, bias / temperature, threshold)


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def _loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(-np.log(_softmax(z)[np.arange(len(y)), y] + 1e-12).mean())


def _regress(x: np.ndarray, y: np.ndarray, classes: int, steps: int = 150, rate: float = 0.3, shrink: float = 1e-5) -> tuple[np.ndarray, np.ndarray]:
    """Multinomial logistic regression with a soft threshold on the weights (sparse), by Adam; classes weigh alike."""
    w, b = np.zeros((x.shape[1], classes)), np.zeros(classes)
    balance = (len(y) / classes / np.maximum(np.bincount(y, minlength=classes), 1))[y][:, None]
    balance = np.sqrt(balance)
    target = np.eye(classes)[y]
    m, v = [np.zeros_like(w), np.zeros_like(b)], [np.zeros_like(w), np.zeros_like(b)]
    for step in range(1, steps + 1):
        g = (_softmax(x @ w + b) - target) * balance / len(y)
        for i, (a, d) in enumerate(((w, x.T @ g), (b, g.sum(axis=0)))):
            m[i] = 0.9 * m[i] + 0.1 * d
            v[i] = 0.99 * v[i] + 0.01 * d * d
            a -= rate * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.99 ** step)) + 1e-9)
        w[:] = np.sign(w) * np.maximum(np.abs(w) - shrink * rate, 0)
    return w, b


def _once(value: Column) -> Column:
    """The value itself; filters on it stay above, so that it is not computed again in them, nor for rows that earlier filters drop."""
    return F.explode(F.array(value))


def _windows(texts: DataFrame, keep: list[str], text: str, words_of: list[str] | None = None) -> DataFrame:
    """Rows of ``keep``, paragraph, word (the window's first) and __w (its words); with ``words_of`` only windows that hold one of those."""
    def some(words: str) -> Column:
        return F.lit(True) if words_of is None else F.arrays_overlap(words, F.split(F.lit(" ".join(words_of)), " "))

    cut = texts.select(*keep, F.posexplode(F.split(text, BREAK)).alias("paragraph", "__p"))
    words = cut.select(*keep, "paragraph", _once(F.regexp_extract_all(F.lower("__p"), F.lit(TOKEN), F.lit(0))).alias("__a")).filter(some("__a"))
    n = F.size("__a")
    # words are fetched one by one: a slice copies the whole array first, which is square in the length of a text
    cut_at = lambda s: F.transform(F.sequence(s, F.least(s + WINDOW, n) - 1), lambda i: F.get("__a", i))
    one = F.array(F.struct(F.lit(0).alias("word"), F.col("__a").alias("w")))
    each = F.when(n <= WINDOW, one).otherwise(F.transform(F.sequence(F.lit(0), n - STEP - 1, F.lit(STEP)), lambda s: F.struct(s.alias("word"), cut_at(s).alias("w"))))
    return (words.select(*keep, "paragraph", F.explode(each).alias("__x")).select(*keep, "paragraph", "__x.word", F.col("__x.w").alias("__w"))
            .filter(F.size("__w") > 0).filter(some("__w")))


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = 0) -> Model:
    """Model with unknown windows from at most ``SAMPLE_DOCUMENTS`` whole documents, drawn by a hash of id and text."""
    known = docs.select(F.col(doc_id).alias("i"), F.col(text).alias("t")).filter("t is not null")
    # about twice the sample by a hash, so that few texts meet where it is cut to size
    share = min(1.0, 2 * SAMPLE_DOCUMENTS / max(1, docs.count()))
    drawn = (known.withColumn("h", F.pmod(F.xxhash64("i", "t"), F.lit(2 ** 31))).filter(F.col("h") <= int(2 ** 31 * share))
             .orderBy("h", "i").limit(SAMPLE_DOCUMENTS))
    cut = _windows(drawn, [], "t").select(F.concat_ws(" ", "__w").alias("p")).orderBy(F.xxhash64("p"), "p").limit(SAMPLE_WINDOWS)
    return train([r["p"] for r in cut.collect()], seed)


def _constant(value, kind: str) -> Column:
    """A constant of a nested type; Spark's optimizer folds it to a literal."""
    return F.from_json(F.lit(json.dumps({"v": value})), f"v {kind}")["v"]


def _ngrams(words: Column) -> Column:
    n = F.size(words)
    pairs = F.zip_with(F.slice(words, 1, F.greatest(n - 1, F.lit(0))), F.slice(words, 2, F.greatest(n - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(F.concat(words, pairs))


def scan(docs: DataFrame, model: Model, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """One row for each paragraph and licence family told in it, by its best window.

    ``keep`` columns (default doc_id), paragraph (from 0), family, word (the
    first of the window, from 0), probability, template (its place in the
    family's list), share (of n-grams in common with it) and confirmed.
    """
    keep = keep or ["doc_id"]
    outputs = ["paragraph", "family", "word", "probability", "template", "share", "confirmed"]
    if set(keep) & set(outputs):
        raise ValueError("the outputs' names are among the kept columns")
    classes = len(model.families) + 1
    kept = [f"__k{i}" for i in range(len(keep))]
    # a text is known by two hashes, so that rows that share the kept columns stay apart
    source = docs.select(*[F.col(c).alias(k) for c, k in zip(keep, kept)], F.col(text).alias("__t")).withColumn("__h", F.xxhash64("__t")) \
        .withColumn("__i", F.xxhash64(F.lit(1), "__t"))
    key = [*kept, "__h", "__i", "paragraph"]
    some = _windows(source, [*kept, "__h", "__i"], "__t", model.words).select(*key, "word", _once(_ngrams(F.col("__w"))).alias("__g"))
    weights = _constant([w.tolist() for w in model.weights], "array<array<double>>")
    vocabulary = _constant(list(model.vocabulary), "array<string>")  # in the order of the weights
    known = F.transform(F.array_intersect("__g", vocabulary), lambda g: (F.array_position(vocabulary, g) - 1).cast("int"))
    some = some.withColumn("__v", known).filter(F.size("__v") > 0)
    nothing = F.array(*[F.lit(0.0)] * classes)
    sums = F.aggregate("__v", nothing, lambda a, v: F.zip_with(a, F.get(weights, v), lambda x, y: x + y))
    bias = F.array(*[F.lit(float(b)) for b in model.bias])
    scored = some.withColumn("__z", F.zip_with(bias, sums, lambda b, x: b + x / F.sqrt(F.size("__g"))))
    scored = scored.withColumn("__e", F.transform("__z", lambda z: F.exp(z - F.array_max("__z"))))
    total = F.aggregate("__e", F.lit(0.0), lambda a, b: a + b)
    highest = F.array_max(F.slice("__e", 1, classes - 1))
    scored = scored.withColumn("probability", F.round(highest / total, DIGITS)).withColumn("__f", (F.array_position("__e", highest) - 1).cast("int"))
    told = scored.filter(F.col("probability") >= model.threshold).select(*key, "word", "__g", "__f", "probability")
    templates = _constant([[{"t": -t, "g": ngrams(tokens(x))} for t, x in enumerate(TEMPLATES[f])] for f in model.families],
                          "array<array<struct<t:int,g:array<string>>>>")
    both = lambda t: F.size(F.array_intersect("__g", t["g"]))
    shares = F.transform(F.get(templates, F.col("__f")), lambda t: F.struct(
        (both(t) / F.least(F.size(t["g"]), F.size("__g"))).alias("share"), t["t"].alias("t"), both(t).alias("both")))
    told = told.withColumn("__b", F.array_max(shares))
    confirmed = (F.col("__b.share") >= CONFIRMING) & (F.col("__b.both") >= CONFIRMING_GRAMS)
    told = told.select(*key, "word", "__f", F.struct(confirmed.alias("confirmed"), "probability", (-F.col("word")).alias("before"),
                                                     F.col("__b.share").alias("share"), F.col("__b.t").alias("t")).alias("__b"))
    # rows that repeat have equal windows: the best one counts them
    best = (told.groupBy(*key, "__f", "word").agg(F.max("__b").alias("__b"), F.count(F.lit(1)).alias("__n"))
            .groupBy(*key, "__f").agg(F.max(F.struct("__b", "__n")).alias("__m"))
            .select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__m.__n")))))
    names, found = F.array(*[F.lit(f) for f in model.families]), F.col("__m.__b")
    return best.select(*[F.col(k).alias(c) for k, c in zip(kept, keep)], "paragraph", names[F.col("__f")].alias("family"),
                       (-found["before"]).alias("word"), found["probability"].alias("probability"),
                       F.when(found["share"] > 0, -found["t"]).alias("template"), found["share"].alias("share"), found["confirmed"].alias("confirmed"))
