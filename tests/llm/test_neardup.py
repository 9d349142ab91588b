"""Signatures, components and classes against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cartwheel.llm import neardup
from cartwheel.llm.components import components
from cartwheel.llm.queries import op6_neardup
from cartwheel.llm.words import Words
from cartwheel.llm.worker import text_buffers
from tests.conftest import SF001, SF01


def bag(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def similarity(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


class Union(dict):
    def find(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def link(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self[b] = a


def brute(rows, least=0.8):
    union, known = Union(), [(i, bag(t)) for i, t in rows if i is not None]
    for k, (i, a) in enumerate(known):
        for j, b in known[:k]:
            if a and b and min(sum(a.values()), sum(b.values())) >= least * max(sum(a.values()), sum(b.values())) and similarity(a, b) >= least:
                union.link(i, j)
    return {i: union.find(i) for i, _ in known}


def signed(texts, registers=neardup.REGISTERS):
    words = Words(*text_buffers(pa.array(texts)))
    return neardup.signatures(*neardup.bags(words), len(texts), registers)


def test_bags_count_shingles():
    texts = ["a b c d e f a b c d e f a b c d e", None, "x y", "x  y", "", "one"]
    words = Words(*text_buffers(pa.array(texts)))
    text, h, count = neardup.bags(words)
    assert [sorted(count[text == i].tolist()) for i in range(6)] == [sorted(bag(t).values()) for t in texts]
    assert h[text == 2].tolist() == h[text == 3].tolist()


@pytest.mark.parametrize("spread", [1, 3, 40])
def test_agreement_is_the_weighted_similarity(spread):
    rng = np.random.default_rng(spread)
    items = rng.integers(0, 2 ** 63, 60).astype(np.uint64)
    errors = []
    for _ in range(30):
        w = rng.integers(0, spread + 1, (2, 60))
        w[0, 0] = w[1, 0] = 1
        text, at = np.nonzero(w)
        times = neardup.signatures(text, rng.permutation(items)[at], w[text, at], 2, 512)
        errors.append((times[0] == times[1]).mean() - np.minimum(*w).sum() / np.maximum(*w).sum())
        items = rng.integers(0, 2 ** 63, 60).astype(np.uint64)
    assert abs(np.mean(errors)) < 0.012 and np.std(errors) < 0.04


def test_signature_does_not_depend_on_the_slice():
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcdefg") for _ in range(rng.choice([1, 3, 6, 40, 900]))) for _ in range(60)]
    together = signed(texts)
    for i in (0, 17, 59):
        assert np.array_equal(signed([texts[i]])[0], together[i])
    assert (together != 0).all() and (signed([""]) == 0).all()


def test_components(spark):
    rng = random.Random(9)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1060)] + [(5000, k) for k in range(5001, 5400)]
    union = Union()
    for a, b in links:
        union.link(a, b)
    got = {r.node: r["class"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: union.find(x) for x in union if any(x in e and e[0] != e[1] for e in links)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def make(rng, n):
    return [rng.choice("abcdefghijkl") + rng.choice("mnopqrstuv") + rng.choice("wxyzé") for _ in range(n)]


def near(rng, words, edits):
    w = list(words)
    for _ in range(edits):
        w[rng.randrange(len(w))] = make(rng, 1)[0]
    return w


@pytest.mark.parametrize("left,few,block", [(neardup.LEFT_PAIRS, neardup.FEW, neardup.BLOCK), (0, 0, 3)])
def test_classes_equal_brute_force(spark, left, few, block, monkeypatch):
    for name, value in (("LEFT_PAIRS", left), ("FEW", few), ("BLOCK", block)):
        monkeypatch.setattr(neardup, name, value)
    rng = random.Random(11)
    rows = []
    for _ in range(8):
        base = make(rng, rng.randrange(60, 200))
        rows += [" ".join(near(rng, base, rng.randrange(0, 6))) for _ in range(rng.randrange(2, 14))]
    rows += [" ".join(make(rng, 80)) for _ in range(40)] + ["short one"] * 3 + ["short two", "", "", None, None] + [rows[0]] * 30
    ids = rng.sample(range(10_000), len(rows))
    data = [(i, t, "c") for i, t in zip(ids, rows)] + [(ids[5], rows[5], "c"), (None, rows[0], "c"), (ids[-1], "another text under a known id", "c")]
    df = spark.createDataFrame(data, "doc_id long, text string, class_id string")
    got = neardup.classes(df).collect()
    assert len(got) == len(data) and {r.class_id for r in got if r.doc_id is None} == {None}
    union = Union()
    for i, c in brute([(i, t) for i, t, _ in data]).items():
        union.link(i, c)
    assert {r.doc_id: r.class_id for r in got if r.doc_id is not None} == {i: union.find(i) for i in ids}
    assert neardup.classes(df.limit(0)).collect() == []


def test_groups_of_unfit_sizes_end(spark):
    """Copies of a page with and without a long footer share bands, but no pair of them can be similar enough."""
    rng = random.Random(4)
    base, footer = make(rng, 400), make(rng, 112)
    rows = [" ".join(near(rng, base, 2)) for _ in range(14)] + [" ".join(near(rng, base, 2) + footer) for _ in range(14)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in neardup.classes(df).collect()}
    assert got == brute(list(enumerate(rows))) and len(set(got.values())) == 2


@pytest.mark.parametrize("block", [3, 512])
def test_a_dense_bucket_of_different_classes(spark, block, monkeypatch):
    """Many texts share a long passage and bands; only some of them are similar."""
    monkeypatch.setattr(neardup, "BLOCK", block)
    monkeypatch.setattr(neardup, "ROUNDS", 1)
    rng = random.Random(6)
    base = make(rng, 150)
    rows = [" ".join(base + make(rng, 45)) for _ in range(25)]
    rows += [" ".join(near(rng, r.split(), 1)) for r in rows[:12]]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in neardup.classes(df).collect()} == brute(list(enumerate(rows)))


def test_rows_that_share_an_id_keep_their_texts(spark):
    rng = random.Random(7)
    a, b, c = (" ".join(make(rng, 40)) for _ in range(3))
    rows = [(1, a, 0), (1, b, 0), (1, a, 0), (2, a, 0), (3, c, 0), (3, c, 1), (None, a, 0), (None, None, 0), (4, None, 0), (4, None, 0)]
    got = neardup.without_duplicates(spark.createDataFrame(rows, "doc_id long, text string, __id int")).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted([(1, a), (1, b), (3, c), (None, a), (None, None), (4, None)], key=repr)
    plain = neardup.without_duplicates(spark.createDataFrame([(1, a), (2, a), (3, b)], "doc_id long, text string"))
    assert sorted(r.doc_id for r in plain.collect()) == [1, 3]


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()]
    got = {r.doc_id: r.class_id for r in op6_neardup(spark, SF01).collect()}
    assert got == brute(docs)
    assert len(op6_neardup(spark, SF001).collect()) == 200
