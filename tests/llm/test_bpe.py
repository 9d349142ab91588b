"""Forced-boundary BPE against the tokenizers library."""

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from cartwheel.llm import bpe
from cartwheel.llm.queries import op9_bpe, vocabulary_path
from tests.conftest import SF001


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.read_vocabulary(vocabulary_path())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path())


def test_fuzzed_texts_equal_library(vocabulary, library):
    own = bpe.ByteBPE(vocabulary)
    rng = random.Random(5)
    chars = list("abcdeESTthe  \n\t'\r.,!?#1234-_éñüß日本語🙂") + [" ", " ", "\x1c", "\x85", "'s", "'ll", "<|endoftext|>", "́", "²", "Ⅷ"]
    for _ in range(3000):
        t = "".join(rng.choice(chars) for _ in range(rng.randrange(0, 40)))
        e = library.encode(t, add_special_tokens=False)
        assert own.encode(t) == e.ids, repr(t)
        assert own.decode(e.ids) == library.decode(e.ids, skip_special_tokens=False) == t


def test_every_code_point(vocabulary, library):
    own = bpe.ByteBPE(vocabulary)
    points = [c for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 64):
        t = " a".join(chr(c) for c in points[at:at + 64])
        assert own.encode(t) == library.encode(t, add_special_tokens=False).ids, hex(points[at])


def test_long_runs(vocabulary, library):
    own = bpe.ByteBPE(vocabulary)
    for t in ("a" * 50_000, " " * 10_001 + "x", "\n" * 999 + "z", "éa#" * 20_000, "q1z" * 9999):
        assert own.encode(t) == library.encode(t, add_special_tokens=False).ids


def test_edge_rows_and_clashing_columns(spark, vocabulary, library):
    rows = [(1, None, 9), (2, "", 9), (3, "Hello there", 9), (3, "Hello there", 9), (None, "x<|endoftext|>y", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = bpe.encode(df, vocabulary, outputs=["ids", "n_tokens", "decoded"]).collect()
    assert sorted((r.doc_id is None, r.doc_id, tuple(r.ids), r.n_tokens, r.decoded) for r in got if r.doc_id is not None) == sorted(
        (False, i, tuple(library.encode(t or "", add_special_tokens=False).ids), len(library.encode(t or "", add_special_tokens=False).ids), t or "")
        for i, t, _ in rows if i is not None)
    back = bpe.decode(bpe.encode(df, vocabulary), vocabulary).collect()
    assert sorted(r.decoded for r in back) == sorted(t or "" for _, t, _ in rows)
    with pytest.raises(ValueError):
        bpe.encode(df, vocabulary, keep=["n_tokens"], outputs=["n_tokens"])
    assert bpe.encode(df.limit(0), vocabulary).collect() == []


def test_query_digest(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    for r in op9_bpe(spark, SF001).collect():
        e = library.encode(docs[r.doc_id], add_special_tokens=False)
        assert r.n_tokens == len(e.ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, e.ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(e.ids, skip_special_tokens=False).encode()).hexdigest()


def merged(merges, ids):
    """Merges one pair at a time: the lowest rank, the leftmost of equals."""
    ids = list(ids)
    while True:
        ranks = [merges.rank_of.get((a << 32) | b, merges.none) for a, b in zip(ids, ids[1:])]
        if not ranks or min(ranks) == merges.none:
            return ids
        i = ranks.index(min(ranks))
        ids[i:i + 2] = [int(merges.made[ranks[i]])]


@pytest.mark.parametrize("seed", range(40))
def test_merges_equal_one_at_a_time(seed):
    rng = random.Random(seed)
    pairs, made, known = [], [], [0, 1, 2]
    for k in range(rng.randrange(0, 12)):  # ranks in any order, also pairs whose product merges earlier
        pairs.append((rng.choice(known), rng.choice(known)))
        made.append(3 + k)
        known.append(3 + k)
    order = rng.sample(range(len(pairs)), len(pairs))
    merges = bpe.Merges([pairs[i] for i in order], [made[i] for i in order])
    fragments = [[rng.randrange(3) for _ in range(rng.randrange(1, 30))] for _ in range(50)]
    edge = np.concatenate([[0], np.cumsum([len(f) for f in fragments])])
    ids, start = merges.together(np.concatenate(fragments), edge)
    want = [merged(merges, f) for f in fragments]
    assert [ids[a:b].tolist() for a, b in zip(start[:-1], start[1:])] == want
    assert [merges.alone(list(f)) for f in fragments] == want
