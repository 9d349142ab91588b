"""Alignment against plain token offsets, sparse products against dense ones."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from cartwheel.llm import alignment
from cartwheel.llm.alignment import Csr
from cartwheel.llm.bpe import byte_chars, read_vocabulary
from cartwheel.llm.queries import model_path, op13_alignment, vocabulary_path
from tests.conftest import SF001


@pytest.fixture(scope="module")
def files():
    return read_vocabulary(vocabulary_path()), alignment.read_model(model_path())


class Plain:
    """Tokens with their byte ranges, pair by pair."""

    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(vocabulary_path())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=model_path())
        self.byte = {c: i for i, c in enumerate(byte_chars())}

    def ranges(self, raw):
        out, at = [], 0
        for i, b in raw:
            out.append((i, at, at + len(b)))
            at += len(b)
        return out

    def tokens(self, text):
        if not text:
            return [], []
        a = [(i, bytes(self.byte[c] for c in self.a.id_to_token(i))) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            p = self.b.id_to_piece(i)
            b.append((i, bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            return [], []
        return self.ranges(a), self.ranges(b)

    def groups(self, a, b):
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        low, out = 0, []
        for c in cuts:
            out.append(",".join(str(i) for i, _, e in a if low < e <= c) + "|" + ",".join(str(i) for i, _, e in b if low < e <= c))
            low = c
        return out

    def rows(self, docs):
        held, counts = [], Counter()
        for key, text in docs:
            a, b = self.tokens(text)
            pairs = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]
            counts.update(set(pairs))
            held.append((key, a, b, pairs))
        best = defaultdict(int)
        for (i, _), n in counts.items():
            best[i] = max(best[i], n)
        for key, a, b, pairs in held:
            groups = self.groups(a, b)
            digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
            yield (key, len(a), len(b), len(groups), len(pairs), sum(counts[p] == best[p[0]] for p in pairs), sum(counts[p] for p in pairs), digest)


def answered(df):
    return [tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()]


TEXTS = ["The cat sat on the mat.", "", None, "naïve café — 東京 🙂🙂", "   leading and  double   blanks ", "tab\tand\nline\r\n\x00end", "a▁b",
         "<|endoftext|> and <s> </s> <0x41>", "x" * 700, "The cat sat on the mat.", "𝔘𝔫𝔦𝔠𝔬𝔡𝔢 ﬁ Å", " " * 50, "日本語のテキスト。", "▁", "one"]


def test_equals_plain_alignment(spark, files):
    docs = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "same id"), (None, "no id"), (None, None)]
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in docs], "doc_id long, text string, n_a int, `key` string").repartition(3)
    got = answered(alignment.align(df, *files))
    assert sorted(got, key=repr) == sorted(Plain().rows(docs), key=repr)
    by_text = dict(zip(TEXTS, range(len(TEXTS))))
    assert [r for r in got if r[0] == by_text["a▁b"]][0][1:] == (0, 0, 0, 0, 0, 0, "")


def test_small_packs_and_copies(spark, files, monkeypatch):
    monkeypatch.setattr(alignment, "PACK_PAIRS", 20)
    monkeypatch.setattr(alignment, "SLICE_BYTES", 200)
    docs = [(i, TEXTS[i % len(TEXTS)] if i % 3 else "the hot text that many rows hold") for i in range(120)]
    got = answered(alignment.align(spark.createDataFrame(docs, "doc_id long, text string"), *files))
    assert sorted(got) == sorted(Plain().rows(docs))


def test_query_on_the_small_tables(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    short = [d for d in docs if len(d[1] or "") < 3_000]
    got = {r[0]: r for r in answered(op13_alignment(spark, SF001))}
    assert len(got) == len(docs)
    for want in Plain().rows(short):  # the counts are corpus-wide, the rest is not
        assert got[want[0]][1:5] == want[1:5] and got[want[0]][7] == want[7]
    if len(short) == len(docs):
        assert sorted(got.values()) == sorted(Plain().rows(docs))


def test_links_and_groups_of_the_general_interface(spark, files):
    df = spark.createDataFrame([(1, "naïve café"), (2, None), (3, "東京 tower")], "doc_id long, text string")
    plain = Plain()
    for r in alignment.links(df, *files).collect():
        a, b = plain.tokens({1: "naïve café", 2: None, 3: "東京 tower"}[r.doc_id])
        assert r.ids_a == [i for i, _, _ in a] and r.ids_b == [i for i, _, _ in b]
        want = [(x, y, min(e, f) - max(s, t)) for x, (_, s, e) in enumerate(a) for y, (_, t, f) in enumerate(b) if s < f and t < e]
        assert list(zip(r.place_a, r.place_b, r.bytes)) == want
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        assert r.group == [sum(c < a[x][2] for c in cuts) for x in r.place_a]


def test_long_texts_and_empty_table(spark, files):
    long = "word and 東京 " * 40_000
    df = spark.createDataFrame([(1, long), (2, "^" * 300_000), (3, "a")], "doc_id long, text string")
    got = {r.doc_id: r for r in alignment.align(df, *files).collect()}
    both = alignment.Pair(*files)
    for i, text in ((1, long), (2, "^" * 300_000)):
        assert got[i].n_a == len(both.library.encode(" " + text, add_special_tokens=False).ids)
        assert got[i].n_b == len(both.pieces.encode(text))
    none = alignment.align(df.filter("doc_id > 9"), *files)
    assert none.count() == 0 and none.columns[0] == "doc_id"


def test_both_encoders_of_a_agree(files):
    both = alignment.Pair(*files)
    assert both.fast is not None
    for t in [x for x in TEXTS if x]:
        assert both.fast.encode_ordinary(" " + t) == both.library.encode(" " + t, add_special_tokens=False).ids


def dense(m):
    out = np.zeros((len(m.start) - 1, m.columns), np.int64)
    np.add.at(out, (m.rows(), m.column), m.value)
    return out


def sparse(x):
    r, c = np.nonzero(x)
    return Csr(np.searchsorted(r, np.arange(len(x) + 1)), c, x[r, c], x.shape[1])


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 8), st.integers(1, 8), st.integers(0, 8), st.integers(0, 10_000))
def test_gustavson_equals_dense_products(n, m, k, seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, 3, (n, m)), rng.integers(0, 3, (m, k))
    assert np.array_equal(dense(sparse(a) @ sparse(b)), a @ b)
    assert np.array_equal(dense(sparse(a).transposed()), a.T)
    assert np.array_equal(sparse(a) * np.arange(m), a @ np.arange(m))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=12), st.integers(0, 10_000))
def test_shared_links_are_the_tokens_of_a_group(lengths, seed):
    rng = np.random.default_rng(seed)
    total, a = sum(lengths), np.array(lengths)
    edges = np.unique(np.append(rng.integers(1, total + 1, 5), total))
    b = np.diff(np.concatenate([[0], edges]))
    al = alignment.Aligned(np.arange(len(a)), np.arange(len(b)), a, b, np.array([0, len(a)]), np.array([0, len(b)]))
    cuts = sorted(set(np.cumsum(a)) & set(np.cumsum(b)))
    ga, gb = np.searchsorted(cuts, np.cumsum(a)), np.searchsorted(cuts, np.cumsum(b))
    want = (ga[:, None] == gb[None, :]).astype(np.int64)
    assert np.array_equal(dense(al.shared_links()), want) and np.array_equal(al.shared(), want.sum(axis=1))
