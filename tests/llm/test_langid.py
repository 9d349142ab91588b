"""Windows, gradients, defined cases and held-out accuracy of the language network."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from cartwheel.llm import langid
from cartwheel.llm.queries import op4_langid
from cartwheel.llm.worker import text_buffers
from tests.conftest import SF01


def test_windows_hold_whole_texts():
    texts = ["a" * 600, None, "", "Bc1é", "x" * 256]
    x, text = langid.windows(*text_buffers(pa.array(texts)))
    assert text.tolist() == [0, 0, 0, 3, 4]
    got = ["".join(map(chr, [])) or x[text == i].tobytes().rstrip(b" ") for i in range(5)]
    assert got == [b"a" * 600, b"", b"", "bc é".encode(), b"x" * 256]


def test_responses_equal_plain_convolution():
    net = langid.Network.fresh(["a", "b"])
    x = np.random.default_rng(0).integers(0, 256, (3, langid.WINDOW)).astype(np.uint8)
    for r, f in zip(net.responses(x), net.filters):
        for place in (0, 7, r.shape[1] - 1):
            want = sum(net.embedding[x[:, place + j]] @ f[j] for j in range(len(f)))
            assert np.allclose(r[:, place], want, atol=1e-4)


def test_gradient_lowers_loss():
    rng = np.random.default_rng(1)
    x = rng.integers(97, 110, (200, langid.WINDOW)).astype(np.uint8)
    y = np.arange(200) % 2
    x[y == 1, 40:43] = [120, 121, 122]
    net = langid.Network.fresh(["a", "b"]).train(x, y, epochs=8)
    assert (net.probabilities(x).argmax(1) == y).mean() > 0.97


def test_defined_cases(spark):
    rows = [(1, "der die das und nicht", "de", 0.1), (2, "the and of with this", "en", 0.1), (3, None, "en", 0.1), (4, "123 !!", "en", 0.1),
            (5, "", None, 0.1), (6, "日本", None, 0.1), (2, "the and of with this", "en", 0.1), (None, "the", "en", 0.1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    net = langid.fit(df)
    assert net.languages == ["de", "en"]
    got = langid.predict(df, net).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.lang_pred, r.score) for r in got if r.doc_id in (3, 4, 5)} == {k: ("und", 0.0) for k in (3, 4, 5)}
    assert all(r.lang_pred in net.languages for r in got if r.doc_id in (1, 2, 6, None))
    none = langid.fit(df.filter("lang is null"))
    assert {(r.lang_pred, r.score) for r in langid.predict(df, none).collect()} == {("und", 0.0)}
    assert langid.predict(df.limit(0), net).collect() == []
    with pytest.raises(ValueError):
        langid.predict(df, net, keep=["score"])


def test_held_out_accuracy(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    rows = op4_langid(spark, SF01).collect()
    assert len(rows) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out and r.lang_pred != "und"]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.95
