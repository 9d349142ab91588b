"""Features, trees, calibration and held-out quality of the toxicity operator."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from cartwheel.llm import toxicity
from cartwheel.llm.queries import op7_toxicity
SF1 = "/root/testdata/sf0.1"


def names(column, lexicon):
    x = toxicity.features(column, lexicon, toxicity._second_person())
    return [dict(zip(toxicity.FEATURES, r)) for r in x]


def test_features():
    word = toxicity.Plain(pa.array(["idiot"])).hashes[0]
    lexicon = toxicity.Lexicon(word, np.array([3.0]))
    column = pa.array(["You are an idiot", "an Id1ot!!", "i.d.i.o.t", "", "ALL CAPS sooo 12 34", "idio tidiots"])
    a, b, c, d, e, f = names(column, lexicon)
    assert a["hit_density"] == 1 / 4 and a["second_person"] == 1 / 4 and a["second_person_near"] == pytest.approx(1 - 3 / 9)
    assert b["hit_density"] == 1 / 2 and b["obfuscated"] == 1 / 2 and b["exclamations"] == 1
    assert c["hit_density"] == 1 and c["obfuscated"] == 1
    assert d["hit_density"] == 0 and d["log_words"] == 0
    assert e["capital_words"] == 2 / 5 and e["repeats"] == 1 / 5 and e["digits"] > 0 and e["hit_density"] == 0
    assert f["hit_density"] == 0


def test_trees_and_isotonic():
    rng = np.random.default_rng(1)
    x = rng.random((1500, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.7)).astype(float)
    model = toxicity.Trees(rounds=60).fit(x[:1000], y[:1000])
    assert ((model.margin(x[1000:]) > 0) == y[1000:]).mean() > 0.95
    at, rate = toxicity.isotonic(np.array([0.0, 1, 2, 3, 4, 5]), np.array([0, 1, 0, 1, 1, 1.0]))
    assert (np.diff(rate) >= 0).all() and np.interp(-9, at, rate) < 0.2 and np.interp(9, at, rate) > 0.9
    assert np.interp(1.5, at, rate) == pytest.approx(0.5)


def test_defined_cases(spark):
    docs = spark.createDataFrame([(1, "x y", 1.0), (2, None, 1.0), (2, None, 1.0), (None, "", 1.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert len(toxicity.score(docs, model).collect()) == 4
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, labels.filter("toxic = 1"))).collect()} == {1.0}
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, labels.limit(0))).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), model).collect() == []
    with pytest.raises(ValueError):
        toxicity.score(docs, model, keep=["score"])


def test_labels_of_absent_documents_take_no_place_in_the_sample(spark):
    docs = spark.createDataFrame([(i, f"some words {i}") for i in range(4)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(2000)], "doc_id long, toxic int")
    assert toxicity.fit(docs, labels, sample_rows=4).trees is not None


def test_rows_of_one_labelled_id_stay_within_the_sample(spark, monkeypatch):
    """Many texts under one labelled id, and many equal rows, fit no more than the stated number of rows."""
    docs = spark.createDataFrame([(i, f"some words {i}") for i in range(50)], "doc_id long, text string")
    docs = docs.union(spark.range(4000).selectExpr("7L", "concat('other words ', id % 2000)")).union(spark.range(3000).selectExpr("8L", "'equal rows'"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, toxic int")
    seen, fit = [], toxicity.Trees.fit
    monkeypatch.setattr(toxicity.Trees, "fit", lambda self, x, y: seen.append(len(y)) or fit(self, x, y))
    model = toxicity.fit(docs, labels, sample_rows=50)
    assert model.trees is None or max(seen) <= 50
    seen.clear()
    model = toxicity.fit(docs.filter("doc_id <> 7"), labels, sample_rows=100)
    assert max(seen) == 50  # 48 texts, two of id 8


@pytest.mark.parametrize("copied", [0, 1])
def test_a_third_of_copies_changes_no_lexicon(spark, copied):
    rng = np.random.default_rng(3)
    word = lambda n: " ".join("".join(rng.choice(list("abcdefghij"), 6)) for _ in range(n))
    rows = [(i, f"{word(12)} {'bad' + str(i // 2 % 20) + 'word' if i % 2 else 'fine'} {word(3)}", i % 2) for i in range(240)]
    half = lambda ids: {r.i: r.h for r in spark.createDataFrame([(i,) for i in ids], "i long").selectExpr("i", "pmod(xxhash64(i, 1), 2) h").collect()}
    of = half([*range(240), *range(1000, 1300)])
    copies = [(i, rows[copied][1], copied) for i in range(1000, 1300) if of[i] == of[copied]][:120]
    fitted = []
    for some in (rows, rows + copies):
        df = spark.createDataFrame(some, "doc_id long, text string, toxic int")
        fitted.append(toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic")).lexicon)
    assert len(copies) == 120 and len(fitted[0].keys) >= 20
    assert (fitted[0].keys == fitted[1].keys).all() and np.allclose(fitted[0].weights, fitted[1].weights)


def test_held_out_quality(spark):
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF1}/labels.parquet").collect()}
    rows = op7_toxicity(spark, SF1).collect()
    assert len(rows) == 10_000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(toxic[r.doc_id], r.score) for r in rows if r.held_out and r.doc_id in toxic]
    pairs = [(a > b) + 0.5 * (a == b) for y, a in held if y for z, b in held if not z]
    assert sum(pairs) / len(pairs) > 0.98
