"""Window removal against brute force, SQL and hand-made cases."""

import hashlib
import random
import re

import duckdb
import pytest

from cartwheel.llm import substrings
from cartwheel.llm.queries import ORACLES, op3_substrings
from tests.conftest import SF001, SF01


def brute(rows, window):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    least = {}
    for i, w in words:
        for p in range(len(w) - window + 1):
            if i is not None:
                k = tuple(w[p:p + window])
                least[k] = min(least.get(k, i), i)
    out = []
    for i, w in words:
        gone = set()
        for p in range(len(w) - window + 1):
            if i is not None and least[tuple(w[p:p + window])] < i:
                gone |= set(range(p, p + window))
        out.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return sorted(out, key=repr)


def test_cover_aligns_every_pair_of_places():
    d = {(a - b) % substrings.PERIOD for a in substrings.COVER for b in substrings.COVER}
    assert d == set(range(substrings.PERIOD))


@pytest.mark.parametrize("packed,bucket_bytes", [(500_000, 1 << 24), (300, 500)])
def test_random_texts_equal_brute_force(spark, packed, bucket_bytes, monkeypatch):
    monkeypatch.setattr(substrings, "PACKED_HASHES", packed)
    monkeypatch.setattr(substrings, "BUCKET_BYTES", bucket_bytes)
    rng = random.Random(7)
    passages = [[rng.choice("abcdefgh") + rng.choice("xyzé") for _ in range(rng.randrange(8, 40))] for _ in range(6)]
    rows = []
    for i in range(120):
        w = []
        while rng.random() < 0.8:
            w += [rng.choice("abcdefgh") + rng.choice("xyzé") for _ in range(rng.randrange(0, 9))] + rng.choice(passages)[rng.randrange(0, 4):]
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(w), "c"))
    rows += [(200, "same " * 60, "c"), (201, "same " * 40, "c"), (202, None, "c"), (203, "", "c"), (5, rows[9][1], "c"), (5, rows[9][1], "c"),
             (None, rows[3][1], "c"), (-4, rows[50][1], "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    got = substrings.remove_repeats(df)
    assert sorted([tuple(r)[:4] for r in got.collect()], key=repr) == brute([r[:2] for r in rows], 13)
    for r in got.collect():
        assert sum(s.end - s.first for s in r.spans) == r.n_removed
    assert substrings.remove_repeats(df.limit(0)).collect() == []


def test_two_texts_under_one_id_with_the_earlier_document_elsewhere(spark):
    passage = " ".join(f"w{k}" for k in range(30))
    rows = [(1, f"first {passage}"), (7, f"one {passage} tail"), (7, f"{passage} another"), (7, f"x y z {passage}"), (7, f"one {passage} tail"), (9, f"{passage} last")]
    parts = [rows[:1], rows[1:5], rows[5:]]
    df = spark.createDataFrame(spark.sparkContext.parallelize([p for p in parts], 3).flatMap(lambda p: p), "doc_id long, text string")
    assert df.rdd.glom().map(len).collect() == [1, 4, 1]
    got = substrings.remove_repeats(df).collect()
    assert sorted([tuple(r)[:4] for r in got], key=repr) == brute(rows, 13)


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    rel = con.sql(ORACLES["op3_substrings"])
    df = op3_substrings(spark, sf)
    assert df.columns == rel.columns
    assert sorted(map(tuple, df.collect())) == sorted(rel.fetchall())


def test_digest(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    want = {i: (n, g, hashlib.sha256(k.encode()).hexdigest()) for i, n, g, k in brute(docs, 13)}
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in op3_substrings(spark, SF001).collect()} == want
