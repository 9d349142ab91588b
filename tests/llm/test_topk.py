"""MaxScore against brute force."""

import math

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from cartwheel.llm import topk
from cartwheel.llm.queries import ORACLES, op1_maxscore
from tests.conftest import SF001, SF01


def brute(ids, x, query_id, q, k):
    scored = sorted((-int(sum(int(a) * int(b) for a, b in zip(q, r))), int(i)) for i, r in zip(ids, x) if i != query_id)
    return [(i, -s) for s, i in scored[:k]]


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 60), st.integers(1, 12), st.integers(1, 6), st.integers(0, 10_000), st.sampled_from([1, 3, 200]))
def test_shard_equals_brute_force(n, width, k, seed, spread):
    rng = np.random.default_rng(seed)
    x = rng.integers(-spread, spread + 1, (n, width)).astype(float)
    ids = rng.permutation(n)
    shard = topk.Shard(ids, x)
    for j in range(min(n, 5)):
        assert shard.best(int(ids[j]), x[j], k) == brute(ids, x, ids[j], x[j], k)


def test_pruned_sparse_shard():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 300, (3000, 40)) * (rng.random((3000, 40)) < 0.08)
    shard = topk.Shard(np.arange(3000), x.astype(float))
    for j in range(0, 3000, 300):
        assert shard.best(j, x[j].astype(float), 5) == brute(range(3000), x, j, x[j], 5)


def test_defined_cases(spark):
    rows = [(0, [1.0, 0.5], 1), (50, [-1.0, 2.0], 1), (1, [0.0, 1.0], 1), (2, [0.0, 1.0], 1), (2, [0.0, 1.0], 1), (3, None, 1), (4, [1.0, None], 1),
            (5, [math.nan, 1.0], 1), (6, [math.inf, 0.0], 1), (7, [2.0], 1), (None, [9.0, 9.0], 1), (8, [], 1), (9, [3e38, -3e38], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    got = {}
    for r in topk.top_k(df, lambda i: i % 50 == 0, k=4).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    big = topk.LIMIT
    assert got[0] == [(1, 9, big), (2, 7, 131072), (3, 1, 32768), (4, 2, 32768)]
    assert [x[1:] for x in got[50]] == [(1, 131072), (2, 131072), (2, 131072), (0, 0)]
    assert topk.top_k(df.limit(0), lambda i: i % 50 == 0).collect() == []


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf}/embeddings.parquet')")
    rel = con.sql(ORACLES["op1_maxscore"])
    df = op1_maxscore(spark, sf)
    assert df.columns == rel.columns
    assert sorted(map(tuple, df.collect())) == sorted(rel.fetchall())


def test_many_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 60)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 3)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF001}/embeddings.parquet')")
    assert sorted(map(tuple, op1_maxscore(spark, SF001).collect())) == sorted(con.sql(ORACLES["op1_maxscore"]).fetchall())


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(1, 8), st.integers(1, 6), st.integers(0, 10_000))
def test_wide_sums_equal_brute_force(n, width, k, seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(-2 ** 62, 2 ** 62, (n, width)).astype(object)
    ids = rng.permutation(n)
    shard = topk.Shard(ids, x)
    for j in range(min(n, 4)):
        assert shard.best(int(ids[j]), x[j], k) == brute(ids, x, ids[j], x[j], k)


@pytest.mark.parametrize("rows", [
    [(0, [1e6, 1.0]), (1, [1e6, 2.0]), (2, [2e6, 1.0]), (3, [-1e6, 7.0])],
    [(0, [1.0, 2.0]), (0, [2.0, 1.0]), (1, [1.0, 3.0]), (2, [4.0, 1.0]), (3, [2.0, 2.0]), (4, [0.0, 9.0]), (5, [5.0, 5.0])],
    [(i, [float((i * 37 + d * 11) % 4001 - 2000) for d in range(1024)]) for i in range(101)]])
def test_large_components_repeated_queries_and_many_dimensions_equal_sql(spark, tmp_path, rows):
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    rel = con.sql(ORACLES["op1_maxscore"])
    assert sorted(map(tuple, op1_maxscore(spark, str(tmp_path)).collect())) == sorted(rel.fetchall())
