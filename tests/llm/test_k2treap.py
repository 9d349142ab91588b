"""K2-treap search against sums over all cells and against DuckDB SQL."""

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from cartwheel.llm import k2treap
from cartwheel.llm.queries import ORACLES, op12_k2treap
from tests.conftest import SF001, SF01
from tests.oracle_harness import canon, compare, duck


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 40), st.integers(1, 200), st.integers(0, 400), st.integers(1, 30), st.integers(0, 10_000), st.sampled_from([1, 5, 10 ** 10]))
def test_treap_equals_dense_sums(rows, columns, cells, k, seed, most):
    rng = np.random.default_rng(seed)
    grid = np.zeros((rows, columns), np.int64)
    grid[rng.integers(0, rows, cells), rng.integers(0, columns, cells)] = rng.integers(1, most + 1, cells)
    r, c = np.nonzero(grid)
    asked = rng.choice(rows, rng.integers(1, rows + 1), replace=False)
    found, score = k2treap.Treap(r, c, grid[r, c]).best(asked, k)
    total = grid[asked].sum(axis=0)
    want = np.sort(total[total > 0])[::-1]
    bar = want[min(k, len(want)) - 1] if len(want) else 1
    keep = np.flatnonzero(total >= max(bar, 1))
    assert sorted(zip(found, score)) == [(i, total[i]) for i in keep]


def test_cells_hold_maxima():
    rng = np.random.default_rng(1)
    grid = rng.integers(0, 3, (16, 16)) * rng.integers(1, 100, (16, 16))
    r, c = np.nonzero(grid)
    t = k2treap.Treap(r, c, grid[r, c])
    assert t.largest[0] == grid.max() and t.quarters[0] == 15
    cell, level = np.zeros((1, 16), np.int64), np.zeros(1, np.int64)
    left, right = (t.halve(cell, np.arange(16), level, h) for h in (0, 1))
    assert [t.largest[left[0, 0]], t.largest[right[0, 0]], t.largest[left[0, 15]], t.largest[right[0, 15]]] == [
        grid[:8, :8].max(), grid[:8, 8:].max(), grid[8:, :8].max(), grid[8:, 8:].max()]


DOCS = [(1, "Alpha beta, beta! gamma"), (2, "alpha ALPHA alpha"), (3, None), (4, ""), (5, "..."), (6, "éa É ÉA beta_beta"), (2, "alpha beta"), (None, "alpha beta"),
        (None, "alpha beta"), (7, "x" * 3 + " " + "beta " * 5_000), (8, "alpha beta"), (8, "alpha beta"), (9, "delta\x00alpha"), (10, "1a 2b alpha1")]
ITEMS = [(1, "alpha beta beta"), (2, None), (3, "unknown words"), (4, "É éa"), (None, "gamma 2B"), (5, "delta"), (5, "x xxx"), (6, "")]


def both(spark, tmp_path, docs, items):
    spark.createDataFrame(docs, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    rel = con.sql(ORACLES["op12_k2treap"])
    got = op12_k2treap(spark, str(tmp_path))
    assert canon(got.columns, [tuple(r) for r in got.collect()]) == canon(rel.columns, rel.fetchall())
    return got.count()


def test_defined_cases_equal_sql(spark, tmp_path):
    assert both(spark, tmp_path, DOCS, ITEMS) > 10


def test_many_copies_and_shards_equal_sql(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(k2treap, "POSTINGS", 40)
    monkeypatch.setattr(k2treap, "ITEMS", 2)
    docs = DOCS + [(100 + i, "a hot copy of alpha") for i in range(300)] + [(500 + i, f"beta {i % 7} gamma {i % 3}") for i in range(200)]
    assert both(spark, tmp_path, docs, ITEMS) > 60


@pytest.mark.parametrize("docs, items", [([], ITEMS), (DOCS, []), ([], []), ([(1, None)], ITEMS), (DOCS, [(1, None)])])
def test_empty_tables(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    assert k2treap.search(d, i).count() == 0


def test_clashing_columns_and_string_ids(spark):
    d = spark.createDataFrame([("b", "alpha", 1, 2), ("a", "alpha", 1, 2), ("c", "beta", 1, 2)], "name string, body string, item_id int, score int")
    i = spark.createDataFrame([("q", "alpha", 3)], "key string, text string, doc_id int")
    got = k2treap.search(d, i, k=5, doc_id="name", item_id="key", text="body").orderBy("rank").collect()
    assert [(r.item_id, r.rank, r.doc_id) for r in got] == [("q", 1, "a"), ("q", 2, "b")]


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_query_equals_sql(spark, sf):
    ok, n, _, detail = compare(spark, duck(sf), "op12", op12_k2treap, ORACLES["op12_k2treap"], sf)
    assert ok and n > 0, detail
