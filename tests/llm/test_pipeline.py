"""The pipeline against plain versions of its stages."""

import hashlib

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from cartwheel.llm import decontaminate, pseudonyms, toxicity
from cartwheel.llm.queries import pseudonym_key, toxicity_model, vocabulary_path
from tests.conftest import SF01
from tests.llm.test_neardup import brute


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage keeps, stage by stage."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    out = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.cut_lineage(stage(spark, docs, SF01))
        out.append(docs.collect())
    return out


def test_toxicity_stage(spark, stages):
    model = toxicity_model(spark, SF01)
    import pyarrow as pa
    score = dict(zip([r.doc_id for r in stages[0]], model.score(pa.array([r.text for r in stages[0]]))))
    assert {r.doc_id for r in stages[1]} == {i for i, s in score.items() if s < 0.5}
    assert stages[1][0].__fields__ == stages[0][0].__fields__ and {tuple(r) for r in stages[1]} <= {tuple(r) for r in stages[0]}
    assert 0 < len(stages[0]) - len(stages[1]) < 200


def test_toxicity_stage_on_documents_without_labels_of_both_kinds(spark, stages):
    clean = {r.doc_id for r in stages[1]}
    labelled = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    toxic = [r for r in stages[0] if r.doc_id not in clean][:40]
    fine = [r for r in stages[1] if labelled.get(r.doc_id) == 0][:40]
    assert len(toxic) == len(fine) == 40

    def left(rows, shift):
        docs = spark.createDataFrame([(r.doc_id + shift, *r[1:]) for r in rows], spark.read.parquet(f"{SF01}/documents.parquet").schema)
        return {r.doc_id - shift for r in corpus_pipeline.drop_toxic(spark, docs, SF01).collect()}

    for shift in (0, 50_000_000):
        assert left(toxic, shift) == set() and left(fine, shift) == {r.doc_id for r in fine}
        assert left(toxic + fine, shift) == {r.doc_id for r in fine}


def test_near_duplicate_stage(stages):
    kept = {i for i, c in brute([(r.doc_id, r.text) for r in stages[1]]).items() if i == c}
    assert sorted(r.doc_id for r in stages[2]) == sorted(kept) and {tuple(r) for r in stages[2]} <= {tuple(r) for r in stages[1]}


def test_decontamination_stage(spark, stages):
    items = [(r.item_id, decontaminate.normal_text(r.text)) for r in spark.read.parquet(f"{SF01}/benchmark.parquet").collect()]
    auto = decontaminate.Automaton(items, decontaminate.ERROR_RATE)
    clean = {r.doc_id for r in stages[2] if not auto.matches(b" " + decontaminate.normal_text(r.text) + b" ")}
    exact = {r.doc_id for r in stages[2] if any(t in decontaminate.normal_text(r.text) for _, t in items)}
    assert {r.doc_id for r in stages[3]} == clean and exact and not exact & clean


def test_pseudonym_stage(spark, stages):
    f = pseudonyms.Feistel(pseudonym_key(spark))
    want = {r.doc_id: pseudonyms.replace(f, r.text)[0] for r in stages[3]}
    assert {r.doc_id: r.text for r in stages[4]} == want
    assert all(r.n_chars == len(r.text) for r in stages[4]) and len(stages[4]) == len(stages[3])


def test_token_stage_and_run(spark, stages):
    library = Tokenizer.from_file(vocabulary_path())
    texts = {r.doc_id: r.text for r in stages[4]}
    for r in stages[5]:
        assert r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert sorted(map(repr, corpus_pipeline.run(spark, SF01).collect())) == sorted(map(repr, stages[5]))


def test_defined_cases(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    odd = spark.createDataFrame([(10_000_001, None, None, None, None), (None, "clean words here", "en", "s", 16), (None, None, None, None, None),
                                 (10_000_002, "", "en", "s", 0), (10_000_003, "twice the same row", "en", "s", 18), (10_000_003, "twice the same row", "en", "s", 18)], docs.schema)
    mixed = docs.limit(200).unionByName(odd)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        empty = stage(spark, docs.limit(0), SF01)
        assert empty.collect() == [] and (k == 4 or empty.columns == docs.columns)
        mixed = corpus_pipeline.cut_lineage(stage(spark, mixed, SF01))
    left = [r.doc_id for r in mixed.collect()]
    assert left.count(None) == 2 and left.count(10_000_001) == left.count(10_000_002) == left.count(10_000_003) == 1
