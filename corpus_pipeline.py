"""Training-corpus pipeline: toxicity, near-duplicates, decontamination, pseudonyms, tokens.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``;
the first four return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import bpe, decontaminate, neardup, pseudonyms, toxicity
from cartwheel.llm.queries import pseudonym_key, table, toxicity_model, vocabulary_path
from cartwheel.session import cut_lineage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated probability of being toxic is below one half, by the model of the corpus in ``sf_dir``."""
    columns = docs.columns
    scored = toxicity.score(docs, toxicity_model(spark, sf_dir), keep=columns, out="__toxic")
    return scored.filter(F.col("__toxic") < 0.5).select(*columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each near-duplicate class."""
    return neardup.without_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, also not with a few edits."""
    return decontaminate.without_matches(docs, table(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced by pseudonyms; n_chars follows the text."""
    columns = docs.columns
    rest = [c for c in columns if c != "text"]
    done = pseudonyms.pseudonymise(docs, pseudonym_key(spark), keep=rest, found=None)
    if "n_chars" in rest:
        done = done.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return done.select(*columns)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document and the digest of what they decode to: doc_id, lang, source, n_tokens, ids, decoded_sha256."""
    keep = [c for c in ("doc_id", "lang", "source") if c in docs.columns]
    return bpe.encode(docs, bpe.read_vocabulary(vocabulary_path()), keep=keep, outputs=["n_tokens", "ids", "decoded_sha256"])


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pseudonyms", replace_personal_data),
    ("tokens", to_tokens),
]

#: Trained scores, keyed permutations and token merges have no SQL form; tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut_lineage(docs)
    return docs
