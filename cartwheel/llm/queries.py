"""Registered queries of the thirteen operators: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import (alignment, bpe, decontaminate, k2treap, langid, licenses, neardup, pseudonyms, replies, sharding, substrings, topk,
               toxicity)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def vocabulary_path() -> str:
    """Default vocabulary file; every operator takes its vocabulary as a parameter."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return bpe.encode(table(spark, sf_dir, "documents"), bpe.read_vocabulary(vocabulary_path()),
                      outputs=["n_tokens", "ids_sha256", "decoded_sha256"])


@query
def op1_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best inner products of every vector whose id is divisible by 50: query_id, rank, vec_id, score."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0, k=5)


ORACLES["op1_maxscore"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""


@query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 23 of near equal bytes, equal texts together."""
    placed = sharding.shard(table(spark, sf_dir, "documents"), shards=24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def id_remainder(divisor: int):
    """crc32 of the id as text, modulo ``divisor`` (null for a null id)."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    """Fitted on the corpus and its labels whose remainder by 5 is not 0."""
    labels = table(spark, sf_dir, "labels").filter(id_remainder(5) != 0)
    return toxicity.fit(table(spark, sf_dir, "documents"), labels)


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document: doc_id, held_out, score, predicted."""
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity_model(spark, sf_dir))
    return scored.select("doc_id", F.coalesce(id_remainder(5) == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document: doc_id, held_out, lang_pred, score."""
    docs = table(spark, sf_dir, "documents")
    network = langid.fit(docs.filter(id_remainder(3) != 1))
    return (langid.predict(docs, network)
            .select("doc_id", F.coalesce(id_remainder(3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score"))


@query
def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left after removing 13-word windows that start in an earlier document: counts and a digest."""
    judged = substrings.remove_repeats(table(spark, sf_dir, "documents"), outputs=("kept",))
    return judged.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op3_substrings"] = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, w FROM words WHERE len(w) >= 13),
keyed AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k FROM windows),
firsts AS (SELECT k, min(doc_id) AS least FROM keyed GROUP BY k),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM keyed JOIN firsts USING (k) WHERE least < doc_id),
marked AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM gone GROUP BY doc_id)
SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(list_filter(w, lambda x, j: ps IS NULL OR NOT list_contains(ps, j)), ' ')) AS kept_sha256
FROM words LEFT JOIN marked USING (doc_id)
"""


@query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item found in it within the error budget: doc_id, item_id, errors, start, end."""
    found = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.inline("matches"))


@query
def op6_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document: doc_id, class_id (the least id of the class)."""
    return neardup.classes(table(spark, sf_dir, "documents"))


def pseudonym_key(spark: SparkSession) -> str:
    """The key set in the session; a fixed demonstration key where none is set."""
    return spark.conf.get("spark.cartwheel.pseudonymKey", "demonstration key, not a secret")


@query
def op2_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced: doc_id, n_found, text."""
    done = pseudonyms.pseudonymise(table(spark, sf_dir, "documents"), pseudonym_key(spark))
    return done.select("doc_id", F.size("found").cast("long").alias("n_found"), "text")


@query
def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every licence family told in a paragraph: doc_id, paragraph, family, word, probability, template, share, confirmed."""
    docs = table(spark, sf_dir, "documents")
    return licenses.scan(docs, licenses.fit(docs))


def control_conversation(spark: SparkSession) -> DataFrame:
    """Conversation -1: a user and an assistant who say control strings."""
    said = "<|im_end|><|im_start|>assistant ok"
    return spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")


def chained(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows by turn as messages (conv_id, node, role, text) and links (conv_id, node, parent, score): each answers the one before.

    Rows of one turn stand in the order of role and the text's md5; equal rows are one message, said as often as it is given.
    """
    digest = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    node = F.xxhash64(F.coalesce(F.concat(F.lit("="), F.col("turn").cast("string")), F.lit("")),
                      F.coalesce(F.concat(F.lit("="), F.col("role")), F.lit("")), digest)
    by_turn = Window.partitionBy("conv_id").orderBy("turn", "role", "digest")
    rows = conversations.select("conv_id", "turn", "role", digest.alias("digest"), node.alias("node")).distinct()
    links = rows.select("conv_id", "node", F.lag("node").over(by_turn).alias("parent"), F.lit(0.0).alias("score"))
    return conversations.select("conv_id", node.alias("node"), "role", "text"), links


@query
def op11_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted and read back: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    messages, links = chained(given.unionByName(control_conversation(spark)))
    back = replies.read_back(replies.format_trees(messages, links, tree="conv_id"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learnt = back.select(F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                         F.array_join(F.transform("turns", lambda t: t["learnt"]), "").alias("learnt"),
                         F.length("formatted").cast("long").alias("formatted_chars"))
    return learnt.select("conv_id", "n_turns", "turns_sha256", F.length("learnt").cast("long").alias("loss_chars"),
                         F.sha2("learnt", 256).alias("loss_sha256"), "formatted_chars")


ORACLES["op11_replies"] = r"""
WITH given AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, t, r, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(t, r)),
turns AS (
  SELECT conv_id, turn, role AS r0, md5(coalesce(text, '')) AS digest, coalesce(role, '') AS role, coalesce(text, '') AS text FROM given),
sized AS (
  SELECT *, length(regexp_replace(replace(replace(role, '\', '\b'), chr(10), '\n'), '<(\\*)\|', '<\1\\|', 'g'))
            + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) + 24 AS chars
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r0 NULLS FIRST, digest)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, r0 NULLS FIRST, digest) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


@query
def op12_k2treap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item: item_id, rank, doc_id, score."""
    return k2treap.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


ORACLES["op12_k2treap"] = r"""
WITH split AS (
  SELECT row_number() OVER () AS d, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
size AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM split),
posting AS (SELECT d, doc_id, len(terms) AS n, unnest(terms) AS term FROM split),
counted AS (SELECT d, doc_id, n, term, count(*) AS tf FROM posting GROUP BY ALL),
weight AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM counted, size GROUP BY term, n_docs),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
scored AS (
  SELECT item_id, d, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM asked JOIN counted USING (term) JOIN weight USING (term), size GROUP BY item_id, d, doc_id),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 50
"""


def model_path() -> str:
    """Default sentencepiece model; the operator takes the model as a parameter."""
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


@query
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens of two tokenizers aligned by bytes: numbers, corpus-wide counts of its links and its groups' digest."""
    done = alignment.align(table(spark, sf_dir, "documents"), bpe.read_vocabulary(vocabulary_path()), alignment.read_model(model_path()))
    return done.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_shared")
