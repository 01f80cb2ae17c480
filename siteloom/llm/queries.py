"""Queries of the training-data operators and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, embeddings, minhash, mixing, passages, pii, quality, segmenting, sharding, toxicity
from .common import stored, table, words

QUERIES: dict = {}
ORACLES: dict = {}

HARD_TURN = "\\### Assistant: </turn> ok"


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formats every conversation, then reads turns and masked text back from the formatted string."""
    hard = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(HARD_TURN).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(hard)
    made = chat.format_chat(turns.withColumn("parts", chat.text_part(F.col("text"))))
    back = made.select("conv_id", "formatted", "n_tokens", chat.parse_turns(F.col("formatted")).alias("turns"), chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["body"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


QUERIES["op1_chat"] = op1_chat
ORACLES["op1_chat"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         replace(replace(coalesce(text, ''), '\', '\b'), '<', '\l') AS body,
         replace(replace(replace(coalesce(role, ''), '\', '\b'), '<', '\l'), '>', '\g') AS head
  FROM (SELECT conv_id, turn, role, text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
        UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, body)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, body) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(length('<turn ' || head || '>' || body || '</turn>') + 1)::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""

SHARDS = 40


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Splits all documents into 40 shards of equal bytes."""
    docs, text = table(spark, sf_dir, "documents"), F.coalesce(F.col("text"), F.lit(""))
    code = lambda c: F.crc32(F.coalesce(F.col(c), F.lit("")).cast("binary")).bitwiseAND(F.lit(0xFFFFF))
    size = F.octet_length(text) + 16
    made = sharding.shard(docs, {"source": code("source"), "lang": code("lang"), "bytes": size, "doc": F.col("doc_id")}, size, F.col("doc_id"), SHARDS, {"text_crc32": F.crc32(text.cast("binary"))})
    return made.select(F.col("key").alias("doc_id"), F.col("weight").alias("size"), "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES["op2_sharding"] = op2_sharding


#: Least score that counts as toxic.
TOXIC = 0.7


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from the labelled ones that aren't held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = toxicity.score(docs, toxic_model(docs, table(spark, sf_dir, "labels")))
    held = F.coalesce(third(F.col("doc_id")) == 1, F.lit(False))
    return made.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"), F.size("passages").cast("long").alias("n_passages"))


def third(doc_id):
    """crc32 of the id as text, modulo 3."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def toxic_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    """The model of the labelled documents whose third isn't 1."""
    return toxicity.fit(docs.where(third(F.col("doc_id")) != 1), labels, (third(F.col("doc_id")) / 2).cast("int"))


QUERIES["op3_toxicity"] = op3_toxicity


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates of all documents: word pairs, similarity of 0.8 or more."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=2)


QUERIES["op4_minhash"] = op4_minhash
# Components by following links both ways from every document that has one.
REACHED = """
ends AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a, b FROM ends UNION SELECT r.a, l.b FROM reach r JOIN ends l ON l.a = r.b),
least AS (SELECT a, least(a, min(b)) AS component_id FROM reach GROUP BY a)
"""
ORACLES["op4_minhash"] = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) > 1 THEN list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) ELSE w END AS s FROM worded
), each AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
  SELECT p.doc_id AS a, q.doc_id AS b FROM each p JOIN each q ON p.x = q.x AND p.doc_id < q.doc_id AND 100 * least(p.n, q.n) >= 80 * greatest(p.n, q.n)
  GROUP BY p.doc_id, q.doc_id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))
), """ + REACHED + """
SELECT doc_id, len(s)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id, coalesce(component_id, doc_id) = doc_id AS kept FROM sets LEFT JOIN least ON a = doc_id
"""


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates of all vectors: cosine of 0.95 or more."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


QUERIES["op9_embeddings"] = op9_embeddings
ORACLES["op9_embeddings"] = """
WITH RECURSIVE good AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT p.vec_id AS a, q.vec_id AS b FROM good p JOIN good q ON p.vec_id < q.vec_id AND len(p.v) = len(q.v) AND list_cosine_similarity(p.v, q.v) >= 0.95
), """ + REACHED + """
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(component_id, vec_id) AS component_id, coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN least ON a = vec_id LEFT JOIN (SELECT a AS id, count(*) AS n FROM ends GROUP BY a) ON id = vec_id
"""


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain figures and the verdict of n-gram likelihoods for every document; trusted are those labelled good."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.weights(docs, labels.where("quality = 1 and coalesce(toxic, 0) = 0"), rejected=labels.where("quality = 0"))
    return quality.judge(docs, model, scores=model.scores)


QUERIES["op5_quality"] = op5_quality


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    made = pii.find(table(spark, sf_dir, "documents"))
    return made.select("doc_id", *(f"n_{k}" for k in pii.KINDS), F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans"))


QUERIES["op8_pii"] = op8_pii


def mixed(docs: DataFrame) -> DataFrame:
    """Documents with the probability at which source, language and topic come near each other, and the draw."""
    return drawn(docs, mixing.topic(F.col("text")), F.size(words(F.col("text"))))


def drawn(docs: DataFrame, topic: Column, tokens: Column) -> DataFrame:
    return mixing.mix(docs, {"source": F.col("source"), "lang": F.col("lang"), "topic": topic}, F.col("doc_id"), tokens)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raked token weights, probability and draw of every document."""
    # Cells and draw both take topic and tokens, so these are made once; without the text, the rows are short.
    docs = stored(table(spark, sf_dir, "documents").select("doc_id", "source", "lang", mixing.topic(F.col("text")).alias("topic"), F.size(words(F.col("text"))).alias("words")))
    made = drawn(docs, F.col("topic"), F.col("words"))
    return made.select("doc_id", "tokens", "dim_source", "dim_lang", "dim_topic", F.round("weight", 6).alias("weight"), F.round("probability", 6).alias("probability"), "sampled")


QUERIES["op7_mixing"] = op7_mixing


def digest_of(made: DataFrame) -> DataFrame:
    """Segmentations with a digest in the place of their packed ids."""
    return made.select("doc_id", "rank", "n_pieces", F.round("log_prob", 6).alias("log_prob"), F.round("perturbed", 6).alias("perturbed"), F.round("inclusion", 9).alias("inclusion"), "round_trip", F.sha2("ids", 256).alias("ids_sha256"))


def op10_segmenting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two distinct sampled segmentations of every document."""
    return digest_of(segmenting.encode(table(spark, sf_dir, "documents"), packed=True))


QUERIES["op10_segmenting"] = op10_segmenting


def op6_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated strings of 100 bytes."""
    return passages.remove_repeats(table(spark, sf_dir, "documents"))


QUERIES["op6_passages"] = op6_passages
