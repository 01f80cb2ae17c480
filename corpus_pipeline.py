"""A corpus pipeline of five stages over documents; each is written as Parquet and read again by the next.

All stages take the columns of COLUMNS and ignore others. Any of them may be null, ids and rows may repeat, and an
empty table gives an empty one; each docstring says what that means there.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteloom.llm import minhash, pii, queries, segmenting, toxicity
from siteloom.llm.common import shared_folder, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Words of a shingle in the near-duplicates stage; the thin query op4_minhash has its own.
SHINGLE = 5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the limit for toxic ones; the model is learnt from those of docs that have labels.

    A row's fate depends on its text alone; null and empty texts stay. Rows with a null id teach nothing.
    """
    model = queries.toxic_model(docs, table(spark, sf_dir, "labels"))
    made = toxicity.score(docs.select(*COLUMNS).withColumn("_text", F.col("text")), model, text="_text", keep=COLUMNS)
    return made.where(F.col("score") < queries.TOXIC).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates by five-word shingles: of the smallest id, a null one last.

    Rows are told apart by id and text, so those with a null or a shared id count like others, and exact repeats of a
    row are one group. Texts without words all stay.
    """
    return minhash.one_of_each(docs.select(*COLUMNS), width=SHINGLE)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each span of personal data replaced by its kind; n_chars is that of the new text.

    A null text becomes an empty one. Rows are masked one by one, so repeated ones alike.
    """
    found = pii.find(docs, keep=("lang", "source"))
    masked = found.select("doc_id", pii.masked(F.col("text"), F.col("spans")).alias("text"), "lang", "source")
    return masked.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents drawn for the mixture of sources, languages and topics.

    Null sources and languages are values of their own, texts without words weigh as one token. The draw is by id:
    rows that share one, a null one too, and their cell are drawn together.
    """
    return queries.mixed(docs.select(*COLUMNS)).where("sampled").select(*COLUMNS)


def segment(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of each document, as digests of their ids.

    Null and empty texts have the empty one only; rows with equal id and text get equal ones.
    """
    return queries.digest_of(segmenting.encode(docs, packed=True))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("mixing", mix_sources),
    ("segmenting", segment),
]

#: The learnt, iterative and sampling stages have no SQL form; tests compare them with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to documents."""
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}-{name}")
        docs = spark.read.parquet(f"{folder}/{i}-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
