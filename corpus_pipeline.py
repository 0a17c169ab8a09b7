"""From raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and gives the documents it keeps, with their columns; the last one
gives ids. ``run`` writes every stage to the shared folder and reads it again for the next one.

A stage sets the session's batches for Python to ``BATCH_BYTES``, and they stay so until its rows are made, which
is after the stage has returned; ``run`` puts the former value back.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.llm import bpe, decontaminate, language_id, ngram_join, pii
from statloom.llm.queries import held_out, table, word_bpe
from statloom.llm.shared import BATCH_SETTING, batches_of, written

#: Bytes of texts that go to Python at once, or one larger row. An executor holds such a batch several times for
#: each of its tasks, as vectors beside the heap and as vectors and texts in Python, and keeps the memory.
BATCH_BYTES = 4 << 20


def in_small_batches(stage):
    @wraps(stage)
    def made(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
        return stage(spark, docs, sf_dir)

    return made


@in_small_batches
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language; a null or empty text, or one without a letter, has none.

    Repeated rows are judged alike, long texts read whole, ties go to the language that sorts first. Columns
    beside doc_id, text and lang may have any names. Without labelled rows no document has a language; an
    empty table stays one. So it is in all stages but for what they say.
    """
    return language_id.keep_known(docs, language_id.learn(docs.where(~held_out())))


@in_small_batches
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id, null ids last.

    Of rows equal in id and text one stays. Null texts count as empty; empty texts are one group.
    """
    return ngram_join.keep_one(docs)


@in_small_batches
def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no passage of the benchmark stands; null and empty texts have none.

    All rows stay where the benchmark is empty. Rows equal in id and text go or stay together.
    """
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


@in_small_batches
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by the name of its kind; null texts stay null.

    Spans that overlap are replaced together, under the kind of the first and longest.
    """
    return pii.redact(docs, pii.learn(docs))


@in_small_batches
def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document, and the digest of the text they stand for.

    A null or empty text has no ids. Every row gives one, repeated rows alike.
    """
    made = bpe.encode(docs, word_bpe())
    return made.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


STAGES = [
    ("language", language),
    ("near duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("personal data", personal_data),
    ("token ids", token_ids),
]

#: The stages learn models and encode with a tokenizer: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    with batches_of(spark, BATCH_BYTES):
        for name, stage in STAGES:
            docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
