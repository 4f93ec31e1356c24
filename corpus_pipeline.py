"""From raw documents to packed training sequences, stage by stage.

Every stage gets what the one before it kept, with the columns of ``documents``; the
last one returns where each piece of text is packed. No stage has an SQL form as a
whole: the tests hold each against a plain computation.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import exact, jaccard, packing, pii, toxicity
from tidemark.llm.common import table, written

VOCABULARY = "byte_bpe_50k.json"
# Words of a shingle and the least similarity, in percent, of near copies in a corpus.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; it learns from ``labels``."""
    known = table(spark, sf_dir, "labels").filter(~toxicity.held_out())
    return toxicity.keep_clean(docs, toxicity.learn(docs, known))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts only the row with the largest id goes on."""
    return exact.keep(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links connect only the one with the smallest id goes on.

    Documents link if their sets of five-word shingles are 80 % alike; ``op8_jaccard``
    has a rule of its own. One row stays, also where ids are repeated or null.
    """
    return jaccard.keep(docs, size=NEAR_WORDS, percent=NEAR_PERCENT)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind; ``n_chars`` follows the text."""
    clean = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    kind = docs.schema["n_chars"].dataType
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents that are left, in sequences of 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_copies),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
