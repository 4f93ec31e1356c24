"""The text operators applied to the supplied tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe,
    curves,
    exact,
    hard_negatives,
    jaccard,
    language,
    licenses,
    lines,
    near_vectors,
    packing,
    pii,
    toxicity,
    whitening,
)
from tidemark.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

VOCABULARY = "byte_bpe_50k.json"


def query(name: str) -> Callable[[Query], Query]:
    def add(build: Query) -> Query:
        QUERIES[name] = build
        return build

    return add


@query("op1_bpe")
def op1_bpe(spark, sf_dir):
    """Round trip of every text through the public vocabulary."""
    path = public_tokenizers.path(VOCABULARY)
    encoded = bpe.encode(table(spark, sf_dir, "documents"), path)
    return bpe.digests(bpe.decode(encoded, path))


@query("op2_licenses")
def op2_licenses(spark, sf_dir):
    """License notices in every whole text."""
    return licenses.report(licenses.find(table(spark, sf_dir, "documents")))


@query("op3_line_dedup")
def op3_line_dedup(spark, sf_dir):
    """All documents without lines that an earlier line is within one edit of."""
    return lines.digests(table(spark, sf_dir, "documents"))


@query("op4_pii")
def op4_pii(spark, sf_dir):
    """Spans of personal data in every text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.digests(pii.find(docs))


@query("op5_exact_dedup")
def op5_exact_dedup(spark, sf_dir):
    return exact.dedup(table(spark, sf_dir, "documents"))


@query("op7_packing")
def op7_packing(spark, sf_dir):
    """All documents in sequences of 2048 tokens."""
    path = public_tokenizers.path(VOCABULARY)
    return packing.pack_documents(table(spark, sf_dir, "documents"), path)


@query("op8_jaccard")
def op8_jaccard(spark, sf_dir):
    """Components of documents whose 3-word shingle sets are 90 % alike."""
    return jaccard.components(table(spark, sf_dir, "documents"))


@query("op9_curves")
def op9_curves(spark, sf_dir):
    """The 20 nearest vectors of every twentieth."""
    return curves.search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


@query("op10_toxicity")
def op10_toxicity(spark, sf_dir):
    """Scores of all texts by a model of the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    known = table(spark, sf_dir, "labels").filter(~toxicity.held_out())
    model = toxicity.learn(docs, known)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


@query("op6_language")
def op6_language(spark, sf_dir):
    """Languages of all texts by a network trained on rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    network = language.learn(docs.filter(~language.held_out()))
    predicted = language.predict(docs, network)
    return predicted.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


@query("op11_hard_negatives")
def op11_hard_negatives(spark, sf_dir):
    """The first negatives below each positive of every hundredth vector."""
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", moved), F.col("id") % 100 == 0)


@query("op12_near_vectors")
def op12_near_vectors(spark, sf_dir):
    """Components of vectors of one label with a cosine of 0.98 and more."""
    return near_vectors.near_copies(table(spark, sf_dir, "embeddings"))


@query("op13_whitening")
def op13_whitening(spark, sf_dir):
    """All vectors in the 32 leading components, each of variance one."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
