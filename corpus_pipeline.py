"""The corpus pipeline: each stage works on all that the one before kept.

Toxic documents go, then those without a language; of near-duplicates one stays; sources are mixed to target
weights, which repeats or leaves out documents; the last stage encodes every copy.

Defined results, of every stage: null and empty texts are not toxic and have no language, so they go at the second
stage; texts of any length are read whole. Rows with a null doc_id are rows like others. Repeated rows are judged
alike, and one of them stays. Ties between near-duplicates go to the smallest doc_id. Columns beyond those of
documents, whatever their names, are carried along up to the last stage. An empty table gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm import bpe, langid, mixing, simhash, toxicity
from cellweave.llm.common import durable, fold, scratch, table

#: Near-duplicates: words of a shingle, and the least similarity.
SHINGLE, SIMILARITY = 5, 0.8
#: The posterior that a document's language must have.
CERTAIN = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold; learned from the labels outside the held-out fold."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), fold("doc_id", 3) != 1)
    mark = f"toxicity_{uuid.uuid4().hex}"  # no column of the documents
    return toxicity.score(docs, model, output=mark).where(F.col(mark) < toxicity.THRESHOLD).select(*docs.columns)


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned; those without a letter, or with no likely language, go."""
    model = langid.learn(docs, fold("doc_id", 4) != 2)
    told = langid.predict(docs.withColumns({"kept_" + c: F.col(c) for c in docs.columns}), model)
    return told.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= CERTAIN)).select(*[F.col("kept_" + c).alias(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs, SHINGLE, SIMILARITY)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in proportion to the square root of their sizes, each document repeated a Poisson number of times."""
    return mixing.mix(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every copy's whole text as token ids; the decoded text's digest shows that they decode to it.

    The result's columns: doc_id, lang, source, n_tokens, token_ids, decoded_sha256; others end here.
    """
    return bpe.encode(docs, keep=["doc_id", "lang", "source"], outputs=("n_tokens", "token_ids", "decoded_sha256"))


STAGES = [("toxicity", drop_toxic), ("language_id", keep_identified), ("simhash", drop_near_copies), ("mixing", mix_sources), ("bpe", encode_tokens)]

#: Learned models, components and tokens are beyond SQL; tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; a stage's checkpoints go when the next one has its result."""
    docs, before = table(spark, sf_dir, "documents"), []
    for _, stage in STAGES[:-1]:
        with scratch(*before) as held:
            docs = durable(stage(spark, docs, sf_dir))
            held.remove(docs)
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
