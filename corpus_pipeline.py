"""A corpus pipeline of five operators; part of the ``llm`` subpackage.

``STAGES`` are applied in order; each is called with (spark, docs, sf_dir),
works on every row its predecessor kept, and is written as Parquet and read again by the
next.  All but the last return the columns of ``documents``:

1. quality: the classifier learns from ``labels`` and the texts at hand; documents scored below 0.5 go.
2. simhash: of each near-duplicate group the document with the smallest id stays.
3. pii: personal data is replaced by ``[EMAIL]``, ``[IP]``, ``[CARD]`` or ``[PHONE]``.
4. mixing: sources are flattened until the most repeated one is used twice
   as often as the least; every document is used at least once, so small sources' documents may appear twice.
5. sentencepiece: ids and decoded text as digests, one row per used document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.llm import mixing, pieces, pii, quality, registry, simhash
from flowlens.llm.common import free_name, small_batches, store, table

ORACLE_SQL = None  # SQL cannot express the classifier, the bootstrapped patterns or the encoder


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    vectors, net = quality.learn(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs, "score")
    return quality.scored(docs, vectors, net, score).where(F.col(score) >= 0.5).select(*docs.columns)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return simhash.one_of_each(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return pieces.digests(docs, registry.model_path(), cache=100_000)  # the workers hold other stages' tables, too


STAGES = [
    ("quality", quality_stage),
    ("simhash", simhash_stage),
    ("pii", pii_stage),
    ("mixing", mixing_stage),
    ("sentencepiece", sentencepiece_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
