"""The registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.llm import convtrie, katz, mixing, pii, pieces, prefixhash, quality, simhash, spelling, suffix, topk, urlfilter, warc
from flowlens.llm.common import table

MODEL = "piece_bpe_32k.model"


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixhash.fingerprints(table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.dedup(table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.extract(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", simhash.hex64(F.col("fp")).alias("fingerprint"), "component_id")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.archive_path(spark)
    warc.write(table(spark, sf_dir, "pages"), path)
    records, gaps = warc.read(spark, path, payloads=False)
    if not gaps.isEmpty():
        raise ValueError(f"the archives just written at {path} have damaged records: {gaps.first()}")
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), model_path(), cache=500_000)  # its workers do nothing else


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convtrie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_top_k, op2_quality, op3_url_filter, op4_fingerprints, op5_suffix_dedup, op6_pii, op7_simhash, op8_warc,
        op9_sentencepiece, op10_mixing, op11_spelling, op12_conversation_trie, op13_katz, pipeline)}


TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_top_k": TOP_K, "op3_url_filter": urlfilter.ORACLE, "op8_warc": warc.ORACLE,
            "op11_spelling": spelling.ORACLE, "op12_conversation_trie": convtrie.ORACLE}
