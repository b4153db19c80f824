"""Queries of the numbered operators, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm.common import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillhouse.llm.decontaminate import decontaminate
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillhouse.llm.quality_rules import BASE, quality_rules
    return quality_rules(table(spark, sf_dir, "documents")).select("doc_id", *BASE, "base_failed", "kept")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tillhouse.llm.bpe import digests
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillhouse.llm.chunk_dedup import repeated_passages
    return repeated_passages(table(spark, sf_dir, "documents"))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillhouse.llm.quality_classifier import quality_scores
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_scores(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillhouse.llm.ngram_join import similar_components
    return similar_components(table(spark, sf_dir, "documents")).drop("n_links")


def queries() -> dict:
    """The numbered queries, by name."""
    from corpus_pipeline import run
    fs = (op1_quality_classifier, op2_decontaminate, op3_license_scan, op4_quality_rules, op5_pii, op6_warc,
          op7_line_dedup, op8_byte_bpe, op9_ngram_join, op10_chunk_dedup, op11_word_bpe, op12_alignment,
          op13_centroid_clusters)
    return {f.__name__: f for f in fs} | {"pipeline": run}


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillhouse.llm.line_dedup import line_dedup
    out = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), exact_words=1)
    return out.select("doc_id", "n_lines", "n_exact", "n_near", F.sha2("text", 256).alias("text_sha256"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillhouse.llm.pii import find_pii, train
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_pii(docs, train(docs)).drop("text")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillhouse.llm.warc import archive_pages
    pages = table(spark, sf_dir, "pages").select(
        "page_id", F.col("url").alias("uri"), F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    return archive_pages(pages)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillhouse.llm.license_scan import license_scan, train
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan(docs, train(docs))


def op11_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tillhouse.llm.word_bpe import digests
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(docs, public_tokenizers.path("word_bpe_49k.json"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tillhouse.llm.alignment import align
    return align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                 public_tokenizers.path("piece_bpe_32k.model"))


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillhouse.llm.centroids import cluster
    return cluster(table(spark, sf_dir, "embeddings"))
