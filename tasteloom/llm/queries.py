"""One query per operator on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tasteloom.llm import (
    clustering, decontaminate, hilbert, language, mixing, negatives, pieces, pii, simhash, suffix_dedup, topk, toxicity, urlfilter,
)
from tasteloom.llm.common import id_hash, n_bytes, table

URL_RULES = [
    urlfilter.Rule("allow", "com", "/"),
    urlfilter.Rule("block", "example.com", "/en/"),
    urlfilter.Rule("allow", "www.example.com", "/en/"),
    urlfilter.Rule("block", "net", "/es/"),
    urlfilter.Rule("block", "net", "/fr/"),
]


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.repeated_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        F.col("key").alias("doc_id"), "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256"
    )


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = pieces.with_ids(docs, pieces.Vocabulary.load(), check="round_trip")
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", "round_trip")


def op3_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.with_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(id_hash("doc_id") % 3 == 1, F.lit(False))
    model = language.learn(docs.where(~held_out))
    return docs.select("doc_id", held_out.alias("held_out"), language.predict(F.col("text"), model).alias("p")).select(
        "doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score"
    )


def op5_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op6_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(
        "doc_id", "lang", "source", (n_bytes("text") + 1).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    sharded = hilbert.shard_by_curve(rows, ["lang", "source", "size"], ["doc_id", "text_crc32"])
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve",
    )


def op7_norm_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(id_hash("doc_id") % 5 == 0, F.lit(False))
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    scored = docs.select("doc_id", held_out.alias("held_out"), toxicity.score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.with_identifiers(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.concat(*pii.KINDS)
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(pii.listed(base).cast("binary"), 256).alias("base_sha256"),
        pii.listed(F.concat(base, "added")).alias("spans"),
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op12_simplex_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster(table(spark, sf_dir, "embeddings"))


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


ALL = [
    op1_suffix_dedup, op2_sentencepiece, op3_benchmark_leaks, op4_language, op5_url_cascade, op6_hilbert_shards,
    op7_norm_topk, op8_simhash, op9_toxicity, op10_pii, op11_hard_negatives, op12_simplex_clusters, op13_source_mix,
    pipeline,
]
