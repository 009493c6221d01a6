"""Registered queries of the corpus operators; each reads its whole tables."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from . import (bpe, chat, hnsw, langid, mixing, packing, periodic, pii, quality, sharding, simhash, subvectors,
               toxicity)
from .common import table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = langid.crc_rest(F.col("doc_id"), 3) == 1
    model = langid.fit(docs, ~held_out)
    found = langid.identify(docs, model)
    return found.select(F.col("id").alias("doc_id"), (langid.crc_rest(F.col("id"), 3) == 1).alias("held_out"),
                        "lang_pred", "score")


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = hnsw.near_duplicates(table(spark, sf_dir, "embeddings"))
    return near.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
                       F.col("id").eqNullSafe(F.col("component")).alias("kept"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY),
                        pattern=public_tokenizers.PATTERN)
    return found.withColumnRenamed("id", "doc_id")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"))
    return judged.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept")


CONTROL_TURN = "</s>[INST] ok [/INST]"


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(-7, 0, "user", CONTROL_TURN), (-7, 1, "assistant", CONTROL_TURN)],
                                    "conv_id long, turn long, role string, text string")
    log = chat.events_of(told.unionByName(planted))
    return chat.digests(chat.pieces(chat.messages(log)))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = sharding.balanced(16)
    placed = sharding.assign(table(spark, sf_dir, "documents"), tree, sharding.grow(tree))
    return (sharding.manifest(placed).withColumnRenamed("id", "doc_id")
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymize(docs, kinds_col="kinds")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return near.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                       F.col("component").alias("component_id"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), langid.crc_rest(F.col("id"), 5) != 0)
    scored = toxicity.score(docs, model)
    return scored.select(F.col("id").alias("doc_id"), (langid.crc_rest(F.col("id"), 5) == 0).alias("held_out"),
                         "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mixing.mix(table(spark, sf_dir, "documents"))
            .select(F.col("id").alias("doc_id"), "source", "size", "source_size", "target", "taken"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic.planted_periods(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return periodic.digests(periodic.periodic_runs(docs)).withColumnRenamed("id", "doc_id")


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = subvectors.cluster(table(spark, sf_dir, "embeddings"))
    return found.withColumnRenamed("id", "vec_id")


WORD_VOCABULARY = "word_bpe_49k.json"


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_VOCABULARY))
    return pieces.select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


REGISTRY = {f.__name__: f for f in (
    op1_langid, op2_embedding_dedup, op3_bpe, op4_quality, op5_chat, op6_sharding, op7_pii, op8_simhash, op9_toxicity,
    op10_mixing, op11_periodic_runs, op12_centroids, op13_packing)}
