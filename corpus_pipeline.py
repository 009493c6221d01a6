"""Corpus pipeline: language ID, near-duplicates, personal data, mixing, tokens.

Each stage is a function (spark, docs, sf_dir) -> DataFrame; its result is
written as Parquet and read again as the next one's ``docs``.  All but the last
return the columns of ``documents``.

* language: drops texts without a language (null text, no letter) and texts
  whose best language has a score below ``MIN_LANG_SCORE``;
* near_duplicates: one document of each SimHash group stays (the smallest id);
* personal_data: personal data in the texts is replaced by pseudonyms;
* mixing: the rows are taken as often as the mix takes them, so that the sources
  meet their target weights (rows of over-full sources go, of scarce ones repeat);
* tokens: every text is encoded; (doc_id, source, n_tokens, ids, decoded_sha256).

Defined cases: an empty table gives an empty result with the columns of the last stage; null ids,
languages and sources stay as they are; of rows that repeat an id and text one stays
(near_duplicates), and of ties the smallest id; further columns, whatever their names, pass through
all stages but the last; texts are treated whole.  Where no row has a language, the language stage
keeps nothing.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm import bpe, langid, mixing, pii, simhash
from medallion.llm.common import scratch

#: Part of the way from chance (one in the number of languages) to certainty that the best language must reach;
#: texts of a few letters have little to go by and stay.
MARGIN = 0.1
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.fit(docs, F.lit(True))
    chance = 1 / len(model.langs) if model else 1.0
    return langid.identified(docs, model, chance + MARGIN * (1 - chance) - 1e-9)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.dedup(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.pseudonymize(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.resample(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.tokenized(docs, public_tokenizers.path(VOCABULARY), ["doc_id", "source"],
                         pattern=public_tokenizers.PATTERN)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("personal_data", personal_data),
          ("mixing", mix_sources), ("tokens", tokens)]

#: SQL can express neither the network nor the encoder; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
