"""The queries of the training-data operators, and the SQL that those are held against which SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyforge.llm import _base as B
from tallyforge.llm import bpe, chat, classifier, decontam, minhash, pii, rules, sql, suffix, token_output, warc

#: The conversation whose texts are control strings of common templates.
CONTROL_TALK = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def byte_bpe(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(B.table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(B.table(spark, sf_dir, "documents"), B.table(spark, sf_dir, "benchmark"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.reduced(B.table(spark, sf_dir, "documents"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.linked(B.table(spark, sf_dir, "documents"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe(B.table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_back(warc.archived(B.table(spark, sf_dir, "pages")))


def op7_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.scored(B.table(spark, sf_dir, "documents"), B.table(spark, sf_dir, "labels"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = B.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digest(talks.unionByName(spark.createDataFrame(CONTROL_TALK, "conv_id long, turn long, role string, text string")))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_output.read_back(token_output.encoded(B.table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.apply_rules(B.table(spark, sf_dir, "documents"), B.table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_pii, op2_decontamination, op3_suffix_dedup, op4_minhash, op5_byte_bpe, op6_warc, op7_quality_votes, op8_chat, op9_token_files, op10_quality_rules]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return sql.oracle_sql()
