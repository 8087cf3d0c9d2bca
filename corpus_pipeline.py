"""Documents from raw to token counts: quality rules, near-duplicate removal, benchmark decontamination, PII, BPE.

Each stage is a function (spark, docs, sf_dir) -> DataFrame; run() applies them to ``documents``, each over the written result
of the one before. The tables that a stage needs are deleted when its result is written, those of the stages when the fourth one
is, which the last one reads. ORACLE_SQL is None: byte-pair merges and MinHash components aren't SQL; tests hold the rows against a
brute-force version.

Null and empty texts fail the base quality rule, so stage 1 removes them; texts of any length are processed whole; rows that
repeat a doc_id are judged each by itself in stage 1, and stay or go together from stage 2 on; other columns are carried along
whatever their names, and an empty table gives an empty one at each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyforge.llm import _base as B
from tallyforge.llm import decontam, minhash, pii, rules
from tallyforge.llm.registry import byte_bpe


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rules.accepted(docs, B.table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.deduplicated(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.uncontaminated(docs, B.table(spark, sf_dir, "benchmark"))


def without_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.sanitised(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe(docs)


STAGES = [("quality_rules", quality), ("minhash_dedup", near_duplicates), ("decontamination", decontaminated), ("pii", without_pii), ("byte_bpe", encoded)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = B.table(spark, sf_dir, "documents")
    with B.tidied(spark) as keep:
        for name, stage in STAGES[:-1]:
            with B.tidied(spark) as keep_stage:
                docs = keep_stage(B.written(stage(spark, docs, sf_dir), name))
        keep(docs)
    return STAGES[-1][1](spark, docs, sf_dir)
