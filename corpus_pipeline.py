"""Documents to training tokens: five stages, each on all that the one before has kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorloom.llm.bbit import without_near_duplicates
from sensorloom.llm.benchmark_suffixes import decontaminated
from sensorloom.llm.line_dedup import deduplicated
from sensorloom.llm.pair_bpe import encode_decode
from sensorloom.llm.suffix_repeats import keep_good
from sensorloom.llm.texts import stored, table

TOKENIZER = "byte_bpe_50k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules on repeats."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier document has; their length anew."""
    out = deduplicated(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, 0.8 or more."""
    return without_near_duplicates(docs, 80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, and digests of them and of the decoded text."""
    return encode_decode(docs, public_tokenizers.path(TOKENIZER), with_ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

ORACLE_SQL = None  # SQL can't merge byte pairs; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs)
    return docs
