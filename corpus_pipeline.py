"""The corpus pipeline: documents in, packed training sequences out.

Each stage calls one operator of ``tidelog.llm`` on all that the stage before
kept; its output is written as Parquet and read again.  All stages but the last
return the columns of documents:

1. quality_rules: rejected documents go.
2. near_dedup: one document of each near-duplicate group stays; sets of 5-word
   shingles at a similarity of 0.80 or more are linked.
3. suffix_dedup: later copies of 200-byte strings are cut out of the texts, the
   first copy stays; a text of which nothing is left goes.
4. source_mix: documents appear as often as the mix takes them, 0 to 2 times.
5. packing: a row for each piece of a document in a sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidelog.llm import minhash, mixing, packing, quality, suffix_repeats
from tidelog.llm.common import cut, documents


NEAR_PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one(docs, NEAR_PERCENT)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_repeats.keep_first(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("source_mix", source_mix),
    ("best_fit_packing", pack),
]

#: The later stages (min-max hashing, suffix arrays, tokenization) have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
