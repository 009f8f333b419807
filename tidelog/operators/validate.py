"""Comparing two sources of the same posts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.texts import prefix_agrees
from tidelog.functions.times import epoch_micros


def overlap(a: DataFrame, b: DataFrame, key: str = "ts_id") -> DataFrame:
    """One row: keys in both, in a only, in b only."""
    x, y = a.select(key).distinct().withColumn("a", F.lit(True)), b.select(key).distinct().withColumn("b", F.lit(True))
    both = x.join(y, key, "full_outer")
    return both.agg(F.count_if(F.col("a") & F.col("b")).alias("both"), F.count_if(F.col("b").isNull()).alias("only_a"), F.count_if(F.col("a").isNull()).alias("only_b"))


def confusion(a: DataFrame, b: DataFrame, key: str = "ts_id", column: str = "kind") -> DataFrame:
    x, y = a.select(key, F.col(column).alias("kind_a")), b.select(key, F.col(column).alias("kind_b"))
    return x.join(y, key).groupBy("kind_a", "kind_b").agg(F.count("*").alias("n"))


def created_disagreements(a: DataFrame, b: DataFrame, seconds: float = 2.0) -> DataFrame:
    x, y = a.select("ts_id", F.col("created_at_utc").alias("created_a")), b.select("ts_id", F.col("created_at_utc").alias("created_b"))
    return x.join(y, "ts_id").filter(F.abs(epoch_micros(F.col("created_a")) - epoch_micros(F.col("created_b"))) > seconds * 1_000_000)


def seeded_sample(ids: DataFrame, key: str, k: int = 300, seed: int = 1) -> DataFrame:
    """k keys without replacement, the same for the same seed: the smallest by a seeded hash."""
    return ids.select(key).distinct().orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key).limit(k)


def content_agreement(a: DataFrame, b: DataFrame, k: int = 300, seed: int = 1) -> DataFrame:
    """One row: posts of a seeded sample of the common ones, and how many agree in the start of their text."""
    x, y = a.select("ts_id", F.col("content_text").alias("ta")), b.select("ts_id", F.col("content_text").alias("tb"))
    both = x.join(y, "ts_id")
    some = both.join(seeded_sample(both, "ts_id", k, seed), "ts_id", "left_semi")
    return some.agg(F.count("*").alias("compared"), F.count_if(prefix_agrees(F.col("ta"), F.col("tb"))).alias("agree"))
