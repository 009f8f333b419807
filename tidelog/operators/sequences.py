"""Operators over the whole time line: neighbours, gaps, bursts, spikes.

A window without a partition key would move every row to one task.  The order is
cut into slices of about the same number of rows instead, wherever they lie
(Spark's range partitioning, bounds by sampling): neighbours inside a slice come
from a window by slice, and what goes on from slice to slice (the last row, the
last window opened, the number of bursts so far) from a small table with a row
for each slice.  Slices are written once, for bounds may differ when they are
drawn again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.times import epoch_micros, minutes_between
from tidelog.sources.store import scratch


#: Slices for each shuffle partition, so that tasks get some of each.
SLICES = 4


def ranged(df: DataFrame, *order: str) -> DataFrame:
    """df with __slice, ascending in the order; slices have about as many rows each."""
    spark = df.sparkSession
    count, path = SLICES * int(spark.conf.get("spark.sql.shuffle.partitions")), scratch(spark)
    df.repartitionByRange(count, *order).withColumn("__slice", F.spark_partition_id()).write.parquet(path)
    return spark.read.schema(T.StructType([*df.schema.fields, T.StructField("__slice", T.IntegerType())])).parquet(path)


def with_previous(df: DataFrame, at: str, key: str, *carry: str) -> DataFrame:
    """df with prev_<c> for every c of carry: values of the row before in order of (at, key)."""
    row, order = F.struct(*carry), F.struct(at, key)
    inside = Window.partitionBy("__slice").orderBy(at, key)
    cut = ranged(df, at, key)
    last = cut.groupBy("__slice").agg(F.max_by(row, order).alias("__last"))
    last = last.select("__slice", F.lag("__last").over(Window.orderBy("__slice")).alias("__before"))
    found = cut.withColumn("__prev", F.lag(row).over(inside)).join(last, "__slice")
    prev = F.coalesce("__prev", "__before")
    return found.select(*df.columns, *[prev[c].alias(f"prev_{c}") for c in carry])


def gaps(posts: DataFrame, at: str = "created_at_utc", key: str = "ts_id", local: str = "created_at_et") -> DataFrame:
    """(from_et, to_et, gap_min, at) between consecutive posts."""
    both = with_previous(posts.select(at, key, local), at, key, at, local).filter(F.col(f"prev_{at}").isNotNull())
    return both.select(F.col(f"prev_{local}").alias("from_et"), F.col(local).alias("to_et"), minutes_between(F.col(f"prev_{at}"), F.col(at)).alias("gap_min"), F.col(at).alias("at"), F.col(key).alias("key"))


def longest_gaps(posts: DataFrame, n: int = 20) -> DataFrame:
    return gaps(posts).orderBy(F.col("gap_min").desc(), "at", "key").limit(n).select("from_et", "to_et", "gap_min")


def longest_silence(posts: DataFrame) -> DataFrame:
    """One row, the largest gap (the earliest of equals); none for fewer than two posts."""
    return longest_gaps(posts, 1).select("gap_min", "from_et", "to_et")


def close_pairs(posts: DataFrame, minutes: int = 10) -> DataFrame:
    """Posts that follow the one before within the time, exactly that long included."""
    both = with_previous(posts.select("created_at_utc", "ts_id", "created_at_et", "kind"), "created_at_utc", "ts_id", "created_at_utc")
    gap = minutes_between(F.col("prev_created_at_utc"), F.col("created_at_utc"))
    return both.withColumn("gap_min", gap).filter(F.col("gap_min") <= minutes).select("ts_id", "created_at_et", "kind", "gap_min")


def bursts(posts: DataFrame, window_min: int = 10, min_posts: int = 5) -> DataFrame:
    """Islands of at least min_posts posts inside a moving window: start_et, end_et, count, kinds (map).

    Every post opens a window; those with enough posts are candidates, and
    overlapping candidates are one burst.  Whether a window has enough says the
    post that is so many places ahead, in this slice or among the first posts
    of the next ones; a post is in a burst if the last candidate's window
    reaches it.  A burst of any length is a few partial sums in each slice.
    """
    window, more = window_min * 60_000_000, min_posts - 1
    some = posts.select("created_at_utc", "ts_id", "created_at_et", "kind").filter("created_at_utc IS NOT NULL").withColumn("us", epoch_micros(F.col("created_at_utc")))
    order, post = Window.partitionBy("slice").orderBy("us", "ts_id"), F.struct("us", "ts_id")
    some = ranged(some, "us", "ts_id").withColumnRenamed("__slice", "slice").withColumn("rn", F.row_number().over(order))
    by_slice, earlier = Window.orderBy("slice"), Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    heads = some.groupBy("slice").agg(F.count("*").alias("n"), F.transform(F.array_sort(F.collect_list(F.when(F.col("rn") <= more, post))), lambda x: x["us"]).alias("head"))
    heads = heads.select("slice", "n", F.flatten(F.collect_list("head").over(by_slice.rowsBetween(1, max(1, more)))).alias("next"))
    ahead = F.coalesce(F.lead("us", more).over(order), F.get("next", (F.lit(more - 1) + F.col("rn") - F.col("n")).cast("int")))
    some = some.join(heads, "slice").withColumn("ahead", ahead).withColumn("cand", F.when(F.col("ahead") - F.col("us") <= window, F.col("us"))).drop("next", "n", "ahead", "rn")
    carried = some.groupBy("slice").agg(F.max("cand").alias("most")).select("slice", F.max("most").over(earlier).alias("carried"))
    before, so_far = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, 0)
    some = some.join(carried, "slice").withColumns({"past": F.greatest(F.max("cand").over(before), "carried"), "reach": F.greatest(F.max("cand").over(so_far), "carried")})
    opens = F.col("cand").isNotNull() & (F.col("past").isNull() | (F.col("past") + window < F.col("us")))
    some = some.withColumns({"opens": F.when(opens, 1).otherwise(0), "inside": F.col("us") <= F.col("reach") + window})
    base = some.groupBy("slice").agg(F.sum("opens").alias("n")).select("slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    members = some.withColumn("nth", F.sum("opens").over(so_far)).filter("inside").join(base, "slice").withColumn("island", F.col("base") + F.col("nth"))
    named = F.struct("us", "ts_id", "created_at_et")
    per_kind = members.groupBy("island", "kind").agg(F.count("*").alias("k"), F.min(named).alias("a"), F.max(named).alias("b"))
    whole = per_kind.groupBy("island").agg(F.min("a").alias("a"), F.max("b").alias("b"), F.sum("k").cast("bigint").alias("count"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("kind", "k")))).alias("kinds"))
    return whole.select(F.col("a.created_at_et").alias("start_et"), F.col("b.created_at_et").alias("end_et"), "count", "kinds")


def spike_days(posts: DataFrame, trailing: int = 28, factor: float = 3.0, least: int = 20, since: Column | None = None) -> DataFrame:
    """(et_date, count, trailing_median): days far above the zero-filled median of the days before."""
    counts = posts.filter(F.col("et_date").isNotNull()).groupBy("et_date").agg(F.count("*").alias("count"))
    span = counts.agg(F.min("et_date").alias("a"), F.max("et_date").alias("b"))
    calendar = span.filter("a is not null").select(F.explode(F.sequence(F.date_sub("a", trailing), F.col("b"), F.expr("interval 1 day"))).alias("et_date"))
    dense = calendar.join(counts, "et_date", "left").withColumn("count", F.coalesce("count", F.lit(0)))
    # a row for each day of the calendar: one task, whatever the number of posts
    before = Window.orderBy("et_date").rowsBetween(-trailing, -1)
    listed = F.array_sort(F.collect_list("count").over(before))
    n = F.size("l")
    median = (F.get("l", ((n - 1) / 2).cast("int")) + F.get("l", (n / 2).cast("int"))) / 2.0
    found = dense.withColumn("l", listed).filter(F.size("l") == trailing).withColumn("trailing_median", median)
    found = found.filter((F.col("trailing_median") > 0) & (F.col("count") > factor * F.col("trailing_median")) & (F.col("count") >= least))
    if since is not None:
        found = found.filter(F.col("et_date") >= since)
    return found.select("et_date", "count", "trailing_median")


def id_gap_ranges(ids: DataFrame, column: str) -> DataFrame:
    """first and last of each run of integers, between the smallest and the largest of a column, that are not there: as many rows as there are runs, however long they are."""
    known = ids.select(F.col(column).cast("bigint").alias("id")).filter("id IS NOT NULL").distinct()
    both = with_previous(known, "id", "id", "id").filter("prev_id < id - 1")
    return both.select((F.col("prev_id") + 1).alias("first"), (F.col("id") - 1).alias("last"))


def id_gaps(ids: DataFrame, column: str, block: int = 1 << 16) -> DataFrame:
    """Integers between the smallest and the largest of a column that are not there, one by one.

    Runs are cut into blocks and expanded in the cluster, never as one array.
    """
    blocks = id_gap_ranges(ids, column).select("last", F.explode(F.sequence("first", "last", F.lit(block).cast("bigint"))).alias("lo"))
    return blocks.repartition("lo").select(F.explode(F.sequence("lo", F.least("last", F.col("lo") + block - 1))).alias(column))
