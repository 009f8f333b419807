"""Structured Streaming over landed observations.

Each micro-batch is merged into the stored data set as one version of it (see
``store``): the months of posts that the batch touches, deletion events,
engagement snapshots and anomalies become visible together, or not at all.  A
run that dies before that repeats the batch from the same records; one that
dies after it, before the stream's checkpoint knows, finds the batch done.
Corrections may be arbitrarily late, so the merge has no watermark.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidelog.operators import merge as merging
from tidelog.operators import throttle
from tidelog.schema import OBSERVATION
from tidelog.sources import landed, sinks, store


def observation_stream(spark: SparkSession, path: str) -> DataFrame:
    """Landed observation files (Parquet) as a stream."""
    return spark.readStream.schema(OBSERVATION).parquet(path)


def merge_into(batch: DataFrame, root: str, name: str, snapshots: DataFrame | None = None, files: DataFrame | None = None) -> dict:
    """Merges observations into the data set at root; snapshots (ENGAGEMENT with ingest_seq) and files (what was read for it) are the batch's.

    name stands for the batch: a second try under it gives what the first gave.
    Gives new_posts, updated_posts and deletions_found.
    """
    spark, made = batch.sparkSession, store.Batch(batch.sparkSession, root, name)
    if made.done is not None:
        return made.done
    logged = landed.deletion_log(spark, root, made.base)
    named = landed.standing_posts(spark, made.base).join(batch.select("ts_id").distinct(), "ts_id", "left_semi")
    merged = merging.merge(named.drop("standing"), batch, logged, lambda rows: made.staged(rows, "rows"))
    posts, events = made.staged(merged.posts, "posts"), made.staged(merged.events, "events")
    month = sinks.post_month().alias("month")
    # where the records belong now and where they stood; a row for each month
    months = sorted(r["month"] for r in posts.select(month).union(named.select("standing")).distinct().collect())
    rest = landed.standing_posts(spark, made.base, months).join(posts.select("ts_id"), "ts_id", "left_anti")
    # a record in another month's folder stays where it is, for the checks to name it
    folder = F.when(sinks.post_month().isin(months), sinks.post_month()).otherwise(F.col("standing"))
    whole = rest.unionByName(posts.drop("changed", "is_new").withColumn("standing", month)).withColumn("month", folder).drop("standing")
    made.replace_months(months, lambda path: sinks.write_months(whole, path, F.col("month"), F.col("ts_id").cast("bigint")))
    gave = posts.agg(F.count_if("is_new").alias("new_posts"), F.count_if(F.col("changed") & ~F.col("is_new")).alias("updated_posts")).first().asDict()
    new = events.join(logged.select("ts_id", "source").distinct(), ["ts_id", "source"], "left_anti").select(*events.columns)
    gave["deletions_found"] = events.select("ts_id").distinct().count()
    made.append("deletions", lambda path: sinks.append_log(new, path))
    if snapshots is not None:
        kept = throttle.filter_engagement(snapshots, landed.engagement(spark, root, made.base).drop("ingest_seq"), landed.posts(spark, root, made.pending()))

        def write(path: str) -> None:
            # written once as they are, for dealing by range reads its rows twice
            once = made.path("staging/kept")
            kept.write.mode("overwrite").parquet(once)
            sinks.write_engagement(spark.read.schema(kept.schema).parquet(once), path)

        made.append("engagement", write)
    made.append("anomalies", lambda path: sinks.append_log(merged.anomalies, path))
    if files is not None:
        made.append("files", lambda path: sinks.append_log(files, path))
    return made.commit(gave)


def merge_batch(root: str, engagement: Callable[[DataFrame], DataFrame] | None = None, checkpoint: str | None = None) -> Callable[[DataFrame, int], None]:
    """The foreachBatch step that merges a batch of observations into the data set at root; engagement gives its snapshots, if it has any.

    A batch's name has the stream's identity from its checkpoint, so a stream
    begun anew is another one, though its batches have the same numbers.
    Without a checkpoint each call is a stream of its own: a batch that comes
    twice is merged twice, which changes no record.
    """
    own = uuid.uuid4().hex

    def step(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            stream = json.loads(store.read_text(batch.sparkSession, f"{checkpoint}/metadata"))["id"] if checkpoint else own
            merge_into(batch, root, f"{stream}-{batch_id}", engagement(batch) if engagement else None)

    return step


def run_merge(stream: DataFrame, root: str, checkpoint: str, engagement: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Merges what is there and ends."""
    return stream.writeStream.foreachBatch(merge_batch(root, engagement, checkpoint)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


#: Groups of posts that a stream's throttle keeps state for; a checkpoint holds on to it.
BUCKETS = 1024


def throttled(stream: DataFrame, gap_seconds: int = throttle.GAP_SECONDS) -> DataFrame:
    """Kept engagement snapshots (ts_id, observed_at, favourites) of a stream: state is the last kept instant of each post.

    Posts are dealt into BUCKETS groups, for a group costs milliseconds however
    few rows it has; the state of one is its posts with their instants, as JSON.
    Rows of a post in one batch are taken in order of time.
    """
    gap = gap_seconds * 1_000_000

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = {post: us for post, us in json.loads(state.get[0])} if state.exists else {}
        rows = pd.concat(list(frames)).sort_values("observed_at", kind="stable")
        keep = []
        for post, missing, us in zip(rows["ts_id"], rows["observed_at"].isna(), rows["observed_at"].astype("datetime64[us]").astype("int64").tolist()):
            stood = last.get(post)
            ok = stood is None or not missing and us - stood >= gap
            keep.append(ok)
            if ok and not missing:
                last[post] = us
        state.update((json.dumps(list(last.items())),))
        yield rows.loc[keep, ["ts_id", "observed_at", "favourites"]]

    dealt = stream.withColumn("bucket", F.pmod(F.xxhash64("ts_id"), F.lit(BUCKETS)))
    return dealt.groupBy("bucket").applyInPandasWithState(step, "ts_id string, observed_at timestamp_ntz, favourites bigint", "last string", "append", GroupStateTimeout.NoTimeout)


def event_counts(stream: DataFrame, at: str = "ts", window: str = "1 day", late: str = "1 day") -> DataFrame:
    """Counts by time window and kind of a stream, each event id once."""
    return (
        stream.withColumn(at, F.to_timestamp_ltz(F.col(at).cast("string"))).withWatermark(at, late).dropDuplicates(["event_id", at])
        .groupBy(F.window(at, window).alias("w"), "event_type").agg(F.count("*").alias("n"))
    )
