"""Merge of a stream by keyed state: one record for each post in a RocksDB store.

``micro`` merges a batch into stored months, which it reads and writes again.
Here a batch costs what its own posts cost, however many are stored: the state
of a post is its record, an observation is folded into it, and records that have
changed go out.  Their log is append-only (a folder of a version for each
batch), the latest row of a post is its record, and ``compact`` leaves one row
a post.

Rules are those of ``operators.merge``, an observation at a time; what follows
from other fields (text of HTML, Eastern time) is computed on the way out.
Observations of a post in one batch are taken in order of seq.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidelog.functions.texts import html_to_text
from tidelog.functions.times import eastern_fields
from tidelog.schema import CREATED_RANK, DEFAULT_SOURCE, FIELDS, MEDIA_FILL, OBSERVATION, POST, SCALARS, SOURCE_RANK
from tidelog.sources import store

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LOG = "records"
#: Groups of posts that a stream keeps state for; a checkpoint holds on to it.
BUCKETS = 1024
_OUT = "ts_id string, version bigint, record string"


def _offer(rec: dict, field: str, value: Any, source: str, ranks: dict[str, int] = SOURCE_RANK) -> bool:
    """Whether a value came to stand: it is there, and of no lower rank than what stands."""
    if value is None or value == "" or value == []:
        return False
    stands = field in rec["value"]
    if stands and ranks[source] < ranks[rec["source"].get(field) or DEFAULT_SOURCE]:
        return False
    rec["value"][field], rec["source"][field] = value, source
    return True


def _filled(items: list[dict], others: list[dict]) -> list[dict]:
    if len(items) != len(others):
        return items
    return [{f: b[f] for f in MEDIA_FILL if f in b} | a for a, b in zip(items, others)]


def _later(*times: str | None) -> str | None:
    return max((t for t in times if t is not None), default=None)


def fold(rec: dict | None, o: dict) -> dict:
    """The record after an observation, both as JSON has them; instants are texts in order of time."""
    source, at = o["source"], o["observed_at"]
    rec = rec or {"value": {}, "source": {}, "status": "present", "seen": [], "first_seen_at": at, "first_seen_source": source}
    value = rec["value"]
    _offer(rec, "created_at_utc", o.get("created_at_utc"), source, CREATED_RANK)
    for f in SCALARS:
        _offer(rec, f, o.get(f), source)
    html = value.get("content_html")
    if _offer(rec, "content_html", o.get("content_html"), source):
        if value["content_html"] != html:
            rec["source"]["content_text"] = source
    elif not html and not o.get("content_html"):
        _offer(rec, "content_text", o.get("content_text"), source)
    media = value.get("media", [])
    if _offer(rec, "media", o.get("media"), source):
        value["media"] = _filled(o["media"], media)
    elif o.get("media"):
        value["media"] = _filled(media, o["media"])
    removed, gone = o.get("removed"), o.get("gone")
    if removed or gone:
        upper = o.get("tracker_removed_at") if removed else at
        rec["deleted_lower"] = _later(rec.get("deleted_lower"), rec.get("last_verified_live_at"), o.get("last_verified_live_at"), value.get("created_at_utc"))
        rec["deleted_upper"] = min((t for t in (rec.get("deleted_upper"), upper) if t is not None), default=None)
        rec["deleted_source"] = rec.get("deleted_source") or ("tracker" if removed else "gone")
        rec["status"] = "deleted"
    elif source == "primary":
        rec["last_verified_live_at"], rec["status"] = _later(rec.get("last_verified_live_at"), at), "present"
    if source == "tracker":
        rec |= {f: o[f] for f in ("tracker_id", "tracker_captured_at") if o.get(f) is not None}
        rec["tracker_removed_at"] = rec.get("tracker_removed_at") or o.get("tracker_removed_at")
    if source == "primary" and o.get("raw_primary") is not None:
        rec["raw_primary"] = o["raw_primary"]
    rec["seen"] = sorted({*rec["seen"], source})
    return rec


class Upsert(StatefulProcessor):
    """State of a bucket of posts: by post its record and how often it has changed, as JSON; only the posts of a batch are read and written."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getMapState("records", "ts_id string", "version bigint, record string")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        out = []
        for ts_id, seen in pd.concat(list(rows)).sort_values("seq", kind="stable").groupby("ts_id", sort=False)["o"]:
            post = (ts_id,)
            version, before = self.state.getValue(post) or (0, None)
            rec = json.loads(before) if before else None
            known = {k: rec.pop(k) for k in ("updated_at", "updated_run_id")} if rec else {}
            bare = json.dumps(rec, sort_keys=True) if rec else None
            for text in seen:
                o = json.loads(text)
                rec = fold(rec, o)
            if json.dumps(rec, sort_keys=True) != bare:
                known = {"updated_at": o["observed_at"], "updated_run_id": o.get("run_id")}
                text = json.dumps(rec | known, sort_keys=True)
                self.state.updateValue(post, (version + 1, text))
                out.append((ts_id, version + 1, text))
        if out:
            yield pd.DataFrame(out, columns=["ts_id", "version", "record"])

    def close(self) -> None:
        pass


def upserts(stream: DataFrame) -> DataFrame:
    """Changed records (ts_id, version, record as JSON) of a stream of observations; version counts a post's changes."""
    fields = [F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, T.TimestampNTZType) else F.col(f.name) for f in OBSERVATION.fields if f.name not in ("ts_id", "seq")]
    rows = stream.select("ts_id", "seq", F.to_json(F.struct(*fields)).alias("o"))
    # posts are dealt into buckets, for a group costs milliseconds however few rows it has
    return rows.withColumn("bucket", F.pmod(F.xxhash64("ts_id"), F.lit(BUCKETS))).groupBy("bucket").transformWithStateInPandas(Upsert(), _OUT, "Update", "None")


def run_upserts(stream: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Folds what is there into the records at root and ends."""
    conf, name = stream.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"

    def step(batch: DataFrame, batch_id: int) -> None:
        stream_id = json.loads(store.read_text(batch.sparkSession, f"{checkpoint}/metadata"))["id"]
        made = store.Batch(batch.sparkSession, root, f"{stream_id}-{batch_id}")
        if made.done is None:
            made.append(LOG, lambda path: batch.write.parquet(path))
            made.commit({})

    before = conf.get(name)
    conf.set(name, ROCKSDB)  # a query takes the session's settings when it starts
    try:
        return upserts(stream).writeStream.foreachBatch(step).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        conf.set(name, before)


def _log(spark: SparkSession, paths: list[str]) -> DataFrame:
    rows = spark.read.schema(_OUT).parquet(*paths) if paths else spark.createDataFrame([], _OUT)
    return rows.groupBy("ts_id").agg(F.max_by("record", "version").alias("record"), F.max("version").alias("version")).select("ts_id", "version", "record")


def compact(spark: SparkSession, root: str) -> None:
    """The log as one folder with a row for each post."""
    store.compact(spark, root, LOG, lambda paths, path: _log(spark, paths).write.parquet(path))


def records(spark: SparkSession, root: str) -> DataFrame:
    """The records (POST) as they stand."""
    instant = lambda f: isinstance(POST[f].dataType, T.TimestampNTZType)
    offered = [f for f in (*SCALARS, "created_at_utc", "content_html", "content_text", "media")]
    kinds = {f: "string" if instant(f) else POST[f].dataType.simpleString() for f in FIELDS}
    own = ("status", "deleted_lower", "deleted_upper", "deleted_source", "last_verified_live_at", "first_seen_at", "first_seen_source", "tracker_id", "tracker_captured_at", "tracker_removed_at", "raw_primary", "updated_at", "updated_run_id")
    schema = "struct<value:struct<" + ",".join(f"{f}:{kinds[f]}" for f in offered) + ">,source:map<string,string>,seen:array<string>," + ",".join(f"{f}:{kinds[f]}" for f in own) + ">"
    rows = _log(spark, store.current(spark, root).log_paths(LOG)).select("ts_id", F.from_json("record", schema).alias("r"))
    found = {f: F.col(f"r.value.{f}") for f in offered} | {f: F.col(f"r.{f}") for f in own} | {"ts_id": F.col("ts_id"), "seen_sources": F.col("r.seen")}
    some = rows.select(*[c.cast(POST[f].dataType).alias(f) for f, c in found.items()], F.map_from_entries(F.array_sort(F.map_entries("r.source"))).alias("field_sources"))
    has_html, none = F.coalesce("content_html", F.lit("")) != "", F.array().cast("array<string>")
    given = {
        "content_text": F.when(has_html, html_to_text(F.col("content_html"))).otherwise(F.coalesce("content_text", F.lit(""))), "content_html": F.coalesce("content_html", F.lit("")), "kind": F.coalesce("kind", F.lit("")),
        "pinned": F.coalesce("pinned", F.lit(False)), "mentions": F.coalesce("mentions", none), "tags": F.coalesce("tags", none), "media": F.coalesce("media", F.array().cast(POST["media"].dataType)), **eastern_fields(F.col("created_at_utc")),
    }
    return some.select(*[(given[f] if f in given else F.col(f)).cast(POST[f].dataType).alias(f) for f in FIELDS])
