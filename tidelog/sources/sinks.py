"""Writers: month-partitioned data sets, logs, exports and report files.

Merges write versions (see ``store``), which become visible by one rename.
``rewrite`` is for plain folders: it writes beside the old one and then swaps
them.  Folders have no atomic swap, so the old one is moved aside first and
readers fall back to it until the new one stands; a run that dies in between
leaves the old data set readable.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.times import month_of, to_iso
from tidelog.plans.views import derived
from tidelog.sources import store
from tidelog.sources.store import scratch  # noqa: F401 (part of this module's interface)

# The columns of the posts export.
EXPORT_COLUMNS = (
    "ts_id", "created_at_utc", "created_at_et", "et_date", "et_hour", "et_dow", "kind", "status", "content_text", "content_len", "media_count", "media_types",
    "card_domain", "card_url", "reblog_of_acct", "quote_of_acct", "edited_at", "deleted_lower", "deleted_upper", "deleted_source", "first_seen_source", "seen_sources",
)


def textual(df: DataFrame) -> DataFrame:
    """Instants as ISO strings."""
    return df.select(*[to_iso(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.TimestampNTZType) else F.col(f.name) for f in df.schema.fields])


def _path(spark, name: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark, path: str) -> None:
    where, fs = _path(spark, path)
    fs.delete(where, True)


def _move(spark, source: str, target: str) -> None:
    (a, fs), (b, _), (old, _) = _path(spark, source), _path(spark, target), _path(spark, target + ".old")
    fs.mkdirs(b.getParent())
    if fs.exists(b):  # else an earlier swap died between its renames, and the old one is all there is
        fs.delete(old, True)
        fs.rename(b, old)
    if not fs.rename(a, b):
        raise OSError(f"could not move {source} to {target}")
    fs.delete(old, True)


def write_months(df: DataFrame, path: str, month: Column, order: Column, format: str = "json") -> None:
    """df as month=<yyyy-MM> folders; a month's rows stand in order over as many files as its size asks for."""
    dealt = textual(df.withColumn("month", month).withColumn("__order", order)).repartitionByRange("month", "__order").sortWithinPartitions("month", "__order").drop("__order")
    dealt.write.mode("overwrite").partitionBy("month").option("ignoreNullFields", False).format(format).save(path)


def rewrite(df: DataFrame, path: str, month: Column, order: Column, format: str = "json") -> None:
    """df as month=<yyyy-MM> folders, sorted inside; months that df no longer has are gone after it."""
    path = path.rstrip("/")
    write_months(df, path + ".new", month, order, format)
    _move(df.sparkSession, path + ".new", path)


def rewrite_months(df: DataFrame, path: str, month: Column, order: Column, months: list[str], format: str = "json") -> None:
    """Only the given months of the data set, from df, which has all their rows; the other months stay as they are."""
    path, spark = path.rstrip("/"), df.sparkSession
    write_months(df, path + ".new", month, order, format)
    for name in months:
        made, target = f"{path}.new/month={name}", f"{path}/month={name}"
        if _path(spark, made)[1].exists(_path(spark, made)[0]):
            _move(spark, made, target)
        else:
            remove(spark, target)
    remove(spark, path + ".new")


def post_month() -> Column:
    """The month folder of a post; those without a time share one."""
    return F.coalesce(month_of(F.col("created_at_utc")), F.lit("unknown"))


def _as_version(posts: DataFrame, root: str, months: list[str] | None) -> None:
    batch = store.Batch(posts.sparkSession, root, f"posts-{uuid.uuid4().hex}")
    batch.replace_months(months, lambda path: write_months(posts, path, post_month(), F.col("ts_id").cast("bigint")))
    batch.commit({})


def save_posts(posts: DataFrame, root: str) -> None:
    """All records: a version where the data set has versions, else a plain folder."""
    if store.numbers(posts.sparkSession, root):
        _as_version(posts, root, None)
    else:
        rewrite(posts, f"{root}/posts", post_month(), F.col("ts_id").cast("bigint"))


def save_posts_of(posts: DataFrame, root: str, months: list[str]) -> None:
    """Only the given months, from posts, which has all their rows; the others stay as they are."""
    if store.numbers(posts.sparkSession, root):
        _as_version(posts, root, months)
    else:
        rewrite_months(posts, f"{root}/posts", post_month(), F.col("ts_id").cast("bigint"), months)


def append_log(rows: DataFrame, path: str) -> None:
    """Deletion events, run rows: appended as JSON lines."""
    textual(rows).write.mode("append").option("ignoreNullFields", False).json(path)


def append_engagement(rows: DataFrame, root: str) -> None:
    write_engagement(rows, f"{root}/engagement")


def write_engagement(rows: DataFrame, path: str) -> None:
    """Snapshots by month of observation, CSV with header, blank for null.

    A month lies in as many files as its size asks for.  Those of a post at one
    instant are in one file, in order of ingest, so readers find the last.
    """
    order = F.col("ingest_seq") if "ingest_seq" in rows.columns else F.monotonically_increasing_id()
    some = rows.withColumns({"month": month_of(F.col("observed_at")), "__order": order})
    dealt = some.repartitionByRange("month", "observed_at", "ts_id").sortWithinPartitions("month", "__order").drop("__order", "ingest_seq")
    textual(dealt).write.mode("append").partitionBy("month").option("header", True).option("nullValue", "").csv(path)


def save_state(state: dict, path: str) -> None:
    with open(path + ".new", "w", encoding="utf-8") as f:
        json.dump(state, f, indent=2, sort_keys=True)
    os.replace(path + ".new", path)


def export_posts(posts: DataFrame, path: str) -> None:
    """CSV, 22 columns, in order of id: one file of a small archive, of a large one several, whose names are in order too."""
    some = derived(posts).withColumn("seen_sources", F.array_join("seen_sources", "|")).orderBy(F.col("ts_id").cast("bigint")).select(*EXPORT_COLUMNS)
    textual(some).write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)


def export_json(value, path: str) -> None:
    with open(path, "w", encoding="utf-8") as f:
        json.dump(value, f, indent=2, ensure_ascii=False, default=str)
