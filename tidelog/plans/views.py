"""The relations that queries are written against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.functions.times import minutes_between
from tidelog.operators.sequences import with_previous

VIEW_COLUMNS = (
    "ts_id", "created_at_utc", "created_at_et", "et_date", "et_hour", "et_dow", "kind", "status", "is_deleted", "content_text", "content_len",
    "media_count", "media_types", "card_domain", "card_url", "reblog_of_acct", "reblog_of_id", "quote_of_acct", "quote_id", "mentions", "tags",
    "edited_at", "deleted_lower", "deleted_upper", "deleted_source", "lifetime_min", "deletion_window_min", "first_seen_source", "seen_sources",
)


def derived(posts: DataFrame) -> DataFrame:
    """posts with media_count, media_types (joined by comma) and content_len."""
    return posts.withColumns({
        "media_count": F.coalesce(F.size("media"), F.lit(0)),
        "media_types": F.array_join(F.transform(F.coalesce("media", F.array().cast(posts.schema["media"].dataType)), lambda m: F.coalesce(m["type"], F.lit(""))), ","),
        "content_len": F.length(F.coalesce("content_text", F.lit(""))),
    })


def deletion_columns(df: DataFrame) -> DataFrame:
    """Adds is_deleted, lifetime_min (deleted posts only) and deletion_window_min (also of resurrected ones)."""
    gone = F.col("status") == "deleted"
    return df.withColumns({
        "is_deleted": F.when(gone, 1).otherwise(0),
        "lifetime_min": F.when(gone, minutes_between(F.col("created_at_utc"), F.col("deleted_upper"))),
        "deletion_window_min": minutes_between(F.col("deleted_lower"), F.col("deleted_upper")),
    })


def posts_et(posts: DataFrame) -> DataFrame:
    return deletion_columns(derived(posts)).select(*VIEW_COLUMNS)


def deletions(view: DataFrame) -> DataFrame:
    return view.filter("is_deleted = 1")


def media_rows(posts: DataFrame) -> DataFrame:
    """A row for each media item: ts_id, idx and the item's fields."""
    return posts.select("ts_id", F.posexplode("media").alias("idx", "m")).select("ts_id", "idx", "m.*")


def engagement_latest(engagement: DataFrame, key: str = "ts_id", at: str = "observed_at", seq: str = "ingest_seq") -> DataFrame:
    """The last snapshot of each post; of several at one instant the one ingested last.

    One partial aggregation: no sort, and a hot post is combined map-side.
    """
    rest = [c for c in engagement.columns if c != key]
    last = F.max_by(F.struct(*rest), F.struct(at, seq))
    return engagement.groupBy(key).agg(last.alias("r")).select(key, *[f"r.{c}" for c in rest])


def engagement_latest_ranked(engagement: DataFrame) -> DataFrame:
    """The same by row_number, as saved SQL writes it."""
    order = Window.partitionBy("ts_id").orderBy(F.col("observed_at").desc(), F.col("ingest_seq").desc())
    return engagement.withColumn("rn", F.row_number().over(order)).filter("rn = 1").drop("rn")


#: A view that costs a pass over the posts before anything is asked of it.
PREVIOUS = "v_posts_previous"


def register_previous(spark: SparkSession) -> DataFrame:
    """v_posts_previous, over v_posts_et as it is now: the time of the post before each post, without a window over the whole time line."""
    found = with_previous(spark.table("v_posts_et"), "created_at_utc", "ts_id", "created_at_utc", "created_at_et")
    found.createOrReplaceTempView(PREVIOUS)
    return found


class Relations(dict):
    """Relations by name."""

    def __missing__(self, name: str) -> DataFrame:
        if name != PREVIOUS:
            raise KeyError(name)
        return self.setdefault(name, register_previous(self["v_posts_et"].sparkSession))


def register(spark: SparkSession, posts: DataFrame, engagement: DataFrame, deletion_log: DataFrame, runs: DataFrame) -> dict[str, DataFrame]:
    """All relations as temporary views, by the names that saved SQL uses; v_posts_previous is made when it is asked for."""
    full = derived(posts)
    view = posts_et(posts)
    if "ingest_seq" not in engagement.columns:
        engagement = engagement.withColumn("ingest_seq", F.monotonically_increasing_id())
    found = Relations({
        "posts": full, "media": media_rows(posts), "engagement": engagement, "deletions": deletion_log, "runs": runs,
        "v_posts_et": view, "v_deletions": deletions(view), "v_engagement_latest": engagement_latest(engagement),
    })
    for name, df in found.items():
        df.createOrReplaceTempView(name)
    return found
