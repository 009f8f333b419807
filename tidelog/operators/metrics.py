"""Parameterised metrics over v_posts_et and its companions; each is one DataFrame.

``start`` and ``end`` are days (columns, dates or ISO strings), both included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions.texts import snippet
from tidelog.schema import KINDS

DAY_COUNTS = (*KINDS, "total", "deleted")


def day(value) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def between(view: DataFrame, start, end) -> DataFrame:
    """Rows of the days; the predicate reaches the scan where et_date is stored."""
    return view.filter(F.col("et_date").between(day(start), day(end)))


def _day_counts() -> list[Column]:
    return [F.count_if(F.col("kind") == k).alias(k) for k in KINDS] + [F.count("*").alias("total"), F.sum("is_deleted").cast("bigint").alias("deleted")]


def volume_by_day(view: DataFrame) -> DataFrame:
    """Counts by kind for the days there are."""
    return view.groupBy("et_date").agg(*_day_counts())


def posts_by_day(view: DataFrame, start, end) -> DataFrame:
    """The same for every day from start to end, with zeros; other kinds count in total only."""
    calendar = view.sparkSession.range(1).select(F.explode(F.sequence(day(start), day(end), F.expr("interval 1 day"))).alias("et_date"))
    found = calendar.join(volume_by_day(between(view, start, end)), "et_date", "left")
    return found.select("et_date", *[F.coalesce(c, F.lit(0)).alias(c) for c in DAY_COUNTS])


def hours(view: DataFrame) -> DataFrame:
    """Posts by hour, hours without posts left out."""
    return view.groupBy("et_hour").agg(F.count("*").alias("n"))


def hour_histogram(view: DataFrame, start, end) -> DataFrame:
    """Posts for each of the 24 hours."""
    clock = view.sparkSession.range(24).select(F.col("id").cast("int").alias("et_hour"))
    return clock.join(hours(between(view, start, end)), "et_hour", "left").select("et_hour", F.coalesce("n", F.lit(0)).alias("n"))


def overnight_share(view: DataFrame, start=None, end=None) -> DataFrame:
    """overnight, total, share (null without posts); hours 0 to 5.

    Without a range, as saved SQL has it, overnight is null without posts.
    """
    some = view if start is None else between(view, start, end)
    night = F.sum(F.when(F.col("et_hour").between(0, 5), 1).otherwise(0)).cast("bigint")
    if start is not None:
        night = F.coalesce(night, F.lit(0).cast("bigint"))
    return some.agg(night.alias("overnight"), F.count("*").alias("total")).withColumn("share", F.try_divide(F.col("overnight"), F.col("total")))


def kinds_mix(view: DataFrame) -> DataFrame:
    return view.groupBy("kind").agg(F.count("*").alias("n"), F.sum("is_deleted").cast("bigint").alias("deleted")).orderBy(F.col("n").desc(), "kind")


def top_accounts(view: DataFrame, n: int = 10, kind: str = "reblog", column: str = "reblog_of_acct") -> DataFrame:
    found = view.filter((F.col("kind") == kind) & F.col(column).isNotNull()).groupBy(F.col(column).alias("account")).agg(F.count("*").alias("n"))
    return found.orderBy(F.col("n").desc(), "account").limit(n)


def link_domains(view: DataFrame, n: int = 10) -> DataFrame:
    found = view.filter(F.col("card_domain").isNotNull() & (F.col("card_domain") != "")).groupBy(F.col("card_domain").alias("domain")).agg(F.count("*").alias("n"))
    return found.orderBy(F.col("n").desc(), "domain").limit(n)


def media_items(view: DataFrame, media: DataFrame) -> DataFrame:
    """Media items by type, and posts without any as no_media_posts."""
    items = media.groupBy("type").agg(F.count("*").alias("n"))
    return items.unionByName(view.filter("media_count = 0").agg(F.lit("no_media_posts").alias("type"), F.count("*").alias("n")))


def media_sets(view: DataFrame) -> DataFrame:
    """no_media, image_only, video_only, mixed: posts by the set of their media types."""
    kinds = F.array_distinct(F.filter(F.split("media_types", ","), lambda t: t != ""))
    only = lambda t: (F.size(kinds) == 1) & (F.get(kinds, F.lit(0)) == t)
    group = F.when(F.coalesce("media_count", F.lit(0)) == 0, "no_media").when(only("image"), "image_only").when(only("video"), "video_only").otherwise("mixed")
    return view.select(group.alias("g")).agg(*[F.count_if(F.col("g") == g).alias(g) for g in ("no_media", "image_only", "video_only", "mixed")])


def media_items_between(view: DataFrame, media: DataFrame, start, end) -> DataFrame:
    return media.join(between(view, start, end).select("ts_id"), "ts_id").groupBy("type").agg(F.count("*").alias("n"))


def engagement_stats(view: DataFrame, latest: DataFrame, values=("favourites", "reblogs", "replies")) -> DataFrame:
    """By kind: n, and nearest-rank median and 90th percentile of each value, nulls left out.

    Ranks are looked up in running counts of the values, which are combined map-side; no state holds a kind's values.
    """
    both = view.select("ts_id", "kind").join(latest.select("ts_id", *values), "ts_id")
    each = both.select("kind", F.explode(F.array(*[F.struct(F.lit(v).alias("name"), F.col(v).alias("value")) for v in values])).alias("x"))
    counts = each.groupBy("kind", "x.name", "x.value").agg(F.count("*").alias("k"))
    known, group = F.when(F.col("value").isNotNull(), F.col("k")), Window.partitionBy("kind", "name")
    counts = counts.withColumns({"n": F.sum("k").over(group), "some": F.sum(known).over(group), "upto": F.sum(known).over(group.orderBy("value").rowsBetween(Window.unboundedPreceding, 0))})
    first = lambda v, p: F.min(F.when((F.col("name") == v) & F.col("value").isNotNull() & (10 * F.col("upto") >= p * F.col("some")), F.col("value")))
    found = [first(v, p).alias(f"{v}_{name}") for v in values for name, p in (("median", 5), ("p90", 9))]
    return counts.groupBy("kind").agg(F.max("n").alias("n"), *found)


def engagement_tiles(view: DataFrame, latest: DataFrame, value: str = "favourites") -> DataFrame:
    """By kind: n and the first value in the 50th and 90th of a hundred tiles; null where a group has fewer rows.

    ntile deals n rows into 100 tiles, the first n % 100 one larger, so the
    first row of a tile has a known rank.  It is looked up in running counts of
    the values, which are combined map-side; no window holds a kind's rows.
    """
    both = view.select("ts_id", "kind").join(latest.select("ts_id", value), "ts_id").filter(F.col(value).isNotNull())
    counts = both.groupBy("kind", value).agg(F.count("*").alias("k"))
    kind = Window.partitionBy("kind")
    counts = counts.withColumns({"n": F.sum("k").over(kind), "upto": F.sum("k").over(kind.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))})
    start = lambda p: 1 + (p - 1) * F.floor(F.col("n") / 100) + F.least(F.lit(p - 1), F.col("n") % 100)
    first = lambda p: F.min(F.when(F.col("upto") >= start(p), F.col(value)))
    return counts.groupBy("kind").agg(F.max("n").alias("n"), first(50).alias(f"{value}_p50"), first(90).alias(f"{value}_p90"))


def deletion_listing(gone: DataFrame, start=None, end=None) -> DataFrame:
    """Deleted posts with lifetime, window and snippet; between two days oldest first with '' for a missing text."""
    some = gone if start is None else between(gone, start, end)
    order = F.col("created_at_utc").desc() if start is None else F.col("created_at_utc").asc()
    text = snippet(F.col("content_text"), empty=start is not None)
    return some.orderBy(order, "ts_id").select("ts_id", "created_at_et", "kind", "deleted_source", "lifetime_min", "deletion_window_min", text.alias("snippet"))


def edits(view: DataFrame, start, end) -> DataFrame:
    return between(view, start, end).filter(F.col("edited_at").isNotNull()).orderBy("created_at_utc", "ts_id").select("ts_id", "created_at_et", "kind", "edited_at")


def trailing_bounds(start, weeks: int = 8) -> tuple[Column, Column]:
    """The weeks before start: (first day, last day)."""
    last = F.date_sub(day(start), 1)
    return F.date_sub(day(start), weeks * 7), last


def trailing_baseline(view: DataFrame, start, end, weeks: int = 8) -> DataFrame:
    """One row: posts in the window, in the weeks before, and their weekly average; one scan."""
    a, b = trailing_bounds(start, weeks)
    inside, before = F.col("et_date").between(day(start), day(end)), F.col("et_date").between(a, b)
    found = view.filter(F.col("et_date").between(a, day(end))).agg(F.count_if(inside).alias("window_total"), F.count_if(before).alias("trailing_total"))
    return found.withColumn("trailing_weekly_avg", F.col("trailing_total") / F.lit(float(weeks)))


def source_combinations(posts: DataFrame, joiner: str = ",") -> DataFrame:
    return posts.groupBy(F.array_join(F.array_sort("seen_sources"), joiner).alias("sources")).agg(F.count("*").alias("n"))


def run_totals(runs: DataFrame, run_id: str) -> DataFrame:
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c)
    return runs.filter(F.col("run_id") == run_id).agg(total("new_posts"), total("deletions_found"))
