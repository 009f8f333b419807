"""Integrity checks: one row for each violation, and the statistics beside them.

Each check is a query for its violations; ``run`` unites them as (severity,
code, ts_id, detail).  A data set is sound if no row is hard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions.times import epoch_micros, month_of, to_iso
from tidelog.operators.sequences import spike_days
from tidelog.schema import DEFAULT_SOURCE, FIELDS, KINDS, MEDIA_ITEM, SOURCES, STATUSES

TS_ID = r"^\d{18}$"
ISO_Z = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"
ISO_OFFSET = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}[+-]\d{2}:\d{2}$"
REQUIRED_INSTANTS = ("created_at_utc", "first_seen_at", "updated_at")
OPTIONAL_INSTANTS = ("edited_at", "last_verified_live_at", "deleted_lower", "deleted_upper", "tracker_captured_at", "tracker_removed_at")
SAMPLE = 10


def _rows(df: DataFrame, severity: str, code: str, ts_id: Column, *detail: Column) -> DataFrame:
    return df.select(F.lit(severity).alias("severity"), F.lit(code).alias("code"), ts_id.cast("string").alias("ts_id"), F.concat_ws(",", *[d.cast("string") for d in detail]).alias("detail"))


def schema_violations(lines: DataFrame) -> DataFrame:
    """(severity, code, ts_id, detail) of raw JSON lines (column ``line``); a record that lacks fields is not looked at further."""
    v = F.try_parse_json("line")
    get = lambda path, kind="string": F.try_variant_get("v", f"$.{path}", kind)
    kind_of = lambda path: F.schema_of_variant(F.try_variant_get("v", f"$.{path}", "variant"))
    some = lines.select("line", v.alias("v")).withColumn("keys", F.coalesce(F.json_object_keys("line"), F.array().cast("array<string>"))).withColumn("id", get("ts_id"))
    lacking = F.array_except(F.array(*[F.lit(f) for f in FIELDS]), F.col("keys"))
    bad: list[tuple[str, Column, Column]] = [
        ("bad_ts_id", ~F.coalesce(F.col("id").rlike(TS_ID), F.lit(False)), F.col("id")),
        ("bad_kind", ~F.coalesce(get("kind").isin(*KINDS), F.lit(False)), get("kind")),
        ("bad_status", ~F.coalesce(get("status").isin(*STATUSES), F.lit(False)), get("status")),
        ("bad_et_hour", ~F.coalesce(get("et_hour", "int").between(0, 23), F.lit(False)), get("et_hour")),
        ("bad_et_dow", ~F.coalesce(get("et_dow", "int").between(0, 6), F.lit(False)), get("et_dow")),
        ("bad_pinned", ~F.coalesce(kind_of("pinned") == "BOOLEAN", F.lit(False)), get("pinned")),
        ("bad_media", ~F.coalesce(kind_of("media").startswith("ARRAY"), F.lit(False)), F.lit("media")),
        ("bad_field_sources", ~F.coalesce(kind_of("field_sources").startswith("OBJECT"), F.lit(False)), F.lit("field_sources")),
    ]
    bad += [("bad_timestamp", ~F.coalesce(get(f).rlike(ISO_Z), F.lit(False)), F.lit(f)) for f in REQUIRED_INSTANTS]
    bad += [("bad_timestamp", get(f).isNotNull() & ~get(f).rlike(ISO_Z), F.lit(f)) for f in OPTIONAL_INSTANTS]
    bad += [("bad_timestamp", ~F.coalesce(get("created_at_et").rlike(ISO_OFFSET), F.lit(False)), F.lit("created_at_et"))]
    items = F.from_json(F.get_json_object("line", "$.media"), "array<string>")
    names = F.sort_array(F.array(*[F.lit(n) for n in MEDIA_ITEM.fieldNames()]))
    bad += [("bad_media_item", F.exists(F.coalesce(items, F.array().cast("array<string>")), lambda x: ~F.coalesce(F.sort_array(F.json_object_keys(x)) == names, F.lit(False))), F.lit("media"))]
    sources = F.from_json(F.get_json_object("line", "$.field_sources"), "map<string,string>")
    bad += [
        ("bad_field_sources_key", F.size(F.array_except(F.map_keys(sources), F.array(*[F.lit(f) for f in FIELDS]))) > 0, F.lit("field_sources")),
        ("bad_field_sources_value", F.size(F.array_except(F.map_values(sources), F.array(*[F.lit(s) for s in SOURCES]))) > 0, F.lit("field_sources")),
    ]
    full = F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.struct(F.lit(code).alias("code"), d.cast("string").alias("detail"))) for code, c, d in bad]), lambda x: x.isNotNull())
    found = F.when(F.size(lacking) > 0, F.array(F.struct(F.lit("missing_fields").alias("code"), F.array_join(lacking, ",").alias("detail")))).otherwise(full)
    return some.select("id", F.explode(found).alias("x")).select(F.lit("hard").alias("severity"), F.col("x.code").alias("code"), F.col("id").alias("ts_id"), F.col("x.detail").alias("detail"))


def wrong_month(posts: DataFrame) -> DataFrame:
    """posts with ``file_month``: records in another month's file."""
    month = month_of(F.col("created_at_utc"))
    return _rows(posts.filter(month != F.col("file_month")), "hard", "wrong_month_file", F.col("ts_id"), F.col("file_month"), month)


#: Lines of a slice of a file, as a power of two.
LINES = 16


def unsorted_files(posts: DataFrame, lines: int = LINES) -> DataFrame:
    """posts with ``file`` (by default the month), ``file_month`` and ``line_no``: files whose ids do not ascend.

    Order is looked at inside slices of a file, then between the last line of a
    slice and the first of the next; no task has a whole file.
    """
    by = "file" if "file" in posts.columns else "file_month"
    named = list(dict.fromkeys((by, "file_month")))
    number, order = F.col("ts_id").try_cast("bigint"), Window.partitionBy(by, "__slice").orderBy("line_no")
    rows = posts.select(*named, "line_no", number.alias("n"), F.shiftright(F.col("line_no").cast("bigint"), lines).alias("__slice"))
    inside = rows.withColumn("p", F.lag("n").over(order)).filter(F.col("n").isNull() | (F.col("n") < F.col("p"))).select(*named)
    edges = rows.groupBy(*named, "__slice").agg(F.min_by("n", "line_no").alias("first"), F.max_by("n", "line_no").alias("last"))
    between = edges.withColumn("p", F.lag("last").over(Window.partitionBy(by).orderBy("__slice"))).filter(F.col("first") < F.col("p")).select(*named)
    return _rows(inside.unionByName(between).distinct(), "hard", "unsorted_file", F.lit(None), F.col("file_month"))


def duplicate_keys(df: DataFrame, keys: list[str], code: str = "duplicate_id", severity: str = "hard", listed: str | None = None) -> DataFrame:
    extra = [F.array_join(F.array_sort(F.collect_list(F.col(listed).cast("string"))), ",").alias("l")] if listed else []
    found = df.groupBy(*keys).agg(F.count("*").alias("n"), *extra).filter("n > 1")
    return _rows(found, severity, code, F.col(keys[0]), *[F.col(k) for k in keys[1:]], F.col("l") if listed else F.col("n"))


def unknown_keys(df: DataFrame, posts: DataFrame, key: str, code: str, detail: str) -> DataFrame:
    return _rows(df.join(posts.select(key), key, "left_anti"), "hard", code, F.col(key), F.col(detail))


def created_after_upper(posts: DataFrame) -> DataFrame:
    return _rows(posts.filter(F.col("created_at_utc") > F.col("deleted_upper")), "hard", "created_after_deleted_upper", F.col("ts_id"), F.col("created_at_utc"), F.col("deleted_upper"))


def inverted_bounds(posts: DataFrame) -> DataFrame:
    return _rows(posts.filter(F.col("deleted_lower") > F.col("deleted_upper")), "soft", "inverted_deletion_bounds", F.col("ts_id"), F.col("deleted_lower"), F.col("deleted_upper"))


def too_close(engagement: DataFrame, key: str = "ts_id", at: str = "observed_at", seconds: int = 3600) -> DataFrame:
    """Snapshots of a post less than the time after the one before."""
    order = Window.partitionBy(key).orderBy(at)
    both = engagement.filter(F.col(at).isNotNull()).withColumn("__p", F.lag(at).over(order)).filter(F.col("__p").isNotNull())
    near = both.filter(epoch_micros(F.col(at)) - epoch_micros(F.col("__p")) < seconds * 1_000_000)
    return _rows(near, "hard", "engagement_too_close", F.col(key), F.col("__p"), F.col(at))


def _age_seconds(now: Column) -> Column:
    return (epoch_micros(now) - epoch_micros(F.col("created_at_utc"))) / 1_000_000


def single_source_recent(posts: DataFrame, now: Column, low_s: int = 86_400, high_s: int = 30 * 86_400) -> DataFrame:
    """Ids of posts one to thirty days old that one source alone has seen."""
    age = _age_seconds(now)
    return posts.filter((F.size("seen_sources") == 1) & (age > low_s) & (age <= high_s)).select("ts_id")


def ambiguous_handles(posts: DataFrame) -> DataFrame:
    """Ids of reblogs whose account the bulk source alone names and whose text goes on with a word character."""
    return posts.filter((F.col("kind") == "reblog") & (F.col("field_sources")["reblog_of_acct"] == DEFAULT_SOURCE) & F.col("content_text").rlike(r"(?U)^\w")).select("ts_id")


def drift(posts: DataFrame, code: str, expected: int, statuses: tuple[str, ...], share: bool) -> DataFrame:
    """A row if the number of posts of the statuses is off by more than 50 (or, with share, 1 % if that is more)."""
    n = posts.agg(F.count_if(F.col("status").isin(*statuses)).alias("n"))
    limit = max(50, expected // 100) if share else 50
    return _rows(n.filter(F.abs(F.col("n") - expected) > limit), "soft", code, F.lit(None), F.col("n"), F.lit(expected))


def _sampled(ids: DataFrame, code: str) -> DataFrame:
    """One row with the count and the first ids; none without ids."""
    n = ids.agg(F.count("*").alias("n"))
    few = ids.orderBy("ts_id").limit(SAMPLE).agg(F.array_join(F.array_sort(F.collect_list("ts_id")), ", ").alias("ids"))
    return _rows(n.filter("n > 0").join(F.broadcast(few)), "soft", code, F.lit(None), F.col("n"), F.col("ids"))


def _dealt(df: DataFrame, *columns: str) -> DataFrame:
    """Columns of df dealt by ts_id to so many tasks, whatever their bytes: ids pack well, and adaptive execution would give the parts of a union by packed size, many millions of ids to one task."""
    return df.select("ts_id", *columns).repartition(4 * df.sparkSession.sparkContext.defaultParallelism, "ts_id")


def run(posts: DataFrame, deletion_log: DataFrame, engagement: DataFrame, runs: DataFrame, now: Column, *, lines: DataFrame | None = None, filed: DataFrame | None = None, run_id: str | None = None, statuses_count: int | None = None, tracker_total: int | None = None) -> DataFrame:
    """All violations.  lines: raw JSON lines; filed: posts with file_month and line_no."""
    ids, logged, shots = _dealt(posts), _dealt(deletion_log, "source"), _dealt(engagement, "observed_at")
    found = [
        duplicate_keys(_dealt(filed, "file_month"), ["ts_id"], listed="file_month") if filed is not None else duplicate_keys(ids, ["ts_id"]), created_after_upper(posts), inverted_bounds(posts),
        unknown_keys(logged, ids, "ts_id", "deletion_unknown_post", "source"), duplicate_keys(logged, ["ts_id", "source"], "duplicate_deletion_event"),
        unknown_keys(shots, ids, "ts_id", "engagement_unknown_post", "observed_at"), too_close(shots),
        _sampled(single_source_recent(posts, now), "single_source_recent_posts"),
    ]
    newest = posts.agg(F.max("created_at_utc").alias("created_at_utc"))
    found.append(_rows(newest.filter(_age_seconds(now) > 12 * 3600), "soft", "stale_newest_post", F.lit(None), to_iso(F.col("created_at_utc"))))
    found.append(_rows(spike_days(posts, since=F.date_sub(now.cast("date"), 60)), "soft", "spike_days", F.lit(None), F.col("et_date"), F.col("count")))
    if lines is not None:
        found.append(schema_violations(lines))
    if filed is not None:
        found += [wrong_month(filed), unsorted_files(filed)]
    if run_id is not None:
        there = runs.filter(F.col("run_id") == run_id).agg(F.count("*").alias("n"))
        found.append(_rows(there.filter("n = 0"), "hard", "missing_run_row", F.lit(None), F.lit(run_id)))
    if statuses_count is not None:
        found.append(drift(posts, "present_count_drift", statuses_count, ("present",), True))
    if tracker_total is not None:
        found.append(drift(posts, "tracker_total_drift", tracker_total, STATUSES, False))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def stats(posts: DataFrame, deletion_log: DataFrame, engagement: DataFrame) -> DataFrame:
    """(name, value, n): counts by status, kind and source combination, and totals."""
    def counted(name: str, c: Column) -> DataFrame:
        return posts.groupBy(F.coalesce(c.cast("string"), F.lit("")).alias("value")).agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "value", "n")

    whole = lambda name, df: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), F.lit("").alias("value"), "n")
    return (
        counted("by_status", F.col("status")).unionByName(counted("by_kind", F.col("kind"))).unionByName(counted("by_source_combination", F.array_join(F.array_sort("seen_sources"), ",")))
        .unionByName(counted("months_present", month_of(F.col("created_at_utc")))).unionByName(whole("posts", posts)).unionByName(whole("deletions", deletion_log)).unionByName(whole("engagement_rows", engagement))
        .unionByName(ambiguous_handles(posts).agg(F.count("*").alias("n")).select(F.lit("ambiguous_handles").alias("name"), F.lit("").alias("value"), "n"))
    )
