"""Registered queries of stored state, payloads, files and streams over the driver's tables.

Inputs are derived from events, orders and documents; files and streams are
written to a scratch folder that driver and executors share and read back.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog import cli, collect, report
from tidelog.adapters import event_observations, event_posts, event_snapshots, spread, table
from tidelog.functions import texts, times
from tidelog.operators import checks, merge, throttle
from tidelog.plans import functions, views
from tidelog.registry import _B, _ISO, _LAG, _MIN, _S, _SIG, _V, _event_merge, _minutes, _text, query
from tidelog.schema import ENGAGEMENT, FIELDS, MEDIA, OBSERVATION, POST, RUN
from tidelog.sources import json_array, landed, sinks, store, tracker_html
from tidelog.streaming import keyed, micro


def _observed(rows: DataFrame, given: dict) -> DataFrame:
    """rows as observations: the given fields, null for the rest."""
    return rows.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in OBSERVATION.fields])


def _signals(rows: DataFrame, **more) -> DataFrame:
    """Observations of users as the registry's merge has them: tracker rows with k < 20 are removals, primary ones with k < 10 missing posts."""
    removed = (F.col("source") == "tracker") & (F.col("k") < 20)
    return _observed(rows, {
        "ts_id": F.col("user_id").cast("string"), "source": F.col("source"), "observed_at": F.col("observed_at"), "run_id": F.lit("r"), "seq": F.col("seq"), "removed": removed,
        "gone": (F.col("source") == "primary") & (F.col("k") < 10), "kind": F.col("value"), "tracker_removed_at": F.when(removed, F.col("observed_at")),
        "created_at_utc": F.lit("2023-12-31 00:00:00").cast("timestamp_ntz"),
    } | more)


def _no_posts(spark) -> DataFrame:
    return spark.createDataFrame([], POST)


def _instants(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: times.to_iso(F.col(c)) for c in columns})


# -- merge into stored records -----------------------------------------------

_STATE = f"""SELECT CAST(user_id AS VARCHAR) AS ts_id, coalesce(arg_max(CASE WHEN signal THEN 'deleted' ELSE 'present' END, seq) FILTER (signal OR live),
  'present') AS status,
  arg_min(CASE WHEN source = 'tracker' THEN 'tracker' ELSE 'gone' END, seq) FILTER (signal) AS deleted_source,
  {_ISO.format("max(observed_at) FILTER (live)")} AS last_verified_live_at,
  {_ISO.format("max(greatest(coalesce(seen, TIMESTAMP '2023-12-31'), TIMESTAMP '2023-12-31')) FILTER (signal)")} AS deleted_lower,
  {_ISO.format("min(observed_at) FILTER (signal)")} AS deleted_upper,
  {_ISO.format("arg_min(observed_at, seq)")} AS first_seen_at, arg_min(source, seq) AS first_seen_source, array_to_string(list_sort(list(DISTINCT
  source)), ',') AS seen_sources,
  arg_max(value, {{'r': rank, 'q': seq}}) FILTER (value <> '') AS kind
FROM (SELECT *, max(CASE WHEN live THEN observed_at END) OVER (PARTITION BY user_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS
  seen FROM q) GROUP BY user_id"""


@query(_SIG + " " + _STATE)
def merge_into_stored_records(spark, d):
    """Three batches, each merged into what the ones before left, give what one batch gives."""
    rows = event_observations(spark, d)
    posts, events = _no_posts(spark), None
    for low, high in ((0, 300), (300, 700), (700, 1 << 40)):
        done = merge.merge(posts, _signals(rows.filter((F.col("seq") >= low) & (F.col("seq") < high))), events)
        posts = done.posts.drop("changed", "is_new")
        events = done.events if events is None else events.unionByName(done.events)
    some = posts.select("ts_id", "status", "deleted_source", "last_verified_live_at", "deleted_lower", "deleted_upper", "first_seen_at", "first_seen_source", F.array_join("seen_sources", ",").alias("seen_sources"), "kind")
    return _instants(some, "last_verified_live_at", "deleted_lower", "deleted_upper", "first_seen_at")


@query(_SIG + """, n AS (SELECT *, row_number() OVER (PARTITION BY user_id, source ORDER BY seq) AS nth FROM q WHERE signal)
SELECT CAST(user_id AS VARCHAR) AS ts_id, source, strftime(observed_at, '%Y-%m-%dT%H:%M:%SZ') AS detected_at FROM n WHERE nth = 1 AND NOT (source =
  'tracker' AND user_id % 2 = 0)""")
def merge_events_not_logged(spark, d):
    """Deletion events of posts and sources that the log has already are no events."""
    rows = event_observations(spark, d)
    logged = rows.filter("user_id % 2 = 0").select(F.col("user_id").cast("string").alias("ts_id"), F.lit("tracker").alias("source")).distinct()
    return _instants(merge.merge(_no_posts(spark), _signals(rows), logged).events.select("ts_id", "source", "detected_at"), "detected_at")


@query("""SELECT count(DISTINCT user_id) AS posts, CAST(0 AS BIGINT) AS changed, CAST(0 AS BIGINT) AS fresh, count(DISTINCT user_id) AS of_first_run FROM events""")
def merge_repeated_batch(spark, d):
    """The same sightings again: no record is new or changed, and the run that changed each stays."""
    rows = event_observations(spark, d).withColumn("k", F.greatest("k", F.lit(20)))  # none is a removal
    first = merge.merge(_no_posts(spark), _signals(rows)).posts.drop("changed", "is_new")
    again = merge.merge(first, _signals(rows.withColumn("seq", F.col("seq") + (1 << 40)), run_id=F.lit("r2"))).posts
    return again.agg(F.count("*").alias("posts"), F.count_if("changed").alias("changed"), F.count_if("is_new").alias("fresh"), F.count_if(F.col("updated_run_id") == "r").alias("of_first_run"))


@query("""WITH k AS (SELECT user_id, event_id, CAST(props->>'$.k' AS INTEGER) AS k, date_trunc('second', ts) AS t FROM events), u AS (SELECT user_id, bool_or(k
  % 10 = 0 AND event_id >= 500) AS moved, arg_max(t, event_id) FILTER (event_id >= 500) AS last FROM k GROUP BY 1)
SELECT CAST(user_id AS VARCHAR) AS ts_id, moved AS changed, CASE WHEN moved THEN 'late' ELSE 'early' END AS updated_run_id FROM u WHERE last IS NOT
  NULL AND user_id IN (SELECT user_id FROM k WHERE event_id < 500)""")
def merge_change_detection(spark, d):
    """Records that a later batch names: changed only where it brings a card title, whatever else it repeats."""
    rows = event_observations(spark, d)
    base = {"ts_id": F.col("user_id").cast("string"), "source": F.lit("bulk"), "observed_at": F.col("observed_at"), "seq": F.col("seq"), "kind": F.lit("original")}
    early = merge.merge(_no_posts(spark), _observed(rows.filter("seq < 500"), base | {"run_id": F.lit("early")})).posts.drop("changed", "is_new")
    late = _observed(rows.filter("seq >= 500"), base | {"run_id": F.lit("late"), "card_title": F.when(F.col("k") % 10 == 0, "t")})
    found = merge.merge(early, late).posts
    named = late.select("ts_id").distinct()
    return found.filter("not is_new").join(named, "ts_id", "left_semi").select("ts_id", "changed", "updated_run_id")


@query(_B + """, w AS (SELECT user_id, arg_max({'v': value, 's': source}, {'r': rank, 'q': seq}) FILTER (value <> '') AS k, arg_max(source, {'r': crank, 'q': seq})
  AS c FROM r GROUP BY 1)
SELECT CAST(user_id AS VARCHAR) AS ts_id, k.v AS kind, k.s AS kind_source, c AS created_source FROM w""")
def merge_field_sources(spark, d):
    src = lambda f: F.col("field_sources")[f]
    return _event_merge(spark, d).posts.select("ts_id", "kind", src("kind").alias("kind_source"), src("created_at_utc").alias("created_source"))


@query(_B + f"""SELECT CAST(user_id AS VARCHAR) AS ts_id, CAST(arg_max(seq, seq) FILTER (source = 'tracker' AND k % 4 <> 0) AS INTEGER) AS tracker_id,
  {_ISO.format("arg_max(observed_at, seq) FILTER (source = 'tracker' AND k % 3 <> 0)")} AS tracker_captured_at,
{_ISO.format("arg_min(observed_at, seq) FILTER (source = 'tracker' AND k < 20)")} AS tracker_removed_at, arg_max('raw' || seq, seq) FILTER (source =
  'primary' AND k % 2 = 0) AS raw_primary FROM r GROUP BY user_id""")
def merge_tracker_fields_and_raw(spark, d):
    """Tracker fields from tracker rows alone: number and capture of the latest, removal of the first; the raw payload from primary rows."""
    more = {"tracker_id": F.when(F.col("k") % 4 != 0, F.col("seq")), "tracker_captured_at": F.when(F.col("k") % 3 != 0, F.col("observed_at")), "raw_primary": F.when(F.col("k") % 2 == 0, F.concat(F.lit("raw"), "seq"))}
    found = merge.merge(_no_posts(spark), _signals(event_observations(spark, d), **more)).posts
    return _instants(found.select("ts_id", "tracker_id", "tracker_captured_at", "tracker_removed_at", "raw_primary"), "tracker_captured_at", "tracker_removed_at")


@query("""SELECT DISTINCT CAST(user_id AS VARCHAR) AS ts_id, '' AS content_html, '' AS content_text, false AS pinned, CAST(0 AS INTEGER) AS n_media, CAST(0 AS
  INTEGER) AS n_mentions, CAST(0 AS INTEGER) AS n_tags, CAST(NULL AS VARCHAR) AS lang, 'created_at_utc' AS known FROM events""")
def merge_defaults(spark, d):
    """What no observation gives has its default, and no source."""
    rows = event_observations(spark, d).withColumn("value", F.lit(None))
    found = merge.merge(_no_posts(spark), _signals(rows)).posts
    return found.select("ts_id", "content_html", "content_text", "pinned", F.size("media").alias("n_media"), F.size("mentions").alias("n_mentions"), F.size("tags").alias("n_tags"), "lang", F.array_join(F.map_keys("field_sources"), ",").alias("known"))


@query(_B + """, h AS (SELECT user_id, arg_max({'t': event_type || ' é… ' || k || ' <b>', 's': source}, {'r': rank, 'q': seq}) FILTER (source <> 'bulk' AND k % 3 <>
  0) AS html, arg_max('bulk ' || seq, seq) FILTER (source = 'bulk') AS plain
  FROM (SELECT r.*, event_type FROM r JOIN events ON seq = event_id) GROUP BY user_id)
SELECT CAST(user_id AS VARCHAR) AS ts_id, coalesce(html.t, plain, '') AS content_text FROM h""")
def merge_content(spark, d):
    """Text from the winning HTML with all its references decoded, else the best plain text."""
    rows = event_observations(spark, d).join(table(spark, d, "events").select(F.col("event_id").alias("seq"), "event_type"), "seq")
    html = F.concat(F.lit("<i>"), "event_type", F.lit(" &eacute;&hellip;</i> "), F.col("k").cast("string"), F.lit("&nbsp;&lt;b&gt;"))
    more = {"content_html": F.when((F.col("source") != "bulk") & (F.col("k") % 3 != 0), html), "content_text": F.when(F.col("source") == "bulk", F.concat(F.lit("bulk "), "seq"))}
    return merge.merge(_no_posts(spark), _signals(rows, **more)).posts.select("ts_id", "content_text")


@query(_B + """, m AS (SELECT *, CASE WHEN k % 3 = 0 THEN NULL ELSE k END AS width, rank >= coalesce(max(rank) OVER (PARTITION BY user_id ORDER BY seq ROWS BETWEEN
  UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM r WHERE k % 5 <> 0)
SELECT CAST(user_id AS VARCHAR) AS ts_id, arg_max('u' || seq, seq) FILTER (ahead) AS url, CAST(coalesce(arg_max(width, seq) FILTER (ahead AND width IS
  NOT NULL), arg_min(width, seq) FILTER (width IS NOT NULL)) AS INTEGER) AS width, arg_max(source, seq) FILTER (ahead) AS media_source
FROM m GROUP BY user_id""")
def merge_media(spark, d):
    """Lists of one item: the best source's item stands, its null parts filled from the others."""
    null = F.lit(None)
    item = F.struct(F.lit("image").alias("type"), F.concat(F.lit("u"), "seq").alias("url"), null.alias("preview_url"), null.alias("mirror_url"), F.when(F.col("k") % 3 != 0, F.col("k")).alias("width"), null.alias("height"), null.alias("duration"))
    found = merge.merge(_no_posts(spark), _signals(event_observations(spark, d), media=F.when(F.col("k") % 5 != 0, F.array(item).cast(MEDIA)))).posts
    first = F.get("media", 0)
    return found.filter(F.size("media") > 0).select("ts_id", first["url"].alias("url"), first["width"].alias("width"), F.col("field_sources")["media"].alias("media_source"))


@query(_B + """, f AS (SELECT * FROM r WHERE value <> ''), w AS (SELECT *, max({'r': rank, 'q': seq, 's': source, 'v': value}) OVER (PARTITION BY user_id ORDER BY
  seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS h FROM f)
SELECT CAST(user_id AS VARCHAR) AS ts_id, seq, 'kind_disagreement' AS code, 'kind_disagreement:' || user_id || ':' || h.s || '=' || h.v || ',' ||
  source || '=' || value AS detail FROM w WHERE h.r > rank AND h.v <> value""")
def merge_disagreement_details(spark, d):
    return _event_merge(spark, d).anomalies.filter("code = 'kind_disagreement'").select("ts_id", "seq", "code", "detail")


@query(_B + """, f AS (SELECT *, TIMESTAMP '2024-01-01 00:00:00' + INTERVAL (k % 6) SECOND AS c FROM r), w AS (SELECT *,
  max({'r': crank, 'q': seq, 's': source, 'v': c}) OVER (PARTITION BY user_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS h FROM
  f)
SELECT CAST(user_id AS VARCHAR) AS ts_id, seq, h.s AS old_source, source AS new_source FROM w WHERE h.r > crank AND abs(epoch(h.v) - epoch(c)) > 2""")
def merge_created_tolerance(spark, d):
    """Times of creation that lose: up to two seconds apart is no disagreement."""
    from tidelog.schema import CREATED_RANK

    rows = event_observations(spark, d).withColumn("c", F.timestamp_add("SECOND", F.col("k") % 6, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")))
    rows = rows.withColumns({"ts_id": F.col("user_id").cast("string"), "crank": merge.rank_of(F.col("source"), CREATED_RANK)})
    return merge.disagreements(rows, ["ts_id"], "c", "source", "crank", "seq", tolerance_s=2.0).select("ts_id", "seq", "old_source", "new_source")


# -- engagement --------------------------------------------------------------


def _aged(days: int) -> str:
    """Snapshots in order of ingest, old from so many days after the first of their post on."""
    start = _S.replace("WITH s AS", "WITH RECURSIVE s AS")
    old = f"observed_at >= min(observed_at) OVER (PARTITION BY ts_id) + INTERVAL {days} DAY AS old"
    return start + f", o AS (SELECT s.*, row_number() OVER (PARTITION BY ts_id ORDER BY ingest_seq) AS rn, {old} FROM s),\n"


@query(_aged(21) + """a AS (SELECT ts_id, observed_at, ingest_seq, rn FROM o WHERE rn = 1 UNION ALL
  SELECT x.* FROM a, LATERAL (SELECT ts_id, observed_at, ingest_seq, rn FROM o WHERE o.ts_id = a.ts_id AND o.rn > a.rn AND NOT o.old AND o.observed_at
  >= a.observed_at + INTERVAL 1 HOUR ORDER BY o.rn LIMIT 1) x)
SELECT ts_id, count(*) AS kept, CAST(sum(ingest_seq) AS BIGINT) AS seqs FROM a GROUP BY 1""")
def throttle_by_age(spark, d):
    """An hour apart, and a post of fourteen days or more only if it has none; each post is born a week after its first snapshot."""
    rows = event_snapshots(spark, d)
    born = rows.groupBy("ts_id").agg(F.timestamp_add("DAY", F.lit(7), F.min("observed_at")).alias("born"))
    kept = throttle.keep(rows.join(born, "ts_id"), ["ts_id"], "observed_at", "ingest_seq", created="born")
    return kept.groupBy("ts_id").agg(F.count("*").alias("kept"), F.sum("ingest_seq").alias("seqs"))


@query(_aged(14) + """l AS (SELECT ts_id, max(observed_at) AS last FROM o WHERE ingest_seq % 10 = 0 GROUP BY 1), c AS (SELECT o.*, last FROM o LEFT JOIN l USING (ts_id)
  WHERE ingest_seq % 10 <> 0),
a AS (SELECT * FROM (SELECT ts_id, observed_at, ingest_seq, rn FROM c WHERE last IS NULL OR NOT old AND observed_at >= last + INTERVAL 1 HOUR QUALIFY
  row_number() OVER (PARTITION BY ts_id ORDER BY rn) = 1) UNION ALL
  SELECT x.* FROM a, LATERAL (SELECT ts_id, observed_at, ingest_seq, rn FROM c WHERE c.ts_id = a.ts_id AND c.rn > a.rn AND NOT c.old AND c.observed_at
  >= a.observed_at + INTERVAL 1 HOUR ORDER BY c.rn LIMIT 1) x)
SELECT ts_id, ingest_seq FROM a""")
def engagement_to_append(spark, d):
    """Candidates against what is stored (every tenth snapshot) and when posts were made (their first snapshot)."""
    rows = event_snapshots(spark, d)
    posts = rows.groupBy("ts_id").agg(F.min("observed_at").alias("created_at_utc"))
    return throttle.filter_engagement(rows.filter("ingest_seq % 10 <> 0"), rows.filter("ingest_seq % 10 = 0"), posts).select("ts_id", "ingest_seq")


# -- checks ------------------------------------------------------------------

_RULES = {
    1: ("ts_id", '"12"', "bad_ts_id"), 2: ("created_at_utc", '"2024-01-01 00:00"', "bad_timestamp"), 3: ("edited_at", '"x"', "bad_timestamp"), 4: ("kind", '"view"', "bad_kind"), 5: ("status", "null", "bad_status"),
    6: ("et_hour", "24", "bad_et_hour"), 7: ("et_dow", "-1", "bad_et_dow"), 8: ("pinned", '"no"', "bad_pinned"), 9: ("media", '"x"', "bad_media"), 10: ("media", '[{"type":"image"}]', "bad_media_item"),
    11: ("field_sources", "[]", "bad_field_sources"), 12: ("field_sources", '{"nope":"bulk"}', "bad_field_sources_key"), 13: ("field_sources", '{"kind":"me"}', "bad_field_sources_value"), 14: ("lang", None, "missing_fields"),
}


@query(f"""WITH c(i, code) AS (VALUES {", ".join(f"({i}, '{code}')" for i, (_, _, code) in _RULES.items())})
SELECT CASE code WHEN 'bad_ts_id' THEN '12' ELSE CAST(110000000000000000 + event_id AS VARCHAR) END AS ts_id, 'hard' AS severity, code FROM events
  JOIN c ON event_id % 17 = i""")
def check_record_rules(spark, d):
    """JSON records, each 17th of a kind with one fault: every rule on records, by value."""
    e = spread(table(spark, d, "events").select("event_id", "ts"))
    number, at = F.col("event_id") % 17, times.to_iso(times.to_second(F.col("ts")))
    sound = {f: F.lit("null") for f in FIELDS} | {
        "ts_id": F.concat(F.lit('"'), (F.lit(110000000000000000) + F.col("event_id")).cast("string"), F.lit('"')), "created_at_et": F.lit('"2024-01-01T00:00:00-05:00"'), "et_hour": F.lit("3"), "et_dow": F.lit("0"), "kind": F.lit('"original"'),
        "status": F.lit('"present"'), "pinned": F.lit("false"), "media": F.lit("[]"), "mentions": F.lit("[]"), "tags": F.lit("[]"), "seen_sources": F.lit('["bulk"]'), "field_sources": F.lit('{"kind":"bulk"}'),
        **{f: F.concat(F.lit('"'), at, F.lit('"')) for f in ("created_at_utc", "first_seen_at", "updated_at")},
    }
    parts = []
    for f, value in sound.items():
        whole = F.concat(F.lit(f'"{f}":'), value)
        for i, (field, bad, _) in _RULES.items():
            if field == f:
                whole = F.when(number == i, F.lit(f'"{f}":{bad}') if bad is not None else F.lit(None)).otherwise(whole)
        parts.append(whole)
    line = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    return checks.schema_violations(e.select(line.alias("line"))).select("ts_id", "severity", "code")


@query("""WITH p AS (SELECT event_id, CASE WHEN event_id % 50 = 7 THEN '2023-12' ELSE strftime(ts, '%Y-%m') END AS file_month, strftime(ts, '%Y-%m') AS month
  FROM events)
SELECT 'wrong_month_file' AS code, CAST(event_id AS VARCHAR) AS ts_id, file_month || ',' || month AS detail FROM p WHERE file_month <> month
UNION ALL SELECT 'unsorted_file', NULL, file_month FROM p WHERE file_month <> '2023-12' GROUP BY file_month""")
def check_files(spark, d):
    """Records in another month's file, and files out of order: only the file of the misplaced is sorted."""
    e = table(spark, d, "events").select(F.col("event_id").cast("string").alias("ts_id"), times.to_second(F.col("ts")).alias("created_at_utc"), F.col("event_id").alias("n"))
    month = F.when(F.col("n") % 50 == 7, "2023-12").otherwise(times.month_of(F.col("created_at_utc")))
    filed = e.withColumns({"file_month": month, "line_no": F.when(F.col("n") % 50 == 7, F.col("n")).otherwise(-F.col("n"))})
    return checks.wrong_month(filed).unionByName(checks.unsorted_files(filed)).select("code", "ts_id", "detail")


@query("""WITH e AS (SELECT event_id, user_id, date_trunc('second', ts) AS t, event_type FROM events)
SELECT 'hard' AS severity, 'duplicate_id' AS code, count(*) AS n FROM e WHERE event_id % 100 = 3 UNION ALL SELECT 'hard',
  'created_after_deleted_upper', count(*) FROM e WHERE event_id % 77 = 0 AND event_id % 100 <> 3
UNION ALL SELECT 'soft', 'inverted_deletion_bounds', count(*) FROM e WHERE event_id % 77 = 0 AND event_id % 100 <> 3 UNION ALL SELECT 'hard',
  'deletion_unknown_post', count(*) FROM e WHERE event_id % 200 = 0
UNION ALL SELECT 'hard', 'duplicate_deletion_event', count(*) FROM e WHERE event_id % 500 = 1 UNION ALL SELECT 'hard', 'engagement_unknown_post',
  count(*) FROM e WHERE event_id % 300 = 0
UNION ALL SELECT 'hard', 'engagement_too_close', count(*) FROM e WHERE event_id % 400 = 2 UNION ALL SELECT 'hard', 'missing_run_row', 1 UNION ALL
  SELECT 'soft', 'stale_newest_post', 1
UNION ALL SELECT 'soft', 'present_count_drift', 1 UNION ALL SELECT 'soft', 'tracker_total_drift', 1""")
def check_counts(spark, d):
    """The whole run over posts, logs and snapshots with planted faults: rows by code."""
    e = table(spark, d, "events").select("event_id", times.to_second(F.col("ts")).alias("at"))
    n, ts_id = F.col("event_id"), (F.lit(110000000000000000) + F.col("event_id")).cast("string")
    bad = (n % 77 == 0) & (n % 100 != 3)
    minus = lambda k: F.timestamp_add("HOUR", F.lit(-k), F.col("at"))
    given = {
        "ts_id": ts_id, "created_at_utc": F.col("at"), "kind": F.lit("original"), "content_text": F.lit("x"), "status": F.when(n % 11 == 0, "deleted").otherwise("present"), "seen_sources": F.array(F.lit("bulk"), F.lit("primary")),
        "deleted_lower": F.when(bad, minus(1)), "deleted_upper": F.when(bad, minus(2)), "et_date": F.col("at").cast("date"), "field_sources": F.create_map(F.lit("kind"), F.lit("bulk")),
    }
    posts = e.select(n, *[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in POST.fields])
    posts = posts.unionByName(posts.filter("event_id % 100 = 3")).drop("event_id")
    event = lambda where, key=ts_id: e.filter(where).select(key.alias("ts_id"), F.lit("tracker").alias("source"))
    log = event("event_id % 500 = 1").unionByName(event("event_id % 500 = 1")).unionByName(event("event_id % 200 = 0", F.concat(F.lit("x"), "event_id")))
    snap = lambda where, key=ts_id, at=F.col("at"): e.filter(where).select(at.alias("observed_at"), key.alias("ts_id"))
    shots = snap("event_id % 400 = 2").unionByName(snap("event_id % 400 = 2", at=F.timestamp_add("MINUTE", F.lit(59), F.col("at")))).unionByName(snap("event_id % 400 = 4")).unionByName(snap("event_id % 400 = 4", at=F.timestamp_add("MINUTE", F.lit(60), F.col("at"))))
    shots = shots.unionByName(snap("event_id % 300 = 0", F.concat(F.lit("y"), "event_id")))
    found = checks.run(posts, log, shots, spark.createDataFrame([], RUN), F.lit("2024-06-01 00:00:00").cast("timestamp_ntz"), run_id="none", statuses_count=1 << 40, tracker_total=1 << 40)
    return found.groupBy("severity", "code").agg(F.count("*").alias("n"))


# -- payloads ----------------------------------------------------------------


@query("""WITH s AS (SELECT doc_id, lang, source, doc_id % 5 AS c FROM documents)
SELECT CAST(doc_id AS VARCHAR) AS ts_id, CASE c WHEN 1 THEN 'reblog' WHEN 2 THEN 'reply' WHEN 3 THEN 'quote' ELSE 'original' END AS kind, CASE c WHEN
  1 THEN '<p>other</p>' ELSE '<p>' || lang || '</p>' END AS content_html,
CASE WHEN c = 1 THEN 'bob' END AS reblog_of_acct, CASE WHEN c = 3 THEN '8' END AS quote_id, CASE WHEN c = 2 THEN '7' END AS in_reply_to_id,
  strftime(TIMESTAMP '2024-01-01' + INTERVAL (doc_id) MINUTE, '%Y-%m-%dT%H:%M:%SZ') AS created_at,
CASE WHEN c <> 1 THEN source || '.example' END AS card_domain, CASE WHEN c <> 1 THEN 'm' || doc_id ELSE '' END AS mentions, CAST(CASE WHEN c = 1 THEN
  0 ELSE 1 END AS INTEGER) AS n_media, doc_id * 2 AS favourites, false AS names_account FROM s""")
def primary_payloads(spark, d):
    """Statuses of every kind as JSON payloads, and what is read from them."""
    docs = table(spark, d, "documents").select("doc_id", "lang", "source")
    c, at = F.col("doc_id") % 5, times.to_iso(F.timestamp_add("MINUTE", F.col("doc_id").cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")))
    account = F.struct(F.lit("own").alias("acct"), F.lit(7).alias("statuses_count"))
    reblog = F.struct(F.lit("9").alias("id"), F.lit("2023-06-01T00:00:00Z").alias("created_at"), F.lit("<p>other</p>").alias("content"), F.struct(F.lit("bob").alias("acct")).alias("account"))
    picture = F.array(F.struct(F.lit("image").alias("type"), F.lit("u").alias("url"), F.struct(F.struct(F.lit(3).alias("width")).alias("original")).alias("meta")))
    body = F.to_json(F.struct(
        F.col("doc_id").cast("string").alias("id"), at.alias("created_at"), F.concat(F.lit("<p>"), "lang", F.lit("</p>")).alias("content"), account.alias("account"), F.when(c == 1, reblog).alias("reblog"), F.when(c == 2, "7").alias("in_reply_to_id"),
        F.when(c == 3, "8").alias("quote_id"), F.struct(F.concat(F.lit("https://www."), "source", F.lit(".example/x")).alias("url")).alias("card"), F.array(F.struct(F.concat(F.lit("m"), "doc_id").alias("acct"))).alias("mentions"), picture.alias("media_attachments"),
        (F.col("doc_id") * 2).alias("favourites_count"),
    ))
    some = landed.primary_partials(landed.statuses(docs.select(F.when(F.col("doc_id") % 2 == 0, body).otherwise(F.concat(F.lit("["), body, F.lit("]"))).alias("value"))))
    return some.select("ts_id", "kind", "content_html", "reblog_of_acct", "quote_id", "in_reply_to_id", times.to_iso(F.col("created_at_utc")).alias("created_at"), "card_domain", F.array_join("mentions", ",").alias("mentions"), F.size("media").alias("n_media"),
                       F.col("engagement.favourites").alias("favourites"), F.col("raw_primary").contains("account").alias("names_account"))


@query("""SELECT CAST(doc_id AS VARCHAR) AS ts_id, CASE WHEN doc_id % 3 = 0 THEN 'original' ELSE 'reblog' END AS kind, CASE doc_id % 3 WHEN 1 THEN 'own' WHEN 2
  THEN 'user_' || doc_id END AS reblog_of_acct,
CASE doc_id % 3 WHEN 1 THEN text WHEN 2 THEN ' ' || text ELSE coalesce(text, '') END AS content_text, CASE WHEN doc_id % 2 = 0 THEN 'video,image' ELSE
  '' END AS media FROM documents""")
def bulk_rows(spark, d):
    """Whole texts as rows of a bulk archive: reposts split from their marker, media typed by their links."""
    docs = table(spark, d, "documents")
    start = F.when(F.col("doc_id") % 3 == 1, "RT @own").when(F.col("doc_id") % 3 == 2, F.concat(F.lit("RT @user_"), "doc_id", F.lit(" "))).otherwise("")
    count = F.lit(None).cast("bigint")
    rows = docs.select(F.col("doc_id").cast("string").alias("id"), F.lit("2024-01-01T00:00:00Z").alias("created_at"), F.concat(start, "text").alias("content"), F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("a.mp4"), F.lit("b.png"))).alias("media"),
                       count.alias("replies_count"), count.alias("reblogs_count"), count.alias("favourites_count"))
    return landed.bulk_partials(rows, "own").select("ts_id", "kind", "reblog_of_acct", "content_text", F.array_join(F.transform("media", lambda m: m["type"]), ",").alias("media"))


def _cards(spark, d) -> DataFrame:
    """A tracker page of one card for each order, with the marks that its number asks for."""
    o = spread(table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")).select(F.col("o_orderkey").alias("n"), F.col("o_orderpriority").alias("p"), times.to_iso(F.col("o_orderdate")).alias("at"))
    card = lambda n, handle: F.concat(
        F.lit('<div class="status" data-status-url="https://tracker.example/statuses/'), n.cast("string"), F.lit(f'"><a class="status-info__meta-item">@{handle}</a><time datetime="'), F.col("at"), F.lit('">x</time><a href="https://truthsocial.com/@'),
        F.lit(handle), F.lit("/"), n.cast("string"), F.lit('" class="status__external-link">o</a><div class="status__content"><p>'), F.col("p"), F.lit(" &amp; more</p></div>"))
    close = F.lit("</div>")
    mark = F.when(F.col("n") % 3 == 0, '<div class="status__reblog-indicator"><strong>Some One</strong> ReTruthed</div>').otherwise("")
    nested = F.when(F.col("n") % 4 == 0, F.concat(card(F.col("n") + 1_000_000, "q"), close)).otherwise("")
    return o.select("n", "at", F.concat(mark, card(F.col("n"), "own"), nested, close).alias("card"))


@query("""SELECT o_orderkey AS tracker_id, CAST(o_orderkey AS VARCHAR) AS ts_id, CASE WHEN o_orderkey % 4 = 0 THEN 'quote' ELSE 'original' END AS kind, CASE
  WHEN o_orderkey % 4 = 0 THEN CAST(o_orderkey + 1000000 AS VARCHAR) END AS quote_id, o_orderkey % 3 = 0 AS reposted,
CASE WHEN o_orderkey % 3 = 0 THEN 'Some One' ELSE '' END AS reposted_by, '<p>' || o_orderpriority || ' &amp; more</p>' AS content_html,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS created_at, 'own' AS account FROM orders""")
def tracker_listing(spark, d):
    pages = _cards(spark, d).select(F.concat(F.lit("p"), "n").alias("url"), F.concat(F.lit('<div class="statuses">'), "card", F.lit("</div>")).alias("html"))
    return tracker_html.listing(pages).select(F.col("tracker_id").cast("bigint").alias("tracker_id"), "ts_id", "kind", "quote_id", "reposted", "reposted_by", "content_html", times.to_iso(F.col("created_at_utc")).alias("created_at"), "account")


@query("""SELECT o_orderkey AS tracker_id, CASE WHEN o_orderkey % 5 = 0 THEN '123' ELSE CAST(o_orderkey AS VARCHAR) END AS ts_id, CASE WHEN o_orderkey % 3 = 0
  THEN 'reblog' WHEN o_orderkey % 4 = 0 THEN 'quote' ELSE 'original' END AS kind,
CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey AS VARCHAR) END AS reblog_of_id, o_orderkey % 7 = 0 AS removed, CASE WHEN o_orderkey % 7 = 0 THEN
  '2026-09-09T02:20:31Z' END AS removed_at, '2026-09-09T02:20:31Z' AS captured_at FROM orders""")
def tracker_status_pages(spark, d):
    row = lambda k, v: f'<tr><td class="status-details-table__key">{k}</td><td class="status-details-table__value">{v}</td></tr>'
    some = lambda every, k, v: F.when(F.col("n") % every == 0, row(k, v)).otherwise("")
    cells = F.concat(F.lit(row("Capture Date", '<time datetime="2026-09-09T02:20:31Z">x</time>')), some(5, "TRUTH Social status ID", "<code>123</code>"), some(7, "Removed from platform", "Yes, removed Sep 8, 2026, 10:20 PM EDT"))
    html = F.concat(F.lit('<meta property="og:url" content="https://tracker.example/statuses/'), F.col("n").cast("string"), F.lit('">'), "card", F.lit("<table>"), cells, F.lit("</table>"))
    found = tracker_html.status_pages(_cards(spark, d).select(F.concat(F.lit("p"), "n").alias("url"), html.alias("html")), "own")
    return found.select(F.col("tracker_id").cast("bigint").alias("tracker_id"), "ts_id", "kind", "reblog_of_id", "removed", times.to_iso(F.col("tracker_removed_at")).alias("removed_at"), times.to_iso(F.col("tracker_captured_at")).alias("captured_at"))


@query("""SELECT o_orderkey AS tracker_id, o_orderkey % 3 = 0 AS removed, CASE o_orderkey % 4 WHEN 0 THEN 'bob' WHEN 1 THEN 'own' WHEN 2 THEN 'ann' END AS
  reblog_of_acct, CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_orderkey AS VARCHAR) END AS reblog_of_id,
CAST(1234 AS INTEGER) AS total, CASE WHEN o_orderkey % 2 = 0 THEN 'c' || o_orderkey ELSE '7' END AS next_cursor FROM orders""")
def tracker_search_hits(spark, d):
    o, n = table(spark, d, "orders").select(F.col("o_orderkey").alias("n")), F.col("n").cast("string")
    snippet = F.when(F.col("n") % 4 == 0, F.concat(F.lit("RT: https://truthsocial.com/users/bob/statuses/"), n, F.lit(" x"))).when(F.col("n") % 4 == 1, "RT @ownX").when(F.col("n") % 4 == 2, "RT @ann says").otherwise("plain")
    link = F.when(F.col("n") % 2 == 0, F.concat(F.lit("/search?a=1&amp;cursor=c"), n)).otherwise("/search?page=7")
    html = F.concat(
        F.lit('1,234 results<div class="search-page__results"><div class="search-result" data-status-url="https://tracker.example/statuses/'), n, F.lit('"><a class="status-info__meta-item">@own</a>'), F.when(F.col("n") % 3 == 0, '<i class="status__deleted-badge"></i>').otherwise(""),
        F.lit('<time datetime="2026-07-01T00:00:00Z"></time><div class="snippet-clean-content">'), snippet, F.lit('</div></div></div><a href="'), link, F.lit('">Next Page</a>'))
    found = tracker_html.search_results(o.select(F.concat(F.lit("p"), "n").alias("url"), html.alias("html")), "own")
    return found.select(F.col("tracker_id").cast("bigint").alias("tracker_id"), "removed", "reblog_of_acct", "reblog_of_id", "total", "next_cursor")


@query("""SELECT c_custkey, CAST(c_custkey * 1000 + 7 AS INTEGER) AS total, CAST(c_custkey AS INTEGER) AS original, CAST(2 AS INTEGER) AS quote, CAST(NULL AS
  INTEGER) AS reblog, '2022-02-14' AS coverage_start FROM customer""")
def stats_page_numbers(spark, d):
    c, number = table(spark, d, "customer").select("c_custkey"), lambda x: F.format_number(x, 0)
    one = lambda k, v: F.concat(F.lit(f'<div class="stats-page__summary-card--{k}">\n<span class="stats-page__summary-value">'), v, F.lit("</span>"))
    html = F.concat(F.lit('<i class="stats-page__summary-value--total">'), number(F.col("c_custkey") * 1000 + 7), F.lit("</span>"), one("original", number(F.col("c_custkey"))), one("quote", F.lit("2")), F.lit("<strong>Total archive coverage:</strong> February 14, 2022 – September 11, 2026</p>"))
    got = landed.stats_page(F.col("html"))
    return c.withColumn("html", html).select("c_custkey", *[got[k].alias(k) for k in ("total", "original", "quote", "reblog")], got["coverage_start"].cast("string").alias("coverage_start"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'reblog' WHEN event_id % 5 = 0 THEN 'reply' WHEN event_id % 2 = 0 THEN 'quote' ELSE 'original' END AS kind, '{\"a\":[{\"b\":' || event_id || '}]}' AS bare FROM events")
def classify_and_strip(spark, d):
    e = table(spark, d, "events").select("event_id")
    raw = F.concat(F.lit('{"account":{"id":1},"a":[{"account":2,"b":'), F.col("event_id").cast("string"), F.lit("}]}"))
    return e.select("event_id", texts.classify(F.col("event_id") % 3 == 0, F.col("event_id") % 5 == 0, F.col("event_id") % 2 == 0).alias("kind"), texts.without_accounts(raw).alias("bare"))


# -- files -------------------------------------------------------------------


def _stored(spark, d) -> DataFrame:
    """Merged records of events' users, as they are stored."""
    return _event_merge(spark, d).posts.drop("changed", "is_new")


@query(_SIG + """ SELECT ts_id, status, deleted_source, last_verified_live_at, deleted_lower, deleted_upper, first_seen_at, first_seen_source, seen_sources,
  coalesce(kind, '') AS kind FROM (""" + _STATE + ")")
def stored_posts_round_trip(spark, d):
    """Records written by month and read back with the given schema."""
    root = sinks.scratch(spark)
    sinks.save_posts(_stored(spark, d), root)
    some = landed.posts(spark, root).select("ts_id", "status", "deleted_source", "last_verified_live_at", "deleted_lower", "deleted_upper", "first_seen_at", "first_seen_source", F.array_join("seen_sources", ",").alias("seen_sources"), "kind")
    return _instants(some, "last_verified_live_at", "deleted_lower", "deleted_upper", "first_seen_at")


@query(_S + """, t AS (SELECT ts_id, max(observed_at) AS m FROM s GROUP BY 1) SELECT ts_id, strftime(m, '%Y-%m-%dT%H:%M:%SZ') AS observed_at, arg_max(favourites,
  ingest_seq) AS favourites, CAST(NULL AS BIGINT) AS upvotes FROM s JOIN t USING (ts_id) WHERE observed_at = m GROUP BY 1, 2""")
def stored_engagement_latest(spark, d):
    """Snapshots appended in two runs as CSV by month; the latest of each post after reading them back."""
    root, rows = sinks.scratch(spark), event_snapshots(spark, d)
    null = F.lit(None)
    typed = rows.select(*[F.col(f.name) if f.name in rows.columns else null.cast(f.dataType).alias(f.name) for f in ENGAGEMENT.fields], "ingest_seq")
    for part in ("ingest_seq < 500", "ingest_seq >= 500"):
        sinks.append_engagement(typed.filter(part).orderBy("ingest_seq"), root)
    return _instants(views.engagement_latest(landed.engagement(spark, root)).select("ts_id", "observed_at", "favourites", "upvotes"), "observed_at")


@query(_SIG + """, n AS (SELECT *, row_number() OVER (PARTITION BY user_id, source ORDER BY seq) AS nth FROM q WHERE signal) SELECT CAST(user_id AS VARCHAR) AS ts_id,
  source, strftime(observed_at, '%Y-%m-%dT%H:%M:%SZ') AS detected_at, 'r' AS run_id FROM n WHERE nth = 1""")
def stored_deletion_log(spark, d):
    root = sinks.scratch(spark)
    sinks.append_log(_event_merge(spark, d).events, f"{root}/deletions")
    return _instants(landed.deletion_log(spark, root).select("ts_id", "source", "detected_at", "run_id"), "detected_at")


@query(_V + "SELECT ts_id, created_at_et, et_date, et_hour, kind, 'bulk|primary' AS seen_sources, CAST(4 AS INTEGER) AS content_len FROM v")
def export_posts_csv(spark, d):
    """The posts export, written and read back as CSV."""
    path = sinks.scratch(spark) + "/csv"
    sinks.export_posts(_event_records(spark, d), path)
    back = spark.read.option("header", True).csv(path)
    return back.select(F.col("ts_id").cast("bigint").alias("ts_id"), "created_at_et", "et_date", F.col("et_hour").cast("int").alias("et_hour"), "kind", "seen_sources", F.col("content_len").cast("int").alias("content_len"))


@query("""WITH t AS (SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m') AS month FROM events) SELECT month AS file_month, count(*) AS n, CAST(0 AS
  BIGINT) AS out_of_order, CAST(0 AS BIGINT) AS misplaced FROM t GROUP BY 1""")
def filed_layout(spark, d):
    """What the sink lays out by month passes the checks on files: months, order, lines."""
    root = sinks.scratch(spark)
    sinks.save_posts(_event_records(spark, d), root)
    filed = landed.filed_posts(spark, root)
    bad = lambda df: df.agg(F.count("*").alias("n"))
    unsorted_, wrong = bad(checks.unsorted_files(filed)), bad(checks.wrong_month(filed))
    found = filed.groupBy("file_month").agg(F.count("*").alias("n"))
    return found.join(F.broadcast(unsorted_.withColumnRenamed("n", "out_of_order"))).join(F.broadcast(wrong.withColumnRenamed("n", "misplaced")))


@query("SELECT CAST(110000000000000000 + user_id AS VARCHAR) AS ts_id, CASE WHEN user_id % 3 = 0 THEN 'original' ELSE 'quote' END AS kind FROM (SELECT DISTINCT user_id FROM events)")
def stored_posts_last_wins(spark, d):
    """Records of one id in the files of two months: the later file's stands."""
    users, root = table(spark, d, "events").select("user_id").distinct(), sinks.scratch(spark)

    def records(kind: str, at: str, where: str) -> DataFrame:
        given = {"ts_id": (F.lit(110000000000000000) + F.col("user_id")).cast("string"), "kind": F.lit(kind), "created_at_utc": F.lit(at).cast("timestamp_ntz")}
        return users.filter(where).select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in POST.fields])

    sinks.save_posts(records("original", "2024-01-05 00:00:00", "true").unionByName(records("quote", "2024-02-05 00:00:00", "user_id % 3 <> 0")), root)
    return landed.keyed_posts(spark, root).select("ts_id", "kind")


@query("SELECT DISTINCT CAST(o_custkey AS INTEGER) AS tracker_id FROM orders WHERE o_orderkey % 3 = 0 AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 5 <> 0)")
def removals_not_processed(spark, d):
    """Removed search hits (each third order) without those that earlier runs have processed (most customers)."""
    hits = table(spark, d, "orders").select(F.col("o_custkey").cast("int").alias("tracker_id"), (F.col("o_orderkey") % 3 == 0).alias("removed"))
    return landed.unprocessed(hits, table(spark, d, "customer").filter("c_custkey % 5 <> 0").select(F.col("c_custkey").cast("int").alias("tracker_id")))


@query("SELECT o_orderkey, strftime(o_orderdate + INTERVAL (o_orderkey % 24) HOUR + INTERVAL (o_orderkey % 60) MINUTE, '%Y-%m-%dT%H:%M:%SZ') AS iso FROM orders")
def eastern_text_of_the_year(spark, d):
    """Instants of all seasons written as Eastern prose with the zone in force, and read back."""
    o = table(spark, d, "orders")
    at = F.timestamp_add("MINUTE", ((F.col("o_orderkey") % 24) * 60 + F.col("o_orderkey") % 60).cast("int"), F.col("o_orderdate"))
    some = o.select("o_orderkey", times.eastern(at).alias("w"), times.offset_minutes(at).alias("off"))
    text = F.concat(F.element_at(F.array(*[F.lit(m.title()) for m in times.MONTH_NAMES[:12]]), F.month("w")), F.lit(" "), F.dayofmonth("w"), F.lit(", "), F.year("w"), F.lit(", "), (F.hour("w") + 11) % 12 + 1, F.lit(":"),
                    F.lpad(F.minute("w").cast("string"), 2, "0"), F.when(F.hour("w") < 12, " AM ").otherwise(" PM "), F.when(F.col("off") == -240, "EDT").otherwise("EST"))
    return some.select("o_orderkey", times.to_iso(times.parse_eastern_text(text)).alias("iso"))


@query("SELECT o_custkey, string_agg(strftime(o_orderdate, '%Y-%m'), ',' ORDER BY strftime(o_orderdate, '%Y-%m')) AS months FROM orders GROUP BY 1 HAVING count(*) > 1")
def duplicate_ids_by_file(spark, d):
    """Ids that stand more than once, with the files that have them."""
    filed = table(spark, d, "orders").select("o_custkey", times.month_of(F.col("o_orderdate")).alias("file_month"))
    found = checks.duplicate_keys(filed, ["o_custkey"], listed="file_month")
    return found.select(F.col("ts_id").cast("bigint").alias("o_custkey"), F.col("detail").alias("months"))


# -- saved SQL and the report ------------------------------------------------


def _event_records(spark, d) -> DataFrame:
    """events as whole records."""
    p = event_posts(spark, d)
    given = {
        "ts_id": F.col("ts_id").cast("string"), "content_text": F.lit("text"), "seen_sources": F.array(F.lit("bulk"), F.lit("primary")), "first_seen_source": F.lit("bulk"), "card_domain": F.when(F.col("ts_id") % 3 == 0, F.concat(F.lit("d"), "user_id")),
        "deleted_lower": F.when(F.col("is_deleted") == 1, F.col("created_at_utc")), "deleted_upper": F.when(F.col("is_deleted") == 1, F.timestamp_add("MINUTE", F.lit(30), F.col("created_at_utc"))), "deleted_source": F.when(F.col("is_deleted") == 1, "gone"),
        "media": F.when(F.col("ts_id") % 4 == 0, F.array(F.struct(F.lit("image").alias("type"), *[F.lit(None).alias(n) for n in ("url", "preview_url", "mirror_url", "width", "height", "duration")])).cast(MEDIA)).otherwise(F.array().cast(MEDIA)),
    }
    return p.select(*[(given[f.name] if f.name in given else F.col(f.name) if f.name in p.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in POST.fields])


def _saved(spark, d, name: str) -> DataFrame:
    """A saved query over the events' relations; a snapshot of each post is its value."""
    null = F.lit(None)
    shots = table(spark, d, "events").select(F.col("event_id").cast("string").alias("ts_id"), times.to_second(F.col("ts")).alias("observed_at"), F.get_json_object("props", "$.k").cast("bigint").alias("favourites"), F.col("event_id").alias("ingest_seq"))
    shots = shots.select(*[F.col(f.name) if f.name in shots.columns else null.cast(f.dataType).alias(f.name) for f in ENGAGEMENT.fields], "ingest_seq")
    posts = _event_records(spark, d)
    views.register(spark, posts, shots, spark.createDataFrame([], landed.DELETION), spark.createDataFrame([], RUN))
    return cli.run_query(spark, cli.saved_queries()[name])


_GAP = f"round({_MIN.format('pu', 'created_at_utc')}, 6)"
_SAVED = {
    "bursts": _V + _LAG + f""" SELECT CAST(ts_id AS VARCHAR) AS ts_id, created_at_et, kind, {_GAP} AS gap_min FROM g WHERE pu IS NOT NULL AND epoch_us(created_at_utc) -
  epoch_us(pu) <= 600000000""",
    "longest_gaps": _V + _LAG + f""" SELECT pe AS from_et, created_at_et AS to_et, {_GAP} AS gap_min FROM g WHERE pu IS NOT NULL ORDER BY gap_min DESC, created_at_utc LIMIT 20""",
    "deletions": _V + """SELECT CAST(ts_id AS VARCHAR) AS ts_id, created_at_et, kind, 'gone' AS deleted_source, 30.0 AS lifetime_min, 30.0 AS deletion_window_min, 'text' AS
  snippet FROM v WHERE is_deleted = 1""",
    "engagement_percentiles": _V + """, t AS (SELECT kind, CAST(props->>'$.k' AS BIGINT) AS f, ntile(100) OVER (PARTITION BY kind ORDER BY CAST(props->>'$.k' AS BIGINT)) AS pct FROM v JOIN
  (SELECT event_id, props FROM events) ON event_id = ts_id)
SELECT kind, count(*) AS n, min(f) FILTER (pct >= 50) AS favourites_p50, min(f) FILTER (pct >= 90) AS favourites_p90 FROM t GROUP BY 1""",
    "hour_histogram": _V + "SELECT et_hour, count(*) AS n FROM v GROUP BY 1",
    "kinds_mix": _V + "SELECT kind, count(*) AS n, CAST(sum(is_deleted) AS BIGINT) AS deleted FROM v GROUP BY 1",
    "link_domains": _V + "SELECT 'd' || user_id AS domain, count(*) AS n FROM v WHERE ts_id % 3 = 0 GROUP BY 1 ORDER BY n DESC, domain LIMIT 10",
    "media_mix": """SELECT 'image' AS type, count(*) AS n FROM events WHERE event_id % 4 = 0 UNION ALL SELECT 'no_media_posts', count(*) FROM events WHERE event_id % 4 <>
  0""",
    "overnight_share": _V + """SELECT CAST(sum(CASE WHEN et_hour < 6 THEN 1 ELSE 0 END) AS BIGINT) AS overnight, count(*) AS total, round(sum(CASE WHEN et_hour < 6 THEN 1 ELSE 0
  END) / count(*), 6) AS share FROM v""",
    "top_accounts": _V + "SELECT reblog_of_acct AS account, count(*) AS n FROM v WHERE kind = 'reblog' GROUP BY 1 ORDER BY n DESC, account LIMIT 10",
    "volume_by_day": _V + """SELECT et_date, count(*) FILTER (kind = 'original') AS original, count(*) FILTER (kind = 'quote') AS quote, count(*) FILTER (kind = 'reblog') AS
  reblog, count(*) FILTER (kind = 'reply') AS reply, count(*) AS total, CAST(sum(is_deleted) AS BIGINT) AS deleted FROM v GROUP BY 1""",
}


def _register_saved(name: str, sql: str) -> None:
    def run(spark, d):
        found = _saved(spark, d, name)
        if name == "overnight_share":
            return found.withColumn("share", F.round("share", 6))
        if name == "volume_by_day":
            return _text(found, "et_date")
        return _minutes(found.withColumn("gap_min", F.col("gap_min").cast("double")), "gap_min") if "gap_min" in found.columns else found

    run.__name__ = f"saved_{name}"
    query(sql)(run)


for _name, _sql in _SAVED.items():
    _register_saved(_name, _sql)


@query(_V + """, i AS (SELECT *, CASE WHEN et_date BETWEEN '2024-01-15' AND '2024-01-21' THEN 'window' WHEN et_date BETWEEN '2024-01-01' AND '2024-01-14' THEN
  'trailing' END AS part FROM v)
SELECT part, count(*) AS posts, CAST(sum(is_deleted) AS BIGINT) AS deleted, count(*) FILTER (et_hour < 6) AS overnight, count(edited_at) AS edits,
  count(*) FILTER (ts_id % 4 = 0) AS images FROM i WHERE part IS NOT NULL GROUP BY 1""")
def report_baseline(spark, d):
    """The weekly report's numbers for a window and the two weeks before it."""
    posts = _event_records(spark, d)
    found = report.baseline(views.register(spark, posts, spark.createDataFrame([], T.StructType([*ENGAGEMENT.fields, T.StructField("ingest_seq", T.LongType())])), spark.createDataFrame([], landed.DELETION), spark.createDataFrame([], RUN)), "2024-01-15", "2024-01-21", 2)
    rows = [(part, sum(x["total"] for x in r["posts_by_day"]), len(r["deletions"]), r["overnight_share"]["overnight"], len(r["edits"]), r["media_mix"]["items"].get("image", 0)) for part, r in ((p, found[p]) for p in ("window", "trailing"))]
    return spark.createDataFrame(rows, "part string, posts bigint, deleted bigint, overnight bigint, edits bigint, images bigint")


# -- streams -----------------------------------------------------------------


def _landing(df: DataFrame, *parts: str, files: int = 1) -> str:
    """df as files landed one after another: what each condition names, then all the rest.

    Of several files for a part, each has all rows of its posts (ts_id): where
    files of the next part come into a batch, those of a post stay in order.
    """
    path, rest = sinks.scratch(df.sparkSession) + "/in", df
    for part in (*parts, "true"):
        some = rest.filter(part)
        (some.coalesce(1) if files == 1 else some.repartition(files, "ts_id")).write.mode("append").parquet(path)
        rest = rest.filter(f"not ({part})")
    return path


def _files(spark) -> int:
    """Files of a part of a landing, and of a batch of its stream: all cores write and read them."""
    return 4 * spark.sparkContext.defaultParallelism


def _drained(stream: DataFrame, mode: str) -> DataFrame:
    """What a stream writes until the landed files are used up."""
    root = sinks.scratch(stream.sparkSession)
    writer = stream.writeStream.outputMode(mode).format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/mark").trigger(availableNow=True)
    writer.start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{root}/out")


@query("SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, count(DISTINCT event_id) AS n FROM events GROUP BY 1, 2")
def stream_dedup_counts(spark, d):
    """The stream's windowed counts, each event once, run to the end of the landed files in complete mode."""
    events, root = table(spark, d, "events"), sinks.scratch(spark)
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(d)
    counts = micro.event_counts(stream)

    def step(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/out")

    counts.writeStream.outputMode("complete").foreachBatch(step).option("checkpointLocation", f"{root}/mark").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(counts.schema).parquet(f"{root}/out").select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "event_type", "n")


@query("""WITH l AS (SELECT max(ts) - INTERVAL 1 DAY AS mark FROM events), w AS (SELECT date_trunc('day', ts) AS day, event_type, count(DISTINCT event_id) AS n
  FROM events GROUP BY 1, 2)
SELECT strftime(day, '%Y-%m-%d') AS day, event_type, n FROM w, l WHERE day + INTERVAL 1 DAY <= mark""")
def stream_event_counts(spark, d):
    """Counts by day of a stream that brings each event twice: once each, for the days that the watermark has closed."""
    e = table(spark, d, "events").select("event_id", "ts", "event_type")
    path = _landing(e.unionByName(e).sort("ts"), "ts < timestamp_ntz'2024-01-10'", "ts < timestamp_ntz'2024-01-20'")
    stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(path)
    return _drained(micro.event_counts(stream), "append").select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "event_type", "n")


@query(_S.replace("WITH s AS", "WITH RECURSIVE s AS") + """, o AS (SELECT ts_id, observed_at, ingest_seq, row_number() OVER (PARTITION BY ts_id ORDER BY observed_at, ingest_seq) AS rn FROM s),
a AS (SELECT * FROM o WHERE rn = 1 UNION ALL SELECT x.* FROM a, LATERAL (SELECT * FROM o WHERE o.ts_id = a.ts_id AND o.rn > a.rn AND o.observed_at >=
  a.observed_at + INTERVAL 1 HOUR ORDER BY o.rn LIMIT 1) x)
SELECT ts_id, count(*) AS kept FROM a GROUP BY 1""")
def stream_throttle(spark, d):
    """Snapshots of a stream in several batches, an hour apart by post; state is the last instant kept."""
    s = event_snapshots(spark, d).select("ts_id", "observed_at", "favourites", "ingest_seq")
    path = _landing(s, "observed_at < timestamp_ntz'2024-01-10'", "observed_at < timestamp_ntz'2024-01-20'")
    stream = spark.readStream.schema(s.schema).option("maxFilesPerTrigger", 1).parquet(path).drop("ingest_seq")
    return _drained(micro.throttled(stream), "append").groupBy("ts_id").agg(F.count("*").alias("kept"))


@query(_SIG + """ SELECT ts_id, status, deleted_source, last_verified_live_at, deleted_lower, deleted_upper, first_seen_at, first_seen_source, seen_sources,
  coalesce(kind, '') AS kind FROM (""" + _STATE + ")")
def stream_merge(spark, d):
    """Landed observations merged batch by batch into a stored data set."""
    files, root = _files(spark), sinks.scratch(spark)
    path = _landing(_signals(event_observations(spark, d)), "seq < 600", files=files)
    stream = spark.readStream.schema(OBSERVATION).option("maxFilesPerTrigger", files).parquet(path)
    micro.run_merge(stream, f"{root}/data", f"{root}/mark").awaitTermination()
    some = landed.posts(spark, f"{root}/data").select("ts_id", "status", "deleted_source", "last_verified_live_at", "deleted_lower", "deleted_upper", "first_seen_at", "first_seen_source", F.array_join("seen_sources", ",").alias("seen_sources"), "kind")
    return _instants(some, "last_verified_live_at", "deleted_lower", "deleted_upper", "first_seen_at")


@query(_SIG + """ SELECT ts_id, status, deleted_source, last_verified_live_at, deleted_lower, deleted_upper, first_seen_at, first_seen_source, seen_sources,
  coalesce(kind, '') AS kind FROM (""" + _STATE + ")")
def merge_after_crash(spark, d):
    """Two batches; the second dies with its months written and nothing committed, is done again, and repeated after its commit: the records of one run."""
    rows, root = _signals(event_observations(spark, d)), sinks.scratch(spark)
    early, late = rows.filter("seq < 600"), rows.filter("seq >= 600")
    micro.merge_into(early, root, "s-0")
    dead = store.Batch(spark, root, "s-1")
    dead.replace_months(list(dead.posts), lambda path: sinks.write_months(landed.posts(spark, root).limit(0), path, sinks.post_month(), F.col("ts_id").cast("bigint")))
    dead.append("deletions", lambda path: sinks.append_log(landed.deletion_log(spark, root), path))
    for _ in range(2):
        micro.merge_into(late, root, "s-1")
    some = landed.posts(spark, root).select("ts_id", "status", "deleted_source", "last_verified_live_at", "deleted_lower", "deleted_upper", "first_seen_at", "first_seen_source", F.array_join("seen_sources", ",").alias("seen_sources"), "kind")
    return _instants(some, "last_verified_live_at", "deleted_lower", "deleted_upper", "first_seen_at")


def _landed_pages(pages: DataFrame, folder: str, at: dt.datetime) -> None:
    """One file for each row of pages (value), all with the given time."""
    spark = pages.sparkSession
    pages.write.option("maxRecordsPerFile", 1).mode("append").text(folder)
    for path in store.glob(spark, f"{folder}/part-*"):
        where, fs = store._fs(spark, path)
        fs.rename(where, store._fs(spark, path.removesuffix(".txt") + ".json")[0])
    for path in store.glob(spark, f"{folder}/part-*.json"):
        where, fs = store._fs(spark, path)
        fs.setTimes(where, int(at.replace(tzinfo=dt.UTC).timestamp() * 1000), -1)


#: Events of a landed page, about: with more of them there are more pages, not larger ones.
PAGE = 1 << 15
_SLOTS = {10: "true", 11: "event_id % 3 = 0", 12: "event_id % 6 = 0"}


@query("""SELECT CAST(110000000000000000 + event_id AS VARCHAR) AS ts_id, CASE WHEN event_id % 3 = 0 AND event_id % 6 <> 0 THEN 'deleted' ELSE 'present' END AS status,
  CASE WHEN event_id % 6 = 0 THEN '2024-03-01T12:00:00Z' ELSE '2024-03-01T10:00:00Z' END AS last_verified_live_at, CASE WHEN event_id % 3 = 0 THEN '2024-03-01T10:00:00Z' END AS deleted_lower,
  CASE WHEN event_id % 3 = 0 THEN '2024-03-01T11:00:00Z' END AS deleted_upper, '2024-03-01T10:00:00Z' AS first_seen_at, CAST(CASE WHEN event_id % 6 = 0 THEN 2 ELSE 1 END AS BIGINT) AS snapshots FROM events""")
def collect_observation_times(spark, d):
    """Pages of 10:00, verifications of 11:00 and pages of 12:00, all landed before the run: each row is an observation of its own file's time."""
    e, root = table(spark, d, "events"), sinks.scratch(spark)
    ts_id = (F.lit(110000000000000000) + F.col("event_id")).cast("string")
    status = F.to_json(F.struct(ts_id.alias("id"), F.lit("2024-02-29T00:00:00Z").alias("created_at"), F.lit("<p>x</p>").alias("content"), F.col("event_id").alias("favourites_count")))
    missing = F.to_json(F.struct(ts_id.alias("id"), F.lit("Record not found").alias("error")))
    count = max(8, e.count() // PAGE)
    for hour, some in _SLOTS.items():
        array = F.concat(F.lit("["), F.array_join(F.collect_list(missing if hour == 11 else status), ","), F.lit("]")).alias("value")
        pages = e.filter(some).groupBy((F.col("event_id") % count).alias("page")).agg(array).select("value")
        folder = f"{root}/landing/{hour}"
        _landed_pages(pages, folder, dt.datetime(2024, 3, 1, hour))
        inbox, fs = store._fs(spark, f"{root}/inbox/primary")
        fs.mkdirs(inbox)
        for path in store.glob(spark, f"{folder}/part-*.json"):
            fs.rename(store._fs(spark, path)[0], store._fs(spark, f"{root}/inbox/primary/{hour}-{path.rsplit('/', 1)[1]}")[0])
    collect.ingest(spark, f"{root}/data", f"{root}/inbox", "primary", "r1", {})
    shots = landed.engagement(spark, f"{root}/data").groupBy("ts_id").agg(F.count("*").alias("snapshots"))
    posts = landed.posts(spark, f"{root}/data").join(shots, "ts_id", "left")
    return _instants(posts.select("ts_id", "status", "last_verified_live_at", "deleted_lower", "deleted_upper", "first_seen_at", F.coalesce("snapshots", F.lit(0).cast("bigint")).alias("snapshots")), "last_verified_live_at", "deleted_lower", "deleted_upper", "first_seen_at")


@query("SELECT doc_id AS id, length(text) AS size, md5(coalesce(text, '')) AS digest, lang FROM documents")
def json_array_by_splits(spark, d):
    """Whole texts in JSON arrays, each task's written as one line of a file, and read by splits of a quarter of a megabyte."""
    docs, root = table(spark, d, "documents"), sinks.scratch(spark)
    quoted = F.concat(F.col("text"), F.lit('{"\\\\}')).alias("text")
    rows = docs.select(F.to_json(F.struct("doc_id", F.struct(F.when(F.col("text").isNotNull(), quoted).alias("body"), "lang").alias("of"))).alias("value")).withColumn("value", F.concat(F.lit(","), "value"))
    rows.write.option("lineSep", " ").text(f"{root}/array")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in before:
        spark.conf.set(k, str(1 << 18))
    try:
        found = json_array.objects(spark, f"{root}/array").select(F.from_json("value", "doc_id long, of struct<body:string,lang:string>").alias("r"))
        found.write.parquet(f"{root}/read")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    text = F.expr("substring(r.of.body, 1, char_length(r.of.body) - 5)")
    return spark.read.schema(found.schema).parquet(f"{root}/read").select(F.col("r.doc_id").alias("id"), F.char_length(text).cast("bigint").alias("size"), F.md5(F.coalesce(text, F.lit("")).cast("binary")).alias("digest"), F.col("r.of.lang").alias("lang"))


@query(_SIG + """ SELECT ts_id, status, deleted_source, last_verified_live_at, deleted_lower, deleted_upper, first_seen_at, first_seen_source, seen_sources,
  coalesce(kind, '') AS kind FROM (""" + _STATE + ")")
def stream_keyed_state(spark, d):
    """Landed observations folded batch by batch into one record a post, held in state: no stored month is read or written."""
    files, root = _files(spark), sinks.scratch(spark)
    path = _landing(_signals(event_observations(spark, d)), "seq < 600", files=files)
    keyed.run_upserts(spark.readStream.schema(OBSERVATION).option("maxFilesPerTrigger", files).parquet(path), f"{root}/data", f"{root}/mark").awaitTermination()
    some = keyed.records(spark, f"{root}/data").select("ts_id", "status", "deleted_source", "last_verified_live_at", "deleted_lower", "deleted_upper", "first_seen_at", "first_seen_source", F.array_join("seen_sources", ",").alias("seen_sources"), "kind")
    return _instants(some, "last_verified_live_at", "deleted_lower", "deleted_upper", "first_seen_at")


# -- logs, feeds, orders and parameters --------------------------------------


@query("""SELECT 'run' || (event_id % 7) AS run_id, event_type AS source, strftime(min(date_trunc('second', ts)), '%Y-%m-%dT%H:%M:%SZ') AS started_at, count(*) AS requests,
  CAST(sum(event_id % 3) AS BIGINT) AS new_posts, min(event_id) % 2 = 0 AS ok, CAST(NULL AS VARCHAR) AS notes FROM events GROUP BY 1, 2""")
def run_log_round_trip(spark, d):
    """Run rows appended as JSON lines, a folder for each run, and read back."""
    e, root = table(spark, d, "events"), sinks.scratch(spark)
    made = e.groupBy(F.concat(F.lit("run"), F.col("event_id") % 7).alias("run_id"), F.col("event_type").alias("source")).agg(
        F.min(times.to_second(F.col("ts"))).alias("started_at"), F.count("*").alias("requests"), F.sum(F.col("event_id") % 3).alias("new_posts"), (F.min("event_id") % 2 == 0).alias("ok"),
    )
    typed = made.select(*[(F.col(f.name) if f.name in made.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in RUN.fields])
    for part in ("run_id < 'run3'", "run_id >= 'run3'"):
        sinks.append_log(typed.filter(part), f"{root}/runs/{'a' if '<' in part else 'b'}")
    return _instants(landed.runs(spark, root).select("run_id", "source", "started_at", "requests", "new_posts", "ok", "notes"), "started_at")


@query("""SELECT CAST(110000000000000000 + doc_id AS VARCHAR) AS ts_id, CAST(doc_id AS INTEGER) AS tracker_id, 'https://tracker.example/statuses/' || doc_id AS url,
  strftime(TIMESTAMP '2024-01-01' + INTERVAL (doc_id) MINUTE, '%Y-%m-%dT%H:%M:%SZ') AS created_at, lang || ' & more' AS title, CASE WHEN doc_id % 2 = 0 THEN '<p>' || source || '</p>' ELSE '' END AS description_html FROM documents""")
def feed_items(spark, d):
    """Documents as items of an RSS feed: a link or else a guid, times in RFC-2822, markup in CDATA, some without a description."""
    docs, root = table(spark, d, "documents"), sinks.scratch(spark)
    at = F.timestamp_add("MINUTE", F.col("doc_id").cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    url = F.concat(F.lit("https://tracker.example/statuses/"), F.col("doc_id"))
    place = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("<link></link><guid>"), url, F.lit("</guid>"))).otherwise(F.concat(F.lit("<link>"), url, F.lit("</link><guid>g</guid>")))
    text = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("<description><![CDATA[<p>"), "source", F.lit("</p>]]></description>"))).otherwise("")
    item = F.concat(
        F.lit("<item><title>"), "lang", F.lit(" &amp; more</title>"), place, F.lit("<truth:originalId>"), (F.lit(110000000000000000) + F.col("doc_id")).cast("string"), F.lit("</truth:originalId><pubDate>"),
        F.date_format(at, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0000</pubDate>"), text, F.lit("</item>"),
    )
    feeds = docs.groupBy(F.col("doc_id") % 8).agg(F.concat(F.lit('<rss xmlns:truth="x"><channel>'), F.array_join(F.collect_list(item), ""), F.lit("</channel></rss>")).alias("value"))
    feeds.select("value").write.option("maxRecordsPerFile", 1).text(f"{root}/feed")
    found = landed.feed_items(spark, f"{root}/feed")
    return _instants(found.withColumnRenamed("created_at_utc", "created_at"), "created_at")


@query("SELECT CAST(event_id AS VARCHAR) AS ts_id, strftime(ts, '%Y-%m') AS month FROM events WHERE event_id % 10 <> 3 ORDER BY event_id LIMIT 150")
def posts_in_numeric_order(spark, d):
    """The first 150 stored posts by number: ids of one to five digits, two months to a folder set."""
    root = sinks.scratch(spark)
    sinks.save_posts(_event_records(spark, d).filter("ts_id % 10 <> 3"), root)
    return landed.sorted_posts(spark, root).limit(150).select("ts_id", times.month_of(F.col("created_at_utc")).alias("month"))


@query(_V + """SELECT CAST(ts_id AS VARCHAR) AS ts_id, kind, et_date FROM (SELECT ts_id, kind, CAST(et_date AS VARCHAR) AS et_date FROM v WHERE CAST(et_date AS VARCHAR) BETWEEN '2024-01-05' AND '2024-01-12' AND kind = 'quote' ORDER BY v.ts_id DESC LIMIT 40)""")
def query_with_parameters(spark, d):
    """SQL over the registered views, its question marks filled, its rows limited."""
    none = spark.createDataFrame([], T.StructType([*ENGAGEMENT.fields, T.StructField("ingest_seq", T.LongType())]))
    views.register(spark, _event_records(spark, d), none, spark.createDataFrame([], landed.DELETION), spark.createDataFrame([], RUN))
    sql = "SELECT ts_id, kind, CAST(et_date AS STRING) AS et_date FROM v_posts_et WHERE et_date BETWEEN ? AND ? AND kind = ? ORDER BY CAST(ts_id AS BIGINT) DESC"
    return cli.run_query(spark, sql, ["2024-01-05", "2024-01-12", "quote"], 40)


@query("""SELECT 'soft' AS severity, 'seen_once' AS code, CAST(NULL AS VARCHAR) AS ts_id, (SELECT count(*) FROM events WHERE event_id % 9 = 4) || ',' || string_agg(t, ', ' ORDER BY t) AS detail
  FROM (SELECT CAST(event_id AS VARCHAR) AS t FROM events WHERE event_id % 9 = 4 ORDER BY t LIMIT 10)""")
def check_names_first_ids(spark, d):
    """One row for many posts: how many, and the first of their ids."""
    ids = table(spark, d, "events").filter("event_id % 9 = 4").select(F.col("event_id").cast("string").alias("ts_id"))
    return checks._sampled(ids, "seen_once").select("severity", "code", "ts_id", "detail")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS ts_id, 'own' AS account FROM orders WHERE o_custkey % 4 = 1")
def cards_of_account(spark, d):
    """Cards of one author among those of four."""
    account = F.element_at(F.array(*[F.lit(a) for a in ("OWN", "own", "owner", "other")]), (F.col("o_custkey") % 4 + 1).cast("int"))
    return landed.of_account(table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("ts_id"), account.alias("account")), "own").select("ts_id", "account")


# -- metrics as SQL table functions ------------------------------------------


def _called(spark, d, sql: str) -> DataFrame:
    """SQL that calls the functions over the events' relations."""
    none = spark.createDataFrame([], T.StructType([*ENGAGEMENT.fields, T.StructField("ingest_seq", T.LongType())]))
    views.register(spark, _event_records(spark, d), none, spark.createDataFrame([], landed.DELETION), spark.createDataFrame([], RUN))
    functions.register(spark)
    return cli.run_query(spark, sql)


_DAYS = "et_date BETWEEN '2024-01-05' AND '2024-01-12'"


@query(_V + f""", a AS (SELECT *, row_number() OVER (ORDER BY created_at_utc, ts_id) AS rn FROM v WHERE {_DAYS}),
h AS (SELECT *, max(rn) OVER (ORDER BY created_at_utc RANGE BETWEEN CURRENT ROW AND INTERVAL 10 MINUTE FOLLOWING) AS hi FROM a),
c AS (SELECT rn AS lo, hi FROM h WHERE hi - rn + 1 >= 5),
i AS (SELECT lo, hi, CASE WHEN lo > coalesce(max(hi) OVER (ORDER BY lo ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) THEN 1 ELSE 0 END AS n FROM c),
k AS (SELECT lo, hi, sum(n) OVER (ORDER BY lo ROWS UNBOUNDED PRECEDING) AS island FROM i), s AS (SELECT min(lo) AS lo, max(hi) AS hi FROM k GROUP BY island)
SELECT x.created_at_et AS start_et, y.created_at_et AS end_et, s.hi - s.lo + 1 AS count,
  (SELECT string_agg(kind || '=' || n, ',' ORDER BY kind) FROM (SELECT kind, count(*) AS n FROM a WHERE rn BETWEEN s.lo AND s.hi GROUP BY 1)) AS kinds FROM s JOIN a x ON x.rn = s.lo JOIN a y ON y.rn = s.hi""")
def function_bursts(spark, d):
    found = _called(spark, d, "SELECT * FROM bursts('2024-01-05', '2024-01-12')")
    return found.withColumn("kinds", F.array_join(F.transform(F.array_sort(F.map_entries("kinds")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ","))


@query(_V + f"""SELECT 'account ' || reblog_of_acct AS name, count(*) AS n FROM v WHERE kind = 'reblog' AND {_DAYS} GROUP BY 1 QUALIFY row_number() OVER (ORDER BY n DESC, name) <= 3
UNION ALL SELECT 'domain d' || user_id, count(*) AS n FROM v WHERE ts_id % 3 = 0 AND {_DAYS} GROUP BY user_id QUALIFY row_number() OVER (ORDER BY count(*) DESC, 'd' || user_id) <= 10
UNION ALL SELECT 'hour ' || r.x, count(et_hour) FROM range(24) r(x) LEFT JOIN (SELECT * FROM v WHERE {_DAYS}) ON et_hour = r.x GROUP BY r.x
UNION ALL SELECT 'overnight', count(*) FROM v WHERE et_hour < 6 AND {_DAYS} UNION ALL SELECT 'media image', count(*) FROM v WHERE ts_id % 4 = 0 AND {_DAYS}
UNION ALL SELECT 'deleted', count(*) FROM v WHERE is_deleted = 1 AND {_DAYS} UNION ALL SELECT 'edited', count(*) FROM v WHERE edited_at IS NOT NULL AND {_DAYS}""")
def function_counts(spark, d):
    """Every function with a count, by position, by name and with its defaults, in one statement."""
    days = "'2024-01-05', '2024-01-12'"
    return _called(spark, d, f"""SELECT 'account ' || account AS name, n FROM top_accounts({days}, 3) UNION ALL SELECT 'domain ' || domain, n FROM link_domains(b => '2024-01-12', a => '2024-01-05')
        UNION ALL SELECT 'hour ' || et_hour, n FROM hour_histogram({days}) UNION ALL SELECT 'overnight', overnight FROM overnight_share({days}) UNION ALL SELECT 'media ' || type, n FROM media_items({days})
        UNION ALL SELECT 'deleted', count(*) FROM deleted_posts({days}) UNION ALL SELECT 'edited', count(*) FROM edited_posts({days})""")


@query(_V + """, c AS (SELECT CAST(x AS DATE) AS day FROM range(DATE '2023-12-25', DATE '2024-01-13', INTERVAL 1 DAY) r(x))
SELECT strftime(day, '%Y-%m-%d') AS et_date, count(*) FILTER (kind = 'original') AS original, count(*) FILTER (kind = 'quote') AS quote, count(*) FILTER (kind = 'reblog') AS reblog, count(*) FILTER (kind = 'reply') AS reply,
  count(ts_id) AS total, CAST(coalesce(sum(is_deleted), 0) AS BIGINT) AS deleted FROM c LEFT JOIN v ON et_date = strftime(day, '%Y-%m-%d') GROUP BY day""")
def function_posts_by_day(spark, d):
    return _text(_called(spark, d, "SELECT * FROM posts_by_day('2023-12-25', '2024-01-12')"), "et_date")
