"""Registered queries of the engine's own operators over the driver's tables, each with its SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.adapters import event_observations, event_posts, event_snapshots, order_media, order_posts, page_posts, table
from tidelog.functions import texts, times
from tidelog.operators import checks, merge, metrics, sequences, throttle, validate
from tidelog.plans import views

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

#: events as posts
_V = """WITH p AS (
  SELECT event_id AS ts_id, date_trunc('second', ts) AS created_at_utc, user_id, value,
    ((date_trunc('second', ts) AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') AS et,
    CASE event_type WHEN 'view' THEN 'original' WHEN 'click' THEN 'quote' WHEN 'purchase' THEN 'reblog' WHEN 'signup' THEN 'reply' ELSE event_type END
  AS kind,
    CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END AS is_deleted
  FROM events),
v AS (
  SELECT *, strftime(et, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch(et) - epoch(created_at_utc) = -14400 THEN '-04:00' ELSE '-05:00' END AS
  created_at_et,
    CAST(CAST(et AS DATE) AS VARCHAR) AS et_date, CAST(hour(et) AS INTEGER) AS et_hour, CAST(isodow(et) - 1 AS INTEGER) AS et_dow,
    CASE WHEN kind = 'reblog' THEN 'user' || user_id END AS reblog_of_acct,
    CASE WHEN event_id17 = 0 THEN created_at_utc + INTERVAL 90 SECOND END AS edited_at
  FROM (SELECT *, ts_id % 17 AS event_id17 FROM p))
"""
#: orders as posts, with their shipping bounds
_O = """WITH b AS (SELECT l_orderkey, min(l_shipdate) AS lo, max(l_shipdate) AS up FROM lineitem GROUP BY 1),
o AS (SELECT o_orderkey AS ts_id, o_custkey, o_orderdate AS created, CASE WHEN o_orderstatus = 'F' THEN 'deleted' ELSE 'present' END AS status,
  o_orderpriority AS kind, lo, up
  FROM orders LEFT JOIN b ON o_orderkey = l_orderkey)
"""
#: events as observations of users
_B = """WITH r AS (
  SELECT user_id, event_id AS seq, date_trunc('second', ts) AS observed_at, CAST(props->>'$.k' AS INTEGER) AS k,
    CASE event_id % 3 WHEN 0 THEN 'primary' WHEN 1 THEN 'tracker' ELSE 'bulk' END AS source, CASE event_id % 3 WHEN 0 THEN 3 WHEN 1 THEN 2 ELSE 1 END
  AS rank,
    CASE event_id % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS crank,
    CASE WHEN CAST(props->>'$.k' AS INTEGER) % 3 = 0 THEN '' ELSE event_type END AS value
  FROM events)
"""
#: events as engagement snapshots
_S = """WITH s AS (SELECT user_id || ':' || event_type AS ts_id, date_trunc('second', ts) AS observed_at, event_id AS ingest_seq, CAST(props->>'$.k' AS
  BIGINT) AS favourites, event_type AS kind FROM events)
"""
_MIN = "(epoch_us({1}) - epoch_us({0})) / 60000000.0"


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        name = f.__name__.lstrip("_")
        _QUERIES[name] = f
        if sql is not None:
            _SQL[name] = sql
        return f

    return add


def _text(df: DataFrame, *days: str) -> DataFrame:
    return df.withColumns({d: F.col(d).cast("string") for d in days})


def _minutes(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# -- time and counts ---------------------------------------------------------


@query(_V + "SELECT et_hour, count(*) AS n FROM v GROUP BY 1")
def hour_histogram_et(spark, d):
    return metrics.hours(event_posts(spark, d))


@query(_V + """SELECT CAST(h AS INTEGER) AS et_hour, count(v.ts_id) AS n FROM range(24) t(h) LEFT JOIN v ON v.et_hour = h AND et_date BETWEEN '2024-01-05' AND
  '2024-01-06' GROUP BY 1""")
def hour_histogram_dense(spark, d):
    return metrics.hour_histogram(event_posts(spark, d), "2024-01-05", "2024-01-06")


_DAYS = "CAST(count(*) FILTER (kind = 'original') AS BIGINT) AS original, count(*) FILTER (kind = 'quote') AS quote, count(*) FILTER (kind = 'reblog') AS reblog, count(*) FILTER (kind = 'reply') AS reply, count(*) AS total, CAST(sum(is_deleted) AS BIGINT) AS deleted"


@query(_V + f"SELECT et_date, {_DAYS} FROM v GROUP BY 1")
def volume_by_day(spark, d):
    return _text(metrics.volume_by_day(event_posts(spark, d)), "et_date")


@query(_V + f""", c AS (SELECT et_date, {_DAYS} FROM v GROUP BY 1) SELECT CAST(CAST(x AS DATE) AS VARCHAR) AS et_date, coalesce(original, 0) AS original,
  coalesce(quote, 0) AS quote, coalesce(reblog, 0) AS reblog, coalesce(reply, 0) AS reply, coalesce(total, 0) AS total, coalesce(deleted, 0) AS
  deleted FROM generate_series(DATE '2023-12-28', DATE '2024-01-10', INTERVAL 1 DAY) t(x) LEFT JOIN c ON c.et_date = CAST(CAST(x AS DATE) AS VARCHAR)""")
def posts_by_day_dense(spark, d):
    return _text(metrics.posts_by_day(event_posts(spark, d), "2023-12-28", "2024-01-10"), "et_date")


@query(_V + """SELECT CAST(sum(CASE WHEN et_hour BETWEEN 0 AND 5 THEN 1 ELSE 0 END) AS BIGINT) AS overnight, count(*) AS total, round(sum(CASE WHEN et_hour BETWEEN 0
  AND 5 THEN 1 ELSE 0 END) / count(*), 6) AS share FROM v""")
def overnight_share(spark, d):
    return metrics.overnight_share(event_posts(spark, d)).withColumn("share", F.round("share", 6))


@query(_V + """SELECT CAST(coalesce(sum(CASE WHEN et_hour < 6 THEN 1 ELSE 0 END), 0) AS BIGINT) AS overnight, count(*) AS total, sum(CASE WHEN et_hour < 6 THEN 1
  ELSE 0 END) / nullif(count(*), 0) AS share
FROM v WHERE et_date BETWEEN '2031-01-01' AND '2031-01-02'""")
def overnight_share_empty(spark, d):
    return metrics.overnight_share(event_posts(spark, d), "2031-01-01", "2031-01-02")


@query(_V + "SELECT kind, count(*) AS n, CAST(sum(is_deleted) AS BIGINT) AS deleted FROM v GROUP BY 1")
def kinds_mix(spark, d):
    return metrics.kinds_mix(event_posts(spark, d))


@query(_V + "SELECT ts_id, created_at_et, et_date, et_hour, et_dow FROM v")
def et_fields(spark, d):
    return _text(event_posts(spark, d).select("ts_id", "created_at_et", "et_date", "et_hour", "et_dow"), "et_date")


@query(_V + """SELECT strftime(created_at_utc, '%Y-%m') AS month, count(*) AS n FROM v GROUP BY 1 UNION ALL SELECT strftime(o_orderdate, '%Y-%m'), count(*) FROM
  orders GROUP BY 1""")
def month_partition_counts(spark, d):
    both = event_posts(spark, d).select("created_at_utc").union(order_posts(spark, d).select("created_at_utc"))
    return both.groupBy(times.month_of(F.col("created_at_utc")).alias("month")).agg(F.count("*").alias("n"))


@query("""WITH w AS (SELECT DISTINCT strftime(o_orderdate, '%G-W%V') AS week FROM orders)
SELECT week, CAST(m AS VARCHAR) AS monday, CAST(m + 6 AS VARCHAR) AS sunday FROM (SELECT week, CAST(strptime(week || '-1', '%G-W%V-%u') AS DATE) AS m
  FROM w)""")
def iso_week_bounds(spark, d):
    day = F.col("created_at_utc").cast("date")
    thursday = F.date_add(F.date_sub(day, F.weekday(day)), 3)
    weeks = order_posts(spark, d).select(F.concat(F.year(thursday), F.lit("-W"), F.lpad(F.weekofyear(day).cast("string"), 2, "0")).alias("week")).distinct()
    monday, sunday = times.week_bounds(F.col("week"))
    return weeks.select("week", monday.cast("string").alias("monday"), sunday.cast("string").alias("sunday"))


@query(_V + """SELECT count(*) FILTER (et_date BETWEEN '2024-01-22' AND '2024-01-28') AS window_total, count(*) FILTER (et_date BETWEEN '2024-01-08' AND
  '2024-01-21') AS trailing_total,
count(*) FILTER (et_date BETWEEN '2024-01-08' AND '2024-01-21') / 2.0 AS trailing_weekly_avg FROM v""")
def baseline_trailing(spark, d):
    return metrics.trailing_baseline(event_posts(spark, d), "2024-01-22", "2024-01-28", weeks=2)


@query(_V + """, h AS (SELECT et_hour, count(*) AS n FROM v GROUP BY 1) SELECT et_hour, n, repeat('#', CAST(round_even(n / (SELECT max(n) FROM h) * 30, 0) AS
  INTEGER)) AS bar FROM h""")
def bar_chart_rows(spark, d):
    found = metrics.hours(event_posts(spark, d))
    peak = found.agg(F.max("n").alias("peak"))
    return found.join(F.broadcast(peak)).select("et_hour", "n", texts.bar(F.col("n"), F.col("peak")).alias("bar"))


@query("""WITH t AS (SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+02:00' AS s, ts FROM events)
SELECT event_id, strftime(date_trunc('second', ts) - INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%SZ') AS iso FROM t""")
def parse_normalize_iso(spark, d):
    e = table(spark, d, "events")
    text = F.concat(F.replace(F.substring(F.col("ts").cast("string"), 1, 19), F.lit(" "), F.lit("T")), F.lit("+02:00"))
    return e.select("event_id", times.to_iso(times.parse_instant(text)).alias("iso"))


@query(_V + "SELECT ts_id, strftime(created_at_utc - INTERVAL (second(created_at_utc)) SECOND, '%Y-%m-%dT%H:%M:%SZ') AS iso FROM v")
def parse_eastern_text(spark, d):
    some = event_posts(spark, d).select("ts_id", times.eastern(F.col("created_at_utc")).alias("w"))
    text = F.concat_ws(" ", F.element_at(F.array(*[F.lit(m.title()) for m in times.MONTH_NAMES[:12]]), F.month("w")), F.concat(F.dayofmonth("w"), F.lit(",")), F.concat(F.year("w"), F.lit(",")),
                       F.concat((F.hour("w") + 11) % 12 + 1, F.lit(":"), F.lpad(F.minute("w").cast("string"), 2, "0")), F.when(F.hour("w") < 12, "AM").otherwise("PM"), F.lit("EST"))
    return some.select("ts_id", times.to_iso(times.parse_eastern_text(text)).alias("iso"))


@query("SELECT event_id, to_base64(encode('{\"status_created_at\":\"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '\",\"_pointsToNextItems\":true}')) AS cursor FROM events")
def page_cursor(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", texts.encode_cursor(F.substring(F.col("ts").cast("string"), 1, 19)).alias("cursor"))


# -- media, accounts, domains ------------------------------------------------


@query("""WITH l AS (SELECT CASE l_returnflag WHEN 'A' THEN 'image' WHEN 'N' THEN 'video' ELSE 'gifv' END AS type FROM lineitem)
SELECT type, count(*) AS n FROM l GROUP BY 1 UNION ALL SELECT 'no_media_posts', count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM
  lineitem)""")
def media_mix_items_union(spark, d):
    posts = order_posts(spark, d)
    return metrics.media_items(views.derived(posts), views.media_rows(posts))


@query("""WITH l AS (SELECT l_orderkey, list_sort(list(DISTINCT CASE l_returnflag WHEN 'A' THEN 'image' WHEN 'N' THEN 'video' ELSE 'gifv' END)) AS ts FROM
  lineitem GROUP BY 1)
SELECT count(*) FILTER (ts IS NULL) AS no_media, count(*) FILTER (ts = ['image']) AS image_only, count(*) FILTER (ts = ['video']) AS video_only,
  count(*) FILTER (ts IS NOT NULL AND ts <> ['image'] AND ts <> ['video']) AS mixed
FROM orders LEFT JOIN l ON o_orderkey = l_orderkey""")
def media_mix_sets(spark, d):
    return metrics.media_sets(views.derived(order_posts(spark, d)))


@query("""SELECT CASE l_returnflag WHEN 'A' THEN 'image' WHEN 'N' THEN 'video' ELSE 'gifv' END AS type, count(*) AS n FROM lineitem JOIN orders ON o_orderkey =
  l_orderkey
WHERE o_orderdate BETWEEN DATE '1997-01-01' AND DATE '1997-06-30' GROUP BY 1""")
def media_join_between(spark, d):
    return metrics.media_items_between(order_posts(spark, d), order_media(spark, d), "1997-01-01", "1997-06-30")


@query("""WITH l AS (SELECT l_orderkey, CAST(count(*) AS INTEGER) AS media_count, string_agg(CASE l_returnflag WHEN 'A' THEN 'image' WHEN 'N' THEN 'video' ELSE
  'gifv' END, ',' ORDER BY l_linenumber, CASE l_returnflag WHEN 'A' THEN 'image' WHEN 'N' THEN 'video' ELSE 'gifv' END) AS media_types FROM lineitem
  GROUP BY 1)
SELECT o_orderkey AS ts_id, coalesce(media_count, 0) AS media_count, coalesce(media_types, '') AS media_types, CAST(length(o_orderpriority) AS
  INTEGER) AS content_len FROM orders LEFT JOIN l ON o_orderkey = l_orderkey""")
def media_columns(spark, d):
    return views.derived(order_posts(spark, d)).select("ts_id", "media_count", "media_types", "content_len")


@query(_V + "SELECT reblog_of_acct AS account, count(*) AS n FROM v WHERE kind = 'reblog' GROUP BY 1 ORDER BY n DESC, account LIMIT 10")
def top_accounts(spark, d):
    return metrics.top_accounts(event_posts(spark, d))


_DOMAIN = r"regexp_replace(lower(regexp_extract(url, '^[a-zA-Z]+://([^/:?#]+)', 1)), '^www\.', '')"


@query(f"SELECT {_DOMAIN} AS domain, count(*) AS n FROM pages WHERE {_DOMAIN} <> '' GROUP BY 1 ORDER BY n DESC, domain LIMIT 10")
def link_domains(spark, d):
    return metrics.link_domains(page_posts(spark, d))


@query(f"SELECT page_id AS ts_id, {_DOMAIN} AS card_domain FROM pages")
def card_domain(spark, d):
    return page_posts(spark, d).select("ts_id", "card_domain")


@query(r"""WITH n AS (SELECT p_partkey, p_name || CASE p_partkey % 7 WHEN 0 THEN '.MP4' WHEN 1 THEN '.jpg?x=1' WHEN 2 THEN '.webp' WHEN 3 THEN '.mov' WHEN 4 THEN
  '.txt' WHEN 5 THEN '' ELSE '.qt' END AS u FROM part),
p AS (SELECT p_partkey, string_split(string_split(u, '?')[1], '.') AS x FROM n), e AS (SELECT p_partkey, CASE WHEN len(x) > 1 THEN lower(x[-1]) END AS x FROM p)
SELECT p_partkey, CASE WHEN x IN ('mp4', 'm3u8', 'mov', 'qt') THEN 'video' WHEN x IN ('jpg', 'jpeg', 'png', 'webp', 'gif') THEN 'image' ELSE 'unknown'
  END AS type FROM e""")
def media_type_by_ext(spark, d):
    end = F.get(F.array(*[F.lit(x) for x in (".MP4", ".jpg?x=1", ".webp", ".mov", ".txt", "", ".qt")]), (F.col("p_partkey") % 7).cast("int"))
    return table(spark, d, "part").select("p_partkey", texts.media_type_of(F.concat("p_name", end)).alias("type"))


# -- gaps and bursts ---------------------------------------------------------

_LAG = ", g AS (SELECT *, lag(created_at_utc) OVER w AS pu, lag(created_at_et) OVER w AS pe FROM v WINDOW w AS (ORDER BY created_at_utc, ts_id))"


@query(_V + _LAG + f""" SELECT ts_id, created_at_et, kind, round({_MIN.format('pu', 'created_at_utc')}, 6) AS gap_min FROM g WHERE pu IS NOT NULL AND
  epoch_us(created_at_utc) - epoch_us(pu) <= 600000000""")
def burst_pairs(spark, d):
    return _minutes(sequences.close_pairs(event_posts(spark, d)), "gap_min")


@query(_V + _LAG + f""" SELECT pe AS from_et, created_at_et AS to_et, round({_MIN.format('pu', 'created_at_utc')}, 6) AS gap_min FROM g WHERE pu IS NOT NULL ORDER BY gap_min
  DESC, created_at_utc, ts_id LIMIT 20""")
def longest_gaps_top20(spark, d):
    return _minutes(sequences.longest_gaps(event_posts(spark, d)), "gap_min")


@query(_V + _LAG.replace("FROM v", "FROM v WHERE et_date BETWEEN '2024-01-05' AND '2024-01-12'") + f""" SELECT round({_MIN.format('pu', 'created_at_utc')}, 6) AS gap_min, pe AS from_et, created_at_et AS to_et FROM g WHERE pu IS NOT NULL ORDER BY gap_min
  DESC, created_at_utc, ts_id LIMIT 1""")
def longest_silence(spark, d):
    return _minutes(sequences.longest_silence(metrics.between(event_posts(spark, d), "2024-01-05", "2024-01-12")), "gap_min")


@query(_V + """, a AS (SELECT *, row_number() OVER (ORDER BY created_at_utc, ts_id) AS rn FROM v),
h AS (SELECT *, max(rn) OVER (ORDER BY created_at_utc RANGE BETWEEN CURRENT ROW AND INTERVAL 10 MINUTE FOLLOWING) AS hi FROM a),
c AS (SELECT rn AS lo, hi FROM h WHERE hi - rn + 1 >= 5),
i AS (SELECT lo, hi, CASE WHEN lo > coalesce(max(hi) OVER (ORDER BY lo ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) THEN 1 ELSE 0 END AS n
  FROM c),
k AS (SELECT lo, hi, sum(n) OVER (ORDER BY lo ROWS UNBOUNDED PRECEDING) AS island FROM i),
s AS (SELECT min(lo) AS lo, max(hi) AS hi FROM k GROUP BY island)
SELECT x.created_at_et AS start_et, y.created_at_et AS end_et, s.hi - s.lo + 1 AS count, (SELECT string_agg(kind || '=' || n, ',' ORDER BY kind) FROM
  (SELECT kind, count(*) AS n FROM a WHERE rn BETWEEN s.lo AND s.hi GROUP BY 1)) AS kinds
FROM s JOIN a x ON x.rn = s.lo JOIN a y ON y.rn = s.hi""")
def burst_islands(spark, d):
    found = sequences.bursts(event_posts(spark, d))
    listed = F.array_join(F.transform(F.array_sort(F.map_entries("kinds")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return found.withColumn("kinds", listed)


@query("""WITH c AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1),
f AS (SELECT CAST(x AS DATE) AS day, coalesce(n, 0) AS n FROM (SELECT unnest(generate_series((SELECT min(day) - 28 FROM c), (SELECT max(day) FROM c),
  INTERVAL 1 DAY)) AS x) LEFT JOIN c ON c.day = CAST(x AS DATE)),
m AS (SELECT *, median(n) OVER w AS med, count(*) OVER w AS k FROM f WINDOW w AS (ORDER BY day ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING))
SELECT CAST(day AS VARCHAR) AS et_date, n AS count, CAST(med AS DOUBLE) AS trailing_median FROM m WHERE k = 28 AND med > 0 AND n > 2 * med AND n >= 3""")
def spike_days(spark, d):
    return _text(sequences.spike_days(order_posts(spark, d), factor=2.0, least=3), "et_date")


@query("""WITH i AS (SELECT DISTINCT event_id AS id FROM events WHERE event_id % 13 <> 5)
SELECT CAST(x AS BIGINT) AS id FROM (SELECT unnest(range((SELECT min(id) FROM i), (SELECT max(id) + 1 FROM i))) AS x) WHERE x NOT IN (SELECT id FROM
  i)""")
def gap_in_id_sequence(spark, d):
    return sequences.id_gaps(table(spark, d, "events").select(F.col("event_id").alias("id")).filter("id % 13 <> 5"), "id")


_SPARSE = "110000000000000000 + event_id * 99999999937 + event_id % 7"


@query(f"""WITH i AS (SELECT DISTINCT {_SPARSE} AS id FROM events WHERE event_id % 13 <> 5 UNION SELECT event_id FROM events WHERE event_id % 3 = 0),
p AS (SELECT id, lag(id) OVER (ORDER BY id) AS p FROM i) SELECT p + 1 AS first, id - 1 AS last FROM p WHERE p < id - 1""")
def id_gap_ranges(spark, d):
    """Runs of missing ids among dense small and sparse 18-digit ones."""
    e = table(spark, d, "events")
    sparse = e.filter("event_id % 13 <> 5").select(F.expr(f"CAST({_SPARSE.replace('110000000000000000', '110000000000000000L').replace('99999999937', '99999999937L')} AS BIGINT) AS id"))
    return sequences.id_gap_ranges(sparse.unionByName(e.filter("event_id % 3 = 0").select(F.col("event_id").alias("id"))), "id")


# -- deletions, engagement, edits --------------------------------------------

_LIFE = f"round({_MIN.format('created', 'up')}, 6)"
_WINDOW = f"round({_MIN.format('lo', 'up')}, 6)"


@query(_O + f"SELECT ts_id, CASE WHEN status = 'deleted' THEN {_LIFE} END AS lifetime_min FROM o")
def lifetime_minutes(spark, d):
    return _minutes(views.deletion_columns(order_posts(spark, d)).select("ts_id", "lifetime_min"), "lifetime_min")


@query(_O + f"SELECT ts_id, {_WINDOW} AS deletion_window_min FROM o")
def deletion_window(spark, d):
    return _minutes(views.deletion_columns(order_posts(spark, d)).select("ts_id", "deletion_window_min"), "deletion_window_min")


@query(_O + f"""SELECT ts_id, kind, {_LIFE} AS lifetime_min, {_WINDOW} AS deletion_window_min, substr(kind, 1, 120) AS snippet FROM o WHERE status = 'deleted' AND
  created BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'""")
def deletion_listing(spark, d):
    view = views.deletion_columns(order_posts(spark, d)).withColumns({"created_at_et": F.lit(""), "deleted_source": F.lit("")})
    found = metrics.deletion_listing(views.deletions(view), "1996-01-01", "1996-12-31").select("ts_id", "kind", "lifetime_min", "deletion_window_min", "snippet")
    return _minutes(found, "lifetime_min", "deletion_window_min")


_LATEST = ", l AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY ts_id ORDER BY observed_at DESC, ingest_seq DESC) = 1)"


@query(_S + _LATEST + " SELECT ts_id, ingest_seq, favourites FROM l")
def engagement_latest(spark, d):
    return views.engagement_latest(event_snapshots(spark, d)).select("ts_id", "ingest_seq", "favourites")


@query(_S + _LATEST + " SELECT ts_id, ingest_seq, favourites FROM l")
def engagement_latest_ranked(spark, d):
    return views.engagement_latest_ranked(event_snapshots(spark, d)).select("ts_id", "ingest_seq", "favourites")


@query(_S + _LATEST + """ SELECT kind, count(*) AS n, CAST(sum(favourites) AS BIGINT) AS favourites FROM l JOIN (SELECT DISTINCT ts_id AS t, kind AS k2 FROM s) ON t = ts_id
  GROUP BY 1""")
def engagement_latest_join(spark, d):
    rows = event_snapshots(spark, d)
    latest = views.engagement_latest(rows).select("ts_id", "favourites")
    return latest.join(rows.select("ts_id", "kind").distinct(), "ts_id").groupBy("kind").agg(F.count("*").alias("n"), F.sum("favourites").alias("favourites"))


@query(_S + """, t AS (SELECT kind, favourites, ntile(100) OVER (PARTITION BY kind ORDER BY favourites) AS pct FROM s) SELECT kind, count(*) AS n, min(favourites)
  FILTER (pct >= 50) AS favourites_p50, min(favourites) FILTER (pct >= 90) AS favourites_p90 FROM t GROUP BY 1""")
def engagement_ntile(spark, d):
    rows = event_snapshots(spark, d).withColumn("ts_id", F.col("ingest_seq"))
    return metrics.engagement_tiles(rows, rows.select("ts_id", "favourites"))


@query("SELECT event_type AS kind, count(*) AS n, quantile_disc(value, 0.5) AS value_median, quantile_disc(value, 0.9) AS value_p90 FROM events GROUP BY 1")
def engagement_percentile_disc(spark, d):
    posts = table(spark, d, "events").select(F.col("event_id").alias("ts_id"), F.col("event_type").alias("kind"), "value")
    return metrics.engagement_stats(posts.select("ts_id", "kind"), posts.select("ts_id", "value"), ("value",))


@query(_V + """SELECT ts_id, created_at_et, kind, strftime(edited_at, '%Y-%m-%dT%H:%M:%SZ') AS edited_at FROM v WHERE edited_at IS NOT NULL AND et_date BETWEEN
  '2024-01-05' AND '2024-01-12'""")
def edits_listing(spark, d):
    return metrics.edits(event_posts(spark, d), "2024-01-05", "2024-01-12").withColumn("edited_at", times.to_iso(F.col("edited_at")))


# -- integrity ---------------------------------------------------------------


@query(_S + """SELECT ts_id, count(*) AS n FROM (SELECT ts_id, observed_at - lag(observed_at) OVER (PARTITION BY ts_id ORDER BY observed_at) AS g FROM s) WHERE g <
  INTERVAL 60 MINUTE GROUP BY 1""")
def spacing_violations(spark, d):
    return checks.too_close(event_snapshots(spark, d)).groupBy("ts_id").agg(F.count("*").alias("n"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(spark, d):
    found = checks.duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])
    return found.select(F.col("ts_id").cast("bigint").alias("l_orderkey"), F.split("detail", ",")[0].cast("int").alias("l_linenumber"), F.split("detail", ",")[1].cast("bigint").alias("n"))


@query("SELECT o_custkey, count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 7 <> 0) GROUP BY 1")
def fk_violations(spark, d):
    known = table(spark, d, "customer").filter("c_custkey % 7 <> 0").select(F.col("c_custkey").alias("o_custkey"))
    bad = checks.unknown_keys(table(spark, d, "orders"), known, "o_custkey", "unknown_customer", "o_orderkey")
    return bad.groupBy(F.col("ts_id").cast("bigint").alias("o_custkey")).agg(F.count("*").alias("n"))


@query(_O + "SELECT ts_id FROM o WHERE created > up")
def created_after_upper(spark, d):
    return checks.created_after_upper(order_posts(spark, d)).select(F.col("ts_id").cast("bigint").alias("ts_id"))


@query(_O + "SELECT ts_id FROM o WHERE up < lo OR (lo + INTERVAL 30 DAY > up AND ts_id % 5 = 0 AND lo <> up)")
def inverted_bounds(spark, d):
    posts = order_posts(spark, d)
    swap = (F.timestamp_add("DAY", F.lit(30), F.col("deleted_lower")) > F.col("deleted_upper")) & (F.col("ts_id") % 5 == 0)
    turned = posts.withColumns({"deleted_lower": F.when(swap, F.col("deleted_upper")).otherwise(F.col("deleted_lower")), "deleted_upper": F.when(swap, F.col("deleted_lower")).otherwise(F.col("deleted_upper"))})
    return checks.inverted_bounds(turned).select(F.col("ts_id").cast("bigint").alias("ts_id"))


@query("""WITH f AS (SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderdate BETWEEN DATE '1997-01-01' AND DATE '1997-12-31')
SELECT o_orderkey AS ts_id FROM orders WHERE o_orderstatus <> 'F' AND o_orderdate BETWEEN (SELECT min(o_orderdate) FROM f) AND (SELECT
  max(o_orderdate) FROM f) AND o_orderkey NOT IN (SELECT o_orderkey FROM f) ORDER BY 1 LIMIT 25""")
def missing_candidates_anti(spark, d):
    posts = order_posts(spark, d).withColumn("last_verified_live_at", F.col("created_at_utc"))
    fetched = posts.filter("ts_id % 5 <> 0 and et_date between date'1997-01-01' and date'1997-12-31'")
    return merge.deletion_candidates(posts, fetched, 25)


@query("""SELECT count(*) AS ids, count(*) FILTER (o_custkey % 3 <> 0) AS known, count(*) = count(*) FILTER (o_custkey % 3 <> 0) AS all_known FROM (SELECT
  DISTINCT o_custkey FROM orders)""")
def semi_known_ids(spark, d):
    page = table(spark, d, "orders").select(F.col("o_custkey").alias("ts_id")).distinct()
    return merge.all_known(page, table(spark, d, "customer").filter("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("ts_id")))


#: every fourth user is seen by one source, every other fourth by two
_SEEN = """WITH e AS (SELECT user_id, date_trunc('second', ts) AS t, CASE WHEN user_id % 4 = 0 THEN ['primary', 'tracker', 'bulk'][1 + user_id // 4 % 3]
  WHEN user_id % 4 = 1 THEN ['primary', 'bulk'][1 + event_id % 2] ELSE ['primary', 'tracker', 'bulk'][1 + event_id % 3] END AS source FROM events),
u AS (SELECT user_id, list_sort(list(DISTINCT source)) AS ss, min(t) + INTERVAL (user_id % 40) DAY AS created FROM e GROUP BY 1)
"""


def _seen(spark, d):
    e, user = table(spark, d, "events"), F.col("user_id")
    pick = lambda names, i: F.get(F.array(*[F.lit(n) for n in names]), i.cast("int"))
    three, two = ("primary", "tracker", "bulk"), ("primary", "bulk")
    source = F.when(user % 4 == 0, pick(three, F.floor(user / 4) % 3)).when(user % 4 == 1, pick(two, F.col("event_id") % 2)).otherwise(pick(three, F.col("event_id") % 3))
    rows = e.select("user_id", source.alias("source"), times.to_second(F.col("ts")).alias("at"))
    found = rows.groupBy(user.alias("ts_id")).agg(F.array_sort(F.collect_set("source")).alias("seen_sources"), F.min("at").alias("at"))
    return found.withColumn("created_at_utc", F.timestamp_add("DAY", (F.col("ts_id") % 40).cast("int"), F.col("at")))


@query(_SEEN + "SELECT user_id AS ts_id FROM u WHERE len(ss) = 1 AND created < TIMESTAMP '2024-01-30 00:00:00' AND created >= TIMESTAMP '2024-01-01 00:00:00'")
def single_source_recent(spark, d):
    return checks.single_source_recent(_seen(spark, d), F.lit("2024-01-31 00:00:00").cast("timestamp_ntz"))


@query(_SEEN + "SELECT array_to_string(ss, ',') AS sources, count(*) AS n FROM u GROUP BY 1")
def source_combinations(spark, d):
    return metrics.source_combinations(_seen(spark, d))


@query("""WITH x AS (SELECT o_orderkey AS id, o_orderstatus AS a FROM orders WHERE o_orderkey % 4 <> 1), y AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey %
  10 = 0 THEN 'X' ELSE o_orderstatus END AS b FROM orders WHERE o_orderkey % 6 <> 2)
SELECT a AS kind_a, b AS kind_b, count(*) AS n FROM x JOIN y USING (id) GROUP BY 1, 2""")
def kind_confusion_matrix(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("ts_id"), F.col("o_orderstatus").alias("kind"))
    return validate.confusion(o.filter("ts_id % 4 <> 1"), o.filter("ts_id % 6 <> 2").withColumn("kind", F.when(F.col("ts_id") % 10 == 0, "X").otherwise(F.col("kind"))))


@query("""SELECT count(*) FILTER (a AND b) AS both, count(*) FILTER (a AND NOT b) AS only_a, count(*) FILTER (b AND NOT a) AS only_b FROM (SELECT o_orderkey % 4
  <> 1 AS a, o_orderkey % 6 <> 2 AS b FROM orders)""")
def id_overlap_full_outer(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("ts_id"))
    return validate.overlap(o.filter("ts_id % 4 <> 1"), o.filter("ts_id % 6 <> 2"))


@query("""SELECT 'both' AS part, count(*) AS n FROM (SELECT c_custkey FROM customer WHERE c_custkey % 3 <> 0 INTERSECT SELECT o_custkey FROM orders)
UNION ALL SELECT 'without', count(*) FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders)""")
def id_set_ops(spark, d):
    c, o = table(spark, d, "customer").select(F.col("c_custkey").alias("id")), table(spark, d, "orders").select(F.col("o_custkey").alias("id"))
    count = lambda name, df: df.agg(F.lit(name).alias("part"), F.count("*").alias("n"))
    return count("both", c.filter("id % 3 <> 0").intersect(o)).unionByName(count("without", c.subtract(o)))


@query("SELECT c_custkey AS id FROM customer ORDER BY md5('1:' || c_custkey), c_custkey LIMIT 50")
def seeded_sample(spark, d):
    return validate.seeded_sample(table(spark, d, "customer").select(F.col("c_custkey").alias("id")), "id", 50, seed=1)


@query("""WITH x AS (SELECT o_orderkey AS id, o_orderpriority AS a, o_orderpriority || CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE ' and more' END AS b FROM
  orders WHERE o_orderkey % 4 <> 1),
s AS (SELECT * FROM x ORDER BY md5('1:' || id), id LIMIT 300),
n AS (SELECT substr(regexp_replace(lower(a), '[^a-z0-9]+', '', 'g'), 1, 60) AS a, substr(regexp_replace(lower(CASE WHEN id % 9 = 0 THEN 'x' || b ELSE
  b END), '[^a-z0-9]+', '', 'g'), 1, 60) AS b FROM s)
SELECT count(*) AS compared, count(*) FILTER (starts_with(a, b) OR starts_with(b, a)) AS agree FROM n""")
def content_agreement(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("ts_id"), F.col("o_orderpriority").alias("content_text"))
    longer = F.concat(F.when(F.col("ts_id") % 9 == 0, "x").otherwise(""), "content_text", F.when(F.col("ts_id") % 7 == 0, "").otherwise(" and more"))
    return validate.content_agreement(o.filter("ts_id % 4 <> 1"), o.withColumn("content_text", longer))


@query(_V + """SELECT 'by_kind' AS name, kind AS value, count(*) AS n FROM v GROUP BY kind UNION ALL SELECT 'by_status', CASE is_deleted WHEN 1 THEN 'deleted' ELSE
  'present' END, count(*) FROM v GROUP BY 2
UNION ALL SELECT 'by_source_combination', 'bulk', count(*) FROM v UNION ALL SELECT 'months_present', strftime(created_at_utc, '%Y-%m'), count(*) FROM
  v GROUP BY 2
UNION ALL SELECT 'posts', '', count(*) FROM v UNION ALL SELECT 'deletions', '', count(*) FROM v WHERE is_deleted = 1 UNION ALL SELECT
  'engagement_rows', '', count(*) FROM v
UNION ALL SELECT 'ambiguous_handles', '', count(*) FROM v WHERE kind = 'reblog'""")
def archive_stats(spark, d):
    posts = event_posts(spark, d).withColumns({"seen_sources": F.array(F.lit("bulk")), "field_sources": F.create_map(F.lit("reblog_of_acct"), F.lit("bulk")), "content_text": F.lit("word")})
    return checks.stats(posts, posts.filter("is_deleted = 1"), posts)


@query("""SELECT CAST(sum(o_orderkey % 7) AS BIGINT) AS new_posts, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS deletions_found FROM
  orders WHERE o_orderpriority = '2-HIGH'""")
def run_totals(spark, d):
    runs = table(spark, d, "orders").select(F.col("o_orderpriority").alias("run_id"), (F.col("o_orderkey") % 7).alias("new_posts"), F.when(F.col("o_orderstatus") == "F", 1).alias("deletions_found"))
    return metrics.run_totals(runs, "2-HIGH")


@query("""WITH a AS (SELECT o_orderkey AS id, o_orderdate AS t FROM orders WHERE o_orderkey % 4 <> 1), b AS (SELECT o_orderkey AS id, o_orderdate + INTERVAL
  (o_orderkey % 5) SECOND AS u FROM orders)
SELECT id AS ts_id FROM a JOIN b USING (id) WHERE epoch(u) - epoch(t) > 2""")
def created_disagreements(spark, d):
    o = order_posts(spark, d).select("ts_id", "created_at_utc")
    moved = o.select("ts_id", F.timestamp_add("SECOND", (F.col("ts_id") % 5).cast("int"), F.col("created_at_utc")).alias("created_at_utc"))
    return validate.created_disagreements(o.filter("ts_id % 4 <> 1"), moved).select("ts_id")


# -- reconciliation ----------------------------------------------------------


@query(_B + """SELECT user_id, value, CAST(rank AS INTEGER) AS rank FROM r WHERE value <> '' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY rank DESC, seq
  DESC) = 1""")
def merge_scalar_precedence(spark, d):
    return merge.precedence(event_observations(spark, d), ["user_id"], "value", "rank", "seq")


@query(_B + """SELECT user_id, strftime(observed_at, '%Y-%m-%dT%H:%M:%SZ') AS observed_at, CAST(crank AS INTEGER) AS crank FROM r QUALIFY row_number() OVER
  (PARTITION BY user_id ORDER BY crank DESC, seq DESC) = 1""")
def merge_created_at_precedence(spark, d):
    from tidelog.schema import CREATED_RANK

    rows = event_observations(spark, d).withColumn("crank", merge.rank_of(F.col("source"), CREATED_RANK))
    return merge.precedence(rows, ["user_id"], "observed_at", "crank", "seq").withColumn("observed_at", times.to_iso(F.col("observed_at")))


def _event_merge(spark, d) -> merge.Merged:
    """events as observations of their users through the whole merge: every tracker row with k < 20 is a removal,
    every primary row with k < 10 a missing post."""
    from tidelog.schema import OBSERVATION, POST

    rows = event_observations(spark, d)
    removed = (F.col("source") == "tracker") & (F.col("k") < 20)
    given = {
        "ts_id": F.col("user_id").cast("string"), "source": F.col("source"), "observed_at": F.col("observed_at"), "run_id": F.lit("r"), "seq": F.col("seq"), "removed": removed,
        "gone": (F.col("source") == "primary") & (F.col("k") < 10), "kind": F.col("value"), "tracker_removed_at": F.when(removed, F.col("observed_at")),
        "created_at_utc": F.lit("2023-12-31 00:00:00").cast("timestamp_ntz"),
    }
    seen = rows.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in OBSERVATION.fields])
    return merge.merge(spark.createDataFrame([], POST), seen)


_SIG = _B + ", q AS (SELECT *, (source = 'tracker' AND k < 20) OR (source = 'primary' AND k < 10) AS signal, source = 'primary' AND k >= 10 AS live FROM r)"
_ISO = "strftime({0}, '%Y-%m-%dT%H:%M:%SZ')"


@query(_SIG + f""", t AS (SELECT *, max(CASE WHEN live THEN observed_at END) OVER (PARTITION BY user_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  AS seen FROM q)
SELECT CAST(user_id AS VARCHAR) AS ts_id,
  {_ISO.format("max(greatest(coalesce(seen, TIMESTAMP '2023-12-31'), TIMESTAMP '2023-12-31')) FILTER (signal)")} AS deleted_lower,
  {_ISO.format("min(observed_at) FILTER (signal)")} AS deleted_upper FROM t GROUP BY user_id""")
def merge_bounds(spark, d):
    return _event_merge(spark, d).posts.select("ts_id", times.to_iso(F.col("deleted_lower")).alias("deleted_lower"), times.to_iso(F.col("deleted_upper")).alias("deleted_upper"))


@query(_SIG + f""" SELECT CAST(user_id AS VARCHAR) AS ts_id, coalesce(arg_max(CASE WHEN signal THEN 'deleted' ELSE 'present' END, seq) FILTER (signal OR live),
  'present') AS status,
arg_min(CASE WHEN source = 'tracker' THEN 'tracker' ELSE 'gone' END, seq) FILTER (signal) AS deleted_source,
  {_ISO.format("max(observed_at) FILTER (live)")} AS last_verified_live_at FROM q GROUP BY user_id""")
def merge_status_resurrection(spark, d):
    return _event_merge(spark, d).posts.select("ts_id", "status", "deleted_source", times.to_iso(F.col("last_verified_live_at")).alias("last_verified_live_at"))


@query(_B + f"""SELECT CAST(user_id AS VARCHAR) AS ts_id, {_ISO.format('arg_min(observed_at, seq)')} AS first_seen_at, arg_min(source, seq) AS first_seen_source,
  array_to_string(list_sort(list(DISTINCT source)), ',') AS seen_sources FROM r GROUP BY user_id""")
def merge_first_seen(spark, d):
    return _event_merge(spark, d).posts.select("ts_id", times.to_iso(F.col("first_seen_at")).alias("first_seen_at"), "first_seen_source", F.array_join("seen_sources", ",").alias("seen_sources"))


@query(_B + """, f AS (SELECT * FROM r WHERE value <> ''), w AS (SELECT *, max({'r': rank, 'q': seq, 's': source, 'v': value}) OVER (PARTITION BY user_id ORDER BY
  seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS h FROM f)
SELECT user_id, seq, 'value' AS field, h.s AS old_source, h.v AS old_value, source AS new_source, value AS new_value FROM w WHERE h.r > rank AND h.v
  <> value""")
def merge_anomalies(spark, d):
    return merge.disagreements(event_observations(spark, d), ["user_id"], "value", "source", "rank", "seq")


@query(_SIG + """, n AS (SELECT *, row_number() OVER (PARTITION BY user_id, source ORDER BY seq) AS nth FROM q WHERE signal)
SELECT CAST(user_id AS VARCHAR) AS ts_id, source, strftime(observed_at, '%Y-%m-%dT%H:%M:%SZ') AS detected_at FROM n WHERE nth = 1""")
def merge_deletion_events(spark, d):
    return _event_merge(spark, d).events.select("ts_id", "source", times.to_iso(F.col("detected_at")).alias("detected_at"))


@query(_S.replace("WITH s AS", "WITH RECURSIVE s AS") + """, o AS (SELECT ts_id, observed_at, ingest_seq, row_number() OVER (PARTITION BY ts_id ORDER BY ingest_seq) AS rn FROM s),
a AS (SELECT * FROM o WHERE rn = 1 UNION ALL SELECT x.* FROM a, LATERAL (SELECT * FROM o WHERE o.ts_id = a.ts_id AND o.rn > a.rn AND o.observed_at >=
  a.observed_at + INTERVAL 24 HOUR ORDER BY o.rn LIMIT 1) x)
SELECT ts_id, count(*) AS kept, CAST(sum(ingest_seq) AS BIGINT) AS seqs FROM a GROUP BY 1""")
def throttle_engagement(spark, d):
    kept = throttle.keep(event_snapshots(spark, d), ["ts_id"], "observed_at", "ingest_seq", gap_seconds=24 * 3600, old_seconds=None)
    return kept.groupBy("ts_id").agg(F.count("*").alias("kept"), F.sum("ingest_seq").alias("seqs"))


@query(_SIG + """, t AS (SELECT user_id, seq, source, max(CASE WHEN signal THEN greatest(coalesce(seen, TIMESTAMP '2023-12-31'), TIMESTAMP '2023-12-31') END) OVER w AS
  lo, min(CASE WHEN signal THEN observed_at END) OVER w AS up, signal, live,
  last_value(CASE WHEN signal THEN 'deleted' WHEN live THEN 'present' END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY seq ROWS BETWEEN UNBOUNDED
  PRECEDING AND 1 PRECEDING) AS before
  FROM (SELECT *, max(CASE WHEN live THEN observed_at END) OVER (PARTITION BY user_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  AS seen FROM q) WINDOW w AS (PARTITION BY user_id ORDER BY seq))
SELECT 'inverted_bounds' AS code, CAST(user_id AS VARCHAR) AS ts_id, seq FROM t WHERE signal AND lo > up UNION ALL SELECT 'resurrected', CAST(user_id
  AS VARCHAR), seq FROM t WHERE live AND before = 'deleted'""")
def merge_deletion_anomalies(spark, d):
    return _event_merge(spark, d).anomalies.filter("code in ('inverted_bounds', 'resurrected')").select("code", "ts_id", "seq")


# -- text --------------------------------------------------------------------

#: Stated behaviour in rows: stretches up to each >, tags by name, references by table, lines by number, empty ones by their neighbour.
_REFERENCES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&copy;", "©"), ("&middot;", "·"), ("&nbsp;", " "), ("&amp;", "&"))
_BREAKS = ", ".join(f"'{x}'" for x in ("br", "/p", "/div", "/li", "/h1", "/h2", "/h3", "/h4", "/h5", "/h6", "/blockquote"))


def _plain(html: str) -> str:
    """DuckDB text of an SQL text with the common references decoded."""
    for name, char in _REFERENCES:
        html = f"replace({html}, '{name}', '{char}')"
    return html


_TEXT_OF_PAGES = f"""WITH s AS (SELECT page_id, string_split(html, '>') AS x FROM pages), i AS (SELECT page_id, len(x) AS n, unnest(x) AS x, generate_subscripts(x, 1) AS i FROM s),
t AS (SELECT page_id, i, CASE WHEN i = n THEN x WHEN instr(x, '<') = 0 THEN x || '>' ELSE substr(x, 1, instr(x, '<') - 1) END AS txt, CASE WHEN i < n AND instr(x, '<') > 0 THEN lower(rtrim(substr(x, instr(x, '<') + 1), ' /')) END AS tag FROM i),
w AS (SELECT page_id, string_agg(txt || CASE WHEN tag IN ({_BREAKS}) THEN chr(10) ELSE '' END, '' ORDER BY i) AS txt FROM t GROUP BY 1),
l AS (SELECT page_id, string_split(translate({_plain("txt")}, chr(160) || chr(13) || chr(9), '   '), chr(10)) AS x FROM w), k AS (SELECT page_id, unnest(x) AS x, generate_subscripts(x, 1) AS i FROM l),
b AS (SELECT page_id, i, array_to_string(list_filter(string_split(x, ' '), lambda y: y <> ''), ' ') AS x FROM k),
e AS (SELECT *, x = '' AND coalesce(lag(x) OVER (PARTITION BY page_id ORDER BY i), '') = '' AS gone, max(CASE WHEN x <> '' THEN i END) OVER (PARTITION BY page_id) AS last FROM b)
SELECT p.page_id, coalesce(string_agg(x, chr(10) ORDER BY i) FILTER (NOT gone AND i <= last), '') AS text FROM pages p LEFT JOIN e USING (page_id) GROUP BY 1"""


@query(_TEXT_OF_PAGES)
def html_to_text(spark, d):
    return table(spark, d, "pages").select("page_id", texts.html_to_text(F.col("html")).alias("text"))


#: Some references of all kinds, as they stand in a page and as they are meant.
_REFS = (
    ("&eacute;", "é"), ("&mdash;", "—"), ("&#8217;", "’"), ("&hellip;", "…"), ("&euro;", "€"), ("&#x1F600;", "😀"), ("&Auml;", "Ä"), ("&laquo;", "«"), ("&frac12;", "½"), ("&nbsp;", " "), ("&amp;amp;", "&amp;"),
    ("&lt;b&gt;", "<b>"), ("&rarr;", "→"), ("&ntilde", "ñ"), ("&bogus;", "&bogus;"), ("&#39;", "\'"), ("&thinsp;", chr(0x2009)),
)
_REF_ROWS = ", ".join(f"({i}, '{a}', '{b.replace(chr(39), chr(39) * 2)}')" for i, (a, b) in enumerate(_REFS))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'a' || event_id || ' q <b' WHEN event_id % 3 = 1 THEN 'a' || event_id || ' end' ELSE 'a' || event_id || ' end' || chr(10) || event_type END AS text FROM events")
def html_inline_quotes(spark, d):
    """Quotes that never end, that hold spans, and two in a text; a quote's class is one of its classes, whole."""
    n = F.col("event_id").cast("string")
    open_, kinds = F.lit('<span class="x quote-inline">'), F.col("event_id") % 3
    never = F.concat(F.lit("a"), n, F.lit(" "), open_, F.lit("q &lt;b"))
    nested = F.concat(F.lit("a"), n, F.lit(" "), open_, F.lit('RT <span class="u">u<span>v</span></span> of'), F.lit("</span>end"))
    two = F.concat(F.lit("<p>a"), n, open_, F.lit("RT</span> "), F.lit('<span class="not-quote-inline">end</span></p>'), open_, F.lit("b</span>"), F.col("event_type"))
    return table(spark, d, "events").select("event_id", texts.html_to_text(F.when(kinds == 0, never).when(kinds == 1, nested).otherwise(two)).alias("text"))


@query(f"""WITH r(i, a, b) AS (VALUES {_REF_ROWS}) SELECT event_id, 'x ' || b || ' y ' || event_type || 'é' AS text FROM events JOIN r ON event_id % {len(_REFS)}
  = i""".replace("'x ' || b || ' y '", "CASE WHEN b = ' ' THEN 'x y ' ELSE 'x ' || b || ' y ' END"))
def html_references(spark, d):
    """Posts' HTML with named and numbered references, one of them without its semicolon."""
    name = F.get(F.array(*[F.lit(a) for a, _ in _REFS]), (F.col("event_id") % len(_REFS)).cast("int"))
    source = F.concat(F.lit("<p>x "), name, F.lit(" y <b>"), "event_type", F.lit("</b>&eacute;</p>"))
    return table(spark, d, "events").select("event_id", texts.html_to_text(source).alias("text"))


_RT = "CASE doc_id % 4 WHEN 0 THEN 'RT @own' WHEN 1 THEN 'RT @user_1 ' WHEN 2 THEN 'RT: ' ELSE '' END || text"


@query(f"""WITH t AS (SELECT doc_id, {_RT} AS s FROM documents)
SELECT doc_id, CASE WHEN starts_with(s, 'RT @own') OR regexp_matches(s, '^RT @[A-Za-z0-9_]{{1,30}}') THEN 'reblog' ELSE 'original' END AS kind,
CASE WHEN starts_with(s, 'RT @own') THEN 'own' WHEN regexp_matches(s, '^RT @[A-Za-z0-9_]{{1,30}}') THEN regexp_extract(s,
  '^RT @([A-Za-z0-9_]{{1,30}})', 1) END AS reblog_of_acct,
CASE WHEN starts_with(s, 'RT @own') THEN substr(s, 8) WHEN regexp_matches(s, '^RT @[A-Za-z0-9_]{{1,30}}') THEN regexp_replace(s,
  '^RT @[A-Za-z0-9_]{{1,30}}', '') ELSE s END AS content_text FROM t""")
def rt_prefix_split(spark, d):
    start = F.when(F.col("doc_id") % 4 == 0, "RT @own").when(F.col("doc_id") % 4 == 1, "RT @user_1 ").when(F.col("doc_id") % 4 == 2, "RT: ").otherwise("")
    some = table(spark, d, "documents").select("doc_id", F.concat(start, "text").alias("s"))
    return some.select("doc_id", *[c.alias(k) for k, c in texts.repost_split(F.col("s"), "own").items()])


@query("SELECT doc_id, substr(regexp_replace(lower(text), '[^a-z0-9]+', '', 'g'), 1, 60) AS norm FROM documents")
def text_norm_prefix(spark, d):
    return table(spark, d, "documents").select("doc_id", texts.norm_prefix(F.col("text")).alias("norm"))


@query("SELECT doc_id, substr(text, 1, 120) AS snippet, CAST(length(text) AS INTEGER) AS content_len FROM documents")
def snippet_and_len(spark, d):
    return table(spark, d, "documents").select("doc_id", texts.snippet(F.col("text")).alias("snippet"), F.length("text").alias("content_len"))


def queries() -> dict[str, Query]:
    from tidelog import registry_state  # noqa: F401  its queries register themselves

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(_SQL)
