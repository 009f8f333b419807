"""Metrics as SQL table functions over the registered views.

    SELECT * FROM bursts('2024-01-05', '2024-01-12')
    SELECT * FROM top_accounts(a => '2024-01-01', b => '2024-01-31', n => 5)

``register`` makes them for a session, beside the views of ``views.register``;
days are Eastern, both ends included.  They are plans, not code that runs apart:
Catalyst sees through them, and a range of days reaches the scan.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

_DAYS = "a DATE COMMENT 'first day', b DATE COMMENT 'last day'"
#: Microseconds of an instant; a slice of the time line is an hour.
_US = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', created_at_utc)"
_SLICE = 3_600_000_000
_EARLIER, _UPTO = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING", "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
_KINDS = ", ".join(f"count_if(kind = '{k}') AS {k}" for k in ("original", "quote", "reblog", "reply"))
_DAY = "coalesce({0}, 0) AS {0}"


def _top(name: str, column: str, where: str) -> tuple[str, str, str]:
    ranked = f"SELECT {column} AS found, count(*) AS k, row_number() OVER (ORDER BY count(*) DESC, {column}) AS place FROM v_posts_et WHERE et_date BETWEEN {name}.a AND {name}.b AND {where} GROUP BY {column}"
    return f"{_DAYS}, n INT DEFAULT 10", f"{column.removeprefix('card_').removeprefix('reblog_of_').replace('acct', 'account')} STRING, n BIGINT", f"SELECT found, k FROM ({ranked}) WHERE place <= {name}.n"


#: name -> (parameters, columns, query).  Bursts are told by ranks: the post so many places ahead says whether a window has enough.
FUNCTIONS = {
    "posts_by_day": (_DAYS, "et_date DATE, original BIGINT, quote BIGINT, reblog BIGINT, reply BIGINT, total BIGINT, deleted BIGINT", f"""
        SELECT d.et_date, {", ".join(_DAY.format(c) for c in ("original", "quote", "reblog", "reply", "total", "deleted"))}
        FROM (SELECT explode(sequence(posts_by_day.a, posts_by_day.b)) AS et_date) d
        LEFT JOIN (SELECT et_date, {_KINDS}, count(*) AS total, sum(is_deleted) AS deleted FROM v_posts_et WHERE et_date BETWEEN posts_by_day.a AND posts_by_day.b GROUP BY et_date) USING (et_date)"""),
    "hour_histogram": (_DAYS, "et_hour INT, n BIGINT", """
        SELECT CAST(h.id AS INT), count(p.et_hour) FROM range(24) h LEFT JOIN (SELECT et_hour FROM v_posts_et WHERE et_date BETWEEN hour_histogram.a AND hour_histogram.b) p ON p.et_hour = h.id GROUP BY h.id"""),
    "overnight_share": (_DAYS, "overnight BIGINT, total BIGINT, share DOUBLE", """
        SELECT count_if(et_hour BETWEEN 0 AND 5), count(*), try_divide(count_if(et_hour BETWEEN 0 AND 5), count(*)) FROM v_posts_et WHERE et_date BETWEEN overnight_share.a AND overnight_share.b"""),
    "top_accounts": _top("top_accounts", "reblog_of_acct", "kind = 'reblog' AND reblog_of_acct IS NOT NULL"),
    "link_domains": _top("link_domains", "card_domain", "card_domain <> ''"),
    "media_items": (_DAYS, "type STRING, n BIGINT", "SELECT m.type, count(*) FROM media m JOIN v_posts_et p USING (ts_id) WHERE p.et_date BETWEEN media_items.a AND media_items.b GROUP BY m.type"),
    "deleted_posts": (_DAYS, "ts_id STRING, created_at_et STRING, kind STRING, deleted_source STRING, lifetime_min DOUBLE, deletion_window_min DOUBLE, snippet STRING", """
        SELECT ts_id, created_at_et, kind, deleted_source, lifetime_min, deletion_window_min, substr(coalesce(content_text, ''), 1, 120) FROM v_deletions WHERE et_date BETWEEN deleted_posts.a AND deleted_posts.b"""),
    "edited_posts": (_DAYS, "ts_id STRING, created_at_et STRING, kind STRING, edited_at TIMESTAMP_NTZ", "SELECT ts_id, created_at_et, kind, edited_at FROM v_posts_et WHERE et_date BETWEEN edited_posts.a AND edited_posts.b AND edited_at IS NOT NULL"),
    "bursts": (f"{_DAYS}, minutes INT DEFAULT 10, posts INT DEFAULT 5", "start_et STRING, end_et STRING, count BIGINT, kinds MAP<STRING, BIGINT>", f"""
        WITH p AS (SELECT ts_id, created_at_et, kind, {_US} AS us FROM v_posts_et WHERE et_date BETWEEN bursts.a AND bursts.b AND created_at_utc IS NOT NULL),
        s AS (SELECT *, floor(us / {_SLICE}) AS slice FROM p),
        n AS (SELECT slice, coalesce(sum(count(*)) OVER (ORDER BY slice {_EARLIER}), 0) AS base FROM s GROUP BY slice),
        k AS (SELECT s.*, base + row_number() OVER (PARTITION BY slice ORDER BY us, ts_id) AS place FROM s JOIN n USING (slice)),
        c AS (SELECT k.*, CASE WHEN o.us - k.us <= bursts.minutes * 60000000L THEN k.us END AS cand FROM k LEFT JOIN k o ON o.place = k.place + bursts.posts - 1),
        m AS (SELECT slice, max(max(cand)) OVER (ORDER BY slice {_EARLIER}) AS carried FROM c GROUP BY slice),
        f AS (SELECT c.*, greatest(max(cand) OVER (PARTITION BY slice ORDER BY place {_EARLIER}), carried) AS past, greatest(max(cand) OVER (PARTITION BY slice ORDER BY place {_UPTO}), carried) AS reach FROM c JOIN m USING (slice)),
        o AS (SELECT *, CASE WHEN cand IS NOT NULL AND (past IS NULL OR past + bursts.minutes * 60000000L < us) THEN 1 ELSE 0 END AS opens FROM f),
        z AS (SELECT slice, coalesce(sum(sum(opens)) OVER (ORDER BY slice {_EARLIER}), 0) AS opened FROM o GROUP BY slice),
        i AS (SELECT o.*, opened + sum(opens) OVER (PARTITION BY slice ORDER BY place {_UPTO}) AS island FROM o JOIN z USING (slice)),
        g AS (SELECT island, kind, count(*) AS n, min(struct(us, ts_id, created_at_et)) AS low, max(struct(us, ts_id, created_at_et)) AS high FROM i WHERE us <= reach + bursts.minutes * 60000000L GROUP BY island, kind)
        SELECT min(low).created_at_et, max(high).created_at_et, sum(n), map_from_entries(array_sort(collect_list(struct(kind, n)))) FROM g GROUP BY island"""),
}


def register(spark: SparkSession) -> list[str]:
    """Makes the functions for this session, over the views that it has; gives their names."""
    for name, (parameters, columns, query) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE({columns}) RETURN {query}")
    return list(FUNCTIONS)
