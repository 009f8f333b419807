-- Posts at most ten minutes after the one before.
SELECT ts_id, created_at_et, kind, timestampdiff(SECOND, prev_created_at_utc, created_at_utc) / 60.0 AS gap_min
FROM v_posts_previous WHERE timestampdiff(SECOND, prev_created_at_utc, created_at_utc) <= 600 ORDER BY created_at_utc, ts_id
