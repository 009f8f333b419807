-- The twenty longest gaps between posts.
SELECT prev_created_at_et AS from_et, created_at_et AS to_et, timestampdiff(SECOND, prev_created_at_utc, created_at_utc) / 60.0 AS gap_min
FROM v_posts_previous WHERE prev_created_at_utc IS NOT NULL ORDER BY gap_min DESC, created_at_utc LIMIT 20
