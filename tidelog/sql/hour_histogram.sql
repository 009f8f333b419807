-- Posts by Eastern hour of day.
SELECT et_hour, count(*) AS n FROM v_posts_et GROUP BY et_hour ORDER BY et_hour
