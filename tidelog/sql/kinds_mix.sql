-- Posts by kind, and how many of them are gone.
SELECT kind, count(*) AS n, sum(is_deleted) AS deleted FROM v_posts_et GROUP BY kind ORDER BY n DESC, kind
