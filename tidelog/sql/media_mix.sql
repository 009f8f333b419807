-- Media items by type, and posts without any.
SELECT type, count(*) AS n FROM media GROUP BY type
UNION ALL SELECT 'no_media_posts', count(*) FROM v_posts_et WHERE media_count = 0
