-- Favourites at the 50th and 90th of a hundred tiles, by kind.
WITH latest AS (SELECT p.kind, e.favourites FROM v_engagement_latest e JOIN v_posts_et p USING (ts_id) WHERE e.favourites IS NOT NULL),
     tiled AS (SELECT kind, favourites, ntile(100) OVER (PARTITION BY kind ORDER BY favourites) AS pct FROM latest)
SELECT kind, count(*) AS n, min(favourites) FILTER (WHERE pct >= 50) AS favourites_p50, min(favourites) FILTER (WHERE pct >= 90) AS favourites_p90
FROM tiled GROUP BY kind ORDER BY kind
