-- Share of posts between midnight and six, Eastern.
SELECT sum(int(et_hour BETWEEN 0 AND 5)) AS overnight, count(*) AS total, sum(int(et_hour BETWEEN 0 AND 5)) / nullif(count(*), 0) AS share FROM v_posts_et
