-- Posts by Eastern day and kind.
SELECT et_date, count_if(kind = 'original') AS original, count_if(kind = 'quote') AS quote, count_if(kind = 'reblog') AS reblog,
       count_if(kind = 'reply') AS reply, count(*) AS total, sum(is_deleted) AS deleted
FROM v_posts_et GROUP BY et_date ORDER BY et_date
