-- Accounts reposted most.
SELECT reblog_of_acct AS account, count(*) AS n FROM v_posts_et WHERE kind = 'reblog' AND reblog_of_acct IS NOT NULL
GROUP BY account ORDER BY n DESC, account LIMIT 10
