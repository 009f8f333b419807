-- Domains linked most.
SELECT card_domain AS domain, count(*) AS n FROM v_posts_et WHERE card_domain <> '' GROUP BY domain ORDER BY n DESC, domain LIMIT 10
