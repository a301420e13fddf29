SELECT accountable_period, transaction_date_sk, COUNT(*) AS registros
FROM movimientos
WHERE accountable_period >= :desde
GROUP BY accountable_period, transaction_date_sk
