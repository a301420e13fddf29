SELECT transaction_date_sk, COUNT(*) AS cantidad_registros
FROM movimientos
WHERE transaction_date_sk >= :desde AND transaction_date_sk IS NOT NULL
GROUP BY transaction_date_sk
ORDER BY transaction_date_sk DESC;
