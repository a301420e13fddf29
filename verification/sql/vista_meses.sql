WITH dias AS (SELECT * FROM vista_dias)
SELECT accountable_period, COUNT(*) AS dias, SUM(registros) AS registros
FROM dias
GROUP BY accountable_period;
