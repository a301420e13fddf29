SELECT d.accountable_period, d.transaction_date_sk, d.registros
FROM vista_dias d
JOIN vista_meses m ON m.accountable_period = d.accountable_period
WHERE d.registros * m.dias > :veces * m.registros
