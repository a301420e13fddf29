SELECT ambito, clave, periodo_contable, fecha, valor, estado, detalle
FROM vw_alertas_primas
WHERE estado <> :estado
