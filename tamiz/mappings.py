"""Lookup values (field labels, product categories) and the joins that apply them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UNCLASSIFIED = "Sin clasificar"

# Long label of each field and summary row of the cube.
LONG_LABELS = {
    "source_system": "Sistema fuente",
    "accountable_period": "Periodo contable",
    "coverage_code": "Código de cobertura",
    "branch_sk": "Sucursal / comercial",
    "product_code": "Código de producto (ramo)",
    "transaction_date_sk": "Fecha del movimiento",
    "policy_effective_date_sk": "Fecha de efectividad de póliza",
    "policy_expiration_date_sk": "Fecha de vencimiento de póliza",
    "inception_date_sk": "Fecha de inicio del contrato",
    "transaction_type": "Tipo de transacción",
    "transaction_effective_date_sk": "Fecha efectiva del movimiento",
    "transaction_type_description": "Descripción del tipo de transacción",
    "current_record_flag": "Marca de vigencia del registro",
    "transaction_delta_billed_premium_amount": "Prima facturada (monto neto)",
    "transaction_delta_billed_premium_amount_raw": "Prima facturada (valor bruto)",
    "transaction_delta_commission_amount": "Comisión del movimiento",
    "risk_number": "Número de riesgo",
    "policy_number": "Número de póliza",
    "policy_transaction_movement_sk": "Identificador del movimiento",
    "sseguro": "Identificador de seguro (derivado del riesgo)",
    "receipt_type": "Tipo de recibo",
    "receipt_number": "Número de recibo",
    "TOTAL_PERIODO": "Total del periodo",
    "TOTAL": "Total del periodo",
    "disponibilidad_mes": "Disponibilidad del mes (días con datos)",
    "disponibilidad_regla4": "Disponibilidad por ramo (días 1–15)",
}

# Short label of the same fields, for axes and narrow tables.
SHORT_LABELS = {
    "source_system": "Sistema fuente",
    "accountable_period": "Periodo contable",
    "coverage_code": "Cobertura",
    "branch_sk": "Sucursal",
    "product_code": "Producto (ramo)",
    "transaction_date_sk": "Fecha movimiento",
    "policy_effective_date_sk": "Inicio póliza",
    "policy_expiration_date_sk": "Fin póliza",
    "inception_date_sk": "Inicio contrato",
    "transaction_type": "Tipo movimiento",
    "transaction_effective_date_sk": "Fecha efectiva mov.",
    "transaction_type_description": "Descripción movimiento",
    "current_record_flag": "Marca de vigencia",
    "transaction_delta_billed_premium_amount": "Prima facturada",
    "transaction_delta_billed_premium_amount_raw": "Prima facturada (bruta)",
    "transaction_delta_commission_amount": "Comisión",
    "risk_number": "N° de riesgo",
    "policy_number": "N° de póliza",
    "policy_transaction_movement_sk": "ID de movimiento",
    "sseguro": "ID de seguro",
    "receipt_type": "Tipo de recibo",
    "receipt_number": "N° de recibo",
    "TOTAL_PERIODO": "Total del periodo",
    "TOTAL": "Total del periodo",
    "disponibilidad_mes": "Disponibilidad del mes",
    "disponibilidad_regla4": "Disponibilidad por ramo",
}

# Business category of each product code.
PRODUCT_CATEGORY = {
    "6031": "Autos",
    "6033": "Autos",
    "6034": "Autos",
    "6035": "Autos",
    "6036": "Autos",
    "6038": "Autos",
    "6039": "Autos",
    "6041": "Autos",
    "6042": "Autos",
    "6043": "Autos",
    "6045": "Autos",
    "6046": "Autos",
    "6047": "Autos",
    "6048": "Autos",
    "6049": "Autos",
    "6060": "Autos",
    "6061": "Autos",
    "800004": "Autos",
    "900731": "Autos",
    "900753": "Autos",
    "900792": "Autos",
    "900795": "Autos",
    "10005": "Responsabilidad Civil",
    "111715": "Responsabilidad Civil",
    "12": "Responsabilidad Civil",
    "800007": "Responsabilidad Civil",
    "900752": "Responsabilidad Civil",
    "900775": "Responsabilidad Civil",
    "DO1": "Responsabilidad Civil",
    "LA1": "Responsabilidad Civil",
    "LB": "Responsabilidad Civil",
    "RC": "Responsabilidad Civil",
    "RCL": "Responsabilidad Civil",
    "RCM": "Responsabilidad Civil",
    "RCP": "Responsabilidad Civil",
    "RCT": "Responsabilidad Civil",
    "REO": "Responsabilidad Civil",
    "462": "Vida",
    "463": "Vida",
    "6023": "Vida",
    "6024": "Vida",
    "6025": "Vida",
    "6026": "Vida",
    "6028": "Vida",
    "6029": "Vida",
    "6052": "Vida",
    "900762": "Vida",
    "900771": "Vida",
    "GC": "Vida",
    "IF": "Vida",
    "10000": "Hogar",
    "10001": "Hogar",
    "10003": "Hogar",
    "410": "Hogar",
    "411": "Hogar",
    "6071": "Hogar",
    "900748": "Hogar",
    "900754": "Hogar",
    "900758": "Hogar",
    "10": "Transporte / Navegación",
    "70107": "Transporte / Navegación",
    "70108": "Transporte / Navegación",
    "8092": "Transporte / Navegación",
    "900777": "Transporte / Navegación",
    "900778": "Transporte / Navegación",
    "TRM": "Transporte / Navegación",
    "19": "Daños Materiales",
    "900744": "Daños Materiales",
    "900746": "Daños Materiales",
    "900747": "Daños Materiales",
    "900774": "Daños Materiales",
    "IN": "Daños Materiales",
    "ST": "Daños Materiales",
    "11": "Ingeniería",
    "17": "Ingeniería",
    "18": "Ingeniería",
    "800008": "Ingeniería",
    "900745": "Ingeniería",
    "900779": "Ingeniería",
    "E1": "Salud",
    "H1": "Salud",
    "RDH": "Salud",
    "SE": "Salud",
    "Z1": "Salud",
    "01": "Cumplimiento",
    "10004": "Cumplimiento",
    "BO": "Cumplimiento",
    "JU": "Cumplimiento",
    "02": "Manejo / Riesgos Financieros",
    "22": "Manejo / Riesgos Financieros",
    "900751": "Manejo / Riesgos Financieros",
    "900776": "Manejo / Riesgos Financieros",
    "396": "Exequias",
    "900719": "Exequias",
    "900720": "Exequias",
    "900721": "Exequias",
    "10024": "PYME / Multiriesgo",
    "900742": "PYME / Multiriesgo",
    "PY": "PYME / Multiriesgo",
    "7467": "Accidentes Personales",
    "7468": "Accidentes Personales",
    "7469": "Accidentes Personales",
    "368": "SOAT",
    "900730": "SOAT",
    "ADU": "Asistencias",
    "T1": "Asistencias",
    "900793": "Agropecuario",
    "900794": "Aviación",
    "800020": "Otros",
    "900765": "Otros",
    "900780": "Otros",
    "LGP": "Otros",
}


def lookup_table(spark: SparkSession, rows: Iterable[tuple[str, ...]], columns: list[str]) -> DataFrame:
    """Small constant table as a local relation.

    Its exact size is known to the planner, so joins with it broadcast by the session's
    own size limit; nothing is broadcast by hint.
    """
    def quote(value: str) -> str:
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    values = ", ".join("(" + ", ".join(quote(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns)})")


def category_table(spark: SparkSession) -> DataFrame:
    rows = list(PRODUCT_CATEGORY.items())
    return lookup_table(spark, rows, ["ramo", "categoria"])


def label_table(spark: SparkSession) -> DataFrame:
    rows = [(name, long, SHORT_LABELS[name]) for name, long in LONG_LABELS.items()]
    return lookup_table(spark, rows, ["nombre_campo", "nombre_natural", "nombre_corto"])


def with_label(df: DataFrame) -> DataFrame:
    """Add ``nombre_natural``; an unmapped field keeps its raw name."""
    labels = label_table(df.sparkSession).select("nombre_campo", F.col("nombre_natural").alias("_label"))
    return (df.join(labels, "nombre_campo", "left")
            .withColumn("nombre_natural", F.coalesce("_label", "nombre_campo")).drop("_label"))


def with_short_label(df: DataFrame) -> DataFrame:
    """Add ``nombre_corto``, falling back to the long label and then the raw name."""
    labels = label_table(df.sparkSession).select(
        "nombre_campo", F.col("nombre_corto").alias("_short"), F.col("nombre_natural").alias("_long"))
    return (df.join(labels, "nombre_campo", "left")
            .withColumn("nombre_corto", F.coalesce("_short", "_long", "nombre_campo")).drop("_short", "_long"))


def with_category(df: DataFrame, mapping: DataFrame | None = None, *, product: str = "product_code",
                  output: str = "categoria_ramo") -> DataFrame:
    """Add the business category of a product code (trimmed before the lookup).

    Apply it after aggregating by product: the join then sees one row per product, not
    one per movement. A code repeated in ``mapping`` takes its first category in
    alphabetical order and never multiplies rows.
    """
    if mapping is None:
        mapping = category_table(df.sparkSession).select(F.col("ramo").alias("_ramo"), F.col("categoria").alias("_categoria"))
    else:
        mapping = mapping.groupBy(F.trim("ramo").alias("_ramo")).agg(F.min("categoria").alias("_categoria"))
    return (df.join(mapping, F.trim(product) == F.col("_ramo"), "left")
            .withColumn(output, F.coalesce("_categoria", F.lit(UNCLASSIFIED))).drop("_ramo", "_categoria"))
