"""Schemas, thresholds and the frozen vocabulary of the engine."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _schema(*columns: tuple[str, T.DataType]) -> T.StructType:
    # Nullability is what the engine measures, so every source column is nullable.
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in columns])


_STR, _INT, _LONG, _DATE, _TS = T.StringType(), T.IntegerType(), T.LongType(), T.DateType(), T.TimestampType()

MOVEMENT_SCHEMA = _schema(
    ("policy_transaction_movement_sk", _LONG),
    ("source_system", _STR),
    ("accountable_period", _INT),
    ("coverage_code", _STR),
    ("branch_sk", _LONG),
    ("product_code", _STR),
    ("transaction_date_sk", _LONG),
    ("policy_effective_date_sk", _LONG),
    ("policy_expiration_date_sk", _LONG),
    ("inception_date_sk", _LONG),
    ("transaction_type", _STR),
    ("transaction_effective_date_sk", _LONG),
    ("transaction_type_description", _STR),
    ("current_record_flag", _INT),
    ("transaction_delta_billed_premium_amount", T.DecimalType(17, 4)),
    ("transaction_delta_commission_amount", T.DecimalType(17, 4)),
    ("risk_number", _STR),
    ("policy_number", _STR),
    ("transaction_delta_billed_premium_amount_raw", T.DecimalType(17, 4)),
    ("sseguro", _STR),
    ("receipt_type", _STR),
    ("receipt_number", _LONG),
    ("transaction_accounting_ts", _TS),
    ("load_ts", _TS),
)

CUBE_SCHEMA = _schema(
    ("periodo_contable", _INT),
    ("periodo_fecha", _DATE),
    ("tipo_indicador", _STR),
    ("nombre_campo", _STR),
    ("nombre_natural", _STR),
    ("total_registros", _LONG),
    ("cantidad_mala", _LONG),
    ("porcentaje", T.DecimalType(10, 2)),
    ("es_total", _INT),
    ("fecha_calculo", _TS),
)

ALERT_SCHEMA = _schema(
    ("ambito", _STR),
    ("clave", _STR),
    ("clave_natural", _STR),
    ("periodo_contable", _INT),
    ("fecha", _DATE),
    ("valor", T.DoubleType()),
    ("valor_referencia", T.DoubleType()),
    ("variacion_abs", T.DoubleType()),
    ("variacion_pct", T.DoubleType()),
    ("umbral_adv", T.DecimalType(6, 2)),
    ("umbral_crit", T.DecimalType(6, 2)),
    ("estado", _STR),
    ("detalle", _STR),
    ("fecha_calculo", _TS),
)

ARRIVAL_SCHEMA = _schema(
    ("fecha_datos", _DATE),
    ("transaction_date_sk", _LONG),
    ("periodo_contable", _INT),
    ("tipo_indicador", _STR),
    ("nombre_campo", _STR),
    ("arribo_datos", _TS),
    ("hora_arribo", _STR),
    ("ultima_escritura", _TS),
    ("registros", _LONG),
    ("minutos_vs_corte", _LONG),
    ("estado", _STR),
    ("fecha_calculo", _TS),
)

COMPLETENESS, ACCURACY, UNIQUENESS, VALIDITY, AVAILABILITY = (
    "completitud", "exactitud", "unicidad", "validez", "disponibilidad")
COMPARABLE_DIMENSIONS = (COMPLETENESS, ACCURACY, UNIQUENESS, VALIDITY)

KEY_FIELD = "policy_transaction_movement_sk"
PREMIUM = "transaction_delta_billed_premium_amount"
COMMISSION = "transaction_delta_commission_amount"


@dataclass(frozen=True)
class Thresholds:
    """Alert limits and score bands. They must equal the published ones."""

    balance_warning: float = 15.0
    balance_critical: float = 30.0
    dimension_warning: float = 95.0
    dimension_critical: float = 90.0
    availability_warning: float = 50.0
    availability_critical: float = 25.0
    arrival_warning_minutes: int = 0
    arrival_critical_minutes: int = 120
    target: float = 95.0
    # Lower edges of BUENO, ALERTA and GRAVE; anything below is CRÍTICO.
    bands: dict[str, tuple[float, float, float]] = field(default_factory=lambda: {
        "default": (99.0, 97.0, 90.0),
        "disponibilidad_mes": (90.0, 75.0, 55.0),
        "disponibilidad_regla4": (80.0, 60.0, 40.0),
    })


THRESHOLDS = Thresholds()

# Order in which alert states are listed, most urgent first. Fixed values.
STATE_ORDER = {"Crítica": 0, "Advertencia": 1, "Pendiente": 2, "Sin base": 3, "Sin dato": 3, "Normal": 4}


def _fits(have: T.DataType, want: T.DataType) -> bool:
    if isinstance(want, T.TimestampType):
        return isinstance(have, (T.TimestampType, T.TimestampNTZType))
    if isinstance(want, T.DecimalType):
        return isinstance(have, (T.DecimalType, T.DoubleType))
    return have == want


def loose_columns(df: DataFrame, schema: T.StructType) -> list[T.StructField]:
    """Declared columns that arrive with another type, so that a value may be there and not be readable."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return [f for f in schema.fields if f.name in have and not _fits(have[f.name], f.dataType)]


def conform(df: DataFrame, schema: T.StructType, *, missing_as_null: bool = False) -> DataFrame:
    """Select the columns of ``schema`` in order, casting only where the type differs.

    A column that fits stays a bare reference, so filters on it still reach the Parquet
    scan. NTZ timestamps and amounts of another precision are accepted as they are. A value that
    cannot be read as its declared type becomes NULL and is counted with the missing ones.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in schema.fields:
        if f.name not in have:
            if not missing_as_null:
                raise ValueError(f"column {f.name!r} is missing")
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif _fits(have[f.name], f.dataType):
            out.append(F.col(f.name))
        else:
            out.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
    return df.select(*out)
