from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import SparkSession

from tamiz.model import CUBE_SCHEMA, MOVEMENT_SCHEMA
from tamiz.session import tune


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = (SparkSession.builder.master("local[8]").appName("tamiz-tests")
               .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.warehouse.dir", str(root / "warehouse"))
               .config("spark.checkpoint.dir", str(root / "shared")).config("spark.driver.memory", "6g")
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


GOOD = {
    "policy_transaction_movement_sk": 1, "source_system": "CO_iaxis", "accountable_period": 202401,
    "coverage_code": "3114", "branch_sk": 446, "product_code": "6031", "transaction_date_sk": 20240115,
    "policy_effective_date_sk": 20240101, "policy_expiration_date_sk": 20250101, "inception_date_sk": 20240101,
    "transaction_type": "3", "transaction_effective_date_sk": 20240115, "transaction_type_description": "Suplemento",
    "current_record_flag": 1, "transaction_delta_billed_premium_amount": Decimal("100"),
    "transaction_delta_commission_amount": Decimal("10"), "risk_number": "1", "policy_number": "76520",
    "transaction_delta_billed_premium_amount_raw": Decimal("100"), "sseguro": "4312014",
    "receipt_type": "unificado-detail", "receipt_number": 10182965,
    "transaction_accounting_ts": datetime(2024, 1, 15), "load_ts": datetime(2024, 1, 16, 5, 30),
}


@pytest.fixture(scope="session")
def facts(spark):
    """Movements from partial rows; every other column takes a good value."""
    def build(*rows):
        full = [tuple({**GOOD, **row}[f.name] for f in MOVEMENT_SCHEMA.fields) for row in rows]
        return spark.createDataFrame(full, MOVEMENT_SCHEMA)
    return build


@pytest.fixture(scope="session")
def cubes(spark):
    """Cubes from (period, dimension, field, total, bad, pct, is_total)."""
    def build(*rows):
        full = [(p, datetime(p // 100, p % 100, 1).date(), d, f, f, t, b, None if v is None else Decimal(str(v)), e,
                 datetime(2024, 3, 5)) for p, d, f, t, b, v, e in rows]
        return spark.createDataFrame(full, CUBE_SCHEMA)
    return build


@pytest.fixture(scope="session")
def rows():
    """Collect as a sorted list of plain tuples."""
    def collect(df, *columns):
        out = [tuple(float(v) if isinstance(v, Decimal) else v for v in r)
               for r in df.select(*columns or df.columns).collect()]
        return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))
    return collect
