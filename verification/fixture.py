"""A movement fact made from the star-schema test tables, with defects by a fixed hash.

``MOVEMENTS_SQL`` states the same definition for the SQL side of the checks.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.session import tune
from tamiz.sources.movements import movements as conform_movements

AS_OF = date(2001, 11, 4)
STAMP = datetime(2001, 11, 4, 12, 0, 0)

# Column by column; the first matching WHEN wins. ``h`` is the row's hash, ``dsk`` its date key.
ADAPTER = {
    "policy_transaction_movement_sk": "CASE WHEN h % 499 <> 0 THEN l_orderkey * 10 + l_linenumber END",
    "source_system": "CASE WHEN h % 97 = 0 THEN NULL WHEN h % 89 = 0 THEN 'Unknown' "
                     "WHEN l_returnflag = 'A' THEN 'CO_as400' ELSE 'CO_iaxis' END",
    "accountable_period": "int(CASE WHEN h % 503 = 0 THEN (dsk div 100) * 10 ELSE dsk div 100 END)",
    "coverage_code": "CASE WHEN h % 101 = 0 THEN NULL WHEN h % 103 = 0 THEN 'Unknown' "
                     "WHEN l_suppkey % 50 = 7 THEN '8888' ELSE string(3000 + l_suppkey) END",
    "branch_sk": "CASE WHEN h % 107 <> 0 THEN l_suppkey END",
    "product_code": "CASE WHEN h % 53 = 0 THEN 'Unknown' WHEN h % 59 = 0 THEN 'A B1' WHEN h % 61 = 0 THEN 'RC' "
                    "WHEN h % 67 = 0 THEN '9007310' WHEN h % 71 = 0 THEN NULL WHEN h % 73 = 0 THEN ' 6031 ' "
                    "WHEN h % 79 = 0 THEN 'X-1' ELSE concat('60', string(brand + 22)) END",
    "transaction_date_sk": "CASE WHEN h % 109 = 0 THEN NULL WHEN h % 113 = 0 THEN dsk div 100 ELSE dsk END",
    "policy_effective_date_sk": "CASE WHEN h % 127 = 0 THEN -1L WHEN h % 131 <> 0 THEN dsk END",
    "policy_expiration_date_sk": "CASE WHEN h % 137 = 0 THEN -1L WHEN h % 139 <> 0 THEN dsk + 10000 END",
    "inception_date_sk": "CASE WHEN h % 149 = 0 THEN -1L WHEN h % 151 <> 0 THEN dsk END",
    "transaction_type": "CASE WHEN h % 157 = 0 THEN 'Unknown' WHEN h % 163 = 0 THEN NULL WHEN h % 167 = 0 THEN '123' "
                        "ELSE string(l_linenumber) END",
    "transaction_effective_date_sk": "CASE WHEN h % 173 = 0 THEN -1L WHEN h % 179 <> 0 THEN dsk END",
    "transaction_type_description": "CASE WHEN h % 181 <> 0 THEN p_type END",
    "current_record_flag": "CASE WHEN h % 191 = 0 THEN NULL WHEN h % 193 = 0 THEN 2 "
                           "WHEN l_linestatus = 'F' AND l_linenumber = 1 THEN 0 ELSE 1 END",
    "transaction_delta_billed_premium_amount": "CAST(CASE WHEN h % 197 = 0 THEN NULL WHEN l_tax = 0 THEN 0 "
                                               "WHEN l_discount >= 0.09D THEN -price ELSE price END AS DECIMAL(17,4))",
    "transaction_delta_commission_amount": "CAST(CASE WHEN h % 199 <> 0 THEN price * CAST(l_discount AS DECIMAL(4,2)) "
                                           "END AS DECIMAL(17,4))",
    "risk_number": "CASE WHEN h % 211 = 0 THEN NULL WHEN h % 223 = 0 THEN 'Unknown' ELSE string(l_linenumber) END",
    "policy_number": "CASE WHEN h % 227 = 0 THEN NULL WHEN h % 229 = 0 THEN 'Unknown' ELSE string(l_orderkey) END",
    "transaction_delta_billed_premium_amount_raw": "CAST(CASE WHEN h % 233 <> 0 THEN price END AS DECIMAL(17,4))",
    "sseguro": "CASE WHEN l_returnflag <> 'A' AND h % 239 <> 0 THEN string(o_custkey) END",
    "receipt_type": "CASE WHEN l_returnflag = 'A' AND h % 2 = 0 THEN NULL WHEN h % 241 = 0 THEN NULL "
                    "WHEN h % 251 = 0 THEN 'otro' WHEN l_linenumber % 3 = 0 THEN 'not-unificado' "
                    "WHEN l_linenumber % 3 = 1 THEN 'unificado-detail' ELSE 'unificado-total' END",
    "receipt_number": "CASE WHEN h % 257 = 0 THEN 1L WHEN l_linenumber % 3 = 0 OR h % 263 = 0 THEN NULL "
                      "ELSE l_orderkey END",
    "transaction_accounting_ts": "timestampadd(DAY, l_linenumber, l_shipdate)",
    "load_ts": "timestampadd(SECOND, (27 + day(l_shipdate) % 11) * 3600 + (l_partkey % 60) * 60 + l_suppkey % 60, "
               "l_shipdate)",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_lookups(lines: DataFrame, orders: DataFrame, parts: DataFrame) -> DataFrame:
    """Lines with what the adapter looks up. Lookups are left joins on keys made unique first, so a query that needs
    no looked-up column loses the join altogether, and a repeated key cannot add rows."""
    customers = orders.groupBy(F.col("o_orderkey").alias("l_orderkey")).agg(F.expr("first(o_custkey) AS o_custkey"))
    products = parts.groupBy(F.col("p_partkey").alias("l_partkey")).agg(
        F.expr("first(int(regexp_replace(p_brand, '[^0-9]', ''))) AS brand"), F.expr("first(p_type) AS p_type"))
    return lines.join(customers, "l_orderkey", "left").join(products, "l_partkey", "left")


#: Computed once per row, above the joins, which need not send them; every defect reads them.
KEYED = ("bigint(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate)) AS dsk",
         "l_partkey * 31 + l_orderkey * 7 + l_linenumber AS h", "CAST(l_extendedprice AS DECIMAL(15,2)) AS price")


def adapted(rows: DataFrame) -> DataFrame:
    """Movements of lines that have their lookups."""
    return rows.selectExpr("*", *KEYED).selectExpr(*[f"{sql} AS {name}" for name, sql in ADAPTER.items()])


def from_lines(lines: DataFrame, orders: DataFrame, parts: DataFrame) -> DataFrame:
    """The adapter."""
    return adapted(with_lookups(lines, orders, parts))


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines as they come, which ``conform_movements(adapted(...))`` makes movements of, with the month shipped."""
    tune(spark)
    rows = with_lookups(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"), table(spark, sf_dir, "part"))
    return rows.withColumn("month", F.expr("year(l_shipdate) * 100 + month(l_shipdate)"))


def movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    raw = from_lines(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"), table(spark, sf_dir, "part"))
    return conform_movements(raw)


MOVEMENTS_SQL = """
line AS (
  SELECT l.*, o.o_custkey, p.p_brand, p.p_type,
         year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS dsk,
         l_partkey * 31 + l_orderkey * 7 + l_linenumber AS h,
         CAST(l_extendedprice AS DECIMAL(15,2)) AS price
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN part p ON p.p_partkey = l.l_partkey),
mov AS (
  SELECT
    CASE WHEN h % 499 = 0 THEN NULL ELSE l_orderkey * 10 + l_linenumber END AS policy_transaction_movement_sk,
    CASE WHEN h % 97 = 0 THEN NULL WHEN h % 89 = 0 THEN 'Unknown' WHEN l_returnflag = 'A' THEN 'CO_as400'
         ELSE 'CO_iaxis' END AS source_system,
    CAST(CASE WHEN h % 503 = 0 THEN (dsk // 100) * 10 ELSE dsk // 100 END AS INTEGER) AS accountable_period,
    CASE WHEN h % 101 = 0 THEN NULL WHEN h % 103 = 0 THEN 'Unknown' WHEN l_suppkey % 50 = 7 THEN '8888'
         ELSE CAST(l_suppkey + 3000 AS VARCHAR) END AS coverage_code,
    CASE WHEN h % 107 = 0 THEN NULL ELSE l_suppkey END AS branch_sk,
    CASE WHEN h % 53 = 0 THEN 'Unknown' WHEN h % 59 = 0 THEN 'A B1' WHEN h % 61 = 0 THEN 'RC'
         WHEN h % 67 = 0 THEN '9007310' WHEN h % 71 = 0 THEN NULL WHEN h % 73 = 0 THEN ' 6031 '
         WHEN h % 79 = 0 THEN 'X-1'
         ELSE '60' || CAST(CAST(regexp_replace(p_brand, '[^0-9]', '', 'g') AS INTEGER) + 22 AS VARCHAR)
         END AS product_code,
    CAST(CASE WHEN h % 109 = 0 THEN NULL WHEN h % 113 = 0 THEN dsk // 100 ELSE dsk END AS BIGINT) AS transaction_date_sk,
    CASE WHEN h % 127 = 0 THEN -1 WHEN h % 131 = 0 THEN NULL ELSE dsk END AS policy_effective_date_sk,
    CASE WHEN h % 137 = 0 THEN -1 WHEN h % 139 = 0 THEN NULL ELSE dsk + 10000 END AS policy_expiration_date_sk,
    CASE WHEN h % 149 = 0 THEN -1 WHEN h % 151 = 0 THEN NULL ELSE dsk END AS inception_date_sk,
    CASE WHEN h % 157 = 0 THEN 'Unknown' WHEN h % 163 = 0 THEN NULL WHEN h % 167 = 0 THEN '123'
         ELSE CAST(l_linenumber AS VARCHAR) END AS transaction_type,
    CASE WHEN h % 173 = 0 THEN -1 WHEN h % 179 = 0 THEN NULL ELSE dsk END AS transaction_effective_date_sk,
    CASE WHEN h % 181 = 0 THEN NULL ELSE p_type END AS transaction_type_description,
    CASE WHEN h % 191 = 0 THEN NULL WHEN h % 193 = 0 THEN 2 WHEN l_linestatus = 'F' AND l_linenumber = 1 THEN 0
         ELSE 1 END AS current_record_flag,
    CAST(CASE WHEN h % 197 = 0 THEN NULL WHEN l_tax = 0 THEN 0 WHEN l_discount >= 0.09 THEN -price ELSE price
         END AS DECIMAL(17,4)) AS transaction_delta_billed_premium_amount,
    CAST(CASE WHEN h % 199 = 0 THEN NULL ELSE price * CAST(l_discount AS DECIMAL(4,2)) END AS DECIMAL(17,4))
         AS transaction_delta_commission_amount,
    CASE WHEN h % 211 = 0 THEN NULL WHEN h % 223 = 0 THEN 'Unknown' ELSE CAST(l_linenumber AS VARCHAR) END AS risk_number,
    CASE WHEN h % 227 = 0 THEN NULL WHEN h % 229 = 0 THEN 'Unknown' ELSE CAST(l_orderkey AS VARCHAR) END AS policy_number,
    CAST(CASE WHEN h % 233 = 0 THEN NULL ELSE price END AS DECIMAL(17,4)) AS transaction_delta_billed_premium_amount_raw,
    CASE WHEN l_returnflag = 'A' OR h % 239 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS sseguro,
    CASE WHEN l_returnflag = 'A' AND h % 2 = 0 THEN NULL WHEN h % 241 = 0 THEN NULL WHEN h % 251 = 0 THEN 'otro'
         WHEN l_linenumber % 3 = 0 THEN 'not-unificado' WHEN l_linenumber % 3 = 1 THEN 'unificado-detail'
         ELSE 'unificado-total' END AS receipt_type,
    CASE WHEN h % 257 = 0 THEN 1 WHEN l_linenumber % 3 = 0 OR h % 263 = 0 THEN NULL ELSE l_orderkey END AS receipt_number,
    l_shipdate + to_days(CAST(l_linenumber AS INTEGER)) AS transaction_accounting_ts,
    l_shipdate + to_days(1) + to_hours(3 + day(l_shipdate) % 11) + to_minutes(l_partkey % 60)
         + to_seconds(l_suppkey % 60) AS load_ts
  FROM line)
"""
