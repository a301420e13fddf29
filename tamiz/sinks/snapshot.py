"""Stored copies of a result that can be refreshed without dropping the table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tamiz.model import conform
from tamiz.sinks.versions import newest, slot_path, write_version


def snapshot(df: DataFrame, table: str, schema: T.StructType, *, path: str | None = None) -> DataFrame:
    """Create ``table`` with its declared schema if missing, then replace its rows.

    The table object stays, so grants on it survive; running it again gives the same rows. The rows are written as a
    version beside ``path`` (or the table's own folder) and the table is then pointed at it in one
    step of the catalog: its readers see the former rows or the new ones, also when the write dies. ``df`` may read the
    table itself. :func:`recover` points the table at the last whole version.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        options = {} if path is None else {"path": path}
        spark.catalog.createTable(table, source="parquet", schema=schema, **options)
    # The declared columns are those of every version, so an existing table must have them in this order.
    have, want = ([(f.name.lower(), f.dataType) for f in s.fields] for s in (spark.table(table).schema, schema))
    if have != want:
        raise ValueError(f"table {table} has other columns than declared: {have}, not {want}")
    rows = conform(df, schema)
    # A declared TIMESTAMP column takes the clock time of an NTZ source in the session zone.
    rows = rows.select(*[rows[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
    write_version(rows, root_of(df, table))
    return recover(df, table)


def root_of(df: DataFrame, table: str) -> str:
    """The folder of a table's versions, beside its first folder or around the one it is pointed at."""
    described = df.sparkSession.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").first()["data_type"]
    return described.split("/rows/slot=")[0] if "/rows/slot=" in described else f"{described}.versions"


def recover(df: DataFrame, table: str) -> DataFrame:
    """Point ``table`` at the last whole version of its rows. ``df`` gives the session."""
    spark = df.sparkSession
    root = root_of(df, table)
    found = newest(spark, root)
    if found is not None:
        location = slot_path(root, found[1]).replace("'", "\\'")
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
        spark.catalog.refreshTable(table)
    return spark.table(table)
