"""Stored SELECT files."""

from __future__ import annotations

from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def run_sql_file(spark: SparkSession, path: str | Path, args: dict[str, Any] | None = None) -> DataFrame:
    """Run one stored SELECT over the session's views, with named parameters (``:name``)."""
    return spark.sql(sql_text(path), args or {})


def sql_text(path: str | Path) -> str:
    return Path(path).read_text(encoding="utf-8-sig").strip().rstrip(";")
