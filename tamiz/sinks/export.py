"""File exports for spreadsheets and dashboards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BOM = "﻿"


#: Rows of a CSV file. Cells may span lines, so a file is read whole by one task.
FILE_ROWS = 100_000


def export_csv(df: DataFrame, path: str, *, bom: bool = True, file_rows: int = FILE_ROWS) -> None:
    """Header CSV. With ``bom`` the header of every part starts with a byte-order mark.

    A task starts a new file after ``file_rows`` rows, in the order it has them: the tasks that read the files back
    grow in number with the table and not in size.

    Quotes are doubled and white space is kept, so ``read_mapping`` gives back every cell; but
    the empty text (a pair of quotes) and NULL (nothing) are both read as NULL.
    """
    first = df.columns[0]
    out = df.withColumnRenamed(first, BOM + first) if bom else df
    (out.write.mode("overwrite").option("maxRecordsPerFile", file_rows).option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def export_json(df: DataFrame, path: str) -> None:
    """One JSON record per line, keys always present, NaN as null."""
    columns = [
        F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name) for f in df.schema.fields]
    df.select(*columns).write.mode("overwrite").option("ignoreNullFields", False).json(path)
