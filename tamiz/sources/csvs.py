"""Reference CSVs: field dictionary, rule catalogue, mappings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CATALOGUE_COLUMNS = (
    "base", "schema_name", "table_name", "table_type", "column_name", "data_type", "constraint_type", "owner",
    "completitud", "unicidad", "exactitud", "validez", "integridad", "disponibilidad",
    "logica_completitud", "logica_unicidad", "logica_exactitud", "logica_validez")


def _read(spark: SparkSession, path: str, columns: Sequence[str], *, encoding: str = "UTF-8") -> DataFrame:
    # Quoted cells may span lines. Columns are named by position, so a byte-order mark or
    # damaged accents in the header do not matter.
    schema = ", ".join(f"`{c}` string" for c in columns)
    return (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
            .option("encoding", encoding).schema(schema).csv(path))


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Field, description, type and example, plus the combined ``definicion``.

    A type cell broken over two lines is put together again; when its halves were swapped
    (``10),NUMERIC(16``) they are put back in order.
    """
    raw = _read(spark, path, ("campo", "descripcion", "tipo", "ejemplo"))
    one_line = F.regexp_replace(F.trim("tipo"), r"\r?\n", ",")
    tipo = F.regexp_replace(one_line, r"^([0-9][^,]*),(.*)$", "$2,$1")
    extras = F.concat_ws(
        " · ", F.when(F.col("tipo") != "", F.concat(F.lit("Tipo: "), F.col("tipo"))),
        F.when(F.col("ejemplo") != "", F.concat(F.lit("Ej: "), F.col("ejemplo"))))
    return (raw.select(F.trim("campo").alias("campo"), F.trim("descripcion").alias("descripcion"),
                       tipo.alias("tipo"), F.trim("ejemplo").alias("ejemplo"))
            .filter((F.col("campo") != "") & (F.col("descripcion") != ""))
            .withColumn("definicion", F.concat(
                "descripcion", F.when(extras != "", F.concat(F.lit(" ("), extras, F.lit(")"))).otherwise(F.lit("")))))


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Rule texts and logic, one row per field and 18 fixed columns."""
    return _read(spark, path, CATALOGUE_COLUMNS)


def read_mapping(spark: SparkSession, path: str, columns: Sequence[str] = ("ramo", "product_description", "categoria"),
                 ) -> DataFrame:
    """A mapping file: product to category by default, or ``("nombre_campo", "nombre_corto")``."""
    return _read(spark, path, columns)
