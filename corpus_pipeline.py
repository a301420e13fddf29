"""A corpus from raw documents: rules, line dedup, near duplicates, mixing, packing.

Each stage takes what the one before kept, as Parquet, and gives a DataFrame; all but the last give
the columns of ``documents``.

In every stage NULL ids, sources and other columns are values like any other, texts of any length are taken whole, columns beyond
those of ``documents`` are carried along whatever their names, and an empty table gives no rows. What a stage does with NULL
and empty texts, ties and repeated rows stands with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tamiz.llm.common import stored, table
from tamiz.llm.jaccard_join import one_of_each
from tamiz.llm.line_dedup import without_boilerplate
from tamiz.llm.mixing import mixed
from tamiz.llm.packing import pack
from tamiz.llm.quality_rules import clean


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without the lines that failed them.

    A NULL, empty or wordless text fails. Repeated rows are judged alike and all kept or all gone.
    """
    return clean(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many sources share, but for their first occurrence.

    The first is that of the least doc_id and place; repeated rows that tie for it all keep the line. A document of which
    nothing is left goes; one that had nothing stays.
    """
    return without_boilerplate(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the least doc_id; documents without a word stay.

    Repeated rows are copies, of which one stays; rows that share an id and differ in text are told apart.
    """
    return one_of_each(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the copies that bring every source to its target; a copy is a row.

    Texts without a word count nothing and are taken once. Repeated rows share the copies they are due as evenly as can be.
    """
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in training sequences.

    A NULL or empty text is its end token alone. Repeated rows are packed as often as they come.
    """
    return pack(docs)


STAGES = [("quality rules", rules), ("line dedup", lines), ("n-gram Jaccard join", near_duplicates),
          ("mixing sources", mixture), ("best-fit packing", packing)]

#: Newton steps, a similarity join and a tokenizer cannot be told in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
