"""Line dedup: how many distinct sites a line is spread over.

A HyperLogLog sketch of the sites is kept for every line hash and merged by aggregation. Lines
whose estimate lies near the threshold get an exact distinct count. A line on enough sites is
cross-site boilerplate: its first occurrence in the collection stays, every other one goes.
"""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from tamiz.llm.common import stored

#: Sites from which a line counts as boilerplate.
MIN_SITES = 10
#: Registers of a sketch as a power of two, and the relative distance from the threshold within
#: which sites are counted exactly: four standard errors of 1.04 / sqrt(registers).
LOG_REGISTERS = 10
BAND = 4 * 1.04 / 2 ** (LOG_REGISTERS / 2)


def _line_hash(line: Column) -> Column:
    """96 bits, so that different lines of a huge collection stay apart."""
    return F.struct(F.xxhash64(line).alias("a"), F.hash(line).alias("b"))


def _occurrences(docs: DataFrame, doc_id: str, text: str, site: str) -> DataFrame:
    """A row for each line with a word: where it is and what it hashes to; no text."""
    lines = docs.select(
        F.col(doc_id).alias("d"), F.xxhash64(F.col(text)).alias("t"),
        F.coalesce(F.col(site).cast("string"), F.lit("")).alias("site"),
        F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)).alias("pos", "line"))
    return (lines.filter(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
            .select("d", "t", "pos", "site", _line_hash(F.col("line")).alias("h")))


def line_spread(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", site: str = "source",
                min_sites: int = MIN_SITES) -> DataFrame:
    """Boilerplate lines: hash ``h``, number of ``sites`` (exact near the threshold, else estimated)
    and the first place they occur, ``first`` (document, text hash, line number).

    Lines of white space only are no lines. A NULL site counts as one site, the empty one.
    """
    seen = _occurrences(docs, doc_id, text, site)
    sketched = stored(
        seen.groupBy("h").agg(F.hll_sketch_agg("site", F.lit(LOG_REGISTERS)).alias("sketch"),
                              F.min(F.struct("d", "t", "pos")).alias("first"))
        .select("h", F.hll_sketch_estimate("sketch").alias("estimate"), "first")
        .filter(F.col("estimate") >= min_sites * (1 - BAND)), "line-spread")
    near = sketched.filter(F.col("estimate") <= min_sites * (1 + BAND)).select("h")
    exact = (seen.join(near, "h", "left_semi").groupBy("h", "site").count()
             .groupBy("h").agg(F.count("*").alias("exact")))
    return (sketched.join(exact, "h", "left")
            .select("h", F.coalesce("exact", "estimate").alias("sites"), "first")
            .filter(F.col("sites") >= min_sites))


def removals(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", site: str = "source",
             min_sites: int = MIN_SITES) -> DataFrame:
    """For each document that loses lines: id ``d``, text hash ``t`` and the ``lines`` to remove, from 0."""
    common = stored(line_spread(docs, doc_id, text, site, min_sites), "common-lines")
    hits = _occurrences(docs, doc_id, text, site).join(common.select("h", "first"), "h")
    again = hits.filter(F.struct("d", "t", "pos") > F.col("first"))
    # Repeated rows share one id and text, hence the set.
    return again.groupBy("d", "t").agg(F.collect_set("pos").alias("lines"))


def line_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", site: str = "source",
               min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with ``clean_text``, ``n_lines`` (lines with a word) and ``removed_lines``.

    One row for each row, other columns untouched; new columns replace columns of the same name.
    A NULL text stays NULL. Of rows with equal id and text each keeps a first occurrence.
    """
    # Names inside a lambda must not be those of columns of ``docs``.
    drop = removals(docs, doc_id, text, site, min_sites).withColumnRenamed("lines", "__lines")
    new = ("clean_text", "n_lines", "removed_lines")
    whole = docs.select(F.struct(*docs.columns).alias("doc"), F.col(doc_id).alias("k"), F.col(text).alias("x"))
    joined = whole.join(drop, F.col("k").eqNullSafe(F.col("d")) & (F.xxhash64("x") == F.col("t")), "left")
    lines = F.split(F.coalesce("x", F.lit("")), "\n", -1)
    kept = F.array_join(F.filter(lines, lambda _, i: ~F.array_contains("__lines", i)), "\n")
    n_lines = F.size(F.filter(lines, lambda line: line.rlike(r"[^\x20\x09-\x0D]")))
    return joined.select(
        *[F.col("doc")[c].alias(c) for c in docs.columns if c not in new],
        F.when(F.col("__lines").isNull(), F.col("x")).otherwise(kept).alias("clean_text"),
        n_lines.alias("n_lines"), F.coalesce(F.size("__lines"), F.lit(0)).alias("removed_lines"))


def without_boilerplate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", site: str = "source",
                        min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` without their boilerplate lines, columns as given.

    A document of which nothing is left goes: all it said stands in first occurrences elsewhere.
    """
    base = docs.select(F.struct(*docs.columns).alias("doc"), F.col(doc_id).alias("k"), F.col(text).alias("x"),
                       F.col(site).alias("s"))
    marked = line_dedup(base, "k", "x", "s", min_sites)
    left = marked.filter((F.col("removed_lines") == 0) | F.col("clean_text").rlike(r"[^\x20\x09-\x0D]"))
    new = {text: F.col("clean_text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("removed_lines") == 0, F.col("doc")["n_chars"]).otherwise(
            F.length("clean_text").cast(docs.schema["n_chars"].dataType))
    return left.select(*[new.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])
