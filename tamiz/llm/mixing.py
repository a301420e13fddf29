"""Mixing sources to target weights: entropy balancing.

Every source gets a target number of words. Document rates are those of least relative entropy
to the documents as they are, given one constraint per source (its words at these rates are its
target) and the bound on repeats. The optimum is an exponential tilt, ``min(bound, exp(a * size))``,
with one multiplier ``a`` per source; the convex dual is solved for all sources at once by Newton
steps, each one aggregation over the table of sizes. Rates are then rounded into whole copies.
"""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, Window

from tamiz.llm.common import WORD, stored

#: Most times that a document is taken, and of its size a source can give.
MAX_RATE = 3
#: Weights of the sources by code point, repeating.
WEIGHTS = (1, 2, 3)
#: Newton steps end when every source is within this share of its target, or after so many.
TOLERANCE = 1e-6
MAX_STEPS = 80
#: Documents that are rounded together, about.
ROUNDED_TOGETHER = 128


def n_words(text: Column) -> Column:
    """Words of a text; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(units: DataFrame, weights=WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """One row per source of ``units`` (source, size, m): documents, size and target.

    Sources are ranked by code point with NULL last: ranges are ranked apart and their counts added,
    so that no task sorts all sources. A target above ``max_rate`` times the source's size stops
    there and the excess is shared again by weight until none is above.
    """
    spark = units.sparkSession
    per_source = stored(
        units.groupBy("source").agg(F.sum("m").alias("docs"), F.sum(F.col("m") * F.col("size")).alias("source_size"),
                                    F.sum(F.col("m") * F.col("size").cast("double") * F.col("size")).alias("squares"))
        .repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()), "sources")
    parts = per_source.groupBy("part").count()
    before = parts.select("part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("before"))
    order = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    weight = F.array(*map(F.lit, weights))
    ranked = (per_source.join(before, "part")
              .withColumn("rank", F.row_number().over(order) + F.col("before") - 1)
              .withColumn("weight", F.get(weight, (F.col("rank") % len(weights)).cast("int")).cast("double"))
              .withColumn("most", F.col("source_size") * F.lit(float(max_rate))))
    ranked = stored(ranked.drop("part", "before"), "ranked-sources")
    total = float(ranked.agg(F.sum("source_size")).first()[0] or 0)
    share, stopped = 0.0, -1
    while True:
        full = F.col("most") <= F.lit(share) * F.col("weight")
        row = ranked.agg(F.coalesce(F.sum(F.when(full, F.col("most"))), F.lit(0.0)),
                         F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
                         F.count(F.when(full, 1))).first()
        if row[2] == stopped or not row[1]:
            break
        stopped, share = row[2], (total - row[0]) / row[1]
    return ranked.select("source", "docs", "source_size", "squares",
                         F.least("most", F.lit(share) * F.col("weight")).alias("target"))


def solve_tilts(units: DataFrame, targets: DataFrame, max_rate: int = MAX_RATE) -> DataFrame:
    """``targets`` with the multiplier ``tilt`` of each source, so that its rates meet the target.

    Documents of one size in one source have one rate, so the sums run over distinct sizes.
    A Newton step that leaves the bracket known to hold the root is replaced by its middle.
    """
    sizes = stored(units.filter("size > 0").groupBy("source", "size").agg(F.sum("m").alias("m"))
                   .withColumnRenamed("source", "s"), "sizes")
    cap = F.log(F.lit(float(max_rate)))
    # Sizes are measured in the mean size of a word's document, so that a tilt is about a log rate.
    start = targets.withColumn("scale", F.col("squares") / F.col("source_size")).withColumns({
        "tilt": F.log(F.greatest(F.col("target"), F.lit(1e-300)) / F.col("source_size")),
        "low": F.lit(-745.0) * F.col("scale"), "high": cap * F.col("scale"),
        "done": F.coalesce((F.col("source_size") == 0) | (F.col("target") >= max_rate * F.col("source_size")),
                           F.lit(True))})
    state = stored(start.withColumn("tilt", F.when(F.col("target") >= max_rate * F.col("source_size"), F.col("high"))
                                    .otherwise(F.least("tilt", "high"))), "tilts")
    for _ in range(MAX_STEPS):
        open_ = state.filter("not done")
        power = F.col("tilt") * F.col("size") / F.col("scale")
        rate = F.exp(F.least(power, cap))
        sums = (sizes.join(open_.select("source", "tilt", "scale"), F.col("s").eqNullSafe(F.col("source")))
                .groupBy("source").agg(
                    F.sum(F.col("m") * F.col("size") * rate).alias("words"),
                    F.sum(F.when(power < cap, F.col("m") * F.col("size") * rate * F.col("size") / F.col("scale"))
                          .otherwise(0.0)).alias("slope"))
                .withColumnRenamed("source", "of"))
        joined = state.join(sums, F.col("source").eqNullSafe(F.col("of")) & ~F.col("done"), "left")
        gap = F.col("words") - F.col("target")
        fits = F.abs(gap) <= TOLERANCE * F.col("target")
        low = F.when(gap < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - gap / F.when(F.col("slope") > 0, F.col("slope"))
        step = F.when(newton.between(low, high), newton).otherwise((low + high) / 2)
        moved = F.col("words").isNotNull()
        state = stored(joined.select(
            *[c for c in state.columns if c not in ("tilt", "low", "high", "done")],
            F.when(moved & ~fits, step).otherwise(F.col("tilt")).alias("tilt"),
            F.when(moved, low).otherwise(F.col("low")).alias("low"),
            F.when(moved, high).otherwise(F.col("high")).alias("high"),
            (F.col("done") | ~moved | fits).alias("done")), "tilts")
        if state.filter("not done").isEmpty():
            break
    return state


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights=WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """A row for each distinct (doc_id, source, size, text_key) of ``docs``: ``m`` rows that have it, ``source_size``,
    ``target`` of its source, ``rate``, ``copies`` and ``more``: ``more`` of these rows are taken once more than ``copies`` times.

    ``text_key`` is a hash of the text. A NULL or empty text has size 0 and adds no word however often it is taken. A
    NULL source is a source of its own. Repeated rows share what their rate asks for as evenly as whole copies allow. Long
    texts are read whole, other columns play no part. The same input gives the same copies. An empty table gives no rows.
    """
    units = stored(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"),
                               F.xxhash64(F.col(text)).alias("text_key"))
                   .groupBy("doc_id", "source", "size", "text_key").agg(F.count("*").alias("m")), "units")
    tilts = solve_tilts(units, source_targets(units, weights, max_rate), max_rate)
    per_source = tilts.select(F.col("source").alias("of"), "docs", "source_size", "target", "tilt", "scale")
    rated = units.join(per_source, F.col("source").eqNullSafe(F.col("of"))).drop("of").withColumn(
        "rate", F.when(F.col("size") == 0, F.lit(1.0)).otherwise(
            F.exp(F.least(F.col("tilt") * F.col("size") / F.col("scale"), F.log(F.lit(float(max_rate)))))))
    return _round(rated, max_rate)


def _round(rated: DataFrame, max_rate: int) -> DataFrame:
    """Whole copies, document by document from large to small within small groups of a source.

    Each document is rounded after adding what earlier ones of the group took too much or too little, so a group ends
    within half of one of its smallest documents of what its rates ask for. The copies of ``m`` equal rows are rounded
    together, to within half a row. Groups are parts of a source by hash and hold about :data:`ROUNDED_TOGETHER`
    documents whatever its size.
    """
    keys = ("size", "doc_id", "text_key", "m", "rate")
    group = F.pmod(F.xxhash64("doc_id", "size", "text_key"), F.ceil(F.col("docs") / ROUNDED_TOGETHER))
    grouped = (rated.withColumn("group", group).groupBy("source", "source_size", "target", "group")
               .agg(F.reverse(F.array_sort(F.collect_list(F.struct(*keys)))).alias("all")))
    empty = F.struct(F.lit(0.0).alias("owed"), F.array().cast("array<bigint>").alias("copies"))

    def take(state: Column, doc: Column) -> Column:
        due = state["owed"] + doc["rate"] * doc["size"] * doc["m"]
        total = F.when(doc["size"] == 0, doc["m"]).otherwise(F.least(F.greatest(
            F.round(due / F.greatest(doc["size"], F.lit(1))), F.lit(0.0)), F.lit(float(max_rate)) * doc["m"])).cast("long")
        return F.struct((due - total * doc["size"]).alias("owed"), F.concat(state["copies"], F.array(total)).alias("copies"))

    taken = grouped.withColumn("copies", F.aggregate("all", empty, take)["copies"])
    rows = taken.select("source", "source_size", "target", F.explode(F.arrays_zip("all", "copies")).alias("x"))
    return (rows.select("source", "source_size", "target", *[F.col(f"x.all.{c}").alias(c) for c in keys], F.col("x.copies").alias("total"))
            .withColumns({"copies": F.expr("total div m").cast("int"), "more": F.col("total") % F.col("m")})
            .select("doc_id", "source", "size", "text_key", "m", "source_size", "target", "rate", "copies", "more"))


#: Times that a row is repeated by one step.
AT_ONCE = 100_000


def repeated(df: DataFrame, times: str, number: str = "number") -> DataFrame:
    """Each row as often as its column ``times`` says, numbered from 1; no array of many numbers is ever made."""
    blocks = F.explode(F.sequence(F.lit(0), F.expr(f"({times} - 1) div {AT_ONCE}")))
    first = F.col("__block") * AT_ONCE
    return (df.filter(F.col(times) > 0).withColumn("__block", blocks)
            .withColumn(number, F.explode(F.sequence(first + 1, F.least(first + AT_ONCE, F.col(times))))).drop("__block"))


def taken(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
          weights=WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """The rows of :func:`mix`, each ``m`` times, with the ``copies`` of one row of ``docs`` and its words ``taken``."""
    rows = repeated(mix(docs, doc_id, text, source, weights, max_rate), "m")
    copies = F.col("copies") + (F.col("number") <= F.col("more")).cast("int")
    return rows.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size")).drop("m", "more", "number")


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
          weights=WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """``docs`` with each row repeated as often as the mix takes it, columns as given. Cases are as in :func:`mix`.

    Where equal rows are not all taken equally often, rows with the same columns fold into one with their number before
    they are told apart.
    """
    counts = stored(mix(docs, doc_id, text, source, weights, max_rate).select(
        F.col("doc_id").alias("d"), F.col("source").alias("s"), F.col("text_key").alias("k"), "copies", "more"), "copies")
    whole = docs.select(F.struct(*docs.columns).alias("doc"), F.xxhash64(F.col(text)).alias("h"))

    def joined(some: DataFrame) -> DataFrame:
        return whole.join(some, F.col("doc")[doc_id].eqNullSafe(F.col("d")) & F.col("doc")[source].eqNullSafe(F.col("s"))
                          & (F.col("h") == F.col("k")))

    rows = joined(counts.filter("more = 0")).select("doc", F.col("copies").cast("long").alias("times"))
    uneven = counts.filter("more > 0")
    if not uneven.isEmpty():
        order = Window.partitionBy("d", "s", "k").orderBy(F.xxhash64("doc"))
        extra = F.greatest(F.least(F.col("more") - F.col("before"), F.col("rows")), F.lit(0))
        folded = joined(uneven).groupBy("doc", "d", "s", "k", "copies", "more").agg(F.count("*").alias("rows"))
        rows = rows.unionByName(folded.withColumn("before", F.sum("rows").over(order) - F.col("rows")).select(
            "doc", (F.col("rows") * F.col("copies") + extra).alias("times")))
    return repeated(rows, "times").select(*[F.col("doc")[c].alias(c) for c in docs.columns])
