"""Benchmark decontamination: a prefix-filtered join of benchmark items with documents.

Items are cut into windows of ``window`` consecutive words, and a window is a set of shingles, each
at its own place. Shingles are ordered by rarity, counted over all documents. A document text of the
window's size that holds ``threshold`` of these shingles must hold one of the rarest few, the prefix: only
prefix shingles are joined. A shingle found at a word gives the start of the text that may hold the
window; one that would begin before the first word or end after the last is passed over. What is left is
verified over the window's size: each of its shingles, by 64-bit hash, at its place.

Everything runs on built-in functions. Words are runs of ``[0-9a-z]`` and of characters above ASCII, with A-Z
in lower case.
"""

from __future__ import annotations

import string

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, Window

from tamiz.llm.common import stored

WINDOW = 10
#: Words of a shingle, or all words of a shorter window.
SHINGLE = 5
#: Share of a window's shingles that a document text must hold at their places.
THRESHOLD = 1.0
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Rows of a table that goes to every task, 10 MB or so; a longer one is joined by shuffling instead.
SHARED_ROWS = 200_000


def words(text: Column) -> Column:
    """Words of a text in order; NULL has none. Only A-Z are lowered, so ``lower`` serves ASCII texts alone."""
    ascii_only = F.octet_length(text) == F.length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.coalesce(F.regexp_extract_all(low, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def windows(items: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """item, phrase (array of words): the windows of every item. One of fewer words, but not none, is one window."""
    cut = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), words(F.col(text)).alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    return cut.filter(F.size("w") > 0).select("item", "w", F.explode(starts).alias("at")).select(
        "item", F.slice("w", F.col("at"), window).alias("phrase")).distinct()


def _shingle(array: str, at: Column, width: int) -> Column:
    """Hash of ``width`` words from the place ``at`` (from 0) on."""
    return F.xxhash64(*[F.get(array, at + i) for i in range(width)], F.lit(width))


def shingles(phrases: DataFrame) -> DataFrame:
    """phrase_id, size, width, offset, token: the shingles of each phrase (phrase_id, phrase) and their places there."""
    rows = phrases.select("phrase_id", "phrase", F.size("phrase").alias("size"), F.least(F.size("phrase"), F.lit(SHINGLE)).alias("width"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("size") - F.col("width"))).alias("offset"))
    token = F.lit(None).cast("long")
    for w in range(1, SHINGLE + 1):
        token = F.when(F.col("width") == w, _shingle("phrase", F.col("offset"), w)).otherwise(token)
    return rows.select("phrase_id", "size", "width", "offset", token.alias("token"))


def places(docs: DataFrame, known: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, text_key, n, head, at, token: where the shingles ``known`` stand in ``docs``.

    A document is its id and the hash of its text, of ``n`` words; each row of ``docs`` also has one row marked ``head``,
    whether a shingle stands there or not. Texts are cut into words once for each number of words that a shingle has, which
    is one number if no item is shorter than a shingle. Words stay where they are: the shingles looked for go to
    every task if they are at most SHARED_ROWS; else the documents' shingles are shuffled.
    """
    widths = sorted(r[0] for r in known.select("width").distinct().collect())  # at most SHINGLE numbers
    wanted = stored(known.select("width", F.col("token").alias("known")).distinct(), "shingles")
    shared = wanted.count() <= SHARED_ROWS
    keyed = docs.select(F.col(doc_id).alias("doc"), F.xxhash64(F.col(text)).alias("text_key"), words(F.col(text)).alias("w"))
    every = keyed.select("doc", "text_key", F.size("w").alias("n"), F.lit(True).alias("head"), F.lit(0).alias("at"), F.lit(None).cast("long").alias("token"))
    out = None if shared and widths else every
    for i, width in enumerate(widths):
        here = keyed.select("doc", "text_key", "w", F.size("w").alias("n"), F.posexplode_outer("w").alias("at", "first"))
        here = here.withColumn("token", F.when(F.col("at") <= F.col("n") - width, _shingle("w", F.col("at"), width))).select(
            "doc", "text_key", "n", (F.coalesce("at", F.lit(0)) == 0).alias("head") if shared and not i else F.lit(False).alias("head"),
            F.coalesce("at", F.lit(0)).alias("at"), "token")
        looked = wanted.filter(F.col("width") == width).select("known")
        if shared:
            found = here.join(F.broadcast(looked), F.col("token") == F.col("known"), "left").filter(F.col("head") | F.col("known").isNotNull())
        else:
            found = here.join(looked, F.col("token") == F.col("known"))
        found = found.select("doc", "text_key", "n", "head", "at", F.col("known").alias("token"))
        out = found if out is None else out.unionByName(found)
    return out


def prefixes(known: DataFrame, met: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """phrase_id, size, width, offset, token: the shingles by which each phrase must be met, the rarest of it in ``met``.

    A phrase of s shingles of which ``ceil(threshold * s)`` must be there misses at most the rest, so one of the
    rarest ``s - ceil(threshold * s) + 1`` is met. One that no document holds need not be looked for.
    """
    times = met.filter("token is not null").groupBy("token").agg(F.count("*").alias("times"))
    rarest = Window.partitionBy("phrase_id").orderBy(F.coalesce("times", F.lit(0)), "token", "offset")
    n_shingles = F.col("size") - F.col("width") + 1
    needed = n_shingles - F.ceil(n_shingles * F.lit(threshold) - F.lit(1e-9)) + 1
    return (known.join(times, "token", "left").withColumn("place", F.row_number().over(rarest))
            .filter((F.col("place") <= needed) & F.col("times").isNotNull()).select("phrase_id", "size", "width", "offset", "token"))


def occurrences(met: DataFrame, known: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc, text_key, start, length, phrase_id: every place where a phrase occurs, ``start`` counted in words from 0.

    ``met``: shingles of the documents at their places (:func:`places`); ``known``: those of the phrases. Only prefix
    shingles are joined; of what they and the bounds leave, all shingles of the phrase are looked for at their places.
    """
    index = stored(prefixes(known, met, threshold), "prefixes")
    small = index.count() <= SHARED_ROWS
    here = met.filter("token is not null").select("doc", "text_key", "n", "at", "token")
    start = F.col("at") - F.col("offset")
    maybe = (here.join(F.broadcast(index) if small else index, "token").filter((start >= 0) & (start + F.col("size") <= F.col("n")))
             .select("doc", "text_key", start.alias("start"), "phrase_id").distinct())
    asked = maybe.join(known, "phrase_id").withColumn("place", F.col("start") + F.col("offset"))
    held = here.select(F.col("doc").alias("d"), F.col("text_key").alias("k"), "at", F.col("token").alias("t")).distinct()
    n_shingles = F.col("size") - F.col("width") + 1
    return (asked.join(held, F.col("doc").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")) & (F.col("place") == F.col("at"))
                       & (F.col("token") == F.col("t")))
            .groupBy("doc", "text_key", "start", "phrase_id", "size", n_shingles.alias("shingles")).agg(F.count("*").alias("shared"))
            .filter(F.col("shared") >= F.col("shingles") * F.lit(threshold) - F.lit(1e-9))
            .select("doc", "text_key", "start", F.col("size").alias("length"), "phrase_id"))


def decontaminate(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  threshold: float = THRESHOLD) -> DataFrame:
    """A row for each row of ``docs``: doc_id, ``n_words``, ``n_hit``, ``items``.

    ``n_hit`` is the number of the document's words inside an occurrence of any window of any item, each word once;
    ``items`` the ids of those items as strings, sorted, each once. An item's id that is NULL is the empty string; rows
    that repeat an id are one item with all their windows. NULL, empty or wordless texts have no words and no hits; long
    texts are searched whole. Repeated document rows get equal results. No items, no hits; an empty table gives no
    rows. Columns of other names play no part. Items are told apart only where their windows differ, so passages that
    many items share are joined once.
    """
    phrases = stored(windows(items, item_id, item_text, window).withColumn("phrase_id", F.xxhash64("phrase")), "windows")
    known = stored(shingles(phrases.groupBy("phrase_id").agg(F.first("phrase").alias("phrase"))), "phrase-shingles")
    met = stored(places(docs, known, doc_id, text), "places")
    found = stored(occurrences(met, known, threshold), "occurrences")

    document = Window.partitionBy("doc", "text_key").orderBy("start", "length")
    end = F.col("start") + F.col("length")
    before = F.coalesce(F.max(end).over(document.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    covered = (found.select("doc", "text_key", "start", "length").distinct()
               .withColumn("fresh", F.greatest(end - F.greatest("start", before), F.lit(0)))
               .groupBy("doc", "text_key").agg(F.sum("fresh").alias("n_hit")))
    # Windows with the same items are one profile.
    holders = phrases.groupBy("phrase_id").agg(F.array_sort(F.collect_set("item")).alias("of"))
    profiles = stored(holders.withColumn("profile", F.xxhash64("of")), "profiles")
    of = profiles.groupBy("profile").agg(F.first("of").alias("of"))
    named = (found.join(profiles.select("phrase_id", "profile"), "phrase_id").select("doc", "text_key", "profile").distinct()
             .join(of, "profile").select("doc", "text_key", F.explode("of").alias("item"))
             .groupBy("doc", "text_key").agg(F.array_sort(F.collect_set("item")).alias("items")))
    hits = covered.withColumnsRenamed({"doc": "d", "text_key": "k"}).join(
        named, F.col("d").eqNullSafe(F.col("doc")) & (F.col("k") == F.col("text_key"))).select("d", "k", "n_hit", "items")
    return met.filter("head").select("doc", "text_key", F.col("n").cast("long").alias("n_words")).join(
        hits, F.col("doc").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")), "left").select(
        F.col("doc").alias("doc_id"), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))
