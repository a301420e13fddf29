"""Spelling variants: words one edit apart, found by probing generated edits against Bloom filters.

The vocabulary is spread over blocked Bloom filters, one shard for each word length, that go to every task.
A task generates the deletions and replacements of its words (an insertion is a deletion seen from the
other word), takes the hash of each from those of the word's parts, and probes the shard of its length.
Only edits that may be words are written out and shuffled to an exact join with the vocabulary, which
removes the filters' false positives.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from tamiz.llm.common import mix64, stored

#: Characters of words; only A-Z are lowered, so these can occur in them.
RUN = r"[A-Za-zÀ-ÿ]+"
ALPHABET = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], np.uint8)
SHORTEST = 6
LEAST_OCCURRENCES = 5
#: A variant's form occurs so many times as often.
RATIO = 5
#: One occurrence in so many, by hash, loses a character.
DAMAGED = 199
#: Bits a filter has for each word, and blocks of 256 bits that all filters have together at most (64 MB). Beyond it
#: they say yes more often, and the join removes more.
BITS_PER_WORD = 16
BLOCK_BITS = 256
MOST_BLOCKS = 1 << 21
#: Words from this length on share a shard.
LONGEST_SHARD = 48
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Probes that a task makes at once, about.
PROBES = 2_000_000
#: Words that a task probes the neighbourhoods of, about.
WORDS_PER_TASK = 20_000


def damaged_runs(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """word: every run of letters of every text, A-Z lowered, one in DAMAGED without a character."""
    raw = F.col(text)
    low = F.when(F.octet_length(raw) == F.length(raw), F.lower(raw)).otherwise(
        F.translate(raw, string.ascii_uppercase, string.ascii_lowercase))
    runs = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("d"),
                       F.explode(F.regexp_extract_all(low, F.lit(RUN), F.lit(0))).alias("run"))
    h = F.crc32(F.concat("d", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    return runs.withColumn("h", h).select(F.when(F.col("h") % DAMAGED == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """word, n: distinct words of SHORTEST characters or more that occur LEAST_OCCURRENCES times or more."""
    return (damaged_runs(docs, doc_id, text).filter(F.length("word") >= SHORTEST).groupBy("word")
            .agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_OCCURRENCES))


def _shard(length: np.ndarray | int):
    return np.minimum(length, LONGEST_SHARD)


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indices of words of one length and their characters as a matrix of bytes."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths).tolist():
        which = np.flatnonzero(lengths == length)
        text = "".join([words[i] for i in which.tolist()]).encode("latin-1")
        yield which, np.frombuffer(text, np.uint8).reshape(-1, length)


def _powers(length: int) -> np.ndarray:
    """Powers of BASE: the factor of each character of a word of ``length``, the last one's being 1."""
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([[np.uint64(1)], np.full(length - 1, BASE)]), dtype=np.uint64)[::-1]


def polynomial(chars: np.ndarray) -> np.ndarray:
    """Polynomial hash of each row of characters."""
    with np.errstate(over="ignore"):
        return (chars.astype(np.uint64) * _powers(chars.shape[1])).sum(axis=1, dtype=np.uint64)


def _spots(hashes: np.ndarray, n_blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of each hash within a shard, and the hash that gives its bits there."""
    mixed = mix64(hashes)
    return ((mixed >> np.uint64(32)) * np.uint64(n_blocks)) >> np.uint64(32), mix64(mixed + BASE)


def _masks(bits: np.ndarray) -> list[np.ndarray]:
    """Four words of a block, two bits in each."""
    out = []
    for lane in range(4):
        part = bits >> np.uint64(16 * lane)
        out.append((np.uint64(1) << (part & np.uint64(31))) | (np.uint64(1) << (np.uint64(32) + ((part >> np.uint64(8)) & np.uint64(31)))))
    return out


class Shards:
    """Blocked Bloom filters of a vocabulary, one for each word length, of bounded size together."""

    def __init__(self, words: DataFrame, bits_per_word: int = BITS_PER_WORD, most_blocks: int = MOST_BLOCKS):
        # One row for each length at most.
        held = words.groupBy(F.least(F.length("word"), F.lit(LONGEST_SHARD)).alias("shard")).count().collect()
        wanted = {r["shard"]: max(1, r["count"] * bits_per_word // BLOCK_BITS) for r in held}
        shrink = min(1.0, most_blocks / max(1, sum(wanted.values())))
        self.words = sum(r["count"] for r in held)
        self.sizes = {shard: max(1, int(n * shrink)) for shard, n in sorted(wanted.items())}
        self.starts, at = {}, 0
        for shard, n in self.sizes.items():
            self.starts[shard], at = at, at + n
        sizes, starts = self.sizes, self.starts

        def spots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                columns: list[list[np.ndarray]] = [[] for _ in range(5)]
                for _, chars in _by_length(batch.column(0).to_pylist()):
                    shard = int(_shard(chars.shape[1]))
                    block, bits = _spots(polynomial(chars), sizes[shard])
                    for column, values in zip(columns, [block + np.uint64(starts[shard]), *_masks(bits)]):
                        column.append(values.view(np.int64))
                if columns[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns],
                                                     names=["block", "a", "b", "c", "d"])

        blocks = (words.select("word").mapInArrow(spots, "block long, a long, b long, c long, d long")
                  .groupBy("block").agg(*[F.bit_or(c).alias(c) for c in "abcd"]).toArrow())  # at most most_blocks rows
        table = np.zeros((max(at, 1), 4), np.uint64)
        where = blocks.column("block").to_numpy()
        for i, c in enumerate("abcd"):
            table[where, i] = blocks.column(c).to_numpy().view(np.uint64)
        self._table = words.sparkSession.sparkContext.broadcast(table)

    def may_hold(self, hashes: np.ndarray, length: int) -> np.ndarray:
        """Which of the hashes may be those of words of ``length``."""
        shard = int(_shard(length))
        if shard not in self.sizes:
            return np.zeros(len(hashes), bool)
        block, bits = _spots(hashes, self.sizes[shard])
        rows = block + np.uint64(self.starts[shard])
        table, which = self._table.value, np.arange(len(hashes))
        # Most edits fail at the first word of their block.
        for lane, mask in enumerate(_masks(bits)):
            mask = mask[which]
            which = which[(table[rows[which], lane] & mask) == mask]
        found = np.zeros(len(hashes), bool)
        found[which] = True
        return found

    def neighbours(self, chars: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Deletions and replacements of the words in ``chars`` that may be words: index of the word, and characters.

        A deletion from a run of equal characters is made once, a replacement only by a later character: the
        pair is met from its other word otherwise.
        """
        n, length = chars.shape
        wide = chars.astype(np.uint64)
        powers = _powers(length)
        with np.errstate(over="ignore"):
            terms = wide * powers
            whole = terms.sum(axis=1, dtype=np.uint64)
            # Behind the deleted character all stays; before it every factor is one power less.
            ahead = np.zeros((n, length), np.uint64)
            ahead[:, 1:] = np.cumsum(wide[:, :-1] * np.append(powers[1:], np.uint64(1))[:length - 1], axis=1, dtype=np.uint64)
            behind = whole[:, None] - np.cumsum(terms, axis=1, dtype=np.uint64)
            at = np.ones((n, length), bool)
            at[:, 1:] = chars[:, 1:] != chars[:, :-1]
            word, place = np.nonzero(at)
            hit = self.may_hold((ahead + behind)[word, place], length - 1) if length > 1 else np.zeros(len(word), bool)
            word, place = word[hit], place[hit]
            rest = np.arange(length - 1)
            yield word, chars[word[:, None], rest + (rest >= place[:, None])]
            step = max(1, PROBES // (n * len(ALPHABET)))
            for left in range(0, length, step):
                part = slice(left, left + step)
                word, place, new = np.nonzero(chars[:, part, None] < ALPHABET)
                place += left
                changed = whole[word] + (ALPHABET[new].astype(np.uint64) - wide[word, place]) * powers[place]
                hit = np.flatnonzero(self.may_hold(changed, length))
                word, place = word[hit], place[hit]
                made = chars[word]
                made[np.arange(len(word)), place] = ALPHABET[new[hit]]
                yield word, made


def near_words(words: DataFrame, shards: Shards) -> DataFrame:
    """word, near, n, near_n: every word with every word that differs by one inserted, deleted or replaced character."""
    at_once = max(1, PROBES // (LONGEST_SHARD * len(ALPHABET)))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = batch.column(1).to_numpy()
            for which, chars in _by_length(batch.column(0).to_pylist()):
                for first in range(0, len(which), at_once):
                    block, own = chars[first:first + at_once], which[first:first + at_once]
                    for word, made in shards.neighbours(block):
                        if len(word):
                            yield pa.RecordBatch.from_arrays(
                                [_strings(block[word]), pa.array(counts[own[word]]), _strings(made)], names=["word", "n", "edit"])

    # A probe costs the same for all words of a length, so tasks are even and their number follows the words.
    dealt = words.select("word", "n").repartition(1 + shards.words // WORDS_PER_TASK, "word")
    maybe = dealt.mapInArrow(probe, "word string, n long, edit string")
    pairs = stored(maybe.join(words.select(F.col("word").alias("edit"), F.col("n").alias("edit_n")), "edit"), "near")
    return pairs.select("word", F.col("edit").alias("near"), "n", F.col("edit_n").alias("near_n")).unionByName(
        pairs.select(F.col("edit").alias("word"), F.col("word").alias("near"), F.col("edit_n").alias("n"), F.col("n").alias("near_n")))


def _strings(chars: np.ndarray) -> pa.Array:
    n, length = chars.shape
    text = chars.tobytes().decode("latin-1")
    return pa.array([text[i:i + length] for i in range(0, n * length, length)], pa.string())


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the last of the forms that follow from each word that has one.

    Forms grow RATIO times as frequent with every step, so there is no cycle. Each round follows twice as many steps as
    the one before.
    """
    state = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(state.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                F.col("next").isNotNull().alias("moved")), "roots")
        if moved.filter("moved").isEmpty():
            return moved.select("word", "root")
        state = moved.select("word", "root")


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ratio: int = RATIO) -> DataFrame:
    """A row for each word of ``docs``: word, form, root, n, n_near, form_n.

    Two words are near if one inserted, deleted or replaced code point makes one the other. ``form`` is the most
    frequent near word, the first in code-point order of equals, if it is ``ratio`` times as frequent as the word or more;
    ``root`` follows forms to the last. NULL, empty and wordless texts have no words, long texts are read whole, an id
    that is NULL counts as empty text, repeated rows count as often as they come, and an empty table gives no rows.
    Other columns play no part.
    """
    words = stored(vocabulary(docs, doc_id, text), "vocabulary")
    pairs = near_words(words, Shards(words))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    per_word = stored(pairs.groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
                      .withColumn("form_n", -F.col("best.less")).withColumn("good", F.col("form_n") >= ratio * F.col("n"))
                      .select("word", "n_near", F.when(F.col("good"), F.col("best.form")).alias("form"),
                              F.when(F.col("good"), F.col("form_n")).alias("form_n")), "forms")
    ends = roots(per_word.filter("form is not null"))
    return words.join(per_word, "word", "left").join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), F.col("n").cast("long").alias("n"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("form_n").cast("long").alias("form_n"))
