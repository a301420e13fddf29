"""Decontamination against a plain search for every window."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tamiz.llm import catalog, contamination
from tamiz.llm.contamination import decontaminate, occurrences, places, prefixes, shingles, windows

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOW))


def cut(text, size=10):
    w = words(text)
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute(docs, items):
    """(doc_id, n_words, n_hit, items) for (id, text) rows."""
    wanted = {}
    for item, text in items:
        for phrase in cut(text):
            wanted.setdefault(phrase, set()).add("" if item is None else str(item))
    sizes = {len(p) for p in wanted}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in wanted:
                    hit.update(range(i, i + n))
                    found |= wanted[tuple(w[i:i + n])]
        out.append((doc, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


LINE = "the quick brown fox jumps over the lazy dog and runs far away home"
ITEMS = [(1, LINE), (2, "Short item"), (3, "the quick brown fox jumps over the lazy dog and"), (None, "été à LA plage"), (5, "one"), (6, " ,. "),
         (7, None), (10, LINE.upper()), (3, "alpha beta gamma delta")]
DOCS = [(1, f"Intro. {LINE}, tail"), (2, "a short ITEM; one été À la plage Été à la PLAGE"), (3, None), (4, ""), (5, " . "), (1, f"Intro. {LINE}, tail"),
        (None, "One one short item"), (6, "x " * 3000 + LINE + " y" * 3000), (7, "alpha beta gamma deltas"), (7, "alpha-beta/gamma_delta"),
        (8, "the quick brown fox jumps over the lazy cat and runs far away home"), (9, (LINE + " ") * 3)]


@pytest.fixture(scope="module")
def tables(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string").repartition(3), spark.createDataFrame(ITEMS, "item_id long, text string")


def test_query(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    got = sorted((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in catalog.op11_contamination(spark, SF).collect())
    assert got == sorted((d, n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0) for d, n, h, i in want)
    assert any(r[5] for r in got)


@pytest.mark.parametrize("shared", [contamination.SHARED_ROWS, 0])
def test_odd_rows(tables, monkeypatch, shared):
    """With the prefix table handed to every task, and joined by shuffling."""
    monkeypatch.setattr(contamination, "SHARED_ROWS", shared)
    docs, items = tables
    want = brute(DOCS, ITEMS)
    assert rows(decontaminate(docs, items)) == want
    clash = docs.withColumns({c: F.lit(3) for c in ("w", "k", "d", "n", "at", "key", "token", "items", "n_hit", "doc")})
    assert rows(decontaminate(clash, items.withColumns({c: F.lit("x") for c in ("item", "w", "phrase", "at")}))) == want


def test_no_rows(tables):
    docs, items = tables
    assert decontaminate(docs.limit(0), items).count() == 0
    assert {(r.n_hit, tuple(r["items"])) for r in decontaminate(docs, items.limit(0)).collect()} == {(0, ())}


def test_megabytes_and_a_common_passage(spark):
    """A passage in a third of the documents, and a text of megabytes."""
    docs = [(i, f"doc {i} " + (LINE if i % 3 == 0 else "nothing of it")) for i in range(300)] + [(999, "word " * 400_000 + LINE)]
    items = [(i, f"{LINE} item {i} has its own end here") for i in range(30)]
    want = brute(docs, items)
    got = decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert rows(got) == want


def searched(spark, docs, item):
    phrases = windows(spark.createDataFrame([(1, item)], "item_id long, text string")).withColumn("phrase_id", F.xxhash64("phrase"))
    known = shingles(phrases)
    return known, places(spark.createDataFrame(docs, "doc_id long, text string"), known)


def test_prefix_is_the_rarest(spark):
    """Of each window as many shingles as may be missing and one more, the rarest; those in no document go."""
    known, met = searched(spark, [(1, "a b c d e f g h i j"), (2, "a b c d e"), (3, "b c d e f")], "a b c d e f g h i j")
    assert [r.offset for r in prefixes(known, met).collect()] in [[i] for i in (2, 3, 4, 5)]
    assert sorted(r.offset for r in prefixes(known, met, threshold=0.5).collect()) == [2, 3, 4, 5]


def test_part_of_a_window(spark):
    """With a lower threshold a window counts where enough shingles stand at their places."""
    text = LINE.split()
    docs = [(1, " ".join(text[:10])), (2, " ".join([*text[:9], "other"])), (3, " ".join(["x"] * 5 + text[5:10]))]
    known, met = searched(spark, docs, docs[0][1])
    found = lambda t: {r.doc for r in occurrences(met, known, threshold=t).collect()}
    assert (found(1.0), found(0.8), found(0.1)) == ({1}, {1, 2}, {1, 2, 3})
