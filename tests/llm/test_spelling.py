"""Spelling variants against all edits of all words."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamiz.llm import catalog, spelling
from tamiz.llm.spelling import Shards, near_words, roots, spelling_variants

SF = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LETTERS = [chr(c) for c in spelling.ALPHABET]


def edits(w):
    return ({w[:i] + w[i + 1:] for i in range(len(w))} | {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in LETTERS}
            | {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in LETTERS}) - {w}


def brute(docs):
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            at = h % len(run)
            counts[run[:at] + run[at + 1:] if h % 199 == 0 else run] += 1
    known = {w: n for w, n in counts.items() if n >= 5 and len(w) >= 6}
    forms, near = {}, {}
    for w in known:
        near[w] = [x for x in edits(w) if x in known]
        best = min(near[w], key=lambda x: (-known[x], x), default=None)
        forms[w] = best if best and known[best] >= 5 * known[w] else None
    out = []
    for w, n in known.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n, len(near[w]), known[forms[w]] if forms[w] else None))
    return sorted(out)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = brute(docs)
    assert rows(catalog.op12_spelling(spark, SF)) == want and any(r[1] for r in want)


WORDS = ["colour", "color", "colours", "coloor", "colouur", "color÷s", "Écouter", "écouter", "ecouter", "écoutér", "banana", "bannana", "banaana", "zzzzzz", "zzzzz", "zzzzzzz"]


@pytest.fixture(scope="module")
def made():
    """Chains of ever commoner variants, ties, words one short, words of thousands of letters."""
    docs = [(i, " ".join([w] * (5 ** (1 + k % 3) + (k % 2)))) for i, w in enumerate(WORDS) for k in [i]]
    docs += [(50 + i, t) for i, t in enumerate(["abcdefg " * 150, "abcdefh " * 30, "abcdefhi " * 6, "abcdefx " * 30, "bbcdefh " * 150])]
    long = "q" * 3000
    return docs + [(70, f"{long} " * 5 + f"{long}q " * 25), (71, None), (72, ""), (73, " 12 - "), (None, "COLOUR colour " * 9), (74, "Straße STRASSE " * 5), (70, "repeat repeats " * 5), (70, "repeat repeats " * 5)]


def test_odd_rows(spark, made):
    df = spark.createDataFrame(made, "doc_id long, text string")
    want = brute(made)
    assert rows(spelling_variants(df)) == want and len({r[2] for r in want}) < len(want)
    clash = df.withColumns({c: F.lit("x") for c in ("word", "d", "run", "h", "n", "form")})
    assert rows(spelling_variants(clash)) == want
    assert spelling_variants(df.limit(0)).count() == 0


def test_full_filters_lose_nothing(spark, made):
    """Filters far too small say yes to nearly all, and the join alone decides."""
    words = spark.createDataFrame([(r[0], r[3]) for r in brute(made)], "word string, n long")
    small = Shards(words, most_blocks=1)
    pairs = {tuple(r)[:2] for r in near_words(words, small).collect()}
    assert pairs == {tuple(r)[:2] for r in near_words(words, Shards(words)).collect()}
    known = {r.word for r in words.collect()}
    assert pairs == {(w, x) for w in known for x in edits(w) if x in known}


def test_filters_hold_every_word_and_few_others(spark):
    dice = np.random.default_rng(5)
    make = lambda n: {"".join(dice.choice(LETTERS[:26], 8)) for _ in range(n)}
    inside = make(4000)
    shards = Shards(spark.createDataFrame([(w,) for w in inside], "word string"))
    hashes = lambda ws: spelling.polynomial(np.frombuffer("".join(ws).encode("latin-1"), np.uint8).reshape(-1, 8))
    assert shards.may_hold(hashes(sorted(inside)), 8).all()
    assert shards.may_hold(hashes(sorted(make(20000) - inside)), 8).mean() < 0.02
    assert not shards.may_hold(hashes(sorted(inside)), 9).any()


def test_roots_of_a_chain(spark):
    chain = [(f"w{i:02}", f"w{i + 1:02}") for i in range(13)]
    got = roots(spark.createDataFrame(chain, "word string, form string")).collect()
    assert {tuple(r) for r in got} == {(w, "w13") for w, _ in chain}
