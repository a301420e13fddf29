"""The randomness battery against a plain version, and the rate of false discoveries on mixed made tokens."""

import math
import random
import string

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamiz.llm import secrets

WORDS = """section chapter user account value number index table column parse render update delete insert select internal external default
public private handler manager factory service request response header footer content payload message channel session token_count buffer
stream reader writer client server config option setting module package version release branch commit author license""".split()


def text_tokens(n, dice):
    """Names of code and paths, some with numbers, 20 characters or more."""
    out = []
    while len(out) < n:
        parts = [dice.choice(WORDS) for _ in range(dice.randint(3, 6))] + [str(dice.randint(0, 99))] * (dice.random() < 0.3)
        style = dice.randint(0, 2)
        name = "_".join(parts) if style == 0 else "".join(p.capitalize() for p in parts) if style == 1 else "-".join(parts)
        if len(name) >= 20:
            out.append(name)
    return out


def secret_tokens(n, dice):
    return ["".join(dice.choice(string.ascii_letters + string.digits) for _ in range(dice.randint(28, 44))) for _ in range(n)]


@pytest.mark.parametrize("seed,n_secret", [(1, 0), (2, 60), (3, 600)])
def test_realised_rate(spark, seed, n_secret):
    """Of what is found nearly nothing is text, whether secrets are none, few or many."""
    dice = random.Random(seed)
    made = [(i, f"see {t} there", 0) for i, t in enumerate(text_tokens(4000, dice))]
    made += [(10_000 + i, f"see {t} there", 1) for i, t in enumerate(secret_tokens(n_secret, dice))]
    found = {r["doc_id"] for r in secrets.scan(spark.createDataFrame(made, "doc_id long, text string, secret int").repartition(4)).collect() if "random" in r["spans"]}
    false = sum(i < 10_000 for i in found)
    assert false <= max(1, 0.005 * len(found))
    assert len(found) - false >= 0.85 * n_secret


def plain(token):
    bare = token.rstrip("=")
    name, letters = next((a, c) for a, p, c in secrets.ALPHABETS if __import__("re").fullmatch(p.strip("^$"), bare))
    n, k = len(bare), len(letters)
    counts = np.array([bare.count(c) for c in letters])
    chi = ((counts - n / k) ** 2 / (n / k)).sum()
    kind = lambda c: 0 if c.isdigit() else 1 if c.isupper() else 2 if c.islower() else 3
    changes = sum(kind(a) != kind(b) for a, b in zip(bare, bare[1:]))
    shares = np.bincount([kind(c) for c in letters], minlength=4) / k
    change = 1 - (shares ** 2).sum()
    codes = np.array([letters.index(c) + 1.0 for c in bare])
    spread = n * (codes ** 2).sum() - codes.sum() ** 2
    serial = (n * (codes * np.roll(codes, -1)).sum() - codes.sum() ** 2) / spread if spread else 1.0
    return {"encoding": name, "n": n, "z_chi": (chi - (k - 1)) / math.sqrt(2 * (k - 1) * (1 - 1 / n)),
            "z_runs": (changes - (n - 1) * change) / math.sqrt(max((n - 1) * change * (1 - change), 0.25)),
            "z_serial": (serial + 1 / (n - 1)) * math.sqrt(n), "pairs": -(counts * (counts - 1)).sum() / (n * (n - 1)),
            "changes": changes / (n - 1), "order": -abs(serial + 1 / (n - 1))}


def test_battery_is_that_of_the_book(spark):
    dice = random.Random(9)
    made = text_tokens(40, dice) + secret_tokens(40, dice) + ["0" * 25, "deadbeef" * 4, "ABCDEFGH" * 3 + "==", "a+b/" * 9, "ABC123" * 5]
    got = {r["t"]: r["b"].asDict() for r in spark.createDataFrame([(t,) for t in made], "t string").select("t", secrets.battery(F.col("t")).alias("b")).collect()}
    for t in made:
        want = plain(t)
        assert got[t].keys() == want.keys()
        assert {k: v for k, v in got[t].items() if k != "encoding"} == pytest.approx({k: v for k, v in want.items() if k != "encoding"}, abs=1e-9)
        assert got[t]["encoding"] == want["encoding"]


def test_steps_are_those_of_benjamini_and_hochberg(spark):
    dice = random.Random(4)
    tokens = [("base62", b, min(int(abs(dice.gauss(0, 3))) + (40 if dice.random() < 0.05 * b else 0), 160)) for b in (1, 2, 3) for _ in range(400)]
    got = {r["band"]: r["least"] for r in secrets.thresholds(spark.createDataFrame(tokens, "encoding string, band int, step int")).collect()}
    for band in (1, 2, 3):
        steps = [s for _, b, s in tokens if b == band]
        fits = [s for s in set(steps) if len(steps) * 10 ** (-s * secrets.STEP) <= secrets.RATE * sum(x >= s for x in steps)]
        assert got.get(band) == min(fits, default=None)


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "no token")], "doc_id long, text string")
    assert {r["spans"] for r in secrets.scan(df).collect()} == {""}
    assert secrets.scan(df.limit(0)).count() == 0
