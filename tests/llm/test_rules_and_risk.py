"""The verdict of the line rules against a plain version, and the classifier's weights against a plain minimiser."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamiz.llm import pu_quality, quality_rules
from tamiz.llm.common import fold
from tamiz.llm.quality_rules import LineRules, judge, line_fault

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fails(line, rules):
    words = WORD.findall(line)
    n = len(words)
    if not n:
        return False
    cells = [c for c in re.split(r"\s[|»›•·>]\s|[|»›•]", line) if c.strip()]
    menu = len([w for w in words if w.strip(".,:;|»›•-").lower() in rules.menu_words])
    symbols = len(re.findall(r"[#*$%&|<>]", line))
    return (len(cells) >= rules.menu_cells and all(len(c.split()) <= 3 for c in cells)
            or n <= 12 and menu > 0.6 * n
            or symbols >= 3 and symbols > rules.symbols_per_word * n
            or n >= rules.capital_words and sum(w.isupper() for w in words) > rules.capital_share * n
            or n >= rules.repeat_words and len(set(words)) < n / 2 and max(Counter(words).values()) > rules.top_word_share * n
            or n >= rules.unpunctuated_words and not re.search("[.,;:!?…。，！？؟،।]", line)
            or n <= rules.boilerplate_words and any(p in line.lower() for p in rules.phrases))


def verdict(text, rules):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    repeated = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    if len(words) < rules.min_words or 100 * len(repeated) > rules.repeat_percent * len(words):
        return False
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return sum(len(x) for x in lines if fails(x, rules)) <= rules.lost_share * sum(map(len, lines))


@pytest.mark.parametrize("rules", [LineRules(), LineRules(lost_share=0.02, symbols_per_word=0.02, capital_share=0.1, phrases=("de la",), menu_words=frozenset({"the", "of", "la", "die"}))])
def test_verdict_is_that_of_the_plain_rules(spark, rules):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = {r["doc_id"]: r["kept"] for r in quality_rules.quality_rules(docs, rules=rules).collect()}
    assert got == {i: verdict(t, rules) for i, t in texts.items()} and len(set(got.values())) == 2


@pytest.mark.parametrize("line,fault", [
    ("Home Contact About Search", "navigation"), ("Startseite Impressum Kontakt Datenschutz", "navigation"), ("Inicio Buscar Contacto Ayuda", "navigation"),
    ("Accueil Contact Aide Panier", "navigation"), ("Todos los derechos reservados. Aviso legal.", "boilerplate"), ("Tous droits réservés.", "boilerplate"),
    ("Alle Rechte vorbehalten.", "boilerplate"), ("All rights reserved.", "boilerplate"), ("The house stood by the road.", None), ("Das Haus stand am Weg.", None)])
def test_furniture_of_four_languages(line, fault):
    assert line_fault(line, line.split()) == fault


def test_lists_are_data():
    none = LineRules(menu_words=frozenset(), phrases=())
    assert line_fault("Home Contact About Search", "a b c d".split(), none) is None and line_fault("All rights reserved.", ["a"] * 3, none) is None
    assert line_fault("Etusivu Haku Yhteys", "Etusivu Haku Yhteys".split(), LineRules(menu_words=frozenset({"etusivu", "haku", "yhteys"}))) == "navigation"


def test_a_text_of_megabytes():
    text = "\n".join(f"Line {i} of text {i * 7} says {i * 3} and {i}." for i in range(60_000)) + "\nHome | About | Help | Search"
    assert judge(text)[6:8] == (True, 1)


def test_capitals_are_counted_alike():
    """One character whose lower case is longer does not change how the others are measured."""
    a, b = pu_quality.features("ǅ Abc def ghi. " * 9), pu_quality.features("İǅ Abc def ghi. " * 9)
    at = 10
    assert a[at] == pytest.approx(2 / 11) and b[at] == pytest.approx(3 / 12)


def test_weights_are_those_of_a_plain_minimiser(spark):
    """Non-negative risk on one machine: its convex minimum, or the edge where the part of the negatives is zero."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    table = pu_quality._table(docs, labels, "doc_id", "text", fold("doc_id", 4) == 2)
    model = pu_quality.fit(table)
    rows = table.filter(~F.col("held_out")).select("x", "trusted").collect()
    x = np.hstack([np.array([r["x"] for r in rows], float), np.ones((len(rows), 1))])
    trusted = np.array([r["trusted"] for r in rows])
    x = (x - model["mean"]) / model["scale"]
    n_u, n_p, prior = len(x), trusted.sum(), model["prior"]
    ridge = np.full(x.shape[1], pu_quality.RIDGE)
    ridge[-1] = 1e-6

    def risk(w):
        g = x @ w
        return np.logaddexp(0, g).mean() - prior * g[trusted].mean() + 0.5 * (ridge * w * w).sum()

    def negatives(w):
        g = np.logaddexp(0, x @ w)
        return g.mean() - prior * g[trusted].mean()

    w = np.zeros(x.shape[1])
    for _ in range(200):  # Newton steps with halving on the full matrix
        s = 1 / (1 + np.exp(-(x @ w)))
        slope = x.T @ s / n_u - prior * x[trusted].sum(axis=0) / n_p + ridge * w
        step = np.linalg.solve((x * (s * (1 - s))[:, None]).T @ x / n_u + np.diag(ridge), slope)
        size = 1.0
        while risk(w - size * step) > risk(w) and size > 1e-6:
            size /= 2
        w = w - size * step
    if negatives(w) >= 0:
        assert model["w"] == pytest.approx(w, abs=0.02) and risk(model["w"]) == pytest.approx(risk(w), abs=1e-5)
    else:
        assert negatives(model["w"]) > -0.02 and risk(model["w"]) <= risk(np.zeros_like(w))
