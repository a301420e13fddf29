"""Nulls, empty and long texts, repeats, ties, empty tables and clashing columns, for every operator and stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tamiz.llm import html_template, jaccard_join, line_dedup, mixing, packing, ppm, pu_quality, quality_rules, secrets, winnowing

WORDS = " ".join(f"word{i}, then" for i in range(60)) + "."
ROWS = [(1, WORDS, "en", "a", None), (1, WORDS, "en", "a", 5), (2, None, None, None, None), (3, "", "en", "b", 0),
        (None, "one two three.", "en", "b", 14), (4, " \n\t ", "en", "b", 4), (5, "x" * 5000 + " end.", "de", "a", 5005),
        (6, WORDS, None, None, 7), (7, "short.", "en", "c", 6)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["kept", "n_words", "clean_text", "lines", "h", "row", "size", "copies", "node", "class_id", "d", "t", "k", "x",
         "doc", "target", "host", "token", "range", "tail", "x__", "held_out", "score", "fixed", "tokens", "judged"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def clashing(docs):
    return docs.withColumns({c: F.lit(7) for c in CLASH})


LABELS = [(i, i % 2) for i in range(20)]
OPERATORS = {
    "quality": lambda d: pu_quality.classify(d, d.sparkSession.createDataFrame(LABELS, "doc_id long, quality int")),
    "mix": mixing.mix, "join": jaccard_join.jaccard_join, "score": ppm.score, "rules": quality_rules.quality_rules,
    "scan": secrets.scan, "pack": packing.pack, "lines": line_dedup.line_dedup, "next": winnowing.compare_with_next,
    "prints": winnowing.fingerprints,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(name, docs, clashing):
    result = OPERATORS[name](docs)
    got = result.collect()
    if name == "mix":
        assert sum(r["m"] for r in got) == len(ROWS)
    elif name == "pack":
        assert len({(r["doc_id"], r["sequence_id"], r["offset"]) for r in got}) == len(got) >= len(ROWS)
    else:
        assert len(got) == len(ROWS)
    again = OPERATORS[name](clashing).select(result.columns).collect()
    key = lambda r: str([round(v, 6) if isinstance(v, float) else v for v in r])
    assert sorted(map(key, again)) == sorted(map(key, got))


@pytest.mark.parametrize("name", OPERATORS)
def test_no_rows(name, docs):
    assert OPERATORS[name](docs.limit(0)).count() == 0


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_odd_rows(spark, docs, name, stage):
    plain = stage(spark, docs, "").collect()
    wide = docs.withColumns({c: F.lit(7) for c in CLASH})
    out = stage(spark, wide, "")
    if name != "best-fit packing":
        assert out.columns == wide.columns
        assert out.schema["text"].dataType == docs.schema["text"].dataType
    assert out.count() == len(plain)
    assert stage(spark, docs.limit(0), "").count() == 0


def test_stage_results(spark, docs):
    kept = [r["doc_id"] for r in corpus_pipeline.rules(spark, docs, "").collect()]
    assert sorted(kept) == [1, 1, 6]
    heads = [r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    assert sorted(heads, key=str) == sorted([1, 2, 3, None, 4, 5, 7], key=str)


@pytest.fixture(scope="module")
def megabytes(spark):
    """A text of two megabytes in many lines, one of them without a line end, and a short one."""
    lines = "\n".join(f"Line {i} of text {i * 7} says {i * 3} and then {i}." for i in range(50_000))
    words = " ".join(f"w{i % 5000}x{i}" + "," * (i % 9 == 0) for i in range(150_000))
    return spark.createDataFrame([(1, lines, "en", "a", len(lines)), (2, words, "en", "b", len(words)), (3, WORDS, "en", "c", None)], SCHEMA).repartition(3)


@pytest.mark.parametrize("name", OPERATORS)
def test_megabytes(name, megabytes):
    got = OPERATORS[name](megabytes).collect()
    assert {r["doc_id"] for r in got} == {1, 2, 3}
    if name == "pack":
        assert sum(r["length"] for r in got if r["doc_id"] == 1) > 500_000
    if name == "mix":
        assert {r["doc_id"]: r["size"] for r in got}[2] == 150_000
    if name == "score":
        assert {r["doc_id"]: r["n_tokens"] for r in got}[2] == 150_001


def test_stages_on_megabytes(spark, megabytes):
    docs = megabytes
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, "")
    assert {r["doc_id"] for r in docs.select("doc_id").collect()} == {1, 2, 3}


PAGES = [(1, "http://a.example/1", "<p>One&amp;two <b>bold</b><p>Next"), (2, None, None), (3, "no url", ""), (1, "http://a.example/1", "<p>One"),
         (None, "http://a.example/2", "<div class='sidebar'>x</div><p>text</p><" + "<b" * 2000)]


def test_odd_pages(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    got = {(r["page_id"], r["text"]) for r in html_template.extract(pages.withColumns({c: F.lit(1) for c in CLASH})).collect()}
    assert {(1, "One&two bold\nNext"), (2, ""), (3, ""), (1, "One")} <= got and len(got) == 5
    assert html_template.extract(pages.limit(0)).count() == 0
