"""Template deduction against explicit occurrence vectors, and pages on which only the template can tell."""

import html
import re
from collections import Counter, defaultdict

import pytest

from tamiz.llm import html_template
from tamiz.llm.html_template import ELEMENT, TEXT, Template, classes, extract, page_text, page_tokens, tokens

SCHEMA = "page_id long, url string, html string"


def texts(spark, made):
    return {r["page_id"]: r["text"] for r in extract(spark.createDataFrame(made, SCHEMA)).collect()}


def article(page):
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = re.sub(r"</?b>", "", re.sub(r"<br>", " ", re.sub(r"</?(?:p|h1)>", "\x01", inner))).split("\x01")
    return "\n".join(x for x in (" ".join(html.unescape(p).split()) for p in parts) if x)


def neutral(page):
    """The page without telling tags and names."""
    page = re.sub(r"<(/?)(?:nav|article|main|footer|aside|header|section)\b[^>]*>", r"<\1div>", page)
    return re.sub("<div [^>]*>", "<div>", page)


def f1(a, b):
    a, b = Counter(a.split()), Counter(b.split())
    return 1.0 if a == b else 2 * sum((a & b).values()) / (sum(a.values()) + sum(b.values()))


def test_pages_without_telling_markup(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    got = texts(spark, [(r["page_id"], r["url"], neutral(r["html"])) for r in pages])
    assert sum(f1(article(r["html"]), got[r["page_id"]]) for r in pages) / len(pages) >= 0.98


def host(n, story="<p>Story {i} begins here, and it is about number {i}.</p><p>It ends, {i}.</p>", frame="div"):
    return [(i, f"http://h.example/{i}", "<body><div>The site</div><div><a href=x>Go {i}</a> <a href=y>On</a></div>"
             f"<{frame}><p>All rights of the story are kept by us.</p>{story.format(i=i)}</{frame}><div>Imprint</div></body>") for i in range(n)]


@pytest.mark.parametrize("n", [2, 3, 20])
def test_what_pages_share_goes(spark, n):
    got = texts(spark, host(n))
    assert got == {i: f"Story {i} begins here, and it is about number {i}.\nIt ends, {i}." for i in range(n)}


def test_result_comes_through_the_template(spark):
    """With no template the text that all pages share stays."""
    made = host(3)
    assert all("All rights" in page_text(page, Template()) for _, _, page in made)
    assert not any("All rights" in t for t in texts(spark, made).values())


def test_a_teaser_does_not_end_the_search(spark):
    made = [(i, f"http://t.example/{i}", f"<body><article><a href=x>Teaser {i}</a></article><div><p>The story number {i} starts in a plain element.</p>"
             f"<p>Its second part {i} follows.</p></div></body>") for i in range(4)]
    assert texts(spark, made) == {i: f"The story number {i} starts in a plain element.\nIts second part {i} follows." for i in range(4)}


def test_the_only_page_of_a_host(spark):
    """No template: its slots and the markup decide, and no text is fixed."""
    [(i, url, page)] = host(1)
    assert texts(spark, [(i, url, page)])[0].split("\n")[1:] == ["Story 0 begins here, and it is about number 0.", "It ends, 0."]


def test_copies_keep_their_text(spark):
    story = "<p>One and the same story on every page of this host, and it is long.</p>"
    got = texts(spark, host(2, story) + [(7, "http://c.example/7", "<p>x y</p>"), (7, "http://c.example/7", "<p>x y</p>")])
    assert all("One and the same story" in got[i] for i in range(2)) and got[7] == "x y"


def test_fixed_texts_out_of_order_are_data(spark):
    made = [(i, f"http://o.example/{i}", f"<body><div><p>First</p><p>Story {i} with words of its own, {i} of them</p><p>Second</p><p>Third</p></div></body>") for i in range(10)]
    made.append((10, "http://o.example/10", "<body><div><p>Second</p><p>Third</p><p>Story 10 with words of its own</p><p>First</p></div></body>"))
    got = texts(spark, made)
    assert got[3] == "Story 3 with words of its own, 3 of them" and got[10] == "Story 10 with words of its own\nFirst"


def test_classes_are_those_of_explicit_vectors(spark):
    made = host(4) + [(i, f"http://g.example/{i}", p) for i, _, p in host(3, "<p>{i}</p><ul><li>a<li>{i}</ul>")]
    made += [(50, "http://r.example/a", "<p>A</p><b>x</b>")] * 2 + [(51, "http://r.example/b", "<p>B</p><i>y</i>")] * 2
    vectors = defaultdict(lambda: defaultdict(Counter))
    for at, (_, url, page) in enumerate(made):
        for token, row in page_tokens(page).items():
            if row[0] in (ELEMENT, TEXT):
                vectors[html_template.host_of(url)][token][at] = row[2]
    want = set()
    for name, found in vectors.items():
        pages = sum(html_template.host_of(url) == name for _, url, _ in made)
        groups = defaultdict(set)
        for token, vector in found.items():
            if len(vector) > 1 and len(vector) >= 0.9 * pages:
                groups[frozenset(vector.items())].add(token)
        want |= {frozenset(g) for g in groups.values()}
    got = defaultdict(set)
    counted = tokens(spark.createDataFrame(made, SCHEMA).repartition(3), "page_id", "url", "html")
    for r in classes(counted).collect():
        got[r["host"], r["low"], r["high"]].add(r["token"])
    assert {frozenset(g) for g in got.values()} == want and len(want) > 4


def test_repeated_rows_do_not_cancel(spark):
    made = [(50, "http://r.example/a", "<p>A</p>")] * 2 + [(51, "http://r.example/b", "<p>B</p>")] * 2
    rows = [r for r in tokens(spark.createDataFrame(made, SCHEMA), "page_id", "url", "html").collect() if r["kind"] == TEXT]
    assert len(rows) == 2 and len({(r["low"], r["high"]) for r in rows}) == 2 and all(r["low"] for r in rows)


def test_long_pages(spark):
    long = "<p>" + "</p><p>".join(f"Paragraph {i} of many." for i in range(60_000)) + "</p>"
    made = [(1, "http://l.example/1", f"<article>{long}</article>"), (2, "http://l.example/2", "<article><p>Short one.</p></article>"), (3, "http://l.example/3", "<div>" * 30_000 + "deep")]
    got = texts(spark, made)
    assert got[1].count("\n") == 59_999 and got[2] == "Short one." and got[3] == "deep"
