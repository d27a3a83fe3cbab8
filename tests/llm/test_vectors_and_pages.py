"""Vector operators against brute force, and text of hand-made pages."""

import numpy as np
import pytest

from tablepact.llm import common
from tablepact.llm.embedding_dedup import multi_sequence, near_vectors
from tablepact.llm.hamming_search import ball, nearest, substring_radii
from tablepact.llm.html_text import blocks, extract, main_text, parse
from tablepact.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string, rank string"


def vectors():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 16))
    for g in range(10):
        x[100 + 12 * g : 112 + 12 * g] = x[g] + rng.normal(size=(12, 16)) * 0.05
    x[280:290] = x[5]
    return x.astype(np.float32)


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, v.tolist(), 0, "a", "b") for i, v in enumerate(vectors())]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] * 16, [1.0, 2.0]]
    rows += [(1000 + i, v, 0, "a", "b") for i, v in enumerate(odd)]
    return spark.createDataFrame([*rows, rows[3], (None, rows[4][1], 0, "a", "b")], SCHEMA)


@pytest.mark.parametrize("tile", [2048, 16])
def test_near_vectors_like_brute_force(spark, table, monkeypatch, tile):
    monkeypatch.setattr(common, "TILE", tile)
    x = vectors().astype(float)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = u @ u.T >= 0.95
    np.fill_diagonal(linked, False)
    comp = np.arange(len(x))
    for _ in range(20):
        comp = np.minimum(comp, np.where(linked, comp, 10**6).min(1))
    got = {r["id"]: r for r in near_vectors(table).collect()}
    assert len(got) == 308 and got[1000]["n_links"] == 0 and got[1006]["kept"]
    assert [(got[i]["n_links"], got[i]["component_id"]) for i in range(300)] == list(zip(linked.sum(1).tolist(), comp.tolist()))
    assert near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_nearest_recall(spark, table):
    x = vectors().astype(float)
    got = {}
    for r in nearest(table, common.F.col("id") % 10 == 0, k=5).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["id"], r["score"]))
    hits = []
    for q in range(0, 300, 10):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        want = np.lexsort((np.arange(300), d))[:5].tolist()
        assert [r for r, _, _ in sorted(got[q])] == [1, 2, 3, 4, 5] and all(s == pytest.approx(d[i], abs=1e-12) for _, i, s in got[q])
        hits.append(len({i for _, i, _ in got[q]} & set(want)) / 5)
    assert np.mean(hits) >= 0.9 and 1000 not in got
    few = table.filter("vec_id < 4")
    assert nearest(few, k=10).count() == 12 and nearest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_pigeonhole_of_substrings():
    for radius in range(0, 33):
        radii = substring_radii(radius, 4)
        # The hardest code just exceeds every substring's radius.
        assert sum(r + 1 for r in radii) == radius + 1
    assert len(ball(8, 2)) == 37


def test_multi_sequence_ascends():
    a, b = np.sort(np.random.default_rng(1).random(9)), np.sort(np.random.default_rng(2).random(7))
    got = [a[i] + b[j] for i, j in multi_sequence(a, b, 1.0)]
    assert got == sorted(got) and len(got) == sum(x + y <= 1.0 for x in a for y in b)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/">menu</a></li></ul></nav><div class="ad">buy</div><div class="cookie-notice">ok?</div>
<article class="post-%d"><h1>A &amp; B</h1><p><b>One   two<br><p>Three&nbsp;four</p><div class="share">share me</div><p>Five</p>
<section id="comments"><p>what a long reader comment that must not count as text of the article at all</p></section></article>
<form><p>mail?</p></form><footer>&copy; x"""


def test_page_text(spark):
    assert extract(parse(PAGE % 1), None) == "A & B\nOne two\nThree four\nFive"
    assert blocks(parse("")) == [] and extract(parse("<p>" * 3000 + "deep"), None) == "deep"
    rows = [(i, f"http://h.example/{i}", PAGE % i) for i in range(5)]
    rows += [(8, "http://h.example/8", "<body><div>just a div with some text in it</div>"), (9, None, None), (10, "x", ""), rows[0]]
    got = main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    by = {r["page_id"]: r for r in got}
    assert len(got) == 9 and by[3]["text"] == "A & B\nOne two\nThree four\nFive" and by[3]["path"] == "html>body>article.post-#"
    assert by[8]["text"] == "just a div with some text in it" and by[9]["text"] == by[10]["text"] == "" and by[9]["n_chars"] == 0
    assert main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_text_beside_a_long_section_stays(spark):
    long = "<p>" + "a long paragraph of the article, " * 30 + "</p>"
    for tag in ("section", "blockquote", "div"):
        page = f"<body><article><h1>Title</h1><p>The intro.</p><{tag}>{long}</{tag}></article><div class='ad'>buy</div>"
        assert extract(parse(page), None).split("\n")[:2] == ["Title", "The intro."] and "buy" not in extract(parse(page), None)
    table = f"<body><div><div id='x'><p>The intro.</p><table><tr><td>{long}</td><td>second cell</td></tr></table></div><div><p>other</p></div></div>"
    assert extract(parse(table), None).split("\n")[0] == "The intro." and extract(parse(table), None).endswith("second cell")
    rows = [(i, f"http://h.example/{i}", f"<article><h1>T{i}</h1><p>Intro {i}</p><section>{long}</section></article>") for i in range(6)]
    got = main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert all(r["path"] == "article" and r["text"].startswith(f"T{r['page_id']}\nIntro {r['page_id']}\n") for r in got)
    assert extract(parse("<div>" * 20000 + "<p>deep text</p>"), None) == "deep text"


def test_names_of_wrappers_drop_no_article():
    text = "<p>" + "words of the article " * 20 + "</p>"
    for name in ("has-sidebar", "content-with-sidebar", "no-comments", "sidebar", "page-header"):
        assert extract(parse(f"<body><div class='{name}'><article><h1>T</h1>{text}</article></div>"), None).startswith("T\nwords")
        assert "words" in extract(parse(f"<body><p>By somebody</p><div class='{name}'>{text}</div>"), None)
        assert "words" in extract(parse(f"<body><article><p>short</p><div class='{name}'>{text}</div></article>"), None)
    page = f"<body><article>{text}<div class='related'><p>another one</p></div><div class='sidebar'><p>side</p></div></article><div class='comments'>{text * 3}</div>"
    assert extract(parse(page), None) == " ".join(["words of the article"] * 20)


def test_every_operator_is_registered():
    assert sorted({int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")}) == list(range(1, 14)) and "pipeline" in QUERIES


@pytest.mark.parametrize("page", ['<x"' * 100_000, '<p a="' * 50_000 + ">", "<!x" * 50_000, "<a b='>\" " * 30_000, "<div>" * 50_000 + "</p>" * 50_000,
                                  "<ul>" + "<div>" * 20_000 + "<td></td>" * 20_000, "</script " * 50_000, "<script>" * 50_000])
def test_broken_pages_take_linear_time(page):
    import time

    began = time.perf_counter()
    extract(parse(page), "html>body>div")
    assert time.perf_counter() - began < 5


@pytest.mark.parametrize("html, want", [
    ('<p title="x>text one two</p>', "text one two"),
    ("<p title=it's>text one two</p><p class='b'>more</p>", "text one two\nmore"),
    ("<body><form><div><p>all the words of a page</p><input><button>go</button></div></form></body>", "all the words of a page"),
    ("<article><p>long enough a text to be the article</p><form><p>your name</p><input></form></article>", "long enough a text to be the article"),
    ("<p>a &lt; b <b and no end", "a < b <b and no end"),
])
def test_broken_markup_leaves_the_text(html, want):
    assert extract(parse(html), None) == want
