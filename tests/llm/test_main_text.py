import html
import re

import duckdb
import numpy as np
import pytest
from llm_rows import SF01

from clientele.llm import block_labeller
from clientele.llm.block_labeller import WIDTH, Labeller, Page
from clientele.llm.html_leaves import leaves
from clientele.llm.main_text import extract, layouts, learn, markup_labels, sample_pages
from clientele.llm.queries import queries

SCHEMA = "page_id long, url string, html string, text string, n_chars long"


def texts(page):
    return [x.text for x in leaves(page)]


def article_of(page):
    inner = re.search(r"<article>(.*)</article>", page, re.DOTALL)[1]
    blocks = (" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inner))
    return "\n".join(b for b in blocks if b)


@pytest.fixture(scope="module")
def labeller():
    pages = duckdb.sql(f"select html from '{SF01}/pages.parquet' order by page_id limit 150").fetchall()
    return learn([p[0] for p in pages])


@pytest.fixture
def pages_of(spark):
    def make(rows):
        return spark.createDataFrame([(i, f"u{i}", h, "clash", 1) for i, h in rows], SCHEMA).repartition(3)

    return make


def test_leaves_of_clean_markup():
    page = "<html><head><title>T</title><style>p{}</style></head><body><nav><a href='/x'>Home</a></nav><p>One <b>two</b>\n three&amp;four</p>"
    found = list(leaves(page))
    assert [x.text for x in found] == ["Home", "One two three&four"]
    assert found[0].path == ("html", "body", "nav") and found[0].linked == 4
    assert found[1].path == ("html", "body", "p") and found[1].linked == 0


def test_leaves_of_broken_markup():
    assert texts('<p>a<p>b<br>c<div class="x>y">d</div>e') == ["a", "b c", "d", "e"]
    assert texts('<script>var t="</p>";</script>x<!-- <p>no</p> -->y<!-- open') == ["xy"]
    assert texts("a < b <3 <p>c</p") == ["a < b <3", "c</p"]
    assert texts("<ul><li>1<li>2</ul></b></div><td>3<script>never closed") == ["1", "2", "3"]
    assert texts("</p></article> <>x&nbsp;&#8364;&lt;p&gt;") == ["<>x €<p>"]
    assert texts(None) == texts("") == texts("<p> </p>") == []


def test_long_and_deep_pages_take_linear_time():
    n = 20_000
    assert len(texts("<div>" * n + "x" + "</div>" * n + "<p>y" * n)) == n + 1
    assert texts('<a b="' * n + ">") == []
    assert texts("<" * n) == ["<" * n]


def test_gradients():
    rng = np.random.default_rng(0)
    lab = Labeller.fresh(3, 1)
    lab.weights = {k: v.astype(np.float64) for k, v in lab.weights.items()}
    x, y = rng.normal(size=(2, 4, WIDTH)), (rng.random((2, 4)) > 0.5).astype(float)
    mask = np.array([[1.0, 1, 1, 1], [1, 1, 0, 0]])
    _, grads = lab.gradients(x, y, mask)
    for name, g in grads.items():
        at = tuple(rng.integers(s) for s in g.shape)
        kept, side = lab.weights[name][at], []
        for e in (1e-4, -1e-4):
            lab.weights[name][at] = kept + e
            side.append(lab.gradients(x, y, mask)[0])
        lab.weights[name][at] = kept
        assert (side[0] - side[1]) / 2e-4 == pytest.approx(g[at], rel=0.05, abs=1e-4), name


def test_stretches_and_groups_change_nothing(labeller, monkeypatch):
    pages = [Page(f) for f, _ in layouts(["some words here", "and more of them, too."], 40, 3)]
    whole = labeller.probabilities(pages)
    monkeypatch.setattr(block_labeller, "STEPS", 3)
    single = [labeller.probabilities([p])[0] for p in pages]
    for a, b in zip(whole, single, strict=True):
        np.testing.assert_allclose(a, b, atol=1e-5)


def test_query_equals_the_articles(spark):
    got = {r.page_id: r for r in queries()["op11_main_text"](spark, SF01).collect()}
    pages = duckdb.sql(f"select page_id, url, html from '{SF01}/pages.parquet'").fetchall()
    assert len(got) == len(pages)
    for page_id, url, page in pages:
        want = article_of(page)
        assert (got[page_id].url, got[page_id].text, got[page_id].n_chars) == (url, want, len(want))


def test_held_out_layouts(labeller):
    lines = ["A line that no training page has.", "Other words, not seen either; they end here.", "Brief"]
    some = list(layouts(lines, 300, 77))
    found = labeller.probabilities([Page(f) for f, _ in some])
    right = [(p >= 0.5) == (y > 0) for p, (_, y) in zip(found, some, strict=True)]
    assert np.concatenate(right).mean() >= 0.97


def test_other_parts_of_a_page_go(labeller, pages_of):
    body = "".join(f"<p>Sentence number {i} of the article, with several words.</p>" for i in range(6))
    page = (
        '<body><header><h1>The site</h1></header><nav><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li></ul></nav>'
        '<div class="cookie-banner"><p>We use cookies.</p></div><div id="content"><h1>A title of some words</h1>'
        f'{body}<form><label>Mail</label><button>Send</button></form></div><aside><p>More like this</p></aside>'
        '<div class="comments"><div class="comment"><p>First to say so!</p></div></div><footer>&copy; 2020 the site</footer></body>'
    )
    rows = extract(pages_of([(1, page)]), labeller).collect()
    assert rows[0].text == "\n".join(["A title of some words", *(f"Sentence number {i} of the article, with several words." for i in range(6))])


def test_odd_pages(labeller, pages_of):
    long = "<article>" + "<p>words of a long page stand here.</p>" * 3000 + "</article>"
    odd = [(1, None), (2, ""), (3, "<html>"), (4, "<article><p>a b c d e</p></article>"), (4, "<article><p>a b c d e</p></article>"), (None, long)]
    rows = extract(pages_of(odd), labeller).collect()
    assert len(rows) == len(odd) and all(r.n_chars == len(r.text) for r in rows)
    by_id = {r.page_id: r for r in rows}
    assert by_id[1].text == by_id[2].text == by_id[3].text == ""
    assert by_id[None].text.count("\n") == 2999
    assert extract(pages_of([]), labeller).count() == 0


def test_markup_labels():
    found = list(leaves("<nav>a</nav><article><p>b</p><aside>c</aside><div class='comments'>d</div></article>"))
    assert markup_labels(found).tolist() == [0, 1, 0, 0]
    assert markup_labels(list(leaves("<p>a</p>"))) is None


def test_sample_is_bounded_and_has_no_copies(spark, pages_of):
    copies = [(i, "<p>same</p>") for i in range(50)] + [(100 + i, f"<p>{i}</p>") for i in range(40)] + [(1, None)]
    got = [r.html for r in sample_pages(pages_of(copies), 20, 1000).collect()]
    assert 5 <= len(got) <= 20 and len(set(got)) == len(got)
    assert sample_pages(pages_of([]), 20, 1000).count() == 0
    assert learn([]).probabilities([Page([])])[0].tolist() == []
