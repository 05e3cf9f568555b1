"""Main text of pages: the parser, the labeller on layouts it has not seen, awkward rows."""

import random
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest

from tidemart.llm import main_text
from tidemart.llm._html import blocks
from tidemart.llm._layouts import Layout

SF = Path("/root/testdata/sf0.01/pages.parquet")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def html():
    return pq.read_table(SF).column("html").to_pylist()


@pytest.fixture(scope="module")
def model(html):
    """Fitted on half of the pages."""
    return main_text.fit(main_text.training_pages(html[::2]))


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        ("<p>a<b>b<p>c</b>d</p>e", [("ab", "p"), ("cd", "p"), ("e", "")]),
        ("<p>a &amp;amp;\n <i>b</i>&nbsp;&copy;<br>c", [("a &amp; b © c", "p")]),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", [("a", "ul/li"), ("b", "ul/li"), ("c", "ul/li/ul/li"), ("d", "ul/li"), ("e", "")]),
        ("<table><tr><td>1<td>2<tr><td>3</table>4", [("1", "table/tr/td"), ("2", "table/tr/td"), ("3", "table/tr/td"), ("4", "")]),
        ('<script>var a="</p><p>"</script>q<style>x', [("q", "")]),
        ("<!-- <p>no</p> --><p>yes<!-- open", [("yes", "p")]),
        ("<head><title>t</title><body>b", [("b", "body")]),
        ("1 < 2 <3 & 4 > 3", [("1 < 2 <3 & 4 > 3", "")]),
        ('<a href="x>y">link</a> text', [("link text", "a")]),
        ("<DIV CLASS=One>a<select><option>x</select></DIV></p></em>b", [("a", "div"), ("b", "")]),
        ("", []),
        (" \n ", []),
    ],
)
def test_blocks(page, expected):
    found = [(b.text, "/".join(e.name for e in b.path)) for b in blocks(page)]
    assert found == expected


def test_parsing_takes_time_in_proportion():
    assert len(blocks("<div>t" * 30_000)) == 30_000
    assert blocks("<a href='" * 30_000) == []
    assert len(blocks("<b><p>x" * 20_000)) == 20_000


def test_articles_of_the_test_table_come_out_whole(html, model):
    """Pages that the model was not fitted on."""
    held_out = html[1::2]
    found = main_text.main_text(held_out, model)
    expected = [
        "\n".join(b.text for b in blocks(h[h.index("<article>") : h.index("</article>")])) for h in held_out
    ]
    assert np.mean([a == b for a, b in zip(found, expected, strict=True)]) >= 0.99


def test_unseen_layouts(html, model):
    """Blocks of invented pages of another seed, with texts of pages not learned from."""
    pool = [b.text for h in html[1::2] for b in blocks(h) if any(e.name == "article" for e in b.path)]
    rng = random.Random(99)
    pages = [(blocks(x.page), x.main) for x in (Layout(rng, pool) for _ in range(200))]
    assert all(len(page) == len(labels) for page, labels in pages)
    found = main_text.labelled([page for page, _ in pages], model)
    right = np.concatenate([f == np.array(m) for f, (_, m) in zip(found, pages, strict=True)])
    assert right.mean() >= 0.97


SITES = [
    """<html><body class="home"><div id="page"><div id="masthead"><h1 class="site-title">My Blog</h1></div>
    <ul id="primary-menu"><li><a href="/">Home</a></li><li><a href="/a">About</a></li></ul>
    <div id="content"><div class="post hentry"><h2 class="entry-title">{0}</h2>
    <div class="entry-content"><p>{1}</p><p>{2}</p></div></div>
    <div id="comments"><h3>2 comments</h3><ol class="commentlist"><li class="comment"><p>{3}</p></li>
    <li class="comment"><p>{4}</p></li></ol></div></div>
    <div id="sidebar" class="widget-area"><div class="widget"><h3>Recent posts</h3><ul><li><a href="/x">{5}</a></li></ul></div></div>
    <div id="colophon">Powered by nothing</div></div></body></html>""",
    """<body><header><nav><a href=/>Start</a> <a href=/b>Blog</a></nav></header>
    <div class="cookie-banner"><p>We use cookies to improve your experience.</p><button>OK</button></div>
    <main><h1>{0}</h1><p>{1}</p><div class="ad">{5}</div><p>{2}</p></main>
    <section class="comments"><h2>Comments</h2><p>{3}</p><p>{4}</p></section>
    <form action="/s"><label>Your e-mail</label><input></form><footer><p>© 2024</p></footer></body>""",
]


@pytest.mark.parametrize("site", range(len(SITES)))
def test_written_sites(site, html, model):
    pool = [b.text for h in html[1::2] for b in blocks(h) if b.path[-1].name == "p" and 15 < b.text.count(" ") < 80]
    right = 0
    for k in range(20):
        some = [t.replace("<", "").replace("&", "") for t in pool[6 * k : 6 * k + 6]]
        some[0], some[5] = " ".join(some[0].split()[:7]), " ".join(some[5].split()[:6])
        some = [" ".join(t.split()) for t in some]
        found = main_text.main_text([SITES[site].format(*some)], model)[0]
        right += found == "\n".join(some[:3])
    assert right >= 18


def test_awkward_pages(spark, model):
    long = "<article>" + "<p>one two three four five.</p>" * 20_000 + "</article>"
    rows = [
        (1, "u", None, "old", 1.0),
        (2, None, "", "old", None),
        (None, "u", "<p>", None, 2.0),
        (4, "u", long, "x", 3.0),
        (4, "u", long, "x", 3.0),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, `a.b` double")
    got = main_text.extract_main_text(pages, model)
    assert got.columns == ["page_id", "url", "a.b", "text"]
    found = sorted(((r.page_id, r["a.b"], len(r.text)) for r in got.collect()), key=repr)
    whole = len("one two three four five.\n") * 20_000 - 1
    assert found == [(1, 1.0, 0), (2, None, 0), (4, 3.0, whole), (4, 3.0, whole), (None, 2.0, 0)]
    assert main_text.extract_main_text(pages.limit(0), model).collect() == []


def test_model_is_the_same_each_time_and_needs_no_marked_pages(spark, html, monkeypatch):
    monkeypatch.setattr(main_text, "FIT_LAYOUTS", 60)
    monkeypatch.setattr(main_text, "EPOCHS", 2)
    pages = spark.createDataFrame(list(enumerate(html[:30])), "page_id long, html string")
    a, b = main_text.train(pages.repartition(4)), main_text.train(pages)
    assert all((a[k] == b[k]).all() for k in a)
    assert main_text.train(pages.limit(0))["path"].shape == a["path"].shape
