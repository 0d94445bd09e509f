"""Blocks of pages, gradients of the labeller, held-out pages."""

import html
import re

import numpy as np
import pytest

from partysieve.llm import block_lstm as b
from partysieve.llm.html_blocks import blocks, features

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labeller(spark):
    return b.train(spark.read.parquet(f"{SF}/pages.parquet").where("page_id % 4 <> 0"))


def texts(source):
    return [x.text for x in blocks(source)]


def test_blocks():
    assert texts("<p>a &amp; b&nbsp;c &lt;i&gt;<b>d</b>e<br>f<p>g\n\n h</p>i") == ["a & b c <i>de f", "g h", "i"]
    assert texts("<script>var x='<p>no</p>';</script><style>p{}</style><!-- <p>no</p> --><title>no</title><div>yes</div>") == ["yes"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>") == ["a", "b", "c", "d"]
    assert [x.path for x in blocks("<ul><li>a<li>b</ul><div><p>c<div>d")] == [("ul", "li"), ("ul", "li"), ("div", "p"), ("div", "div")]
    assert texts("</p></div>a<div title='x>y' class=\"q\">b") == ["a", "b"]
    assert texts("a < b <3 <unclosed") == ["a < b <3"]
    assert texts("<script>never closed <p>x") == [] and texts("") == [] and texts(" \n ") == []
    assert blocks("<div class='Cookie-Notice x' id=main><p>t")[0].names == ("cookie", "notice", "x", "main")
    deep = "<div>" * 3000 + "x"
    assert texts(deep) == ["x"] and len(features([blocks(deep)])[0]) == 1
    assert features([[], blocks("<p>a")])[0].shape[0] == 0


def test_long_pages_are_sampled(spark):
    long = "<article>" + "<p>long text here</p>" * 6000
    frame = spark.createDataFrame([(i % 6, f"{long}{i % 6}") for i in range(9)] + [(9, None)], "page_id long, html string")
    assert sorted(r["html"] for r in b.sampled(frame).collect()) == [f"{long}{i}" for i in range(6)]
    assert b.sampled(frame, chars=2 * len(long) + 2).count() == 2 and b.sampled(frame, chars=10).count() == 1
    assert b.sampled(frame.where("false")).count() == 0


def test_silent_elements():
    assert texts("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds") == ["so x=2 holds"]
    for tag in ("button", "object", "select", "video", "noscript", "svg", "template", "canvas", "audio"):
        assert texts(f"<p>a<{tag} class='q'>no<p>no</{tag.upper()} >b<{tag}/>c") == ["abc"]
        assert texts(f"<div>a<{tag} class='q'></div><article><p>b</p></article>") == ["a", "b"]
    for tag in ("script", "style", "title", "textarea", "iframe"):
        assert texts(f"<div>a<{tag}></div><p>no") == ["a"]
    assert texts("<button><p>a" * 20_000) == ["a"] * 20_000


def test_gradients():
    draw = np.random.default_rng(2)
    pages = [draw.normal(size=(n, b.WIDTH)).astype(np.float32) for n in (5, 3)]
    labels = [np.array([1, 0, 1, 1, 0], np.float32), np.array([0, 1, 0], np.float32)]
    model = b.Labeller()
    x, mask = b.padded(pages)
    y = np.zeros(mask.shape)
    for j, l in enumerate(labels):
        y[:len(l), j] = l

    def loss():
        s = model.scores(x, mask)[0].astype(float)
        return (np.where(mask, np.logaddexp(0, s) - y * s, 0)).sum()

    keep = ([], [])
    score, _ = model.scores(x, mask, keep)
    d = np.where(mask, b._sigmoid(score) - y, 0).astype(np.float32)
    d_state = d[:, :, None] * model.v
    grads = model.there.backward(x, keep[0], d_state[:, :, :b.HIDDEN]) + model.back.backward(x[::-1], keep[1], d_state[::-1, :, b.HIDDEN:2 * b.HIDDEN])
    for p, g in zip(model.parameters(), grads):
        for at in [tuple(draw.integers(0, n) for n in p.shape) for _ in range(4)]:
            old, eps = p[at], np.float32(1e-2)
            p[at] = old + eps
            up = loss()
            p[at] = old - eps
            down = loss()
            p[at] = old
            assert abs((up - down) / (2 * eps) - g[at]) < 0.03 + 0.05 * abs(g[at])


def test_held_out_pages(spark, labeller):
    rows = spark.read.parquet(f"{SF}/pages.parquet").where("page_id % 4 = 0")
    got = {r["page_id"]: r["text"] for r in b.extract(rows, labeller).collect()}
    for r in rows.collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert got[r["page_id"]] == "\n\n".join(x for x in parts if x)


def test_other_layouts(labeller):
    page = ("<body><div id='nav'><ul><li><a>x</a></li></ul></div><div class='content'><h1>T of it all</h1><p>Para one is here.</p><p>Para two</p>"
            "</div><div class='sidebar'><p>about me</p></div><div id='comments'><p>nice one, I agree with you</p></div><div class='footer'>c 2020</div>")
    found = blocks(page)
    assert b.main_text(found, labeller.label(features([found]))[0]).split("\n\n") == ["T of it all", "Para one is here.", "Para two"]
    made, labels = b.varied(["Some good text that goes on.", "More of it here."], ["Home", "Contact us now"], 200, seed=77)
    right = np.concatenate([x == y for x, y in zip(labeller.label(features(made)), labels)])
    assert right.mean() > 0.93


def test_odd_pages(spark, labeller):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>"), (2, "v", "no markup at all"), (3, "w", "<article>" + "<p>long text here</p>" * 3000)]
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    got = b.extract(frame, labeller).collect()
    assert len(got) == 5 and [r for r in got if r["page_id"] == 1][0]["text"] == ""
    long = [r for r in got if r["page_id"] == 3][0]
    assert long["n_chars"] == len(long["text"]) == 3000 * 14 + 2999 * 2
    assert b.extract(frame.where("false"), labeller).collect() == []


def test_references_end_at_markup():
    assert [b.text for b in blocks("<p>a &<b>amp;</b> b &amp; &lt<i>;</i> c&nbsp;d</p>")] == ["a &amp; b & <; c d"]


def test_long_pages_are_labelled_in_stretches():
    """However a page is cut into stretches, each block sees the whole of it."""
    labeller = b.fitted([])
    page = blocks("<body><nav><li>Home</li></nav><article>" + "<p>A sentence of the text, number one.</p>" * 300
                  + "</article><footer><p>All rights reserved.</p></footer></body>")
    want = labeller.label_pages([page, page[:5], [], page])
    for cells in (7, 100, 250):
        got = labeller.label_pages([page, page[:5], [], page], cells)
        assert [x.tolist() for x in got] == [x.tolist() for x in want]
    many = page[1:2] * 300_000
    assert len(labeller.label_pages([many])[0]) == 300_000
