from __future__ import annotations

import re

import numpy as np
import pytest

from cinderlog.llm import extraction
from tests.llm.layouts import PAGES


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet("/root/testdata/sf0.01/pages.parquet")


@pytest.fixture(scope="module")
def network(pages):
    return extraction.train(pages, bound=120)


def test_pages_give_their_articles(pages, network):
    found = {r.page_id: r for r in extraction.extract(pages, network).collect()}
    rows = pages.collect()
    assert len(found) == len(rows)
    right = 0
    for r in rows:
        blocks = extraction.blocks_of(r.html)
        right += found[r.page_id].text == "\n".join(b.text for b in blocks if extraction.semantic_label(b))
        assert found[r.page_id].n_chars == len(found[r.page_id].text)
    assert right / len(rows) > 0.98


def test_other_layouts(pages, network):
    rng, vectors, right, n = np.random.default_rng(5), extraction.Vectors(), 0, 0
    for r in pages.where("page_id % 7 = 0").collect():
        blocks = extraction.blocks_of(r.html)
        some, labels = extraction.variant(blocks, [extraction.semantic_label(b) for b in blocks], rng)
        said = network.scores([vectors.of(some)])[0] >= 0.5
        right, n = right + int((said == np.array(labels)).sum()), n + len(labels)
    assert right / n > 0.97


def test_blocks():
    page = """<html><head><title>T</title><style>p{}</style></head><body><!-- <p>no</p> --><p>a &amp; b&nbsp;&#99;
      d<br>e<p>f <b>g</b><script>var t="</p>";</script>h<ul><li>i<li>j</ul>k < 3 &am <div title="x>y">l</div><p"""
    assert [b.text for b in extraction.blocks_of(page)] == ["a & b c d e", "f gh", "i", "j", "k < 3 &am", "l"]
    assert extraction.blocks_of(None) == extraction.blocks_of("") == extraction.blocks_of("<p> </p>") == []


@pytest.mark.parametrize(("page", "texts"), [
    ('<p>one</p><svg class="i"/><p>two</p>', ["one", "two"]),
    ("<svg><text>no</text></svg><p>a<math><mi>y</mi></math>", ["ay"]),
    ("<p>a</p><svg><p>b</p><svg></svg><p>c</p>", ["a", "b", "c"]),
    ("<html><head><title>T</title><link rel=x><p>c", ["c"]),
    ("<head><noscript><style>s</style></noscript></head><body>b", ["b"]),
    ("<head> text", ["text"]),
    ("<noscript>n</noscript><p>e<noscript>f<p>g", ["ef", "g"]),
    ("<object>o<p>f", ["o", "f"]), ("<iframe src=x><p>i", ["i"]), ("<iframe>no</iframe><p>i", ["i"]),
    ("<template><template>q</template>r</template>s", ["s"]), ("<p>a<script>b", ["a"]),
])
def test_hidden_and_missing_ends(page, texts):
    assert [b.text for b in extraction.blocks_of(page)] == texts


def test_only_class_id_and_role_name_an_element():
    page = """<div data-id="comment-5" aria-grid="nav" title="a class=footer" ID=main class='x-y' role="main">t"""
    assert extraction.blocks_of(page)[0].path == (("div", "main", "x", "y", "main"),)


def test_pages_without_semantic_tags_teach_too():
    names = extraction.blocks_of("<div class=menu><a>m</a></div><div class=post-content><p>a</p><div class=share>s</div></div>")
    assert extraction.teaching_labels(names) == [0, 1, 0]
    long = "one two three four five six seven eight nine ten."
    shapes = extraction.blocks_of(f"<div><a>{long}</a></div><div><p>{long}</p><p>short</p></div><div class=footer><p>{long}</p></div>")
    assert extraction.teaching_labels(shapes) == [0, 1, 0, 0]
    assert extraction.teaching_labels([]) == []


def test_network_taught_by_pages_without_semantic_tags(spark, pages):
    plain = pages.selectExpr("page_id", "regexp_replace(html, '<(/?)(article|main)', '<$1section') AS html")
    assert not any(extraction.semantic_label(b) for r in plain.limit(20).collect() for b in extraction.blocks_of(r.html))
    taught = extraction.train(plain, bound=60)
    rows, section = pages.where("page_id % 5 = 0").collect(), re.compile("<(/?)(?:article|main)")
    right = n = 0
    for r in rows:
        blocks = extraction.blocks_of(r.html)
        text = extraction.extract_texts(taught, [section.sub(r"<\1section", r.html)])[0].split("\n")
        wanted = [b.text for b in blocks if extraction.semantic_label(b)]
        right, n = right + len(set(text) & set(wanted)), n + len(set(text) | set(wanted))
    assert right / n > 0.8


def test_layouts_labelled_by_hand(network):
    """Precision and recall over the blocks of other layouts."""
    hit = said = wanted = 0
    for page in PAGES:
        lines = page.split("\n")
        right = {b.text for line in lines if line[0] == "+" for b in extraction.blocks_of(line[1:])}
        found = extraction.extract_texts(network, ["\n".join(line.removeprefix("+") for line in lines)])[0]
        own = set(found.split("\n")) - {""}
        hit, said, wanted = hit + len(right & own), said + len(own), wanted + len(right)
    print(f"precision {hit / said:.3f} recall {hit / wanted:.3f}")
    assert hit / said > 0.9 and hit / wanted > 0.9


def test_edges(spark, pages, network):
    rows = [(1, None, None), (1, None, None), (2, "u", ""), (None, "v", "<article><p>" + "Some words here. " * 20_000), (3, "w", "<" * 50_000)]
    edges = spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, text string")
    found = extraction.extract(edges, network).collect()
    assert [r.text for r in found if r.page_id in (1, 2)] == ["", "", ""]
    assert len(found) == 5 and extraction.extract(edges.where("false"), network).count() == 0


def test_gradients(monkeypatch):
    """The backward pass agrees with small differences."""
    rng = np.random.default_rng(0)
    monkeypatch.setattr(extraction, "HIDDEN", 3)
    pages = [rng.standard_normal((n, extraction.INPUT)).astype(np.float32) for n in (4, 2)]
    x, mask = extraction._padded(pages)
    w = (rng.standard_normal((extraction.INPUT + 1, 12)) / 10).astype(np.float64)
    u = rng.standard_normal((3, 12)) / 3
    d = rng.standard_normal((4, 2, 3))
    for reverse in (False, True):
        _, tape = extraction._run(x, mask, (w, u), reverse, keep=True)
        grads = extraction._learn(x, mask, (w, u), tape, d, reverse)
        for k, (i, j) in ((0, (5, 2)), (0, (-1, 7)), (1, (1, 10)), (1, (2, 4))):
            ends = []
            for step in (1e-2, -1e-2):
                moved = [w.copy(), u.copy()]
                moved[k][i, j] += step
                ends.append(float((extraction._run(x, mask, moved, reverse)[0] * d).sum()))
            assert abs((ends[0] - ends[1]) / 2e-2 - grads[k][i, j]) < 2e-3
