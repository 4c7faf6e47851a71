import itertools
import re

import numpy as np
import pytest

from chatterloom.llm import html_text as H


@pytest.fixture(scope="module")
def weights(pages):
    return H.fit(pages)


def test_messages_equal_enumeration():
    page = H.parse("<div class=content><p>a b c d</p><ul><li>x<li>y</ul></div><p>z")
    trees = H.forest([page])
    rng = np.random.default_rng(0)
    weights = H.Weights(rng.normal(size=H.N_FEATURES), rng.normal(size=(H.N_KINDS, 2, 2)))
    nodes, pairs, log_z = H.sum_product(trees, weights)
    scores = trees.grid @ weights.node
    total, ones = 0.0, np.zeros(len(scores))
    for y in itertools.product((0, 1), repeat=len(scores)):
        y = np.array(y)
        score = scores @ y + sum(weights.edge[trees.kind[i], y[trees.parent[i]], y[i]] for i in range(1, len(y)))
        total += np.exp(score)
        ones += np.exp(score) * y
    assert np.isclose(np.log(total), log_z)
    assert np.allclose(ones / total, nodes[:, 1])
    assert np.allclose(pairs.sum(axis=(1, 2)), 1)


def test_parser_is_tolerant():
    blocks = lambda s: [t for _, t in H.parse(s).blocks]
    assert blocks("<p>a <b>b<br>c\n <p>d &amp; &lt;e&gt;<p>") == ["a b c", "d & <e>"]
    assert blocks("<script>var t='</p>';</script>x<!-- <p>no --><style>p{}</style>y") == ["xy"]
    assert blocks("<ul><li>one<li>two</ul>three") == ["one", "two", "three"]
    assert blocks("a < b and <3, <a href='>'>link</a> <i") == ["a < b and <3, link"]
    assert blocks("<table><tr><td>1<td>2<tr><td>3</table>") == ["1", "2", "3"]
    assert blocks("<title>no</title><div>t<div>u</div>v</div></p></div>w") == ["t", "u", "v", "w"]
    assert blocks("<textarea>no</textarea><p>&nbsp; x &#233;&am") == ["x é&am"]
    assert blocks("") == [] and blocks("<p></p>") == []


def test_held_out_layouts(weights, pages):
    sentences = H.sentences_of(pages, "page_id", "html", 10)
    unseen, labels = H.labelled_pages(sentences, 150, seed=77)
    marginals = H.sum_product(H.forest(unseen), weights)[0][:, 1]
    assert np.mean((marginals >= 0.5) == np.array([y for p in labels for y in p])) > 0.98


def test_given_pages_give_the_article(spark, pages, weights):
    found = {r.page_id: r for r in H.extract(pages, weights).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", r.html, re.S)[1]
        inner = re.sub(r"<[^>]*(?:>|\Z)", lambda m: "\n" if re.match(r"</?(p|h1)", m[0]) else (" " if m[0] == "<br>" else ""), inner)
        lines = [" ".join(H.entities.unescape(line).split()) for line in inner.split("\n")]
        assert found[r.page_id].text == "\n".join(line for line in lines if line)
        assert found[r.page_id].n_chars == len(found[r.page_id].text)


def test_other_layouts(weights):
    prose = "It was a long day, and the harbour lay quiet under the rain while the boats came home."
    source = f"""<body><header class="site-header"><p>The Paper</p></header><div class="cookie-notice"><p>We use cookies. {prose}</p></div>
    <div class="sidebar"><h3>Related</h3><p>{prose}</p></div><div id="content"><h1>News of the day</h1><p>{prose}</p>
    <div class="advert"><p>Buy {prose}</p></div><ul><li>{prose}</li></ul><p>{prose}</p></div>
    <section id="comments"><div class="comment"><p>Reader: {prose}</p></div></section>
    <form class="newsletter"><p>Sign up. {prose}</p></form><footer><p>&copy; all of us</p></footer>"""
    assert H.main_text([H.parse(source)], weights) == [f"News of the day\n{prose}\n{prose}\n{prose}"]


def test_edges(spark, weights):
    rows = [(1, "u", None, "t"), (None, None, "", "t"), (2, "u", "just text", "t"), (2, "u", "just text", "t"), (3, "v", "<div>" * 3000 + "deep", "t"), (4, "w", "<article>" + "<p>Long words, here.</p>" * 20_000, "t")]
    found = H.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string, text string"), weights).collect()
    assert len(found) == 6 and all(r.text is not None and r.n_chars == len(r.text) for r in found)
    assert [r.text for r in found][:2] == ["", ""]
    assert [r.n_chars for r in found if r.page_id == 4] == [20_000 * 18 - 1]
    empty = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert H.extract(empty, H.fit(empty, steps=3)).collect() == []


def test_embedded_text_and_late_digits_count():
    tags = ("math", "svg", "object", "noscript", "audio", "video", "canvas")
    page = H.parse("<p>The sum " + " ".join(f"<{t}>in {t}</{t}>" for t in tags) + " ends.<script>no()</script><p>After <svg/> it")
    assert [text for _, text in page.blocks] == ["The sum " + " ".join(f"in {t}" for t in tags) + " ends.", "After it"]
    early, late, none = (H.features(H.parse(f"<p>{text}")) for text in ("7" * 50 + "x" * 250, "x" * 250 + "7" * 50, "x" * 300))
    assert (early == late).all() and (late != none).any()
