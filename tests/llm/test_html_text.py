import itertools
import time
from collections import Counter

import numpy as np
import pytest

from playstream.llm import html_text as H
from playstream.llm.queries import QUERIES

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model():
    return H.learn()


def text(model, source):
    return H.main_texts(model, [source], H.KeyScores(model))[0]


def test_messages_against_all_assignments():
    rng = np.random.RandomState(1)
    parent, depth = np.array([-1, 0, 0, 1, 1, 3, -1]), np.array([0, 1, 1, 2, 2, 3, 0])
    scores, moves = rng.randn(7, 2), rng.randn(2, 2)
    weight = {s: np.exp(sum(scores[i, k] for i, k in enumerate(s)) + sum(moves[s[p], s[i]] for i, p in enumerate(parent) if p >= 0))
              for s in itertools.product((0, 1), repeat=7)}
    z = sum(weight.values())
    want, pairs = np.zeros((7, 2)), np.zeros((2, 2))
    for s, w in weight.items():
        for i, k in enumerate(s):
            want[i, k] += w / z
            if parent[i] >= 0:
                pairs[s[parent[i]], k] += w / z
    got, got_pairs = H.messages(scores, moves, parent, depth)
    assert np.allclose(got, want) and np.allclose(got_pairs, pairs)


def test_held_out_pages(model):
    right = wrong = missed = 0
    for source, blocks in H.made_pages(800)[600:]:
        got, want = Counter(text(model, source).split("\n")), Counter(blocks)
        right, wrong, missed = right + sum((got & want).values()), wrong + sum((got - want).values()), missed + sum((want - got).values())
    assert right / (right + wrong) > 0.95 and right / (right + missed) > 0.95


def test_blocks_and_references(model):
    page = """<!doctype html><HTML><head><title>T</title><style>p{}</style><script>var x="</p>"; if (a<b) c();</script></head><body>
    <nav><ul><li><a href="/a">Home</a><li><a href='/b>'>News</a></ul></nav><div class="ad">Buy now, buy all of it.</div><article><h1>A  title
    here</h1><p><b>First&nbsp;line &amp; more &#233; text,<br>goes on for a while.<p>Second <a href=x>part</a> &lt;b&gt; of it is here, too.</p>
    <!-- gone --><p></p></article><div id="comments"><p>I do not agree with this at all.</p></div><footer>&copy; 2020 Some site</footer>"""
    assert text(model, page) == "A title here\nFirst line & more é text, goes on for a while.\nSecond part <b> of it is here, too."


def test_query_on_articles(spark):
    import html
    import re
    rows = {r.page_id: r for r in QUERIES["op9_html_tree_model"](spark, SF001).collect()}
    pages = spark.read.parquet(f"{SF001}/pages.parquet").collect()
    assert len(rows) == len(pages)
    for p in pages:
        inner = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        want = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert rows[p.page_id].text == "\n".join(x for x in want if x) and rows[p.page_id].url == p.url
        assert rows[p.page_id].n_chars == len(rows[p.page_id].text)


def test_edge_cases(spark, model):
    deep = "<div>" * 3000 + "<p>Deep text that is long enough to be read. It goes on.</p>"
    rows = [(1, None, 1), (2, "", 1), (3, "no markup at all", 1), (4, "<p", 1), (5, "< > <> </ <!", 1), (6, deep, 1), (7, "<article><p>" + "Words of it. " * 100_000, 1),
            (8, "<script>never closed <p>x</p>", 1), (8, "<script>never closed <p>x</p>", 1), (9, '<a href="' + "x\"'" * 2000, 1), (None, "<article><p>Some text.</p></article>", 1)]
    df = spark.createDataFrame(rows, "page_id long, html string, text int")
    got = {r.page_id: r.text for r in H.extract(df, model).collect()}
    assert got[1] == got[2] == "" and got[8] == "" and len(got[7]) == len("Words of it. " * 100_000) - 1
    assert got[None] == "Some text."
    assert H.extract(df.limit(0), model).count() == 0


def test_deep_pages_take_time_in_proportion(model):
    prose = "<p>Deep text that is long enough to be read. It goes on."
    for opened in ("<div>", "<div><p>", "<ul><li>", "<table><tr><td>", "<b><section>"):
        times = []
        for n in (10_000, 100_000 // opened.count("<")):
            began = time.perf_counter()
            page = H.parse(opened * n + prose)
            times.append((time.perf_counter() - began) / n)
            assert len(page.keys) > n and page.runs[-1][1].startswith("Deep text")
        assert times[1] < 5 * times[0]
    began = time.perf_counter()
    assert isinstance(text(model, "<div>" * 100_000 + prose), str)
    assert time.perf_counter() - began < 60


def test_pages_are_read_together_up_to_a_size(model):
    pages = [s for s, _ in H.made_pages(40)] + [""]
    want = [text(model, s) for s in pages]
    parts = list(H.together(pages, 5000))
    assert len(parts) > 8 and sum(parts, []) == pages
    assert [t for p in parts for t in H.main_texts(model, p, H.KeyScores(model))] == want
