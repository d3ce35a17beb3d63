import itertools
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.llm import boosting
from footfall.llm import extraction as e
from footfall.llm.dom import Page, blocks_of
from footfall.llm.layouts import Writer
from footfall.llm.shared import table

PROSE = "The river rose over night, and by the morning the lower fields were under water. Nobody had seen it coming."
MORE = "It took the council three days to open the gates. By then, the water had reached the old mill, the road and the school."
TEMPLATES = {
    "semantic": (
        f"""<html><head><title>t</title></head><body><header><a href="/">The Daily</a></header><nav><ul><li><a href="/a">World</a>
        <li><a href="/b">Sport</a></ul></nav><main><article><h1>Flood &amp; gates</h1><p>{PROSE}</p><aside class="related">
        <a href="/x">Read also</a></aside><p>{MORE}</article></main><section id="comments"><h3>Comments</h3><p>{PROSE}</p></section>
        <footer>&copy; 2020 The Daily</footer></body></html>""",
        ["Flood & gates", PROSE, MORE],
    ),
    "divs": (
        f"""<body><div id="header"><div class="logo">Site</div></div><div class="menu"><a href="/1">Home</a> <a href="/2">About</a></div>
        <div class="cookie-notice">We use cookies to make this site better. <a href="/p">More</a></div>
        <div id="content"><h1>Flood</h1><div class="ad">Buy boots now</div><p>{PROSE}</p><p>{MORE}<br>{PROSE}</p></div>
        <div class="sidebar"><h3>Popular</h3><ul><li><a href="/3">One thing</a></li><li><a href="/4">Another</a></li></ul></div>
        <div class="comments"><div class="comment"><p>{MORE}</p></div></div><div id="footer">Imprint</div></body>""",
        ["Flood", PROSE, f"{MORE} {PROSE}"],
    ),
    "form and script": (
        f"""<body><form action="/s"><label>Search</label><input name=q><button>Go</button></form><script>var t = "<p>{PROSE}</p>";</script>
        <div class="advertisement"><p>Cheap flights</p></div><article class="post"><p>{PROSE} <b>Bold</b> and <a href="/y">a link</a>.</p>
        <ul><li>First point, at some length</li><li>Second point, likewise</li></ul><p>{MORE}</p></article>
        <form class="newsletter"><p>Subscribe to our letter</p><input type=email></form><!-- {MORE} --></body>""",
        [f"{PROSE} Bold and a link.", "First point, at some length", "Second point, likewise", MORE],
    ),
}


@pytest.fixture(scope="module")
def pages(spark):
    return table(spark, "/root/testdata/sf0.01", "pages")


@pytest.fixture(scope="module")
def model(pages):
    return e.train(e.sampled(pages))


@pytest.mark.parametrize("name", TEMPLATES)
def test_hand_labelled_pages(model, name):
    source, want = TEMPLATES[name]
    assert model.texts([source], {})[0].split("\n") == want


def test_given_pages_equal_their_article(model, pages):
    got = {r.page_id: (r.text, r.n_chars) for r in e.main_text(pages, model).collect()}
    rows = pages.select("page_id", "html").collect()
    for r in rows:
        inside = r.html.split("<article>", 1)[1].split("</article>")[0]
        want = "\n".join(blocks_of((block, text) for _, block, text, _ in Page(inside).runs))
        assert got[r.page_id] == (want, len(want))
    assert len(got) == len(rows)


def test_made_up_layouts_held_out(model, pages):
    texts = [r.text for r in e.main_text(pages.limit(40), model).collect()]
    blocks = [b for t in texts for b in t.split("\n") if b]
    right = total = 0
    for i in range(150):
        page = Page(Writer(10**6 + i, blocks, blocks).page())
        held = e._marked(page)
        elements = e.Elements([page], model.weights, {})
        kept = elements.kept(model.forest.log_odds(elements.features()))
        own = np.bincount([r[0] for r in page.runs], [len(r[2]) for r in page.runs], len(page.parent))
        right, total = right + (own * (kept == held)).sum(), total + own.sum()
    assert right / total > 0.93


def test_choice_is_the_best_without_contradiction(model):
    rng = np.random.RandomState(0)
    for _ in range(40):
        source = "".join(rng.choice(["<div>", "</div>", "<div>x", "<section>y", "</section>"], 7))
        elements = e.Elements([Page(source)], {}, {})
        elements.features()
        odds = rng.randn(elements.n).round(1)
        value = np.where(elements.chars > 0, odds, 0)
        best = max(
            sum(v for v, k in zip(value, choice) if k)
            for choice in itertools.product([False, True], repeat=elements.n)
            if all(not k or choice[p] for k, p in zip(choice, elements.parent))
        ) if elements.n <= 14 else None
        kept = elements.kept(odds)
        assert all(not k or kept[p] for k, p in zip(kept, elements.parent))
        assert best is None or abs(value[kept].sum() - best) < 1e-9


def test_trees_equal_a_plain_loop():
    rng = np.random.RandomState(1)
    x = rng.randint(0, 9, (400, 4)).astype(float)
    y = ((x[:, 0] > 4) ^ (x[:, 2] > 6)).astype(float)
    forest = boosting.fit(x, y, np.ones(400), trees=1, depth=2, rate=1.0)
    p = y.mean()
    gradient, curvature = y - p, np.full(400, p * (1 - p))

    def grow(rows, depth):
        if depth == 0 or len(rows) == 0:
            return gradient[rows].sum() / (curvature[rows].sum() + 1)
        score = lambda r: gradient[r].sum() ** 2 / (curvature[r].sum() + 1)
        best = (1e-9, None)
        for f in range(4):
            for bound in np.unique(x[:, f])[:-1]:
                low = rows[x[rows, f] <= bound]
                high = rows[x[rows, f] > bound]
                gain = score(low) + score(high) - score(rows)
                if gain > best[0] + 1e-12:
                    best = (gain, (f, bound))
        if best[1] is None:
            return grow(rows, 0)
        f, bound = best[1]
        return (f, bound, grow(rows[x[rows, f] <= bound], depth - 1), grow(rows[x[rows, f] > bound], depth - 1))

    tree = grow(np.arange(400), 2)

    def value(node, row):
        return node if not isinstance(node, tuple) else value(node[2 if row[node[0]] <= node[1] else 3], row)

    want = np.array([value(tree, row) for row in x]) + np.log(p / (1 - p))
    assert np.allclose(forest.log_odds(x), want)


def test_tree_of_elements():
    page = Page("<ul><li>a<li>b <i>c</ul><p>d<div>e</p>&lt;<br>f</div><td>g<title>no</title><p>x &am")
    assert blocks_of((b, t) for _, b, t, _ in page.runs) == ["a", "b c", "d", "e", "< f", "g", "x &am"]
    for i, parent in enumerate(page.parent[1:], 1):
        assert parent < i < page.end[i] <= page.end[parent]


@pytest.mark.parametrize("piece", ["<div>", "<b>", "<", "</x>", "<a b=\"", "<p '", "<button>", "<!--", "</div", "<li><div>", "<td><table>", "<p a= ", "&", "<svg>x", "<a>x"])
def test_odd_pages_take_linear_time(model, piece):
    start = time.time()
    model.texts([piece * 20_000], {})
    assert time.time() - start < 10


def test_edges(spark, model):
    schema = "page_id long, url string, html string, text int, n_chars string, kept string"
    huge = f"<article><p>{PROSE}</p>" * 3000
    rows = [(1, "u", None), (2, None, ""), (3, "u", "   "), (None, "u", TEMPLATES["semantic"][0]), (4, "u", "<p"), (5, "u", huge)]
    rows += [(6, "u", TEMPLATES["divs"][0])] * 2
    frame = spark.createDataFrame([(*r, 1, "x", "x") for r in rows], schema)
    got = sorted((r.page_id or 0, r.n_chars, r.text) for r in e.main_text(frame, model).collect())
    want = {1: "", 2: "", 3: "", 4: "", 0: "\n".join(TEMPLATES["semantic"][1]), 6: "\n".join(TEMPLATES["divs"][1])}
    assert len(got) == 8 and all(text == want.get(i, text) and n == len(text) for i, n, text in got)
    assert {i: text for i, _, text in got}[5].count(PROSE) == 3000
    assert e.main_text(frame.where("false")).collect() == []
    alone = e.main_text(frame.where("page_id IN (1, 2, 3)"))
    assert [r.text for r in alone.collect()] == [""] * 3
    assert frame.where(F.col("html").isNull()).count() == 1
