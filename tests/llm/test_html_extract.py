"""Main text extraction: the parser, the LSTM's gradients, and what it learns."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from farebox.llm import lstm
from farebox.llm.html_blocks import blocks
from farebox.llm.html_extract import _MARK, _draw_page, fit, label, main_text, weak_labels

HTML = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>
<nav class="Top-menu"><ul><li><a href="/a">Home</a><li>About</ul></nav><!-- <p>hidden</p> -->
<article id=main><h1>A &amp; B</h1><p><b>First  line<br>goes&nbsp;on.<p>Second <i>one</i></b> &#8212; done &lt;p&gt;
<table><tr><td>c1<td>c2</table></article><footer>&copy; x</footer>"""


def test_blocks_of_broken_markup():
    got = blocks(HTML)
    assert [b.text for b in got] == ["Home", "About", "A & B", "First line goes on.", "Second one — done <p>", "c1", "c2", "© x"]
    assert [[e.tag for e in b.path] for b in got][:3] == [["html", "body", "nav", "ul", "li"]] * 2 + [["html", "body", "article", "h1"]]
    assert got[0].path[2].names == ("top", "menu") and got[2].path[2].names == ("main",)
    assert got[0].linked == 4 and got[1].linked == 0
    assert weak_labels(got) == [0, 0, 1, 1, 1, 1, 1, 0]


@pytest.mark.parametrize("html", [None, "", "<", "<p", "</p></div>", "a < b & c", "<script>x", "<!-- open", "<p>" * 3000 + "x"])
def test_odd_input(html):
    for block in blocks(html):
        assert block.text == block.text.strip() != ""


def test_text_after_open_or_nested_elements_is_kept():
    texts = lambda html: [b.text for b in blocks(html)]
    assert texts("<p>one</p><select><option>x<p>two</p><article><p>three</p></article>") == ["one", "x", "two", "three"]
    assert texts("<article><p>a <math><mi>x</mi></math> b</p></article>") == ["a x b"]
    assert texts("<object><object>in</object>between</object>after") == ["inbetweenafter"]
    assert texts("<template><p>t</p><template>u</template></template><p>v") == ["t", "u", "v"]
    assert blocks("<select><option>x<p>two</p>")[1].path == blocks("<p>two</p>")[0].path
    assert texts("<script>if (a < b) '<p>no'</script><textarea><p>no</textarea><p>yes") == ["yes"]


@pytest.mark.parametrize("html, found", [
    ("<b>" * 150_000 + "</i>" * 150_000, 0), ("<div>x" * 100_000, 100_000), ("<div><i><div>" + "<b>" * 50_000 + "</i>" * 50_000 + "x", 1),
    ("<ul>" + "<b>" * 20_000 + "<li>x" * 30_000, 30_000), ("<a '" * 20_000, 1), ("<p>" * 100_000 + "y", 1), ("</p>" * 200_000 + "z", 1),
])
def test_hostile_markup_takes_time_and_memory_by_its_length(html, found):
    import time
    import tracemalloc

    start = time.process_time()
    got = blocks(html)
    assert len(got) == found and time.process_time() - start < 10
    assert all(len(b.path) <= 64 for b in got)
    if len(html) < 700_000:
        tracemalloc.start()
        blocks(html)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 150e6


EXPECTED = {
    """<html><body><div class=top><a href=/>Home</a> | <a href=/n>News</a></div><div id=page><div class="zq7"><h1>The   river &amp; the mill</h1>
<p>It rained for a week.<br>The water rose.</p><div class="advertisement"><p>Buy our boots now, they are cheap!</p></div>
<p>Nobody slept.</p></div><div class="comments"><p>Great story, thank you very much for it.</p></div></div>
<div class="footer"><p>Copyright 2020 by us.</p></div></body></html>""":
        "The river & the mill\nIt rained for a week. The water rose.\nNobody slept.",
    """<body><nav><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></nav><main><h2>Salt</h2><p>Salt is a mineral of the sea and of old lakes.
<p>It keeps fish &lt;fresh&gt; for many months.</main><aside><p>Related: pepper, and where it grows today.</p></aside></body>""":
        "Salt\nSalt is a mineral of the sea and of old lakes.\nIt keeps fish <fresh> for many months.",
    """<body><form><label>Search</label><input><button>Go</button></form><article><p>The old bridge was closed in May.</p>
<p>It will be mended &#8211; slowly.</p><div class="share"><a href=x>Share</a></div></article><div class="cookie-notice"><p>We use cookies on this site.</p></div>""":
        "The old bridge was closed in May.\nIt will be mended – slowly.",
}


def test_texts_written_by_hand(spark, pages):
    """Pages and their main text as a reader would copy it, among the given ones."""
    odd = spark.createDataFrame([(-1 - i, "u", html) for i, html in enumerate(EXPECTED)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in main_text(pages.select("page_id", "url", "html").unionByName(odd)).collect() if r.page_id < 0}
    assert [got[-1 - i] for i in range(len(EXPECTED))] == list(EXPECTED.values())


def test_renamed_containers(spark, pages):
    """With the name of the article taken off all pages that are not learnt from, and off all of them."""
    source = pages.orderBy("page_id").collect()
    want = {r.page_id: "\n".join(b.text for b, y in zip(p, weak_labels(p)) if y) for r in source for p in [blocks(r.html)]}
    gone = r"(?i)<(/?)(?:article|main)\b"
    for kept in (80, 0):
        named = F.col("page_id") < kept
        renamed = F.regexp_replace(F.regexp_replace("html", r"(?i)<(article|main)\b", '<div class="xq"'), gone, "</div")
        got = main_text(pages.withColumn("html", F.when(named, F.col("html")).otherwise(renamed))).collect()
        assert sum(r.text == want[r.page_id] for r in got) >= 0.99 * len(got)


def test_pages_learnt_from_are_bounded_in_bytes(spark, monkeypatch):
    from farebox.llm import html_extract

    learnt = []
    monkeypatch.setattr(html_extract, "fit", lambda pages: learnt.append(pages))
    prose = "<p>This is a sentence of the text.</p>"
    rows = [(i, "u", f"<nav>menu {i}</nav><article>{prose * (9000 if i % 5 == 0 else 3)}</article>") for i in range(40)]
    rows += [(100 + i, "u", f"<nav>menu</nav><div>{prose}</div>") for i in range(900)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in main_text(df, sample=30).collect()}
    assert len(learnt[0]) == 30 and all("<article" in p and len(p) < 1000 for p in learnt[0])
    assert got[5] == "\n".join(["This is a sentence of the text."] * 9000) and got[100] == "This is a sentence of the text."


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    weights = {k: v.astype(np.float64) for k, v in lstm.initial(5, 4, 3, 1).items()}
    items, mask = lstm.padded([rng.standard_normal((n, 5)).astype(np.float32) for n in (4, 2, 6)])
    labels = (rng.random(mask.shape) < 0.5).astype(np.float64) * mask

    def loss(w):
        p = lstm.scores(w, items, mask)
        return -np.where(mask, labels * np.log(p) + (1 - labels) * np.log(1 - p), 0).sum() / mask.sum()

    grads = lstm.gradients(weights, items, mask, labels)
    for name, matrix in weights.items():
        for spot in list(np.ndindex(matrix.shape))[:: max(1, matrix.size // 6)]:
            step = 1e-3
            keep = matrix[spot]
            matrix[spot] = keep + step
            up = loss(weights)
            matrix[spot] = keep - step
            down = loss(weights)
            matrix[spot] = keep
            assert grads[name][spot] == pytest.approx((up - down) / (2 * step), rel=0.05, abs=2e-4), name


def test_padding_changes_nothing():
    rng = np.random.default_rng(0)
    weights = lstm.initial(5, 4, 3, 1)
    one, other = (rng.standard_normal((n, 5)).astype(np.float32) for n in (3, 9))
    alone = lstm.scores(weights, *lstm.padded([one]))[:, 0]
    assert np.allclose(lstm.scores(weights, *lstm.padded([one, other]))[:3, 0], alone, atol=1e-6)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet("/root/testdata/sf0.01/pages.parquet")


def test_text_is_the_article(pages):
    got = main_text(pages)
    assert got.columns[:4] == ["page_id", "url", "text", "n_chars"]
    source = {r.page_id: r.html for r in pages.collect()}
    rows = got.collect()
    assert len(rows) == len(source)
    right = 0
    for r in rows:
        page = blocks(source[r.page_id])
        right += r.text == "\n".join(b.text for b, y in zip(page, weak_labels(page)) if y)
        assert r.n_chars == len(r.text)
    assert right >= 0.98 * len(rows)


def test_other_templates(pages):
    html = [r.html for r in pages.orderBy("page_id").limit(240).collect()]
    weights = fit(html[:150])
    rng, wrong, total = random.Random(77), 0, 0
    texts = [b.text for h in html for b in blocks(h)]
    for source in map(blocks, html[150:]):
        content = [b for b, y in zip(source, weak_labels(source)) if y]
        drawn = blocks(_draw_page(content, texts, rng))
        want = np.array([b.text.startswith(_MARK) for b in drawn])
        found = label(weights, [[b._replace(text=b.text.replace(_MARK, "")) for b in drawn]])[0]
        wrong, total = wrong + int((found != want).sum()), total + len(want)
    assert wrong <= 0.02 * total


def test_nulls_clashing_columns_and_no_pages(spark, pages):
    odd = spark.createDataFrame([(1, None, None, 1), (2, "u", "", 2), (2, "u", "", 2), (None, "v", "<p>x</p>", 3)],
                                "page_id long, url string, html string, text int")
    got = main_text(odd.unionByName(pages.limit(20).selectExpr("page_id + 100 AS page_id", "url", "html", "1 AS text"))).collect()
    assert len(got) == 24 and sorted(r.n_chars for r in got if r.page_id in (1, 2)) == [0, 0, 0]
    assert main_text(odd.limit(0)).collect() == []
    assert [r.text for r in main_text(odd.where("page_id IS NULL")).collect()] == ["x"]
