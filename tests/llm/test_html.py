import re
from html import unescape

import numpy as np

from costseries.llm import html

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>
<header class="site"><a href="/">Home</a></header><nav><ul><li><a href="/a">One</a><li><a href="/b">Two</a></ul></nav>
<div class="cookie-notice">We use cookies to serve you.</div>
<article><h1>A&nbsp;title &amp; more</h1><p>First <b>bold</b>er
 text&#33;<br>Second line<p>Third &lt;p&gt; caf&eacute;<!-- hidden --></article>
<aside class="sidebar"><p>Other stories of today</p></aside>
<section class="comments"><div class="comment"><p>I think this is great.</p></div></section>
<form><label>Your mail</label><input type=text><button>Send</button></form><footer>&copy; somebody</footer>"""


def test_leaves_decode_join_and_split():
    got = [t for _, t, _ in html.leaves(PAGE)]
    assert got[:2] == ["Home", "One"]
    assert got[4:8] == ["A title & more", "First bolder text!", "Second line", "Third <p> café"]
    assert not any("hidden" in t or "no" == t or "p{}" in t for t in got)
    paths = {t: p for p, t, _ in html.leaves(PAGE)}
    assert ".comment" in paths["I think this is great."] and "nav" in paths["Two"]


def test_leaves_of_broken_markup():
    assert html.leaves(None) == html.leaves("") == html.leaves("<!-- open <p>x") == []
    assert [t for _, t, _ in html.leaves("a<p>b</div>c<script>x")] == ["a", "b", "c"]
    assert [t for _, t, _ in html.leaves("<p>x &am")] == ["x &am"]
    assert [t for _, t, _ in html.leaves("1 < 2 <p title='>'>y")] == ["1 < 2", "y"]


def test_gradient_is_right():
    rng = np.random.default_rng(1)
    w = {k: v.astype(np.float64) for k, v in html.initial(rng).items()}
    x, mask = html.padded([rng.normal(size=(5, html.DIM)), rng.normal(size=(3, html.DIM))])
    x, y = x.astype(np.float64), (rng.random(mask.shape) > 0.5).astype(float)
    _, grad = html.gradient(w, x, y, mask)
    for name, at in (("xf", (3, 5)), ("hf", (2, 7)), ("hb", (1, 40)), ("bb", (20,)), ("o", (4, 0)), ("c", (0,))):
        moved = {k: v.copy() for k, v in w.items()}
        moved[name][at] += 1e-3
        up = html.gradient(moved, x, y, mask)[0]
        moved[name][at] -= 2e-3
        down = html.gradient(moved, x, y, mask)[0]
        assert abs((up - down) / 2e-3 - grad[name][at]) < 2e-3


def expected(page):
    """Main text of the sample pages, which keep it in one article element."""
    body = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
    parts = re.sub(r"</?b>", "", re.sub(r"<(p|h1|br|/p|/h1)>", "\0", body)).split("\0")
    return " ".join(x for x in (" ".join(unescape(p).split()) for p in parts) if x)


def test_all_sample_pages(table):
    pages = table("pages")
    got = {r.page_id: r for r in html.extract(pages).collect()}
    wrong = [r.page_id for r in pages.collect() if got[r.page_id].text != expected(r.html)]
    assert wrong == []
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_other_frames_than_the_samples(spark, table):
    """The labeller reads frames that the sample pages don't have, from its lessons."""
    more = spark.createDataFrame([(-1, "u", PAGE)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html.extract(table("pages").select("page_id", "url", "html").unionAll(more)).collect()}
    assert got[-1] == "A title & more First bolder text! Second line Third <p> café"


def test_odd_rows(spark):
    rows = [(None, None, None), (1, "u", ""), (1, "u", ""), (2, None, "<p>"), (3, "u", "<article><p>Hello there, friend.</p></article>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = html.extract(pages).collect()
    assert len(got) == 5 and all(r.text == "" and r.n_chars == 0 for r in got if r.page_id != 3)
    assert html.extract(pages.where("false")).count() == 0
    assert html.extract(pages.where("html is null")).collect()[0].text == ""


def test_quotes_outside_quoted_values():
    page = "<p data-x=it's class=a>two</p><p>it's fine</p><p title=don't>Hello</p><p a=\"x>y\" b='>'>there</p><p c = 'd'e>end</p><p 'odd'>last</p>"
    assert [t for _, t, _ in html.leaves(page)] == ["two", "it's fine", "Hello", "there", "end", "last"]
    assert [t for _, t, _ in html.leaves("<scripted>a</scripted><script x='>'>no</script>b<p x=\"open>c")] == ["a", "b", "c"]


FRAMES = [
    "<body class='page has-sidebar'><nav><a href=/>Home</a></nav><article>{}</article><footer>Imprint</footer></body>",
    "<div class='content-sidebar-wrap'><nav><a href=/>Home</a></nav><main class='content'><article>{}</article></main></div>",
    "<header><a href=/>Home</a></header><article class='post comments-open'>{}</article><div class=comments><p>Nice one, thanks</p></div>",
    "<nav><a href=/>Home</a></nav><main class='content related-width'>{}</main><aside>Other stories of today</aside>",
    "<body class='with-footer no-banner'><nav><a href=/>Home</a></nav><main id=main-menu-target>{}</main><footer>Imprint</footer>",
]


def test_layout_names_around_the_article_do_not_hide_it(spark, table):
    """Class names of several parts on body, wrappers and the article itself; headings in the article's own header."""
    body = "<header><h1>A fine title</h1></header><p>The first sentence of the story is here.</p><p>And this is the second one, a bit longer than the first.</p>"
    rows = [(-k, "u", frame.format(body)) for k, frame in enumerate(FRAMES, 1)]
    more = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html.extract(table("pages").select("page_id", "url", "html").unionAll(more)).collect()}
    want = "A fine title The first sentence of the story is here. And this is the second one, a bit longer than the first."
    assert {k: got[k] for k in got if k < 0} == {-k: want for k in range(1, len(FRAMES) + 1)}


def test_comment_articles_stay_comments():
    page = "<main><p>Story</p><ol class='comment-list'><li class=comment><article class='comment-body'><p>Mine</p></article></ol></main><section class=comments><article class='comment-body'><p>Yours</p></article></section>"
    paths = {t: p for p, t, _ in html.leaves(page)}
    assert ".comment" in paths["Mine"] and ".comments" in paths["Yours"] and ".comment" not in paths["Story"]
