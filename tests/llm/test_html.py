"""Main text of pages: rules on small pages, consensus over a host, awkward rows."""

import html
import re
import time
import tracemalloc

import pytest
from pyspark.sql import functions as F

from palimpsest.llm.html_consensus import extract, extract_pages, vote

from .conftest import SF

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><aside>side</aside><div class="cookie-notice">notice</div>
<div class="ad-banner">buy</div><div id="content"><h1>Title &amp; more</h1><p>One <b>two</b>
three&nbsp;four<p>five <a href='a>b'>six</a><ul><li>x<li>y</ul><form>send</form><div class="share-buttons">share</div>
<table><tr><td>c1<td>c2</table></div><section id="comments"><p>first!</p></section><footer>&copy; me</footer></body></html>"""


def test_rules():
    assert extract(PAGE, [])[0] == "Title & more\nOne two three four\nfive six\nx\ny\nc1\nc2"


@pytest.mark.parametrize(
    "page,text",
    [
        (None, ""), ("", ""), ("plain  text", "plain text"), ("<p>a<p>b", "a\nb"), ("<div><p>a</div><!-- x <p>y</p>", "a"),
        ("<article><header><h1>T</h1></header><p>b</article>", "T\nb"), ("<body><p>&lt;p&gt; &#233;", "<p> é"),
        ("<article>a<script>x</script><noscript>y</noscript>b<br>c</article>", "ab c"), ("<main>q<div class='comment'>r</div>s</main>", "q\ns"),
        ("<article>1 < 2 and <b>3</article>", "1 < 2 and 3"), ("<div role=navigation>n</div><div>t</div>", "t"), ("<a href=\"x", "<a href=\"x"),
        ("<div class='content with-sidebar'><div class='post-header'><h1>T</h1></div><p>b<div class='comment-body'>c</div></div>", "T\nb"),
        ("<div class='main-nav'>n</div><div id='sidebarLeft'>s</div><div class='entry'>e</div><div id=cookieBanner>c</div>", "e"),
    ],
)
def test_small_pages(page, text):
    assert extract(page, [])[0] == text


def test_votes_carry_a_weak_page(spark):
    """A page whose article is short follows the host's other pages."""
    body = "<div class='teaser-{0}'><p>{1}</p></div><div class='story-{0}'><p>{2}</p></div>"
    pages = [(i, "http://h.example/" + str(i), body.format(i, "short", "long text " * 40)) for i in range(8)]
    pages.append((8, "http://H.example/8", body.format(8, "a much longer teaser " * 9, "tiny")))
    pages.append((9, "http://other.example/9", "<div class='x'>own</div>"))
    got = {r.page_id: r.text for r in extract_pages(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()}
    assert got[8] == "tiny" and got[9] == "own" and got[0].startswith("long text")


@pytest.mark.parametrize("size", [64 << 20, 0])
def test_awkward_pages(spark, size):
    data = [(1, None, "<p>a"), (1, None, "<p>a"), (None, "no url", None), (2, "http://h/x", ""), (3, "http://h/y", "<p>" + "w " * 50_000)]
    df = spark.createDataFrame(data, "page_id bigint, url string, html string")
    for name in ("host", "text", "paths", "k", "h", "salt"):
        df = df.withColumn(name, F.lit("clash"))
    got = sorted(repr((r.page_id, r.url, r.text[:5], r.n_chars)) for r in extract_pages(df, broadcast_bytes=size).collect())
    expected = [(1, None, "a", 1), (1, None, "a", 1), (None, "no url", "", 0), (2, "http://h/x", "", 0), (3, "http://h/y", "w w w", 99_999)]
    assert got == sorted(map(repr, expected))
    assert extract_pages(df.limit(0)).count() == 0


def test_whole_table_against_its_articles(spark):
    """These pages keep their text in one article element, which a pattern can cut out."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r for r in extract_pages(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1|ul|li|div)\b[^>]*>", inner))
        text = "\n".join(filter(None, parts))
        assert (got[r.page_id].text, got[r.page_id].n_chars, got[r.page_id].url) == (text, len(text), r.url)


def test_vote_of_empty_pages():
    assert vote(None) is None and vote("<nav>x</nav>") is None


@pytest.mark.parametrize(
    "page,text",
    [
        ("<body><main><h1>T</h1><div class='content'><p>{a}</div></main>", "T\n{a}"),
        ("<body><main><h1>T</h1><div><div class='content'><p>{a}</div></div></main><div class='ad'>x</div>", "T\n{a}"),
        ("<div class='post'><h1>T</h1><div class='post-lead'>lead</div><div class='post-body'>{a}</div></div>", "T\nlead\n{a}"),
        ("<div class='wrap'><section class='intro'>{a}</section><section class='details'>{b}</section></div>", "{a}\n{b}"),
        ("<body><section class='intro'>{a}</section><section class='details'>{b}</section>", "{a}\n{b}"),
        ("<section class='intro'>{a}</section><section class='details'>{b}</section>", "{a}\n{b}"),
        ("<body><div class='teaser'>short</div><div class='story'>{a}</div><div class='list'><a href='/'>{b}</a></div>", "{a}"),
    ],
)
def test_parts_and_titles_stay_with_the_article(page, text):
    a, b = " ".join(["word"] * 80), " ".join(["more"] * 60)
    page, text = page.format(a=a, b=b), text.format(a=a, b=b)
    assert extract(page, [])[0] == text
    assert extract(page, [vote(page)[0]])[0] == text


def test_a_large_host_is_treated_as_a_small_one(spark):
    """Pages of another kind on the same host, twenty or 1,200, change nothing for these three."""
    story = "<body><div class='strange'><p>{0}</p></div><div class='list'><p>{1}</p></div></body>"
    other = "<body><div class='item{0}'><p>{1}</p></div></body>"
    kept = []
    for n in (20, 1_200):
        rows = [(i, "http://h.example/a", story.format(f"tale {i} " * 30, f"links {i}")) for i in range(2)]
        rows.append((2, "http://h.example/b", story.format("real", "links to other things that are longer " * 9)))
        rows += [(100 + i, "http://h.example/c", other.format(i, f"thing {i} " * 20)) for i in range(n)]
        got = extract_pages(spark.createDataFrame(rows, "page_id bigint, url string, html string")).where("page_id < 3")
        kept.append({r.page_id: r.text for r in got.collect()})
    assert kept[0] == kept[1] and kept[0][2] == "real"


def test_text_that_stays_the_same_beside_different_articles_goes(spark):
    page = "<body><div class='wrap'><h1>Title {0}</h1><div class='zq9'>{1}</div><div class='lede'>{2}</div><div class='b7'>{3}</div></div></body>"
    rows = [(i, "http://h.example/", page.format(i, f"Buy {'this' if i % 2 else 'that'} now", f"Lede {i}.", f"word{i} " * 40)) for i in range(12)]
    # The same article on many pages is no evidence against itself.
    rows += [(100 + i, "http://copies.example/", page.format(7, "Buy this now", "Lede 7.", "word7 " * 40)) for i in range(9)]
    got = {r.page_id: r.text for r in extract_pages(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    for i in range(12):
        assert got[i] == f"Title {i}\nLede {i}.\n" + " ".join([f"word{i}"] * 40)
    assert {got[100 + i] for i in range(9)} == {"Title 7\nBuy this now\nLede 7.\n" + " ".join(["word7"] * 40)}


def test_more_layouts():
    assert extract("<body><article class='related-post'>" + "x " * 300 + "</article><main><p>the story</main>", [])[0] == "the story"
    assert extract("<article><section class='header-note'>kept</section><p>b</article>", [])[0] == "kept\nb"
    assert extract("<article><div class='header-nav'>gone</div><p>b</article>", [])[0] == "b"
    assert extract("<article><p title=\"a\" b\">x</p>y</article>", [])[0] == "x\ny"


HOSTILE = {
    "never closed": "<div>" * 200_000, "tags without end": "<a " * 300_000, "quotes without end": '<a b="' * 160_000, "signs in quotes": '<a b=">" ' * 110_000,
    "items": "<li><ul>" + "<div>" * 90_000 + "<li></li>" * 40_000, "closed only": "<div>" * 100_000 + "</span></p>" * 40_000, "names": "".join(f"<div class='c{'x' * 60}q{chr(97 + i % 26)}'>t" for i in range(11_000)),
}


@pytest.mark.parametrize("name", HOSTILE)
def test_time_and_memory_follow_length(name):
    """A megabyte of each; a parser that looks back or ahead from each tag takes minutes or gigabytes."""
    tracemalloc.start()
    began = time.process_time()
    vote(HOSTILE[name])
    extract(HOSTILE[name], [])
    used, peak = time.process_time() - began, tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert used < 40 and peak < 200e6  # tracing takes most of the time


def test_paths_are_of_bounded_length():
    assert len(vote("<div class='a'>" * 3_000 + "text")[0]) < 600
