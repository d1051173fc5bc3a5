import html
import re
import time

import pytest

from voltledger.llm import mainhtml

WEIGHTS = {"word article": 4.0, "word menu": -4.0, "word footer": -4.0, "tag li": -4.0}


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("just  text\n here", "just text here"),
        ("<p>a b<p>c<br>d<b>e</b>f &lt;g&gt;&nbsp;h", "a b\n\nc def <g> h"),
        ("<article><h1>T</h1><p>one<div class=ad>buy</div><p>two &amp three</article> x", "T\n\none\n\ntwo & three"),
        ("<nav><a>menu words</a></nav><main><p>the text</p></main><footer>&copy; x</footer>", "the text"),
        ("<script>var a='<p>no</p>'</script><p>yes</p><style>p{}</style><!-- no --><p>so</p>", "yes\n\nso"),
        ("<article><p>read</p><form><input><label>mail</label></form><p>on</p></article>", "read\n\non"),
        ("<article><p>read</p></article><section class='comments'><p>I liked it</p></section>", "read"),
        ("<body class=has-sidebar><div><p>body text</div><div id=cookie-notice>we use</div>", "body text"),
        ("<article><p>open", "open"),
        ("<article><p>end &am", "end &am"),
        ("<article><p>a < b</p></article>", "a < b"),
        ("<article><p class=x title='a>b'>in</p><p a=\"unclosed>out</p>", "in\n\nout"),
        ("<title>no</title><nav>no</nav>", ""),
        ("<article><header><h1>Own</h1></header><p>text</article>", "Own\n\ntext"),
    ],
)
def test_pages(page, text):
    assert mainhtml.extract(page, WEIGHTS) == text


def test_the_run_has_the_greatest_sum():
    import random

    rng = random.Random(0)
    for _ in range(300):
        scores = [rng.randint(-5, 5) for _ in range(rng.randint(0, 12))]
        start, end = mainhtml.best_run(scores)
        best = max([sum(scores[a:b]) for a in range(13) for b in range(a, 13)], default=0)
        assert sum(scores[start:end]) == best


def article_text(page):
    inside = page[page.index("<article>") + 9 : page.index("</article>")]
    blocks = re.split("</?(?:p|h1)>", re.sub("<br>", " ", inside))
    clean = (" ".join(html.unescape(re.sub("<[^>]*>", "", block)).split()) for block in blocks)
    return "\n\n".join(block for block in clean if block)


def test_given_table_against_the_marked_article(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = mainhtml.main_text(pages).select("html", "text", "n_chars").collect()
    assert len(rows) == pages.count()
    for row in rows:
        assert row.text == article_text(row.html) and row.n_chars == len(row.text)


def test_weights_come_from_labelled_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    weights = mainhtml.learn(pages, limit=20)
    assert weights["word article"] > 0 > weights["word menu"] and weights["tag li"] < 0
    assert mainhtml.learn(pages.where("false")) == {}


def test_odd_rows(spark):
    rows = [(1, None, None, 5), (None, "u", "<p>" + "word " * 200_000, 6), (1, None, "<article><p>x", 7)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    found = mainhtml.main_text(pages.unionAll(pages)).collect()
    assert sorted((row.text or "")[:4] for row in found) == ["", "", "word", "word", "x", "x"]
    assert {row.n_chars for row in found} == {0, 1, 999_999}
    assert mainhtml.main_text(pages.where("false")).collect() == []


KEPT = [
    ('<h2 id="related-work">', "</h2>"),
    ('<h2 class="comments">', "</h2>"),
    ('<section id="search-algorithms"><p>', "</section>"),
    ('<div class="long-form"><p>', "</div>"),
    ('<p class="comment-text">', "</p>"),
    ('<table aria-label="Share of votes"><tr><td>', "</table>"),
    ('<div aria-label="advert"><p>', "</div>"),
    ('<div data-id="ad" title="class=ad id=\'ad\'"><p>', "</div>"),
    ('<header class="entry-header"><h1>', "</h1></header>"),
    ('<div class="header"><h1>', "</h1></div>"),
    ('<p><span class="ad">', "</span>"),
]
DROPPED = [
    ('<div class="box ad"><p>', "</div>"),
    ("<section id=comments><article class=comment><p>", "</article></section>"),
    ("<aside><p>", "</aside>"),
    ('<ul class="social">', "</ul>"),
    ("<div role=navigation>", "</div>"),
    ("<nav>", "</nav>"),
    ("<form>", "</form>"),
]


@pytest.mark.parametrize("mark", ["article", "main"])
@pytest.mark.parametrize("opened, closed", KEPT)
def test_hints_drop_no_article_text(mark, opened, closed):
    page = f"<{mark}><p>before it</p>{opened}the middle words{closed}<p>after it</p></{mark}>"
    assert mainhtml.extract(page, WEIGHTS) == "before it\n\nthe middle words\n\nafter it"


@pytest.mark.parametrize("mark", ["article", "main"])
@pytest.mark.parametrize("opened, closed", DROPPED)
def test_whole_hints_drop_containers(mark, opened, closed):
    page = f"<{mark}><p>before it</p>{opened}the middle words{closed}<p>after it</p></{mark}>"
    assert mainhtml.extract(page, WEIGHTS) == "before it\n\nafter it"


@pytest.mark.parametrize(
    "page, text",
    [
        ("<article><p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p></article>", "so x=2 holds"),
        ('<article id="comment-culture"><p>the text</p></article>', "the text"),
        ('<div class="long-form"><h2 id="related-work">T</h2><p class="comment-text">text</p></div>', "T\n\ntext"),
        ('<div><p>the text</p><section id="search-algorithms"><p>more</p></section></div>', "the text\n\nmore"),
        ('<div><p>the text of it</p></div><div class="site-footer"><p>a</p></div>', "the text of it"),
    ],
)
def test_pages_with_misleading_hints(page, text):
    assert mainhtml.extract(page, WEIGHTS) == text


PROSE = "a sentence that is long enough to be read as prose by all"

GONE = [
    '<ol class="commentlist"><li class="comment"><p>{}</p></li></ol>',
    '<div id="disqus_thread"><p>{}</p></div>',
    '<section id="comments-section"><p>{}</p></section>',
    '<div class="comments-area"><article class="comment-body"><p>{}</p></article></div>',
    '<div class="comments-container"><div><p>{}</p></div></div>',
    '<div class="sidebar-box"><p>{}</p></div>',
    '<div class="cookie-notice"><p>{}</p></div>',
    '<div id="cookie_consent_banner"><p>{}</p></div>',
    '<div class="ad-slot"><p>{}</p></div>',
    '<div class="ad-container ad-2"><p>{}</p></div>',
    '<div class="newsletter-signup"><p>{}</p></div>',
    '<div class="social-share"><p>{}</p></div>',
    '<section class="related"><article><p>{}</p></article></section>',
    '<aside><article><h2>more</h2><p>{}</p></article></aside>',
    '<ul class="tabs"><li><a href="x">{}</a></li></ul>',
    '<div class="search"><p>{}</p><input name="q"></div>',
    '<div class="alert"><p><a href="/buy">{}</a></p></div>',
    '<div class="related-posts"><ul><li><a href="x">{}</a></li></ul></div>'.replace("posts", "items"),
]
STAYING = [
    '<div class="alert"><p>{}</p></div>',
    '<ul class="tabs"><li>{}</li></ul>',
    '<div class="search"><p>{}</p></div>',
    '<div class="discussion"><p>{}</p></div>',
    '<div class="comment-culture"><p>{}</p></div>',
    '<div id="related-work"><p>{}</p></div>',
    '<div class="adaptation"><p>{}</p></div>',
    '<div class="content-sidebar-wrap"><p>{}</p></div>',
    '<section id="discussion"><p>{}</p></section>',
    '<div class="shareholders"><p>{}</p></div>',
]


@pytest.mark.parametrize("mark", ["article", "main"])
@pytest.mark.parametrize("region", GONE)
def test_regions_that_are_no_article_text(mark, region):
    page = f"<{mark}><p>before {PROSE}</p>{region.format(PROSE)}<p>after {PROSE}</p></{mark}>"
    assert mainhtml.extract(page, WEIGHTS) == f"before {PROSE}\n\nafter {PROSE}"


@pytest.mark.parametrize("mark", ["article", "main"])
@pytest.mark.parametrize("region", STAYING)
def test_regions_that_only_seem_to_be(mark, region):
    page = f"<{mark}><p>before {PROSE}</p>{region.format(PROSE)}<p>after {PROSE}</p></{mark}>"
    assert mainhtml.extract(page, WEIGHTS) == f"before {PROSE}\n\n{PROSE}\n\nafter {PROSE}"


MANY = " ".join(f"<p>{PROSE} {k}</p>" for k in range(5))
MANY_TEXT = "\n\n".join(f"{PROSE} {k}" for k in range(5))


@pytest.mark.parametrize(
    "page, text",
    [
        (f'<div id="related-work">{MANY}</div><div class="footer">end</div>', MANY_TEXT),
        (f'<div class="header"><h1>The title</h1></div><div>{MANY}</div>', "The title\n\n" + MANY_TEXT),
        (f'<div class="content-sidebar-wrap"><article>{MANY}</article><div class="sidebar"><p>{PROSE}</p></div></div>', MANY_TEXT),
        (f'<div class="sidebar-layout"><article>{MANY}</article></div>', MANY_TEXT),
        (f'<div>{MANY}</div><div id="comments">' + 9 * f"<p>{PROSE}</p>" + "</div>", MANY_TEXT),
        (f"<article>{MANY}</article><div class=comments>" + 9 * f"<article><p>{PROSE}</p></article>" + "</div>", MANY_TEXT),
        (f'<article><p>x</p><div class="ad">{PROSE}</div></article>', "x"),
        (f"<nav><article><p>{PROSE}</p></article></nav><main>{MANY}</main>", MANY_TEXT),
    ],
)
def test_layouts(page, text):
    assert mainhtml.extract(page, WEIGHTS) == text


@pytest.mark.parametrize("opened", ["<div>", "<div class=ad>", "<section class='related-x'>", "<p><b><i>"])
def test_deep_nesting_is_read_in_linear_time(opened):
    name = re.match(r"<(\w+)", opened)[1]
    page = opened * 16_000 + "deep" + f"</{name}>" * 16_000 + f"<article>{MANY}</article>"
    start = time.monotonic()
    assert mainhtml.extract(page, WEIGHTS) == MANY_TEXT
    assert time.monotonic() - start < 4
