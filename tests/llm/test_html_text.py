import html
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marketlens.llm import html_text as H

LONG = "lorem ipsum dolor sit amet consetetur " * 8
MORE = "sadipscing elitr sed diam nonumy " * 8


def test_articles_of_the_test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in H.extract(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        article = re.sub(r"</?(p|h1|br|b)>", lambda m: "" if m[1] == "b" else " ", article)
        want = " ".join(html.unescape(article).split())
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want) and got[r.page_id].url == r.url


def test_pages_without_a_marked_article():
    page = f"""<html><head><title>T</title><style>p{{}}</style></head><body class="has-sidebar"><div id="header"><a href=/>Site</a> tagline</div>
    <ul class="menu"><li><a>One</a></li><li><a>Two</a></li></ul><div class="cookie-notice"><p>{MORE}</p></div>
    <div class="content-with-sidebar"><div class=post><h2>Head</h2><p>{LONG}</p><div class="ad-box"><p>{MORE} buy!</p></div><p>short</p><p>{MORE}</p></div>
    <div class="sidebar"><p>{LONG}</p></div><div id="comments"><p>nice {LONG}</p></div><form><p>{LONG}</p></form></div>
    <div class=footer>(c)</div></body>"""
    assert H.main_text(page) == f"Head {LONG.strip()} short {MORE.strip()}"


def test_marked_articles_keep_short_blocks_and_lose_what_is_beside():
    page = f"""<nav>n</nav><header>h</header><main><article><header><h1>T&eacute;st</h1></header><p>a</p><aside>no</aside>
    <p>b<br>c <b>d</b>e &#x41;&amp;&lt;x&gt;</p><footer>f</footer><div class="share">s</div><script>if (a<b) "</p>"</script>
    <ul><li>one<li>two</ul></article></main><section class="comments"><article class="comment"><p>{LONG}</p></article></section>"""
    assert H.main_text(page) == "Tést a b c de A&<x> one two"


@pytest.mark.parametrize(
    "page,want",
    [(None, ""), ("", ""), ("   ", ""), ("just text", "just text"), ("<p>a<p>b", "a b"), ("a < b", "a < b"), ("<!-- x", ""), ("<script>x", ""),
     ("<p hidden>x</p><p>y</p>", "y"), ("<article>" + "word " * 20000 + "</article>", ("word " * 20000).strip())],
)
def test_odd_pages(page, want):
    assert H.main_text(page) == want


MENU = "<ul class=menu><li><a>One</a></li><li><a>Two</a></li><li>Three</li></ul>"
FOOT = "<div class=footer><p>(c)</p><p>Imprint</p><p>Contact</p></div>"


@pytest.mark.parametrize(
    "body,want",
    [(f"<h1>{'h' * 30}</h1><p>{'a' * 30}</p><p>{'b' * 200}</p>", f"{'h' * 30} {'a' * 30} {'b' * 200}"),
     (f"<div><div><h1>Title</h1></div></div><div><div><p>{LONG}</p></div></div><div><p>short end</p></div>", f"Title {LONG.strip()} short end"),
     (f"<p>{LONG}</p><table><tbody><tr><td>a</td><td>1</td></tr><tr><td>b</td><td>2</td></tr></tbody></table>", f"{LONG.strip()} a 1 b 2"),
     (f"<table><tbody><tr><td>a</td><td>1</td></tr></tbody></table><div><p>{LONG}</p></div>", f"a 1 {LONG.strip()}"),
     (f"<div><h1><a href=/x>Linked title</a></h1></div><div><p>{LONG}</p></div><p><a>all of it linked</a></p><p>end</p>", f"Linked title {LONG.strip()} all of it linked end"),
     (f"<p>{LONG}</p><ul><li><a>x</a></li><li><a>y</a></li><li><a>z</a></li></ul>", LONG.strip())],
)
def test_edges_of_pages_without_a_marked_article(body, want):
    assert H.main_text(f"{MENU}{body}{FOOT}") == want
    assert H.main_text(f"{MENU}\n<section>\n{body}\n</section>\n{FOOT}") == want


@pytest.mark.parametrize("tag", ["<svg-icon name=a></svg-icon>", "<video-js></video-js>", "<audio-player>", "<object-x/>", "<title-bar></title-bar>", "<svg/>", "<svg d='a>b' />", '<math a="b"/>'])
@pytest.mark.parametrize("outer", ["article", "div"])
def test_custom_elements_and_closed_drawings_hide_no_text(tag, outer):
    page = f"{tag}<{outer}><p>Before {tag} {LONG}</p>{tag}<svg><text>no</text></svg ><p>{MORE}</p></{outer}>"
    assert H.main_text(page) == f"Before {LONG.strip()} {MORE.strip()}"


STATES = "header-fixed site|nav-open|sticky-header|comment-free|notification-bar-off wrapper|layout-sidebar|page-with-cookie-banner|widget-area-none".split("|")


@pytest.mark.parametrize("outer", [f'div class="{c}"' for c in STATES] + ['form id="aspnetForm"', 'div class="modal"', 'div role="dialog"', 'div style="display: none"'])
def test_an_element_that_holds_the_text_is_kept(outer):
    page = f"{MENU}<{outer}><h1>Title</h1><p>{LONG}</p><p>{MORE}</p></{outer.split()[0]}>{FOOT}"
    assert H.main_text(page) == f"Title {LONG.strip()} {MORE.strip()}"


def test_classes_that_only_hold_a_word_of_boilerplate_stay_in_articles():
    kept = [f'<{e}>{k}</{e.split()[0]}>' for k, e in enumerate(['div class="notice-period"', 'section id="share-prices"', 'p class="tags-explained"', "p data-x='class=ad'"])]
    gone = ['<div class="share-buttons">s</div>', "<p class=ad>a</p>", '<p class="comment_list">c</p>', '<div id="related-box">r</div>']
    assert H.main_text(f"<article>{''.join(kept + gone)}<p>{LONG}</p></article>") == f"0 1 2 3 {LONG.strip()}"


def test_variants_of_the_test_pages_without_their_mark(spark):
    """The article in a plain element with a class of state, in place of `<article>`."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").orderBy("page_id").limit(60).collect()
    for k, r in enumerate(pages):
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        text = re.sub(r"</?(p|h1|br|b)>", lambda m: "" if m[1] == "b" else " ", article)
        want = " ".join(html.unescape(text).split())
        page = r.html.replace("<article>", f'<div class="{STATES[k % len(STATES)]}">').replace("</article>", "</div>")
        assert H.main_text(page) == want, page


@pytest.mark.parametrize(
    "page,want",
    [("<p>He said <a href='it's here'>link</a> and more text.</p><p>Don't lose this.</p><p>End.</p>", "He said link and more text. Don't lose this. End."),
     ('<p>It"s <b title=5" wide>five inches</b> wide.</p><p>And "so" on.</p>', 'It"s five inches wide. And "so" on.'),
     ('<p title="a > b">x</p><p class = "y">z</p>', "x z")],
)
def test_quotes_open_values_only_behind_an_equals_sign(page, want):
    assert H.main_text(page) == want


@pytest.mark.parametrize("raw", ["video", "object", "svg", "audio controls", "noscript", "iframe", "script", "title"])
def test_raw_elements_that_are_never_closed_end_at_the_next_block(raw):
    page = f"<div><p>Before</p><{raw}>hidden<p>{LONG}</p><p>After</p></div>"
    assert H.main_text(page) == f"Before {LONG.strip()} After"
    assert H.main_text(f"<article>{page}</article>") == f"Before {LONG.strip()} After"


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([0, 0, 1, 5, 30, 90, 400]), min_size=1, max_size=25).filter(any), st.integers(1, 5), st.integers(1, 200))
def test_windows_surge_and_dive_by_brute_force(weights, window, surge):
    sums = {first: sum(weights[max(0, first) : first + window]) for first in range(1 - window, len(weights))}
    least = min(surge, (max(sums.values()) + 1) // 2)
    high = [first for first, total in sums.items() if total >= least]
    begin, last = max(0, high[0]), high[-1]
    while last + 1 in sums and sums[last + 1] > 0:  # the dive
        last += 1
    while begin > 0 and weights[begin - 1] > 0:
        begin -= 1
    got = H.edges(H.np.array(weights), window, least)
    assert got == (begin, min(last + window - 1, len(weights) - 1))
    page = "".join("<p>" + "x" * w + "</p>" if w else "<nav>gap</nav>" for w in weights)
    want = [w for k, w in enumerate(weights) if begin <= k <= got[1] and w]
    assert [len(w) for w in H.main_text(page, window, surge).split()] == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div class='ad'>", "</div>", "<", ">", "\"", "'", "<a href=\"x", "text ", "&amp;", "<!--", "-->", "</", "<article>", "</article>", "<script>"]), max_size=40))
def test_any_markup_is_read(parts):
    assert isinstance(H.main_text("".join(parts)), str)


def test_tables_with_nulls_repeats_and_no_rows(spark):
    pages = spark.createDataFrame([(1, "u", None, 1), (1, "u", None, 2), (None, None, "<p>x</p>", 3)], "page_id long, url string, html string, text int")
    assert sorted(map(repr, map(tuple, H.extract(pages).collect()))) == sorted(map(repr, [(1, "u", "", 0), (1, "u", "", 0), (None, None, "x", 1)]))
    assert H.extract(pages.limit(0)).collect() == []
