import html
import re

import numpy as np
import pytest
from odd import pages

from loomcart.llm import html_text as H

SF = "/root/testdata/sf0.01"


def plain(article):
    """Text of an article that holds h1, p, b and br only."""
    spaced = re.sub(r"<(?:/?(?:p|h1|br))>", " ", article).replace("<b>", "").replace("</b>", "")
    return " ".join(html.unescape(spaced).split())


@pytest.fixture(scope="module")
def weights(spark):
    return H.learn(spark.read.parquet(f"{SF}/pages.parquet"))


def test_articles_of_the_test_pages(spark):
    table = spark.read.parquet(f"{SF}/pages.parquet")
    want = {r.page_id: plain(re.search("<article>(.*)</article>", r.html, re.S)[1]) for r in table.collect()}
    out = H.extract(table).collect()
    assert {r.page_id: r.text for r in out} == want
    assert all(r.n_chars == len(r.text) for r in out)


STORY = "<h1>A title here</h1><p>First words of the story, and <b>bold</b> ones.</p>\n<p>Second &amp; last\n part&nbsp;now.</p>"
TEXT = "A title here First words of the story, and bold ones. Second & last part now."


@pytest.mark.parametrize("page", [
    f"<body><header><h2>Site name and slogan</h2></header><main>{STORY}</main><footer>All rights reserved by us</footer>",
    f"<nav><a href=1>Home page</a><a href=2>About us</a></nav><div class='post-body'>{STORY}</div>"
    "<div class='comments'><p>Great article, thank you so much for it!</p><p>I agree with all of that</p></div>",
    f"<article>{STORY}<aside>Read also these many other fine stories</aside></article>",
    f"<div id=cookie-notice>We use cookies on this site to make it better</div><article>{STORY}</article>",
    f"<article><h1>A title here</h1><div class='ad banner'>Buy this thing now</div>{STORY.split('</h1>')[1]}</article>",
    f"<article>{STORY}<form><label>Your name please</label><input name=x><button>Send it</button></form></article>",
    f"<script>var a = '<p>not text at all</p>';</script><style>p {{ color: red }}</style><article>{STORY}</article>",
    f"<!-- <article>commented out words</article> --><article>{STORY}<!-- note --></article>",
    f"<ul class=menu><li>One entry<li>Two entries<li>Three more</ul><section>{STORY}</section><ul class=menu><li>x</ul>",
    f"<ARTICLE CLASS=x>{STORY.replace('<p>', '<P >').replace('</p>', '</P>')}</ARTICLE>",
    f"<article>{STORY}",
    f"<div role='navigation'>Go to some other place</div><div>{STORY}</div>",
])
def test_layouts(weights, page):
    assert H.main_text(page, weights) == TEXT


@pytest.mark.parametrize("page,text", [
    ("", ""), ("<p>", ""), ("<nav>only a menu here</nav>", ""), ("just words", "just words"),
    ("a < b and c > d", "a < b and c > d"), ("<p>x<br>y</p><p>z", "x y z"), ("<p>un<i>broken</i></p>", "unbroken"),
    ("<p>&lt;p&gt; &#65;&#x42; &eacute;&unknown;</p>", "<p> AB é&unknown;"), ("<p title='a>b'>word</p>", "word"),
    ("<p title='open>word</p>", "word"), ("words <!-- never closed", "words"), ("<p>word</p></article></div></p>", "word"),
    ("<p>...</p><p>Word.</p><p>!</p>", "... Word. !"),
])
def test_small_pages(weights, page, text):
    assert H.main_text(page, weights) == text


@pytest.mark.parametrize("page", [
    f"<html class=has-menu><body class='no-sidebar'><nav>Home page</nav><div>{STORY}</div><div class=ad>Buy this now</div></body></html>",
    f"<div id='page' class='has-header'><div class='header'>Site name</div>{STORY}</div>",
    f"<article class='post comments-open'>{STORY}</article><div class='comments'><p>Great article</p></div>",
    f"<main id='skip-target' role='search'>{STORY}</main>",
    f"<div class='search-result related'>{STORY}</div><div class='related'>Three more words</div>",
    f"<body class='menu-open'><div id='page' class='has-sidebar'><article class='post'><div class='entry share-on'>{STORY}</div>"
    "<div class='share'>Tell your friends</div></article><ol class='comments'><li><article class='comment'>I agree with this"
    "</article><li><article class='comment'>I do not</article></ol></div>",
    f"<div class='header'>Name of the site</div><div class='widget'>{STORY}</div><div class='comments'><p>One two three four "
    "five six seven</p></div><div class='promo'>One two three four five six seven</div>",
    f"<article>{STORY}</article><div class='comments'><p>{'So very many words. ' * 20}</p></div>",
    f"<div class='menu'>{'<a href=1>Go to this page</a>' * 20}</div><div>{STORY}</div>",
    f"<div class='has-header'><article class='x'>{STORY}</article></div><div class='comments'><p>{'Many words. ' * 20}</p></div>",
])
def test_names_alone_do_not_cut_what_holds_the_page(weights, page):
    assert H.main_text(page, weights) == TEXT


def test_articles_in_parts_that_names_call_furniture(weights):
    parts = [f"Part {i} has these words." for i in range(5)]
    page = "".join(f"<div class='widget'><p>{p}</p></div>" for p in parts)
    assert H.main_text(page, {**weights, H.NAMED: -1.0}) == " ".join(parts)


def test_pages_in_named_wrappers_are_learnt_from(spark, weights):
    table = [(r.page_id, r.url, r.html.replace("<body>", "<body class='no-sidebar'><div class='has-header'>").replace("<article>", "<article class='share'>"))
             for r in spark.read.parquet(f"{SF}/pages.parquet").limit(60).collect()]
    want = {i: plain(re.search("<article class='share'>(.*)</article>", h, re.S)[1]) for i, _, h in table}
    assert {r.page_id: r.text for r in H.extract(pages(spark, table)).collect()} == want
    assert H.LEAST_COST >= weights[H.NAMED] >= -H.MOST


@pytest.mark.parametrize("attributes", [
    'style="overflow: hidden"', 'style="overflow-x: hidden"', 'title="a hidden gem"', "title='the class=ad of it'", 'data-hidden="1"',
    'hiddenness=1', 'title=hidden', 'aria-hidden="false"', 'data-id="menu"', 'title = "id=menu"', 'alt="x" class=""',
])
def test_words_in_values_are_no_attributes(weights, attributes):
    assert H.main_text(f"<div {attributes}><article {attributes}>{STORY}</article></div>", weights) == TEXT


def test_a_value_without_its_end_quote(weights):
    assert H.main_text(f"<article><p title=\"so hidden>{STORY}</article>", weights) == TEXT


@pytest.mark.parametrize("attributes", [
    "hidden", "HIDDEN", 'hidden=""', 'title="x"hidden', 'aria-hidden="true"', "aria-hidden = true", "title=x hidden/", "aria-hidden='TRUE'",
])
def test_hidden_elements_are_left_out(weights, attributes):
    assert H.main_text(f"<article>{STORY}<div {attributes}>Not to be seen here</div></article>", weights) == TEXT


def test_best_region_is_the_greatest_sum():
    made = np.random.default_rng(3)
    for _ in range(300):
        scores = made.integers(-4, 4, made.integers(0, 12)).astype(float)
        start, end = H.best_region(scores)
        sums = [scores[i:j].sum() for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]
        assert scores[start:end].sum() == max([0.0, *sums])


def test_odd_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<article>some words</article>"), (3, "u", "<b>" * 50_000 + "deep words"),
            (3, "u", "<article>" + "long words. " * 100_000 + "</article>"), (4, "u", "<a href='" * 20_000)]
    out = sorted(((r.page_id or 0, r.url, r.n_chars) for r in H.extract(pages(spark, rows)).collect()), key=repr)
    assert [n for _, _, n in out] == [10, 0, 0, 10, 1_199_999, out[5][2]]
    assert H.extract(pages(spark, [])).collect() == []


LINKS = "".join(f"<li><a href={i}>item number {i}</a></li>" for i in range(10))
ITEMS = " ".join(f"item number {i}" for i in range(10))


@pytest.mark.parametrize("page,text", [
    (f"<article><p>First words.</p><ul>{LINKS}</ul><p>Twenty more words of the rest follow here.</p></article>",
     f"First words. {ITEMS} Twenty more words of the rest follow here."),
    ("<article><p>See <a href=1>this fine link</a> and more words of the text.</p></article>",
     "See this fine link and more words of the text."),
    ("<article><p>Some words here. More at <a href=1>the project page</a></p></article>",
     "Some words here. More at the project page"),
    ("<article><p><a href=1>A link</a> begins it, <a href=2>one</a> is in the middle and it ends by <a href=3>one more</a></p></article>",
     "A link begins it, one is in the middle and it ends by one more"),
    (f"<body><form id=aspnetForm><nav>Home page</nav><div>{STORY}</div><input name=x><button>Send</button></form></body>", TEXT),
    (f"<body><form><article>{STORY}</article><div class=sidebar>Other things to read</div></form></body>", TEXT),
    (f"<article>{STORY}<section class='related-work'><h2>Others</h2><p>They did it, too.</p></section></article>",
     f"{TEXT} Others They did it, too."),
    (f"<article>{STORY}<div class='notice-period'><p>A month it is.</p></div></article>", f"{TEXT} A month it is."),
    (f"<article>{STORY}<div class='related-posts'><p>Read this</p></div><div class='ad-google'>Buy it</div>"
     "<div class='share-buttons'>Tell them</div><div id='comment-12'>I agree</div></article>", TEXT),
    (f"<article>{STORY}{'<br><hr>' * 400}<p>The end</p></article><p>{'Words around it. ' * 30}</p>", f"{TEXT} The end"),
    (f"<article></article><div>{STORY}</div>", TEXT),
    (f"<div>{STORY}<p>See <a href=1>that page</a></p></div>", f"{TEXT} See that page"),
    (f"<div><a href=1>Home page</a> <a href=2>About us</a> <a href=3>Our shop</a></div><div>{STORY}</div>", TEXT),
])
def test_nothing_of_an_article_is_lost(weights, page, text):
    assert H.main_text(page, weights) == text


def test_marked_articles_are_kept_whole(weights):
    """Every word that stands in a marked article outside furniture is in the text, in order."""
    made = np.random.default_rng(8)
    for _ in range(150):
        want, body = [], []
        for i in range(made.integers(1, 12)):
            said = f"w{i} x{i}"
            kind = made.integers(0, 7)
            body.append([f"<p>{said}</p>", f"<ul><li><a href=1>{said}</a></li></ul>", f"<p>{said} <a href=1>l{i}</a></p>",
                         f"<aside>{said}</aside>", f"<div class='comments'>{said}</div>", f"<div><div>{said}</div></div>",
                         f"<form>{said}</form>"][kind])
            want += {2: [said, f"l{i}"], 3: [], 6: [], 4: []}.get(int(kind), [said])
        if len(want) < 3:
            continue
        page = f"<p>Before it {made.integers(9)}</p><article><h1>Head</h1><p>Long words lead it all on</p>{''.join(body)}</article><p>After it</p>"
        assert H.main_text(page, weights) == " ".join(["Head Long words lead it all on", *want])
