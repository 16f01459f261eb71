"""Main text of pages: the scan, the reader, layouts with known content, whole tables, odd rows."""

from __future__ import annotations

import html
import random
import re
import time
from collections import Counter

import pytest

from fieldloom.llm import main_text
from fieldloom.llm.main_text import best_region, counted, weights
from fieldloom.llm.markup import Page
from fieldloom.llm.queries import op12_main_text

PRIOR = weights({})


def article_text(source):
    """What stands in the first article element of a generated page, by pattern."""
    found = re.search(r"<article>(.*?)</article>", source or "", re.DOTALL)
    if not found:
        return ""
    text = re.sub(r"</?(?:p|h1|br)>", " ", found[1])
    return " ".join(html.unescape(re.sub(r"<[^>]*>", "", text)).split())


@pytest.fixture(scope="module")
def pages(spark, tables_dir):
    return [tuple(r) for r in spark.read.parquet(f"{tables_dir}/pages.parquet").select("page_id", "url", "html").collect()]


def test_region_of_the_greatest_sum():
    rng = random.Random(4)
    for _ in range(300):
        scores = [rng.choice([-3, -1, -0.5, 0, 0.5, 1, 2]) for _ in range(rng.randint(0, 12))]
        start, end = best_region(scores)
        every = [sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]
        assert sum(scores[start:end]) == max([0, *every])
        assert (start, end) == (0, 0) if max([0, *every]) == 0 else end > start


def test_query_on_whole_table(spark, tables_dir, pages):
    got = Counter(map(tuple, op12_main_text(spark, tables_dir).select("page_id", "url", "text", "n_chars").collect()))
    assert got == Counter((key, url, article_text(source), len(article_text(source))) for key, url, source in pages)


@pytest.mark.parametrize("keep_names", [True, False])
def test_held_out_pages_without_their_marks(pages, keep_names):
    """Weights from half of the pages find the content of the others when nothing says article."""
    totals = {}
    for key, _, source in pages:
        if key % 2:
            for name, (a, b) in counted(Page(source)).items():
                n = totals.get(name, (0, 0))
                totals[name] = (n[0] + a, n[1] + b)
    weight = weights(totals)
    right = words = 0
    for key, _, source in pages:
        if key % 2 == 0:
            want = Counter(article_text(source).split())
            bare = re.sub("<(/?)article>", r"<\1section>", source)
            if not keep_names:
                bare = re.sub("<(/?)(?:nav|footer)>", r"<\1div>", bare).replace('class="ad"', 'class="c7"')
            got = Counter(main_text.main_text(bare, weight).split())
            right += 2 * (want & got).total()
            words += want.total() + got.total()
    assert right / words > (0.999 if keep_names else 0.97)


STORY = ["Harbour lights return to the old town", "First words & more: 5 < 6 of them.", "A second paragraph, a little longer than the first one.", "The end."]
BODY = (
    "<h1>Harbour lights return to the old town</h1><p>First <em>words</em> &amp; more: 5 &lt; 6 of them.</p>"
    "<p>A second\n\t paragraph, a <a href='/x'>little</a>&nbsp;longer<br>than the first one.</p><p>The end."
)
AROUND = (
    "<header><a href=/>Town paper</a> News for all</header><div class='cookie-banner'><p>We use cookies to give you the best time on this site."
    " <button>Accept</button></p></div><ul class='main-menu'><li><a href=a>Home</a><li><a href=b>Sport</a><li><a href=c>Weather</a></ul>"
)
AFTER = (
    "<aside><h3>More news</h3><p>Long words about some other story that is far longer than this short one here is, and then some.</p></aside>"
    "<div id=comments><h3>Comments</h3><div class=comment><p>I have never read a better story about lights in any town, says one reader.</p></div>"
    "<form action=/c><label>Your words</label><textarea>Type here</textarea><input type=submit value=Send></form></div>"
    "<div class='sidebar-left'><p>Side words</p></div><div role=contentinfo>Imprint and rights of the paper</div><footer>&copy; Town paper</footer>"
)


@pytest.mark.parametrize(
    "page",
    [
        "{around}<article>{body}</article>{after}",
        "{around}<main><article class=full>{body}</article>{after}</main>",
        "{around}<div role='main'>{body}</div>{after}",
        "{around}<div class='post-content'>{body}</div>{after}",
        "{around}<div><div itemprop=articleBody>{body}</div></div>{after}",
        "{around}<table><tr><td class=nav><a href=1>One</a> <a href=2>Two</a><td>{body}</table>{after}",
        "{around}{body}{after}",
        "{around}<article><header>{body}</header><div class='ad-slot'>Buy words now and save half of all</div></article>{after}",
        "<!-- <article>no</article> -->{around}<ARTICLE CLASS=\"a>b\" data-x='<p>'>{body}<script>var t = '</p><article>never';</script>"
        "<style>p{{x:1}}</style><noscript>Switch scripts on</noscript></ARTICLE>{after}",
    ],
)
@pytest.mark.parametrize("weight", [PRIOR, None])
def test_layouts(page, weight, pages):
    if weight is None:
        totals = {}
        for _, _, source in pages:
            for name, (a, b) in counted(Page(source)).items():
                n = totals.get(name, (0, 0))
                totals[name] = (n[0] + a, n[1] + b)
        weight = weights(totals)
    source = "<!DOCTYPE html><html><head><title>Harbour &mdash; paper</title><script>x</script></head><body>" + page.format(
        around=AROUND, body=BODY, after=AFTER
    )
    assert main_text.main_text(source, weight) == " ".join(STORY)


def test_advert_within_the_article_and_names_that_only_sound_alike():
    source = (
        "<div class='has-sidebar'><article><h2 id='comments'>On comments</h2><p>Loading the adder, said the header.</p>"
        "<section id='navigation-at-sea'><div class='advert'>Buy!</div><div class='shadow-box'>Shadows.</div></section>"
        "<p class='lead'>Last.</p></article></div>"
    )
    assert main_text.main_text(source, PRIOR) == "On comments Loading the adder, said the header. Shadows. Last."
    for apart in ("comments-list", "ad-12", "shareButtons", "side-bar"):
        assert "Shadows." not in main_text.main_text(source.replace("navigation-at-sea", apart), PRIOR)


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("", ""),
        ("   \n ", ""),
        ("plain words only", "plain words only"),
        ("a < b and c <3 d", "a < b and c <3 d"),
        ("&lt;p&gt; stays &amp;amp; &#233;&#x41; &copy &bogus;", "<p> stays &amp; éA © &bogus;"),
        ("<p>one<p>two<b>bold</b>er", "one twobolder"),
        ("<p>one<!-- no --> more<!--> two --><p>x", "one more two --> x"),
        ("<p>text <a href='never closed>more</a> words", "text more words"),
        ("<p>text</p><script>if (a</b) x", "text"),
        ("<p>text <unfinished attr='x'", "text"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "a b c d"),
        ("<nav><p>menu</nav><p>text", "text"),
        ("<nav>a</div></p></b>b</nav>text", "text"),
        ("<p>x</p><svg><title>t</title><g/><text>drawn</text></svg><p>y</p>", "x y"),
        ("<div hidden>no</div><div style='display: none'>no</div><p>yes</p>", "yes"),
        ("<nav>only a menu</nav><footer>and a footer</footer>", ""),
        ("<p>日本語の文章です。</p>", "日本語の文章です。"),
    ],
)
def test_markup(source, text):
    assert main_text.main_text(source, PRIOR) == text


@pytest.mark.parametrize(
    "source",
    [
        "<div>" * 60_000 + "word " + "<p>x" * 20_000,
        "<a x='>' " * 60_000,
        '<a b="' * 60_000 + "<p>x</p>" * 1000,
        "<u><div>" + "<b>" * 60_000 + "</u>" * 60_000 + "x",
        "<" * 400_000,
        "<!--" * 100_000,
        "<script>" * 60_000,
        "<a " + "x" * 500_000 + " " * 500_000 + ">words",
        "<p>" + "word &amp " * 200_000,
        "<table><tr><td>x" * 20_000,
    ],
)
def test_long_and_broken_pages_take_linear_time(source):
    start = time.time()
    main_text.main_text(source, PRIOR)
    assert time.time() - start < 8


def test_odd_rows(spark):
    long = "<article>" + "<p>many words in one page</p>" * 40_000 + "</article>"
    page = f"<nav>menu</nav>{BODY}"
    rows = [(1, "u", page), (1, "u", page), (None, None, None), (3, None, ""), (4, "v", long), (5, "w", "<nav>x</nav>")]
    schema = "page_id long, url string, html string, text string, n_chars int, body string"
    frame = spark.createDataFrame([(*r, "t", 1, "b") for r in rows], schema)
    got = Counter(map(tuple, main_text.extract(frame).collect()))
    story, many = " ".join(STORY), " ".join(["many words in one page"] * 40_000)
    want = [(1, "u", story), (1, "u", story), (None, None, ""), (3, None, ""), (4, "v", many), (5, "w", "")]
    assert got == Counter((*r, len(r[2])) for r in want)
    empty = main_text.extract(spark.createDataFrame([], schema))
    assert empty.columns == ["page_id", "url", "text", "n_chars"] and empty.count() == 0
