import html as entities
import re

import pytest

from tillroll.llm import html_text
from tillroll.llm.html_text import main_text

PAGE = """<html><head><title>T</title></head><body class="home"><header class="site"><h1>Site name</h1><nav><a href=x>One</a></nav></header>
<div class="cookie-notice"><p>We use cookies, please accept, or not, as you like, to go on with this page.</p></div>
<div id="wrap"><div class="sidebar"><ul><li><a>Link a</a></li><li><a>Link b</a></li></ul></div>
<div class="content-with-sidebar"><h2>Head &amp; line</h2><p>First, long paragraph, with some commas, that is the article&nbsp;text.<p>Second<br>one &lt;tag&gt; here, with words.
<ul><li>item one</li><li>item <b>t</b>wo</li></ul><div class="ad"><p>Buy now, cheap, good, nice, and more and more and more!</p></div><blockquote>Quoted words of someone</blockquote></div></div>
<section id="comments"><p>Reader one, says, a, lot, of, things, with, commas, to score, high, you know.</p></section>
<form><p>Subscribe here</p></form><footer><p>copyright</p></footer><script>if (a<b) {"</p>"}</script></body>"""


def test_a_page_without_article_element():
    want = ["Head & line", "First, long paragraph, with some commas, that is the article text.", "Second one <tag> here, with words."]
    assert main_text(PAGE).split("\n\n") == [*want, "item one", "item two", "Quoted words of someone"]


@pytest.mark.parametrize(
    "page,text",
    [
        (None, ""), ("", ""), ("plain words", "plain words"), ("<p>a", "a"), ("<script>unclosed <p>x", ""), ("<!-- x", ""), ("<!-- <p>a</p> --><p>b", "b"),
        ("<div class='ad'>only an ad</div>", "only an ad"), ("<article></article><p>x y</p>", "x y"), ("<nav><p>menu</p></nav>", ""),
        ("<div hidden>q</div><main><p>m</p></main>", "m"), ("<p>1 &lt 2 &copy 3 &#233; &#x41;</p>", "1 < 2 © 3 é A"), ("a < b", "a < b"),
        ("<article><p>a\t\n b<i>c</i>d</p>tail</article>", "a bcd\n\ntail"), ("<p title='a > b'>q</p>", "q"), ("<P>up</P><STYLE>p{}</STYLE>", "up"),
        ("<article><p>one</p><div class=comments><p>Reader, words, here, many</p></div><aside>x</aside></article>", "one"),
    ],
)
def test_small_pages(page, text):
    assert main_text(page) == text


def test_short_article_beats_long_notice():
    notice = "<div><p>" + "We, the owners, of this, site, say, many, things. " * 20 + "</p></div>"
    assert main_text(f"<body>{notice}<article><h1>Head</h1><p>Short.</p></article></body>") == "Head\n\nShort."


def test_points_go_up_and_links_discount():
    links = "<div>" + "".join(f"<p><a href=x>A linked teaser, with commas, number {i}, and more text</a></p>" for i in range(9)) + "</div>"
    text = "<div>" + "".join(f"<p>A plain sentence, with a comma, number {i}, and more text.</p>" for i in range(4)) + "</div>"
    assert main_text(f"<body>{links}{text}</body>").count("plain") == 4
    assert "teaser" not in main_text(f"<body>{links}{text}</body>")


def test_pages_equal_brute_force(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in html_text.extracted(pages).collect()}
    assert len(got) == pages.count()
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = (" ".join(entities.unescape(re.sub(r"</?b>", "", p.replace("<br>", " "))).split()) for p in re.split(r"</?(?:p|h1)>", inner))
        want = "\n\n".join(p for p in parts if p)
        assert (got[r.page_id].text, got[r.page_id].n_chars, got[r.page_id].url) == (want, len(want), r.url)


def test_awkward_rows(spark):
    rows = [(1, None, None, "z"), (None, "u", "<p>a", "z"), (2, "u", "<p>" * 20_000 + "<div>" * 3000 + "<p>deep<p>er", "z"), (2, "u", "<p>b", "z"), (2, "u", "<p>b", "z")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_text.extracted(df).collect()
    assert len(got) == 5 and html_text.extracted(df.limit(0)).count() == 0
    assert {(r.page_id, r.text) for r in got} == {(1, ""), (None, "a"), (2, "deep\n\ner"), (2, "b")}


BODY = [f"Sentence number {i} of the story, told at length, with commas, and a good many words." for i in range(6)]
STORY = "".join(f"<p>{p}</p>" for p in BODY)
TEASER = "<article class=card><h3><a href=x>Another story</a></h3><p>What it is about, in short.</p></article>"


@pytest.mark.parametrize("teasers", [1, 2, 8])
@pytest.mark.parametrize("around", ["<body>{}</body>", "<body><div>{}</div></body>", "<main>{}</main>"])
def test_body_in_a_div_beside_teaser_articles(around, teasers):
    for page in ("<div><h1>Head</h1>" + STORY + "</div><div>" + TEASER * teasers + "</div>", "<div>" + STORY + "</div>" + TEASER * teasers):
        assert main_text(around.format(page)).removeprefix("Head\n\n").split("\n\n") == BODY


@pytest.mark.parametrize("around", ["<body>{}</body>", "<body><div>{}</div></body>", "<main>{}</main>"])
def test_story_split_over_articles(around):
    parts = "".join(f"<article><p>{a}</p><p>{b}</p></article>" for a, b in zip(BODY[::2], BODY[1::2]))
    assert main_text(around.format(parts)).split("\n\n") == BODY
    assert main_text(around.format(parts + TEASER)).split("\n\n") == BODY
    assert main_text(around.format(parts + "<article><p>The end.</p></article>")).split("\n\n") == [*BODY, "The end."]


def test_headings_beside_the_article():
    page = f"<body><h1>Head</h1><article>{STORY}</article><h2>More</h2>{TEASER}{TEASER}</body>"
    assert main_text(page).split("\n\n") == ["Head", *BODY]
    assert main_text(f"<main><h1>Head</h1><div>{STORY}</div>{TEASER}</main>").split("\n\n") == ["Head", *BODY]
    assert main_text(f"<article><h1>Head</h1><div>{STORY}</div><p>End.</p></article>").split("\n\n") == ["Head", *BODY, "End."]


def test_body_after_an_introducing_article():
    assert main_text(f"<article><h1>Head</h1><p>Intro.</p></article><div>{STORY}</div>").split("\n\n") == ["Head", "Intro.", *BODY]


STRAY = "<div class='title'>A site of ours</div>"


@pytest.mark.parametrize("names", ["class='post category-legal'", "class='tag-search'", "class='post related'", "id='share'"])
def test_names_of_articles_and_large_parts(names):
    assert main_text(f"{STRAY}<article {names}>{STORY}</article>").split("\n\n") == BODY
    assert main_text(f"{STRAY}<section><div {names}><div>{STORY}</div></div></section>").split("\n\n")[-len(BODY) :] == BODY
    assert main_text(f"<article><h1>Head</h1><div {names}>{STORY}</div></article>").split("\n\n") == ["Head", *BODY]


def test_names_that_still_leave_out():
    comments = "<article class='comment'><p>" + "Reader says, at length, many things, with commas. " * 12 + "</p></article>"
    assert main_text(f"<article>{STORY}</article>{comments}").split("\n\n") == BODY
    assert main_text(f"<article>{STORY}{comments}</article>").split("\n\n") == BODY
    assert main_text(f"<article>{STORY}<div class='ad'><p>Buy now, cheap, good.</p></div></article>").split("\n\n") == BODY
    sidebar = "<div class='sidebar'>" + "<p>A word, or two, from us, the makers, on what we do here.</p>" * 6 + "</div>"
    assert main_text(f"<div>{sidebar}<div>{STORY}</div></div>").split("\n\n") == BODY
    assert main_text(f"<div><div>{STORY}</div></div>{sidebar}").split("\n\n") == BODY


def test_lists_of_links_within_the_article():
    sources = ["The first report of the committee, in full", "A second source, with the numbers of the year", "Third"]
    listed = "<ul>" + "".join(f"<li><a href=x>{s}</a></li>" for s in sources) + "</ul>"
    menu = "<ul><li><a href=x>Home</a></li><li><a href=x>News</a></li><li><a href=x>Sports</a></li></ul>"
    short = "<ol><li><a href=x>One</a></li><li><a href=x>Two</a></li></ol>"
    for tag in ("article", "main", "div"):
        assert main_text(f"<{tag}>{STORY}{listed}</{tag}>").split("\n\n") == [*BODY, *sources]
        assert main_text(f"<{tag}>{STORY}<p>Sources:</p>{short}</{tag}>").split("\n\n") == [*BODY, "Sources:", "One", "Two"]
        assert main_text(f"<{tag}>{STORY}<h2>Sources</h2>{short}</{tag}>").split("\n\n") == [*BODY, "Sources", "One", "Two"]
        assert main_text(f"<{tag}>{menu}{STORY}</{tag}>").split("\n\n") == BODY
        assert main_text(f"<{tag}><ul><li><a href=x>One</a> is, now</li><li><a href=x>The long second</a></li></ul>{STORY}</{tag}>").split("\n\n")[-6:] == BODY
    assert main_text(f"<body>{menu}<article>{STORY}</article>{listed}</body>").split("\n\n") == BODY
    assert main_text(f"<body>{STORY}{listed}</body>").split("\n\n") == BODY
    assert main_text(f"<body><div>{listed}</div>{STORY}<div>{listed}</div></body>").split("\n\n") == BODY


PROSE = "<p>" + "This is a long sentence about the subject, with commas, and enough words to count as prose in an article. " * 2 + "</p>"


@pytest.mark.parametrize("tag", ["section class='share-prices'", "section id='legal'", "div class='social-history'", "div class='related-work'"])
@pytest.mark.parametrize("others", [1, 6])
def test_parts_named_after_their_subject_stay(tag, others):
    part = f"<{tag}><p>Unique paragraph text which is long enough to be counted as prose by any rule, and it ends here.</p></{tag.split()[0]}>"
    page = f"<html><body><nav><a href=x>home</a></nav><article><h1>T</h1>{PROSE * others}{part}{PROSE}</article></body></html>"
    assert "Unique paragraph" in html_text.main_text(page)
    links = f"<{tag}><ul><li><a href=a>Another story to read</a></li><li><a href=b>One more story to read</a></li></ul></{tag.split()[0]}>"
    assert "story to read" not in html_text.main_text(page.replace(part, links))


def test_formulas_are_text():
    page = "<article><p>Energy is <math><mi>E</mi><mo>=</mo><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup><annotation>E=mc^2</annotation></math> here, as everybody knows.</p></article>"
    assert html_text.main_text(page) == "Energy is E=mc2 here, as everybody knows."


def test_title_in_a_small_card_does_not_win():
    page = f"<body><div>{PROSE * 8}</div><article><h1>Author card</h1><p>one short sentence</p></article></body>"
    assert html_text.main_text(page).startswith("This is a long sentence")


@pytest.mark.parametrize("piece", ["<div>a ", "<div><b>a</b> ", "<article><p>word, ", "<td>a ", "<div class='ad'>x", "</b><div><b>"])
def test_deep_pages_take_linear_time(piece):
    import time

    start = time.process_time()
    html_text.main_text(piece * 10_000)
    small = time.process_time() - start
    start = time.process_time()
    html_text.main_text(piece * 100_000)
    assert time.process_time() - start < max(5, 25 * small)
