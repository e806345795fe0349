import pytest

from shiftwell.llm.html_text import extract_text, main_text

ARTICLE = "A paragraph of some length, so that the sum over its window is a surge of text. " * 2


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<html><head><title>T</title></head><body></body></html>", ""),
        ("<article><h1>A</h1><p>x</p></article>", "A\nx"),
        ("<nav>Menu</nav><article><p>B &amp;lt; &eacute;&nbsp;c\n d</article><footer>F", "B &lt; é c d"),
        ("<article><p>one<b>two</b> th<i>r</i>ee<p>four<br>five</article>", "onetwo three\nfour five"),
        ("<article><p>a<aside>side</aside><p>b<script>if (a<b) x('</p>')</script></article>", "a\nb"),
        ("<article><p>a</p><form><input>name</form><p>b</p></article>", "a\nb"),
        ("<article><p>a</p></article><section class='comments'><p>c</p></section>", "a"),
        ("<article><p>a</p><div id='cookie-notice'>c</div><p>b</p></article>", "a\nb"),
        ("<article><div class='ad-slot'>buy</div><p>a</p><div class='share'>s</div></article>", "a"),
        ("<article><p>a</p><div class='comment-list'><article>c</article></div></article>", "a"),
        ("<body class='has-sidebar'><main><p>m</p></main><div class=sidebar>s</div></body>", "m"),
        ("<article><p>1 < 2 and 3 > 2</p></article>", "1 < 2 and 3 > 2"),
        ("<article><p title='a > b'>q</p><!-- <p>no</p> --><p>z</article>", "q\nz"),
        ("<article><header><h1>T</h1></header><p>x</p></article>", "T\nx"),
        ("<header>Site</header><article><ul><li>a<li>b</ul></article>", "a\nb"),
        ("<p>short page", "short page"),
        ("<article><p>unclosed <b", "unclosed <b"),
        ("<ARTICLE><P>upper</P></ARTICLE>", "upper"),
    ],
)
def test_page(page, text):
    assert main_text(page) == text


def test_without_an_article_the_surge_decides():
    page = f"<div>Home</div><div>x</div><div></div><div></div><div></div><p>{ARTICLE}</p><p>End.</p>"
    page += "<div></div><div></div><div></div><div></div><div>Imprint</div>"
    assert main_text(page) == f"{ARTICLE.strip()}\nEnd."


def test_lines_of_links_weigh_nothing_outside_articles():
    page = f"<p>{ARTICLE}</p><p><a href=x>{ARTICLE}</a></p>"
    assert main_text(page) == ARTICLE.strip()


def test_short_lines_inside_an_article_stay():
    blocks = ["a", "b", ARTICLE.strip(), "c", "d"]
    page = "<article>" + "".join(f"<p>{b}</p><div class=ad>buy</div><hr><hr>" for b in blocks)
    assert main_text(page) == "\n".join(blocks)


def test_long_and_broken_pages_take_linear_time():
    assert main_text("<a href='" * 20_000) is not None
    assert len(main_text("<article>" + "<p>word " * 100_000)) == 5 * 100_000 - 1
    assert main_text("<div>" * 30_000 + "deep") == "deep"


def test_table(spark):
    rows = [(1, "u", "<p>a</p>"), (1, "u", "<p>a</p>"), (None, None, None), (2, "v", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = extract_text(pages)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(
        [(1, "u", "a", 1), (1, "u", "a", 1), (None, None, "", 0), (2, "v", "", 0)], key=repr
    )
    clashing = extract_text(pages.withColumnRenamed("url", "text"))
    assert clashing.columns == ["page_id", "text", "n_chars"]
    assert extract_text(pages.limit(0)).collect() == []


BODY = "Long body text of the page goes on here. " * 5


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<div><div><p>{BODY}</p></div><div><p>Short end.</p></div></div>", f"{BODY.strip()}\nShort end."),
        (f"<h1>Title</h1><div><section><p>{BODY}</p></section></div>", f"Title\n{BODY.strip()}"),
        (f"<article><p>Teaser</p></article><div><p>{BODY}</p></div>", f"Teaser\n{BODY.strip()}"),
        (f"<main><article><p>Teaser</p></article><p>{BODY}</p></main><p>Out</p>", f"Teaser\n{BODY.strip()}"),
    ],
)
def test_nesting_and_teasers_cost_no_text(page, text):
    assert main_text(page) == text


def test_surge_and_dive_decide_inside_an_article():
    gap = "<div></div>" * 3
    page = f"<article><p>Tag</p>{gap}<h1>Title</h1><p>By me</p><p>{BODY}</p><p>End.</p>{gap}<p>Like</p></article>"
    assert main_text(page) == f"Title\nBy me\n{BODY.strip()}\nEnd."


@pytest.mark.parametrize("scope", ["article", "div"])
def test_empty_blocks_do_not_part_a_heading_from_its_text(scope):
    gap = "<div></div>" * 3
    page = f"<{scope}><h1>T</h1>{gap}<p>{BODY}</p></{scope}>"
    assert main_text(page) == f"T\n{BODY.strip()}"
    assert main_text(page.replace("h1>", "p>")) == BODY.strip()
