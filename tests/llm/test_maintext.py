import re
import time

import pytest

from mercato.llm.maintext import extracted, main_text
from tests.conftest import SF

PARAGRAPH = "This paragraph is long enough to count, it has commas, and it says one thing or another."
CASES = {
    "plain text only": "plain text only",
    "": "",
    None: "",
    "<p>one": "one",
    "<div>a<p>b</div>c": "a\n\nb\n\nc",
    "<script>x<y</script>hello <!-- c -- > --> world": "hello world",
    "a < b &amp; c &gt; d&nbsp; e": "a < b & c > d e",
    "<table><tr><td>x<td>y<tr><td>z</table>": "x\n\ny\n\nz",
    '<p>see <a href="x>y">this</a> text</p>': "see this text",
    "<p>a<br>b<br/>c</p><p> d\n\t e </p>": "a b c\n\nd e",
    "<title>t</title><style>p{}</style><body></body>": "",
}


@pytest.mark.parametrize("page", CASES)
def test_small_pages(page):
    assert main_text(page) == CASES[page]


@pytest.mark.parametrize(
    "around",
    [
        "<nav><ul><li><a href=1>Home</a><li><a href=2>News, sport, more</a></ul></nav>",
        '<div class="sidebar"><p>Elsewhere, on this site, today.</p></div>',
        '<div id="comments"><p>First, second, third: said a reader.</p><p>Well, well, well.</p></div>',
        '<div class="cookie-banner"><p>We use cookies, and more, here.</p></div>',
        '<div class="ad">Buy, now, here.</div>',
        "<footer><p>Copyright, all of it, reserved.</p></footer>",
        "<form><label>Name</label><input><button>Send</button></form>",
        "<aside><p>By the way, this, that.</p></aside>",
        '<div style="display:none"><p>Hidden, not seen, at all.</p></div>',
        "<ul><li><a href=1>More, one</a><li><a href=2>More, two</a><li><a href=3>More, three</a></ul>",
    ],
)
@pytest.mark.parametrize("box", ["article", "div"])
def test_the_article_alone_is_kept(around, box):
    article = f"<{box}><h1>Title</h1><p>{PARAGRAPH}</p><p>Second one, <b>{PARAGRAPH}</b></p><ul><li>point</ul></{box}>"
    expected = f"Title\n\n{PARAGRAPH}\n\nSecond one, {PARAGRAPH}\n\npoint"
    page = "<html><head><title>T</title></head><body>{}<header>Site</header>{}{}</body></html>"
    assert main_text(page.format(around, article, "")) == expected
    assert main_text(page.format("", article, around)) == expected


def test_siblings_like_the_best_container_stay():
    part = f"<div><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></div>"
    assert main_text(f"<body><nav>menu</nav>{part}{part}</body>").count(PARAGRAPH) == 4


LONG = "A long paragraph, with some commas, stands here, one of three, says much, and more, " + "and on " * 30 + "it goes."
SHORT = f"<h2>Second part</h2><p>{PARAGRAPH}</p><ul><li>one point</li></ul><figure>Its picture</figure><h5>Note</h5>"


@pytest.mark.parametrize(
    "page",
    [
        "<article><section>{0}</section><section>{1}</section></article>",
        "<main><div><section>{0}</section></div><div>{1}</div></main>",
        "<div><section>{0}</section>{1}</div>",
        "<div><div><div>{0}</div></div><div><div>{1}</div></div></div>",
        "<div><div><div>{0}</div></div><div><div><a href=1>{0}</a></div>{1}</div></div>",
        "<span><div>{0}</div></span><span><div>{1}</div></span>",
    ],
)
def test_small_parts_of_the_article_stay(page):
    body = "<body><nav>menu</nav>" + page.format(f"<p>{LONG}</p>" * 3, SHORT) + "<div><a href=1>Home</a> | <a href=2>News</a></div></body>"
    small = ["Second part", PARAGRAPH, "one point", "Its picture", "Note"]
    assert main_text(body).split("\n\n") == [LONG] * 3 + small


def test_text_around_the_best_container_stays():
    page = f"<body><div>Before it, <a href=1>see</a> this.<div><p>{LONG}</p><p>{LONG}</p></div>After it.</div><a href=1>Home</a></body>"
    assert main_text(page).split("\n\n") == ["Before it, see this.", LONG, LONG, "After it."]


@pytest.mark.parametrize(
    "page",
    [
        '<div class="content has-sidebar"><article>{}</article></div><div class="sidebar">{}</div>',
        '<div class="no-sidebar with-comments">{}</div><div id="comments">{}</div>',
        '<div class="legal"><article>{}</article></div><aside>{}</aside>',
        '<div class="social-issues">{}</div><div class="site-footer">{}</div>',
        '<div class="side">{}</div><div class="siteFooter">{}</div>',
        '<form id="form1" action="./page.aspx"><div>{}</div><footer>{}</footer></form>',
        "<form><h1>Title</h1><fieldset>{}</fieldset></form><nav>{}</nav>",
        '<form class="search"><main>{}</main><div class="cookie-banner">{}</div></form>',
        '<article>{}</article><div class="comments"><article>{}</article></div>',
        "<main>{}</main><aside><article>{}</article></aside>",
    ],
)
def test_names_and_forms_around_the_article_do_not_lose_it(page):
    other = "Something else, said aside."
    text = main_text(f"<html><body>{page.format(f'<p>{PARAGRAPH}</p>' * 3, f'<p>{other}</p>')}</body></html>")
    assert text.removeprefix("Title\n\n") == "\n\n".join([PARAGRAPH] * 3)


def test_pages_in_one_form_have_text():
    assert main_text("<body><form>plain text</form></body>") == "plain text"
    assert main_text("<body><form><label>Name</label><input><button>Send</button></form></body>") == ""
    assert main_text("<body><nav><a href=1>Home</a></nav></body>") == ""


def test_given_pages_give_their_articles(spark):
    """The given pages mark their article; the scores must find it without the mark."""
    for row in spark.read.parquet(f"{SF}/pages.parquet").collect():
        inner = re.search("<article>(.*?)</article>", row.html, re.S).group(1)
        blocks = [re.sub("<[^>]+>", "", b) for b in re.split("</?(?:p|h1)>", inner.replace("<br>", " "))]
        import html

        blocks = [" ".join(html.unescape(b).split()) for b in blocks]
        assert main_text(row.html) == "\n\n".join(b for b in blocks if b)


BROKEN = {
    "unclosed inline tags": lambda n: "<b>" * n + "</i>" * n,
    "ends beyond a block": lambda n: "<i><div>" + "<b>" * n + "</i>" * n,
    "open end tags": lambda n: "</b" * n,
    "open tags": lambda n: "<a " * n,
    "open quotes": lambda n: '<a "' * n,
    "less-than": lambda n: "<" * n,
    "comments": lambda n: "<!--" * n,
    "deep blocks": lambda n: "<div>" * n + "x",
    "bodies in depth": lambda n: "<div>" * n + "<body>" * n,
    "lists": lambda n: "<ul><li>" * n + "x" + "<li>" * n,
    "paragraphs": lambda n: "<p><b>" * n,
}


@pytest.mark.parametrize("name", BROKEN)
def test_broken_pages_take_linear_time(name):
    """Four times the page takes about four times as long, not sixteen."""

    def seconds(n):
        best = 9.0
        for _ in range(3):
            start = time.process_time()
            main_text(BROKEN[name](n))
            best = min(best, time.process_time() - start)
        return best

    assert seconds(16_000) <= 4 * 1.6 * seconds(4_000) + 0.05


def test_deep_pages_close_what_an_opening_tag_ends():
    """A paragraph ends at the next block however many inline elements are open in it."""
    inline = "<b>" * 60
    page = f"<article><p>{inline}First paragraph, with words.<p>Second one, with words.</article>"
    assert main_text(page) == "First paragraph, with words.\n\nSecond one, with words."


def test_awkward_rows(spark):
    rows = [(None, "u", "<p>a", "t"), (1, None, None, "t"), (2, "v", "", "t"), (2, "v", "", "t"), (3, "w", "<p>" + "ü " * 90_000, "t")]
    found = extracted(spark.createDataFrame(rows, "page_id bigint, url string, html string, text string"))
    got = sorted((tuple(r) for r in found.collect()), key=repr)
    assert got == sorted(((i, u, t, len(t)) for (i, u, h, _) in rows for t in [main_text(h)]), key=repr)
    assert extracted(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0
