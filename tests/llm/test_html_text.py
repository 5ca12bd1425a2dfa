"""Main text of pages: against the SQL of the given tables, and page by page."""

import duckdb
import pytest

from docengine.llm import html_text
from docengine.llm.html_text import main_text
from tests.llm.helpers import clashing

LONG = "This is a paragraph of the article that is long enough to stand out on its page. "


def test_given_pages_equal_their_sql():
    con = duckdb.connect()
    con.execute("CREATE VIEW pages AS SELECT * FROM '/root/testdata/sf0.01/pages.parquet'")
    wanted = {r[0]: r[2:] for r in con.execute(html_text.QUERY_SQL).fetchall()}
    got = {i: main_text(h) for i, h in con.execute("SELECT page_id, html FROM pages").fetchall()}
    assert {i: (t, len(t)) for i, t in got.items()} == wanted


def page(body, head="<title>Not this</title><style>p{}</style><script>var t='</p>';</script>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


BOILERPLATE = [
    "<nav><ul><li><a href='/'>Home</a></li><li>Menu</li></ul></nav>", "<header><p>Site of many sites.</p></header>",
    f"<footer><p>{LONG}</p></footer>", f"<aside><p>{LONG * 3}</p></aside>",
    f"<div class='cookie-notice'><p>{LONG}</p></div>", f"<div id=\"ad_1\">{LONG}</div>",
    f"<form action='/'><label>{LONG}</label><input value='x>y'></form>", f"<!-- {LONG} <p> -->",
    f"<script>document.write('<p>{LONG}</p>');</script>", f"<section class=comments><p>{LONG * 9}</p></section>",
    f"<div role=navigation>{LONG}</div>", f"<div hidden>{LONG}</div>", f"<div style='display: none'>{LONG}</div>",
]


@pytest.mark.parametrize("extra", BOILERPLATE)
@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_boilerplate_goes_before_within_and_after(extra, tag):
    article = f"<h1>The title</h1><p>{LONG}</p>{{}}<p>Short.</p><p><b>{LONG}</b></p>"
    whole = " ".join(f"The title {LONG} Short. {LONG}".split())
    assert main_text(page(f"{extra}<{tag}>{article.format('')}</{tag}>{extra}")) == whole
    assert main_text(page(f"<{tag}>{article.format(extra if '<header' not in extra else '')}</{tag}>")) == whole


def test_unmarked_menus_and_edges_go():
    menu = "".join(f"<div><a href='/{k}'>Entry number {k} of the menu</a></div>" for k in range(12))
    body = f"{menu}<div>Posted by me</div><h2>Heading</h2><div>{LONG}</div><div>{LONG}</div><div>Share this</div>{menu}"
    assert main_text(page(body)) == " ".join(f"Heading {LONG} {LONG}".split())


def test_low_rises_far_from_the_article_are_no_surges():
    gap = "<div></div>" * 5
    body = f"<div>A tagline.</div>{gap}<p>{LONG * 4}</p>{gap}<p>{LONG * 4}</p>{gap}<div>Made by us.</div>"
    assert main_text(page(body)) == " ".join((LONG * 8).split())


def test_unclosed_tags_and_cut_pages():
    assert main_text("<body><article><p><b>One<p>two <i>three<br>four</article><footer>x") == "One two three four"
    assert main_text("<article><p>One</p><p>two &amp; thr&eacute;e &am</p><a hre") == "One two & thrée &am"
    assert main_text("<article>5 < 6 and <3 <p title='a>b' lang=\"it's\">seven") == "5 < 6 and <3 seven"
    assert main_text("<article><!-- never closed <p>x</p>") == ""


def test_white_space_and_inline_tags():
    assert main_text("<article><p> a\n\t b<i>c</i> &nbsp; d </p>\r\n<p>e</p>f</article>") == "a bc d e f"


def test_the_marked_article_with_most_text_is_taken():
    one, two = f"<article><p>{LONG}</p></article>", f"<article><p>{LONG * 2}</p></article>"
    assert main_text(page(one + two + one)) == " ".join((LONG * 2).split())


def test_awkward_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>x</p>"), (3, "u", "no tags at all."), (3, "u", "no tags at all."),
            (4, "u", "<nav>only a menu</nav>"), (5, "u", "<article>" + "<p>word</p>" * 50_000 + "</article>"),
            (6, "u", "<" * 50_000), (7, "u", "<p class='" * 20_000), (8, "u", "<b>" * 20_000 + "deep." + "</i>" * 20_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = [tuple(r) for r in html_text.extracted(clashing(pages, "text", "n_chars", "lines")).collect()]
    assert sorted(got, key=str) == sorted([
        (1, "u", "", 0), (2, None, "", 0), (None, "u", "", 0), (3, "u", "no tags at all.", 15),
        (3, "u", "no tags at all.", 15), (4, "u", "", 0), (5, "u", " ".join(["word"] * 50_000), 249_999),
        (6, "u", "<" * 50_000, 50_000), (7, "u", "", 0), (8, "u", "deep.", 5)], key=str)
    assert html_text.extracted(pages.limit(0)).count() == 0
