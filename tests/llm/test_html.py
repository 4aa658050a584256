import re
from html import unescape

import pytest

from strata.llm.html import blocks, decide, extract, grow, labelled_table, main_text


@pytest.fixture(scope="module")
def tree():
    return grow(*labelled_table())


def test_tree_fits_its_table(tree):
    x, y = labelled_table()
    assert all(decide(tree, row) == label for row, label in zip(x, y, strict=True))


def test_article_of_every_page(spark, sf):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = extract(spark.read.parquet(f"{sf}/pages.parquet")).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search("<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        assert r.text == " ".join(unescape(re.sub("<[^>]*>", " ", article)).split()) and r.n_chars == len(r.text)


def test_left_out(tree):
    body = " ".join(["word"] * 30)
    page = (f"<!doctype html><head><title>T</title><style>p{{}}</style></head><body><header><h2>Site</h2></header><nav><a href=/>Home</a></nav>"
            f"<div class='cookie-banner'>{body}</div><main><h1>Head &amp; line</h1><script>var a='<p>x</p>';</script><p>{body}<!-- hidden --></p>"
            f"<p>A&nbsp;b\n  <b>c</b>d &lt;e&gt;</p><form><label>{body}</label><input value='q'></form><aside>{body}</aside>"
            f"<div id=comments><p>{body}</p></div></main><div class=sidebar>{body}</div><footer>{body}</footer>")
    assert main_text(page, tree) == f"Head & line {body} A b cd <e>"


def test_names_of_page_furniture(tree):
    body = " ".join(["word"] * 30)
    for attribute in ("class=cookieBar", "id='user-comments'", "class='ad'", "class=\"site_footer x\"", "role=navigation", "class=newsletterSignup", "class=sidebar-left"):
        assert main_text(f"<article><p>{body}</p></article><div {attribute}><p>{body}</p><ul><li>{body}</li></ul></div>", tree) == body, attribute
    # a frame that is named after its layout does not hide the article, comments do
    assert main_text(f"<div class='layout with-sidebar'><div class=sidebar>{body}</div><article><p>{body}</p></article></div>", tree) == body
    assert main_text(f"<main><p>{body}</p></main><section id=comments><article><p>{body}</p></article></section>", tree) == body


def test_broken_markup(tree):
    assert main_text("<p>One<p>two <b>three", tree) in ("One two three", "")
    assert [b[0] for b in blocks("a<div>b</span></div>c<!-- d")] == ["a", "b", "c"]
    assert [b[0] for b in blocks("<p>1 < 2 & 3</p><p title=\"a>b\">x")] == ["1 < 2 & 3", "x"]
    assert blocks("<script>while(1)") == [] and blocks("") == []


def test_edge_rows(spark):
    pages = spark.createDataFrame([(1, None, None, "a"), (None, "u", "", "b"), (3, "u", "<nav><a href=x>only menu</a></nav>", "c"),
                                   (2**60 + 1, "u", "<article><p>" + "long " * 300_000 + "</p></article>", "d")], "page_id long, url string, html string, text string")
    rows = {r.page_id: r for r in extract(pages).collect()}
    assert [rows[k].n_chars for k in (1, None, 3)] == [0, 0, 0] and rows[1].text == ""
    assert rows[2**60 + 1].n_chars == 5 * 300_000 - 1
    assert extract(pages.limit(0)).count() == 0


def test_hidden_is_an_attribute_or_a_style(tree):
    body = " ".join(["word"] * 30)
    for shown in ("style=\"overflow:hidden\"", "class='overflow-hidden'", "title=\"The hidden valley\"", "data-x=hidden", "aria-hidden=false",
                  "data-style='display:none'", "title='a style=\"display:none\" b'", "style='--x-display:none'", "data-hidden"):
        assert main_text(f"<body {shown}><article><p>{body}</p></article></body>", tree) == body, shown
    assert main_text(f"<article><p>{body} <a href=\"/hidden-gems\">of gems</a> {body}</p></article>", tree) == f"{body} of gems {body}"
    for left_out in ("hidden", "class=x HIDDEN id=y", "hidden=''", "hidden=hidden", "aria-hidden=true", "aria-hidden=\"TRUE\"",
                     "style='display:none'", "style=\"color:red; Display : none !important\"", "style=visibility:hidden"):
        assert main_text(f"<article><p>{body}</p><div {left_out}><p>{body}</p></div></article>", tree) == body, left_out


def test_names_do_not_take_an_article_away(tree):
    body = " ".join(["word"] * 30)
    around = f"<nav><a href=/>Home</a></nav>%s<footer>{body}</footer>"
    for attribute in ("class='post ad-free'", "class=\"post comments-open\"", "class='post no-sidebar'", "class=tag-subscription", "id=navigation-systems",
                      "class=paywall-free", "class='hentry has-sidebar'"):
        page = around % f"<article {attribute}><h1>Head</h1><p>{body}</p></article>"
        assert main_text(page, tree) == f"Head {body}", attribute
    assert main_text(around % f"<div class='content no-sidebar'><p>{body}</p></div>", tree) == body
    title = f"<article><div class=entry-header><h1>Head</h1></div><p>{body}</p><div class=entry-footer><a href=x>Tag</a></div></article>"
    assert main_text(around % title, tree) == f"Head {body}"
    # a form or dialog around the whole page, as some servers write it
    whole = f"<body><form action=x><div class=menu><a href=/>Home</a></div><h1>Head</h1><p>{body}</p><p>{body}</p><div class=footer>Imprint</div></form></body>"
    assert main_text(whole, tree) == f"Head {body} {body}"


def test_long_comments_stay_out(tree):
    body = " ".join(["word"] * 30)
    comments = "".join(f"<article class=comment><p>{body}</p></article>" for _ in range(20))
    assert main_text(f"<article><h1>Head</h1><p>{body}</p></article><section id=comments>{comments}</section>", tree) == f"Head {body}"
    assert main_text(f"<article><h1>Head</h1><p>{body}</p></article>{comments}", tree) == f"Head {body}"
