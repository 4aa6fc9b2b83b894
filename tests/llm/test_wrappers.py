import time

import pytest

from reviewlab.llm import html, wrappers

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script>
</head><body class="has-sidebar"><nav><a href="/a">Menu</a></nav><!-- ad <p>no</p> -->
<div class="ad">Buy</div><article><h1>A &amp; B</h1><p><b>First
 part.<br>still first<p>Second &eacute;&nbsp;x</p><div class="comments"><p>Me too</p></div>
<ul><li>one<li>two</ul><form><input>Mail</form><aside>Side</aside></article>
<footer>&copy; us</footer>"""


def test_marked_article():
    text = wrappers.article_text(PAGE, None)
    assert text == "A & B\n\nFirst part. still first\n\nSecond é x\n\none\n\ntwo"


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("plain &lt;text&gt;", "plain <text>"),
        ("<p>a<p>b</p>c", "a\n\nb\n\nc"),
        ("<article>x", "x"),
        ("<div>" * 3000 + "deep", "deep"),
        ("<p title='a>b'>q</p><p", "q\n\n<p"),
        ("a<br/>b<hr>c", "a b\n\nc"),
        ("<script>never closed <p>x", ""),
    ],
)
def test_broken_pages(page, text):
    assert wrappers.article_text(page, None) == text


def plain_page(i):
    return (
        f"<html><body><div id=top>Welcome to our site</div><div id=body><h1>Title {i}</h1>"
        + "".join(f"<p>Text {i} {j} and more words of it</p>" for j in range(1 + i % 4))
        + "</div><div id=end>All rights reserved</div></body></html>"
    )


def test_induced_template(spark):
    rows = [(i, "http://h.org/x", plain_page(i)) for i in range(12)]
    rows.append((50, "http://alone.org/", plain_page(50)))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    found = {r["page_id"]: r for r in wrappers.extract(pages).collect()}
    for i in range(12):
        wanted = [f"Title {i}"] + [f"Text {i} {j} and more words of it" for j in range(1 + i % 4)]
        assert found[i]["text"].split("\n\n") == wanted
        assert found[i]["n_chars"] == len(found[i]["text"])
    # One page tells nothing about its host's template.
    assert found[50]["text"].startswith("Welcome")


def test_alignment_is_the_largest():
    trees = [wrappers.skeleton(html.parse(t)) for t in ("<a></a><b></b><i></i>", "<b></b><a></a><i></i>")]
    assert len(wrappers.align(*trees)) == 3


def test_odd_rows(spark):
    rows = [(1, None, None), (None, "http://a.b/c", ""), (2, "x", "<article>t</article>")] * 2
    pages = spark.createDataFrame(
        [(*r, "n", 0) for r in rows], "page_id long, url string, html string, text string, row int"
    )
    found = wrappers.extract(pages).collect()
    assert sorted(r["text"] for r in found) == ["", "", "", "", "t", "t"]
    assert wrappers.extract(pages.limit(0)).count() == 0


def marked_page(i):
    return (
        f"<html><body><article><h1>Title {i}</h1><p>Read our <b>terms</b> first</p>"
        + f"<p>Text {i} and <b>terms</b> of it</p><p>Tell your friends about us</p></article>"
        + f"<article class='comment'><p>Comment {i} on it</p></article></body></html>"
    )


def test_constant_text_inside_marked_articles(spark):
    rows = [(i, "http://h.org/x", marked_page(i)) for i in range(12)]
    # Copies say nothing about the template.
    rows += [(100 + i, "http://same.org/x", marked_page(0)) for i in range(12)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    found = {r["page_id"]: r["text"] for r in wrappers.extract(pages).collect()}
    for i in range(12):
        assert found[i] == f"Title {i}\n\nText {i} and terms of it"
        assert found[100 + i].split("\n\n")[:2] == ["Title 0", "Read our terms first"]


def test_comments_are_no_marked_article():
    page = "<div><p>the text</p></div><article class='comment'><p>me too</p></article>"
    assert wrappers.article_text(page, None) == "the text"
    page = "<article class='post tag-share'><p>the text</p><article class='reply'>x</article></article>"
    assert wrappers.article_text(page, None) == "the text"


def other_page(i):
    return (
        f"<html><body><div class=wrap><div class=head>Our other pages</div><div class=story>"
        f"<p>Story {i} as told</p></div><div class=end>Ask us {i}</div></div></body></html>"
    )


def test_layouts_of_one_host(spark):
    rows = [(-1, "http://h.org/x", None), (-2, "http://h.org/x", "")]
    rows += [(i, "http://h.org/x", plain_page(i)) for i in range(12)]
    rows += [(100 + i, "http://h.org/x", other_page(i)) for i in range(5)]
    # The empty pages come first, so they have the smallest numbers.
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    found = {r["page_id"]: r["text"] for r in wrappers.extract(pages).collect()}
    assert found[-1] == found[-2] == ""
    for i in range(12):
        assert found[i].startswith(f"Title {i}\n\n") and "rights" not in found[i]
    for i in range(5):
        assert found[100 + i].startswith(f"Story {i} as told") and "other pages" not in found[100 + i]


def test_time_of_the_reader_grows_with_the_page():
    for part in ("<a ", "<a", '<a "', "<div>", "<p><b '", "<table><li>", "<!-", "</p>"):
        started = time.monotonic()
        root = html.parse(part * (1_000_000 // len(part)))
        html.blocks(root, set(), False)
        assert time.monotonic() - started < 5, part


def test_tags_that_never_end():
    """A tag that another one begins in before its end is text; quoted marks end nothing."""
    root = html.parse('<p>one <b two <i title="a<b>c">three</i><p>four <a')
    assert html.blocks(root, set(), False) == ["one <b two three", "four <a"]
    nested = html.parse("<ul><li>a<ul><li>b</ul><li>c</ul><p>d<p>e")
    assert html.blocks(nested, set(), False) == ["a", "b", "c", "d", "e"]
