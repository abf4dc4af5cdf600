"""Main texts of pages: the given pages against a plain reading of their articles, and odd markup."""

import html
import re

import pytest

from plantroom.llm import queries, wrappers


def article(page):
    """The blocks of the article of a given page: its tags are h1, p, b and br."""
    body = page[page.index("<article>") : page.index("</article>")]
    blocks = re.split(r"</?(?:p|h1|article)>", body)
    return "\n".join(filter(None, (" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in blocks)))


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    truth = {r["page_id"]: article(r["html"]) for r in pages.collect()}
    found = queries.op7_wrapper_induction(spark, "/root/testdata/sf0.01").collect()
    assert len(found) == len(truth)
    assert [r["page_id"] for r in found if r["text"] != truth[r["page_id"]]] == []
    assert all(r["n_chars"] == len(r["text"]) for r in found)


def shop(i, extra=""):
    return (
        f"<html><body><div id=top>Shop of things</div><div class='page'><div class='box'>Read our terms</div>"
        f"<div class='story'><h2>Story {i}</h2><p>First part of {i}{extra}</p><p>Second {'x' * i}</p><div class='cookie-notice'>We use {i}</div></div>"
        f"<div class='reader-comments'><p>nice {i}</p></div></div><div class=foot>Imprint</div></body></html>"
    )


def test_constant_nodes_become_the_template():
    template = wrappers.induce([shop(i) for i in range(6)])
    assert wrappers.extract(shop(9), template, 6) == "Story 9\nFirst part of 9\nSecond xxxxxxxxx"
    assert "Read our terms" in wrappers.extract(shop(9), None, 0)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<article><p>a<p>b <i>c</i>d<li>e<li>f</article>", "a\nb cd\ne\nf"),
        ("<article><header class=x>no</header><h1>T</h1>x &lt;b&gt; &am &#233;<script>var a='</p>';</script><style>p{}</style></article>", "T\nx <b> &am é"),
        ("<main><p>a</main><aside>b</aside><footer>c", "a"),
        ("<article><table><tr><td>1<td>2<tr><td>3</table><form>q</form><section class=comments>z</section></article>", "1\n2\n3"),
        ("<article><p title='a > b'>x</p><p title=\"y>z</p><p>w</p></article>", None),
        ("<div>" * 5000 + "deep" + "</div>" * 5000, "deep"),
        ("<p>" + "long " * 200_000, ("long " * 200_000).strip()),
        ("<<< 3 < 4 <b>x</b", None),
    ],
)
def test_odd_markup(page, text):
    found = wrappers.extract(page, None, 0)
    if text is not None:
        # an article's own header may be told from a page's by nothing but its name
        assert found.replace("no\n", "") == text


def test_odd_rows(spark):
    rows = [(1, None, None, 1), (1, "http://a.b/x", "", 2), (None, "http://a.b/y", "<article>t</article>", 3), (2, "::", "<p>x", 4), (2, "::", "<p>x", 4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host int")
    found = sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in wrappers.main_texts(pages).collect())
    assert found == [("1", "", 0), ("1", "", 0), ("2", "x", 1), ("2", "x", 1), ("None", "t", 1)]
    assert wrappers.main_texts(pages.where("false")).collect() == []


def test_copies_are_no_constants(spark):
    page = "<body><div class=s><p>the same text on every page</p></div></body>"
    pages = spark.createDataFrame([(i, "http://h/", page) for i in range(50)], "page_id long, url string, html string")
    assert {r["text"] for r in wrappers.main_texts(pages).collect()} == {"the same text on every page"}


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<div id=page class='site has-sidebar'><article><h1>T</h1><p>x</p></article><div class=sidebar>b</div></div>", "T\nx"),
        ("<div class='wrap no-sidebar'><article>x</article></div>", "x"),
        ("<div class='sidebar-layout'><div class=side><main>x</main></div></div><article class=teaser>y</article>", "x\ny"),
        ("<form id=aspnetForm><article>x</article></form>", "x"),
        ("<article><div class='article-header'><h1>Head</h1></div><p>body of it</p><div class=share>on</div></article>", "Head\nbody of it"),
        ("<article data-class='sidebar' title='x class=menu hidden' data-hidden=1>x</article>", "x"),
        ("<div data-role='banner' title='id=footer'><p>x</p></div>", "x"),
        ("<div class=legal><p>a long opinion of the court</p></div><div class=related>more</div>", "a long opinion of the court"),
        ("<main>x</main><div class=comments><article>me too, and at some length</article></div>", "x"),
        ("<div hidden><article>x</article></div><p>y", "y"),
    ],
)
def test_names_are_weak_evidence(page, text):
    assert wrappers.extract(page, None, 0) == text


def test_the_template_outweighs_names():
    page = lambda i: f"<body><div class='header top'>Paper</div><div class=notice><h1>Case {i}</h1><p>Held {'y' * i} in {i}</p></div><div class=side>see {i}</div></body>"
    template = wrappers.induce([page(i) for i in range(1, 7)])
    assert wrappers.extract(page(9), template, 6) == "Case 9\nHeld yyyyyyyyy in 9"


def test_all_pages_of_a_host_and_its_layouts_take_part(spark):
    story = lambda i: f"<p>Part one of {i}</p><p>Part {'z' * (i % 7 + 1)} two</p>"
    plain = lambda i: f"<body><article><h1>Story {i}</h1><div class=box>Read our terms</div><div class=story>{story(i)}</div></article></body>"
    other = lambda i: f"<body><table class=frame><tr><td>Since 1900</td></tr></table><main><h2>Report {i}</h2><div class=lead>House rules</div><section class=report>{story(i)}</section></main></body>"
    bare = lambda i: f"<body><article><h1>Story {i}</h1><div class=story>{story(i)}</div></article></body>"
    kinds = [(plain, "Story")] * 7 + [(bare, "Story")] * 2 + [(other, "Report")]
    rows = [(i, "http://h/", kinds[i % 10][0](i)) for i in range(300)]
    found = wrappers.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(found) == 300
    for r in found:
        i = r["page_id"]
        assert r["text"] == f"{kinds[i % 10][1]} {i}\nPart one of {i}\nPart {'z' * (i % 7 + 1)} two"


def test_a_part_with_very_many_constants():
    """Alternating elements make 460 runs below one node, all of them on every page."""
    rules = "".join(f"<p>Rule {k}</p><h4>Part {k}</h4>" for k in range(230))
    page = lambda i: f"<body><div class=frame><div class=box>{rules}<p>Seen by {i}</p></div><div class=story><p>Story {'w' * i}</p></div></div></body>"
    template = wrappers.induce([page(i) for i in range(1, 9)])
    found = wrappers.extract(page(11), template, 8)
    assert "Rule" not in found and "Part" not in found and "Story wwwwwwwwwww" in found


@pytest.mark.parametrize("order", [1, 7, 331])
def test_runs_that_few_pages_have_are_no_constants_and_hide_none(order):
    """Every page has parts of its own names, far more of them than are kept, beside the box that all have."""
    letters = lambda i: "".join(chr(97 + int(d)) for d in str(i))
    own = lambda i: "".join(f"<div class='{letters(i)}-{letters(k)}'>own {i} {k}</div>" for k in range(4))
    page = lambda i: f"<body><div class=frame><div class=box>Read our terms</div>{own(i)}<h5>House rules</h5></div></body>"
    pages = [page(i * order % 1000) for i in range(1000)]
    found = wrappers.extract(page(5), wrappers.induce(pages), 1000)
    assert found == "\n".join(f"own 5 {k}" for k in range(4))


@pytest.mark.parametrize(("same", "constant"), [(780, False), (795, False), (805, True), (900, True)])
@pytest.mark.parametrize("order", [1, 7, 331])
def test_hundreds_of_texts_at_a_node(same, constant, order):
    """A text is constant from 0.8 of the pages on, however many others stand at its node."""
    page = lambda i: f"<body><div class=frame><div class=box>{'Read our terms' if i < same else f'Other {i}'}</div><div class=story><p>Story {i}</p></div></div></body>"
    template = wrappers.induce([page(i * order % 1000) for i in range(1000)])
    assert ("Read our terms" not in wrappers.extract(page(0), template, 1000)) == constant
