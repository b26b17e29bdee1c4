from __future__ import annotations

import time

import pytest

from spendlens.llm.pages import extract, main_text, parse, weigh

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header><a href=/>Home</a> site name</header><nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav>
<div class="cookie-notice">We use cookies on this site, accept them all now please.</div><div id="wrap">
<article><header><h1>The &amp; title</h1></header><p>First  paragraph with <a href=x>a link</a>,\n long enough.
<p>Second &eacute;<br>one. <div class="ad">Buy this now</div><ul><li>item</li><li>other item</ul></article>
<section id="comments"><p>Great article, I really liked reading all of this text here!</p></section></div>
<aside><p>Related text that is quite long and has no links in it at all, really.</p></aside>
<form><label>Mail</label><input><button>Send</button></form><footer>&copy; someone</footer></body></html>"""


def test_article_without_boilerplate():
    assert main_text(PAGE) == "The & title\nFirst paragraph with a link, long enough.\nSecond é one.\nitem\nother item"


@pytest.mark.parametrize("page, text", [
    ("", ""), ("plain &lt; text", "plain < text"), ("<p>a<p>b", "a\nb"), ("<!-- only", ""), ("<script>x", ""),
    ("<div><p>x</div></p></b>y", "x\ny"), ("<p class='a>b'>t</p", "t"), ("<nav>menu</nav>", ""),
    ("<div class='main-content'><p>one</p><p>two</p></div><div class='sidebar'>s</div>", "one\ntwo")])
def test_small_pages(page, text):
    assert main_text(page) == text


def test_links_lower_the_density():
    nodes = parse("<div><p>" + "words of text " * 5 + "</p></div><div><p>" + "<a>words of text </a>" * 5 + "</p></div>")
    weigh(nodes)
    plain, linked = (n for n in nodes if n.tag == "p")
    assert plain.density > 2 * linked.density


def test_malformed_pages_take_linear_time():
    start = time.perf_counter()
    for part in ("<div>", '<p "', "<", "<!--", "<a ", "<p><b>", "</x>", "<script>x</script"):
        main_text(part * 20_000)
    assert time.perf_counter() - start < 20


def test_given_pages_give_their_articles(spark, small_dir):
    pages = spark.read.parquet(f"{small_dir}/pages.parquet")
    found = {r["page_id"]: r for r in extract(pages).collect()}
    for page in pages.collect():
        body = page["html"].partition("<article>")[2].partition("</article>")[0]
        title = body.partition("<h1>")[2].partition("</h1>")[0]
        text = found[page["page_id"]]["text"]
        assert len(text) == found[page["page_id"]]["n_chars"]
        if "&" not in body and body:
            blocks = body.replace("<b>", "").replace("</b>", "").replace("<br>", " ")
            for tag in ("<h1>", "</h1>", "<p>", "</p>"):
                blocks = blocks.replace(tag, "\n\0")
            assert text == "\n".join(b for b in (" ".join(x.split()) for x in blocks.split("\0")) if b), title


@pytest.mark.parametrize("around", ["article", "main", "div"])
def test_all_of_a_sectioned_article(around):
    lead, words = "lead " * 50, "some words of text " * 9
    page = (f"<body><div><ul><li><a href=/>{'menu ' * 20}</a></ul></div><div><{around}><h1>Title</h1><p>{lead}</p>"
            f"<section>{f'<p>{words}</p>' * 10}</section><section>{f'<p>{words}</p>' * 3}</section>"
            f"<blockquote>quoted</blockquote></{around}></div></body>")
    assert main_text(page).split("\n") == ["Title", lead.strip(), *[words.strip()] * 13, "quoted"]


@pytest.mark.parametrize("names", [
    'class="site has-sidebar"', 'id="page" class="no-comments"', 'class="post ad-free"',
    'class="content share-enabled"'])
def test_wrappers_with_a_boilerplate_word(names):
    words = "some words of text " * 9
    comments = f'<section id="comments"><article class="comment-body"><p>{words}</p></article></section>'
    for inner in ("article", "div"):
        page = f"<body><div {names}><{inner}><h1>T</h1>{f'<p>{words}</p>' * 4}</{inner}>{comments}</div></body>"
        assert main_text(page).split("\n") == ["T", *[words.strip()] * 4]
