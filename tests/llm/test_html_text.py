from __future__ import annotations

import html
import re
import time

import pytest

from lapstack.llm import html_text, queries

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";x("<div>")</script></head>
<body class="post-12"><header><h1>Site</h1></header><nav><ul><li><a href=/a>Menu &amp; more</a></ul></nav>
<div class="cookie-notice">We use cookies and say so at some length, in many words.</div>
<div class="wrap"><div class="main-col p-%d"><article><h1>A   title</h1><p><b>First &eacute; one,<br>two.
<p>Second <a href="x">link</a> text &lt;b&gt; 5 > 4.</p><div class="ad">Buy a lot of things here</div>
<ul><li>Item one<li>Item two</ul><table><tr><td>cell<td>next</table><!-- no <p>comment</p> -->
<form><p>Sign up</p></form><section class="comments"><p>A reader's comment that is rather long.</p></section></article></div>
<aside>Sidebar text that goes on.</aside></div><footer>Footer</footer></body></html>"""
TEXT = "A title\n\nFirst é one, two.\n\nSecond link text <b> 5 > 4.\n\nItem one\n\nItem two\n\ncell\n\nnext"
SCHEMA = "page_id bigint, url string, html string, text string"


def test_blocks_and_votes():
    blocks = html_text.blocks_of(PAGE % 7)
    assert "\n\n".join(b.text for b in blocks) == TEXT
    assert html_text.best_path(blocks) == ("html", "body.post-0", "div.wrap", "div.main-col.p-0", "article")


def test_extraction_prefers_the_winning_path():
    page = "<body><div class=x><p>one</p></div><div class=y><p>two two two two two</p></div></body>"
    assert html_text.extract(page, []) == "two two two two two"
    assert html_text.extract(page, ["body>div.none", "body>div.x"]) == "one"
    assert html_text.extract("", ["a"]) == html_text.extract("<nav>only</nav>", []) == ""
    assert html_text.extract("plain   text &amp; more", []) == "plain text & more"


@pytest.mark.parametrize(
    "page", ["<", "<p", "<a href='x>b", '<div class="', "<!--", "</p></p>", "<p>" * 3000, "<div>" * 500 + "x", "<script>x", "<b>" + "a" * 10**6, "<" * 20_000]
)
def test_broken_pages_end(page):
    html_text.extract(page, [])


def test_hosts_vote(spark):
    good = "<body><div class=story><p>%s</p></div><div class=more><p>%s</p></div></body>"
    rows = [(i, f"http://u@A.example:80/{i}", good % ("long text " * 9 + str(i), "short"), None) for i in range(20)]
    # on one page the other container holds more, but the host's pages agree on the story
    rows += [(20, "https://a.example/20", good % ("brief", "much longer text " * 9), None)]
    rows += [(21, "http://b.example/", PAGE % 1, None), (22, None, None, None), (23, "", "", "x"), (23, "", "", "x")]
    pages = spark.createDataFrame(rows, SCHEMA)
    won = {r.host: r.winners for r in html_text.winning_paths(html_text.path_votes(pages)).collect()}
    assert won["a.example"] == ["body>div.story"]
    for limit in (20_000, 0):  # broadcast and salted
        out = html_text.main_text(pages, broadcast_hosts=limit).collect()
        got = {r.page_id: r.text for r in out}
        assert len(out) == len(rows) and all(r.n_chars == len(r.text) for r in out)
        assert got[20] == "brief" and got[3] == "long text " * 9 + "3" and got[21] == TEXT and got[22] == got[23] == ""
    assert html_text.main_text(pages.limit(0)).count() == 0


def plain_article(page):
    """The article of the test pages by hand, whose markup is known."""
    body = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    blocks = re.split(r"</?(?:p|h1)>", body)
    texts = (re.sub(r"\s+", " ", html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b)))).strip() for b in blocks)
    return "\n\n".join(t for t in texts if t)


def test_query_on_the_given_pages(spark):
    sf_dir = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = queries.op8_consensus_html(spark, sf_dir).collect()
    assert {r.page_id: r.text for r in rows} == {i: plain_article(h) for i, h in pages.items()}


ARTICLE = "<h1>Title of it</h1><p>" + "A sentence of the article. " * 20 + "</p>"
FRAME = "<body><header>Site</header><nav><a href=/>Home</a></nav>%s<footer>Imprint</footer></body>"


@pytest.mark.parametrize(
    "start", ['<div class="page has-sidebar">', '<div id="page" class="nav-open">', '<section class="post comments-open">', "<div class=widget>"]
)
def test_a_word_on_the_wrapper_drops_no_article(start):
    end = "</section>" if start.startswith("<section") else "</div>"
    page = FRAME % (start + ARTICLE + "<div class=ad>Buy things</div>" + end)
    text = html_text.extract(page, [])
    assert text.startswith("Title of it\n\nA sentence") and text.endswith("the article.")


def test_words_inside_an_article_are_evidence_only():
    page = FRAME % (
        '<article><div class="article-header"><h1>Title</h1><p>By me</p></div><h2 class="section-header">Part</h2>'
        f'{ARTICLE[24:]}<div id="side-effects"><p>Sleep.</p></div><div class="share-price">12.30</div>'
        '<div class="post-nav"><a href=/1>Older</a> <a href=/2>Newer</a></div><div class="comments"><p>First!</p></div></article>'
    )
    text = html_text.extract(page, [])
    assert [t for t in text.split("\n\n") if len(t) < 30] == ["Title", "By me", "Part", "Sleep.", "12.30"]


def test_sections_title_and_lead_are_whole():
    a, b, c = "x " * 200 + "a", "x " * 1600 + "b", "x " * 200 + "c"
    sections = f"<section class=intro><p>{a}</p></section><section class=body><p>{b}</p></section><section class=end><p>{c}</p></section>"
    for wrapped in (
        f"<article><header><h1>T</h1></header>{sections}</article>",
        f"<div class=post><div class=top><h1>T</h1></div>{sections}</div>",
        f"<div class=title><h1>T</h1></div><div class=post>{sections}</div>",
        f"<div class=post><h1>T</h1><p>{a}</p><div class=text><p>{b}</p></div><p>{c}</p></div>",
    ):
        assert html_text.extract(FRAME % wrapped, []) == "\n\n".join(["T", a, b, c])
    path = html_text.best_path(html_text.blocks_of(FRAME % f"<article>{sections}</article>"))
    assert path == ("body", "article")


def test_second_layout_and_nested_winners():
    page = "<body><div class=x><p>teaser</p></div><div class=y><p>%s</p><div class=z><p>%s</p></div></div></body>" % ("y " * 30, "z " * 90)
    y, z = ("y " * 30).strip(), ("z " * 90).strip()
    assert html_text.extract(page, ["body>div.x", "body>div.y"]) == f"{y}\n\n{z}"
    assert html_text.extract(page, ["body>div.y>div.z", "body>div.y"]) == f"{y}\n\n{z}"


THREAD = "".join(f"<p>Reader {i} says at length what the reader thinks of all this.</p>" for i in range(40))
BODY = "A sentence of the article. " * 6


@pytest.mark.parametrize(
    "wrapped",
    [
        "<form action=/><div class=page>%s</div><input><button>Go</button></form>",
        "<form id=aspnetForm><fieldset><div class=page>%s</div></fieldset></form>",
        "<div role=form><div class=page>%s</div></div>",
    ],
)
def test_a_form_around_the_page(wrapped):
    page = f"<h1>Title</h1><p>{BODY}</p><form class=signup><p>Mail address</p><label>Name</label></form>"
    assert html_text.extract(FRAME % (wrapped % page), []) == f"Title\n\n{BODY.strip()}"
    assert html_text.extract(FRAME % "<form><p>Your name</p></form><div class=text><p>%s</p></div>" % BODY, []) == BODY.strip()


@pytest.mark.parametrize(
    "thread",
    [
        f"<div id=comments>{THREAD}</div>",
        f"<section class='comments-area'><ol class=comment-list>{THREAD}</ol></section>",
        f"<div id=comments><h1>40 replies</h1>{THREAD}</div>",
        "".join(f"<article class=comment>{p}</p></article>" for p in THREAD.split("</p>")[:-1]),
        f"<article id='comment-7'>{THREAD}</article>",
        f"<div id=disqus_thread>{THREAD}</div>",
    ],
)
@pytest.mark.parametrize("post", [f"<div class=post><h1>T</h1><p>{BODY}</p></div>", f"<article><h1>T</h1><p>{BODY}</p></article>"])
def test_comments_never_win_by_their_length(post, thread):
    text = f"T\n\n{BODY.strip()}"
    assert html_text.extract(FRAME % (post + thread), []) == text
    inside = post.replace("</article>", thread + "</article>").replace("</div>", thread + "</div>")
    assert html_text.extract(FRAME % inside, []) == text
    without_title = post.replace("<h1>T</h1>", "")
    if "<h1>" not in thread:
        assert html_text.extract(FRAME % (without_title + thread), []) == BODY.strip()


def test_a_page_that_says_it_has_comments_is_kept():
    for start in ('<div class="comments-open">', '<div class="post comments">', '<div id=comment-enabled>'):
        page = f"{start}<h1>T</h1><p>{BODY}</p><div class=comment-list>{THREAD}</div></div>"
        assert html_text.extract(FRAME % page, []) == f"T\n\n{BODY.strip()}"


def test_labels_and_buttons_are_inline():
    page = "<article><p>Press the <button>Go</button> button, then <label for=x>tick</label> it.</p><button>Share</button><p>Done.</p></article>"
    assert html_text.extract(page, []) == "Press the Go button, then tick it.\n\nDone."


def test_quoted_values():
    page = """<article data-x='a > b <p class="nav">' title="x > y"><p class='a"b' id = part-1>One<p>Two <a href=x title='">'>li'nk</a></article>"""
    assert html_text.extract(page, []) == "One\n\nTwo li'nk"


DEEP = 100_000


@pytest.mark.parametrize(
    "page",
    [
        "<div class=menu-x><p>" * DEEP,
        "<div class=comment>" * DEEP + "x",
        "".join(f"<div class=c><p>text {i}" for i in range(DEEP)),
        "<div><b>x</div></p></ul>" * DEEP,
        "<article><h1>x" * (DEEP // 2),
        "<div>" * DEEP + "</p></span></section>" * DEEP,
        "<a href=\"x " * DEEP,
        "<a '>\"'" * DEEP,
        "<p class='x>" + "a" * 1_000_000,
        "<a title=\"" * DEEP + ">" * 10,
        "<select>x" * DEEP,
        "<svg>" * DEEP + "<!-- " * DEEP,
        "<? x" * DEEP,
        "<form><fieldset><label>x" * (DEEP // 2),
    ],
)
def test_time_grows_with_the_page(page):
    begin = time.process_time()
    html_text.extract(page, ["body>div.menu-x"])
    assert time.process_time() - begin < 5


def test_clashing_columns(spark):
    names = ["winners", "host", "salt", "_host", "n_chars"]
    pages = spark.createDataFrame([(1, "http://a.example", PAGE % 1, None, *names)], SCHEMA + "".join(f", {n} string" for n in names))
    for limit in (20_000, 0):
        out = html_text.main_text(pages, broadcast_hosts=limit)
        row = out.first()
        assert sorted(out.columns) == sorted(pages.columns) and row.text == TEXT and row.n_chars == len(TEXT)
        assert [row[n] for n in names[:-1]] == names[:-1]
