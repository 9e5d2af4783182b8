import pytest
from conftest import DATA

from textgauge.llm import html_text as H

PAGES = [
    ("", ""),
    ("just text &amp; nothing else, a line that is long enough to be a paragraph of its own here", None),
    ("<nav><a href=x>Home</a></nav><article><h1>T</h1><p>A  b\n c &lt;d&gt;<br>e<p>Yes.</article>", "T\n\nA b c <d> e\n\nYes."),
    ("<article><p>One <a href='>'>two</a> three four five<script>if (a<b) '</p>'</script> six</p></article>", "One two three four five six"),
    ("<main><header><h1>Title here</h1></header><p>Body text.</p><footer>By me</footer></main>", "Title here\n\nBody text."),
    ("<article><p>Good.</p><div class='ad-box'>Buy it now</div><aside>More</aside><form>Name <input></form></article>", "Good."),
    ("<article><p>Good.</p></article><section id='comments'><article class='comment'><p>I disagree with it.</p></article></section>", "Good."),
    ("<article><p>cut in a ta", "cut in a ta"),
    ("<article><p>cut in a tag</p><p clas", "cut in a tag"),
    ("<article><p>ref &amp</p><!-- open comment <p>x</p>", "ref &"),
    ("<div class='cookie-notice'>We use cookies to make this site better for you and for all of us.</div><div><p>"
     + "word " * 40 + "</p><p>Short.</p><p>" + "more " * 30 + "</p></div><div><a href=1>one</a> <a href=2>two</a></div>",
     "word " * 39 + "word\n\nShort.\n\n" + "more " * 29 + "more"),
]


@pytest.mark.parametrize("page,text", [p for p in PAGES if p[1] is not None])
def test_pages(page, text):
    assert H.main_text(page) == text


def test_table_is_learned():
    wrong = [x for x, label in H.LABELLED if H.says(H.TREE, x) != label]
    assert len(wrong) <= 2


def test_table_of_pages(spark):
    rows = [(1, "u", PAGES[2][0], "x"), (None, None, None, "y"), (2, "v", "", "z"), (2, "v", "", "z"), (3, "w", "<p>" * 5000 + "a" * 100000, "q")]
    got = H.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert len(got) == 5 and all(r.n_chars == len(r.text) for r in got)
    assert [r.text for r in got if r.page_id == 1] == [PAGES[2][1]] and [r.text for r in got if r.page_id is None] == [""]
    assert H.extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_articles_of_the_pages(spark):
    import html
    import re

    for r in spark.read.parquet(f"{DATA}/sf0.01/pages.parquet").collect():
        inside = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>?", "", p)).split()) for p in re.split(r"</?(?:p|h1)>", inside)]
        assert H.main_text(r.html) == "\n\n".join(p for p in parts if p)


ARTICLE = "<article><h1>Title here</h1><p>" + "word " * 40 + "</p></article>"
TEXT = "Title here\n\n" + "word " * 39 + "word"


@pytest.mark.parametrize(
    "page,text",
    [
        (f"<form id='aspnetForm'>{ARTICLE}</form>", TEXT),
        *[(f"<div class='{c}'>{ARTICLE}</div>", TEXT) for c in ("has-sidebar", "page-with-sidebar", "layout-header", "elementor-widget-wrap")],
        ("<form><div class='header'>My site</div><div><p>" + "word " * 40 + "</p></div></form>", "word " * 39 + "word"),
        (ARTICLE + "<form>Your name and your address</form>", TEXT),
        (ARTICLE + f"<div class='related-posts'>{ARTICLE}</div><aside>{ARTICLE}</aside><div id='comments'>{ARTICLE}</div>", TEXT),
    ],
)
def test_wrappers_named_like_furniture(page, text):
    assert H.main_text(page) == text


WORDS = "word " * 39 + "word"


@pytest.mark.parametrize(
    "page,text",
    [
        ("just text", "just text"),
        ("<p>Short one.</p>", "Short one."),
        ("<html><head><title>t</title></head><body><h1>Alone</h1></body></html>", "Alone"),
        *[
            (f"<article><p>{WORDS}</p><{e}><p>{WORDS}</p><p>End here.</p></article>", f"{WORDS}\n\n{WORDS}\n\nEnd here.")
            for e in ("svg", "select", "object", "noscript", "canvas", "button", "audio", "video", "math", "datalist")
        ],
        (f"<article><p>{WORDS} <select><option>x</article><p>", WORDS + " "),
        (f"<article><select><p>{WORDS}</p><select><option>a</option></select><p>Then more.</p></article>", f"{WORDS}\n\nThen more."),
        (f"<article><p>{WORDS}</p><p><a href=x>this paragraph is one link</a></p><p>{WORDS}</p></article>", f"{WORDS}\n\nthis paragraph is one link\n\n{WORDS}"),
        (f"<article><p>{WORDS}</p><p>See <a href=x>a long link of seven words here</a> now.</p><p>{WORDS}</p></article>",
         f"{WORDS}\n\nSee a long link of seven words here now.\n\n{WORDS}"),
        (f"<article><p>{WORDS}</p><ul><li><a href=1>one more</a></li><li><a href=2>two more</a></li><li><a href=3>three</a></li></ul></article>", WORDS),
        (f"<div class='comment-policy-article'><p>{WORDS}</p></div>", WORDS),
        (f"<article><p>{WORDS}</p></article><div class='comment-body'><p>{WORDS} I say</p></div>", WORDS),
        (f"<script>var a = 1; <p>{WORDS}</p>", ""),
    ],
)
def test_nothing_else_is_dropped(page, text):
    assert H.main_text(page) == text.strip()


def test_neighbours_decide():
    """The tree asks for the link density of a neighbour, and its answer depends on it."""

    def asked(tree):
        return set() if isinstance(tree, int) else {tree[0]} | asked(tree[2]) | asked(tree[3])

    assert asked(H.TREE) & {3, 5}
    among_text, among_links = (8, 1.0, 40, 0.0, 40, 0.0, 0, 1, 0, 0), (8, 1.0, 4, 1.0, 4, 1.0, 0, 1, 0, 0)
    assert H.says(H.TREE, among_text) == 1 and H.says(H.TREE, among_links) == 0
