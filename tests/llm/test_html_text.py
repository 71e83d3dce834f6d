import pytest

from docsink.llm.html_text import main_text, style_tree
from tests.llm.conftest import prose


@pytest.fixture
def pages(spark):
    return lambda rows: spark.createDataFrame(rows, "page_id long, url string, html string")


def texts(frame):
    return {r.page_id: r.text for r in main_text(frame).collect()}


CASES = {
    "<html><head><title>t</title><style>p{}</style></head><body><nav><a>menu</a></nav><article><h1>Head</h1>"
    "<p>One <b>bo</b>ld &amp; t&eacute;xt.<br>next</p><p>Two</article><footer>f</footer>": "Head One bold & téxt. next Two",
    "<body><header>top</header><article><header><h1>Title</h1></header><p>a</p><aside>side</aside>"
    "<form>f<input></form><div class='comments'><p>reader</p></div><script>if (a<b) x('</p>')</script>"
    "<!-- c --><p>b\n \t c</p></article></body>": "Title a b c",
    "<body><div class='cookie-notice'>we use</div><div id='ad-3'>buy</div><main><p>a</p></main><div>x</div>": "a",
    "<body><div role='navigation'>m</div><p>plain page</p><p hidden>no</p>": "plain page",
    "<nav><ul><li>menu<li>more<article><p>menu never closed</p></article>": "menu never closed",
    "<article><p>1 < 2 &lt; 3 &#65;&#x42; &unknown; &am</p></article>": "1 < 2 < 3 AB &unknown; &am",
    "<article><p>a<div>b</div>c</p><ul><li>d<li>e</ul><table><tr><td>f<td>g</table></article>": "a b c d e f g",
    "just text": "just text",
    "": "",
    "<<<>>>&&&": "<<<>>>&&&",
}


def test_single_pages(pages):
    rows = [(i, f"http://h{i}.org/", html) for i, html in enumerate(CASES)]
    got = texts(pages([*rows, (100, None, None), (101, "odd url", "<article><p>x")]))
    assert [got[i] for i in range(len(CASES))] == list(CASES.values())
    assert got[100] == "" and got[101] == "x"


def site(n, article):
    return [
        (i, "https://site.org/" + str(i), f"<body><div class='x'>Welcome to the site</div><div class='y'><p>{article(i)}</p></div>"
         f"<div class='z'><p>All rights</p></div></body>")
        for i in range(n)
    ]


def test_branches_equal_on_every_page_go(pages):
    frame = pages(site(30, lambda i: prose(i, 20)))
    assert texts(frame) == {i: prose(i, 20) for i in range(30)}
    tree = {r.path: r.importance for r in pages_tree(frame)}
    assert tree[">body>div.x"] < 0.2 < 0.8 < tree[">body>div.y"]


def pages_tree(frame):
    from docsink.llm import html_text

    parsed = frame.mapInPandas(html_text._parse, html_text._PARSED)
    return style_tree(parsed).collect()


def test_few_pages_prove_nothing(pages):
    got = texts(pages(site(3, lambda i: prose(i, 20))))
    assert got[0] == f"Welcome to the site {prose(0, 20)} All rights"


def test_copied_articles_stay(pages):
    """A host that carries one article many times keeps it."""
    rows = [(i, "http://copy.org/" + str(i), f"<article><p>{prose(1, 30)}</p><p>{prose(2, 30)}</p></article>") for i in range(50)]
    assert set(texts(pages(rows)).values()) == {f"{prose(1, 30)} {prose(2, 30)}"}


def test_constant_branch_inside_varied_articles_goes(pages):
    rows = [(i, "http://v.org/" + str(i), f"<article><p>{prose(i, 30)}</p><div class='q'>Read more here</div></article>") for i in range(40)]
    assert texts(pages(rows)) == {i: prose(i, 30) for i in range(40)}


def test_long_pages_extra_columns_and_repeats(spark, pages):
    rows = [(1, "u", "<article>" + "<p>w</p>" * 50_000), (2, "u", "<article><p>x"), (2, "u", "<article><p>x")]
    frame = pages(rows).selectExpr("*", "'t' as text", "'s' as salt", "'h' as host")
    got = main_text(frame).collect()
    assert sorted((r.page_id, r.n_chars) for r in got) == [(1, 99_999), (2, 1), (2, 1)]
    assert main_text(frame.where("false")).collect() == []


WRAPPED = {
    "<div class='layout has-sidebar'><article><p>a b</p></article></div>": "a b",
    "<div class='social'><p>menu</p><main><p>a long text</p></main></div>": "a long text",
    "<form id='page'><div class='widget'><article><p>a b</p></article></div></form>": "a b",
    "<aside><main><p>a b</p></main></aside>": "a b",
    "<div class='with-comments no-menu'><p>plain page</p></div>": "plain page",
    "<div class='widget'><p>plain page</p></div>": "plain page",
    "<main><p>the body of the page</p><article><p>teaser</p></article></main>": "the body of the page teaser",
    "<main><p>the body of the page</p></main><article><p>teaser</p></article>": "the body of the page",
    "<article><p>the text</p><ol class='comments'><li><article>long words of a reader</article></ol></article>": "the text",
    "<article><p>the text</p></article><div class='comments'><article>long words of a reader</article></div>": "the text",
    "<p>the text <span class='ads'>buy</span> goes on</p>": "the text goes on",
}


def test_names_and_teasers_take_no_article(pages):
    got = texts(pages([(i, f"http://w{i}.org/", html) for i, html in enumerate(WRAPPED)]))
    assert [got[i] for i in range(len(WRAPPED))] == list(WRAPPED.values())


def test_boilerplate_of_a_small_section_goes(pages):
    """Sections below any share of a host, notices in most articles, and paths that differ in their fifth name."""
    rows = [(i, f"http://big.org/{i}", f"<body><div class='y'><p>{prose(i, 20)}</p></div></body>") for i in range(1000)]
    section = "<body><div class='s'>Of this section</div><div class='y'><p>{}</p></div></body>"
    rows += [(2000 + i, f"http://big.org/s{i}", section.format(prose(2000 + i, 20))) for i in range(10)]
    notice = "<div class='q'>Read more here</div>"
    rows += [(3000 + i, f"http://v.org/{i}", f"<article><p>{prose(i, 20)}</p>{notice * (i % 5 > 0)}</article>") for i in range(40)]
    names = "<body><div class='a b c d {}'><p>{}</p></div><div class='a b c d f'><p>All rights</p></div></body>"
    rows += [(4000 + i, f"http://n.org/{i}", names.format("e", prose(i, 20))) for i in range(20)]
    copies = [(5000 + i, f"http://v.org/c{i}", "<article><section class='k'><p>a copied article</p></section></article>") for i in range(20)]
    got = texts(pages([*rows, *copies]))
    assert all(got[i] == prose(i, 20) for i in range(1000)) and all(got[2000 + i] == prose(2000 + i, 20) for i in range(10))
    assert all(got[3000 + i] == prose(i, 20) for i in range(40)) and all(got[4000 + i] == prose(i, 20) for i in range(20))
    assert all(got[5000 + i] == "a copied article" for i in range(20))
