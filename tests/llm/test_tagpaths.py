"""Main texts of pages: given pages by a plain reading of their article, handmade ones by what they should give."""

import html
import re

import pytest
from agorascope.llm import queries, tagpaths

P = "<p>Some words, quite a few of them, make this a paragraph. It has two sentences.</p>"
T = "Some words, quite a few of them, make this a paragraph. It has two sentences."


def plain(page: str) -> str:
    """The text of the one article element of a given page, block by block."""
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = (" ".join(html.unescape(re.sub(r"<[^>]+>", " ", re.sub(r"</?b>", "", b))).split()) for b in re.split(r"</?(?:p|h1)>", body))
    return "\n".join(filter(None, blocks))


def test_given_pages(spark):
    folder = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    got = queries.QUERIES["op11_main_text"](spark, folder).collect()
    assert sorted(r.page_id for r in got) == sorted(pages)
    for r in got:
        assert r.text == plain(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


@pytest.mark.parametrize("page, want", [
    # No article element: a column of paragraphs among a menu, a sidebar, comments and a last line.
    (f"<body><div id=menu><a href=x>A</a></div><div class='content main-col'><h1>Title &amp; more</h1>{P}{P}<ul><li>one item, first<li>two "
     f"<a>linked</a></ul>{P}</div><div class=sidebar>{P}{P}</div><div id='comments'><h2>Comments</h2>{P * 8}</div><p>Copyright x</p>",
     f"Title & more\n{T}\n{T}\none item, first\ntwo linked\n{T}"),
    # Site and article headers, table and preformatted text, a form, an aside, comments inside the article.
    (f"<header><h1>Site</h1></header><main><article><header><h1>T</h1><p>By me</p></header>{P}<blockquote>Quoted</blockquote><pre>a  b\nc</pre>"
     f"<table><tr><td>c1<td>c2</table>{P}<aside>no</aside><form>no<input></form><section class='comments'>{P * 5}</section></article></main><footer>f</footer>",
     f"T\nBy me\n{T}\nQuoted\na b c\nc1\nc2\n{T}"),
    (f"<article><h1>Real</h1>{P * 3}</article><article class='comment'>{P * 9}</article>", f"Real\n{T}\n{T}\n{T}"),
    # A name on an element that holds the article's heading doesn't set that apart; of a whole page neither.
    (f"<body class='has-sidebar'><div class='header-fixed'><h1>H</h1>{P}</div>", f"H\n{T}"),
    ("<div class=ad>only an ad.</div>", "only an ad."),
    # Menus of links inside the article go, a paragraph that is one link stays.
    (f"<article>{P}<ul><li><a href=a>One</a></li><li><a href=b>Two</a></li></ul><p><a href=x>All link</a></p></article>", f"{T}\nAll link"),
    # Inline parts, hidden ones, breaks, quotes in attributes, references, comments, scripts.
    (f"<p hidden>secret</p>{P}<p>x<span style='display:none'>hid</span>y <b>z</b>!<br>w</p>", f"{T}\nxy z! w"),
    ("<p a='>' b=\"x>y\">q<b>r</b>s <i>t</i>.</p><!-- <p>no</p> --><script>'<p>no</p>'</script><p>u,&nbsp;&eacute;&#233;&lt;b&gt;</p>", "qrs t.\nu, éé<b>"),
    ("no tags &lt;b&gt; at  all", "no tags <b> at all"),
    ("<p>One, here.<p>Two, there.", "One, here.\nTwo, there."),
    ("", ""), (None, ""), ("<!-- never closed <p>x</p>", ""), ("<script>never closed <p>x</p>", ""), ("<nav>only <a>links</a></nav>", ""), ("< < <3", "< < <3"),
])
def test_handmade_pages(page, want):
    assert tagpaths.main_text(page) == want


def test_deep_long_and_broken_pages_end_soon():
    for page in ("<div>" * 50_000 + P, "<p>a.<i>" * 30_000, "<a \"" * 30_000, "<" * 100_000, "<li>x" * 30_000, "<b>" * 20_000 + "x<p>" * 20_000):
        tagpaths.main_text(page)
    assert tagpaths.main_text("<article>" + P * 20_000 + "</article>").count("\n") == 19_999


def test_ratios_choose_long_punctuated_paths():
    page = tagpaths.read_page(f"<body><div><span>Short</span></div>{P}{P}<div>Other</div>{P}</body>")
    scores = dict(zip((b.text for b in page.blocks), tagpaths.path_scores(page, page.blocks)))
    assert scores[T] == 1.0 and scores["Short"] < 0.7 and scores["Other"] == scores["Short"]
    assert tagpaths.alike(page, 0, 0) == 1.0 and 0 < tagpaths.alike(page, page.blocks[0].path, page.blocks[1].path) < 1


def test_odd_rows_of_pages(spark):
    rows = [(1, None, None, "x"), (1, None, None, "x"), (None, "u", f"<article>{P}</article>", "y"), (2, "u", "", "z"), (3, "v", f"<article>{P * 3000}</article>", "z")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = [tuple(r)[:4] for r in tagpaths.extract_text(df).collect()]
    want = [(1, None, "", 0)] * 2 + [(None, "u", T, len(T)), (2, "u", "", 0), (3, "v", "\n".join([T] * 3000), 3000 * len(T) + 2999)]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert tagpaths.extract_text(df.where("false")).count() == 0
