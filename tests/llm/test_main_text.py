import time
from html.parser import HTMLParser

import pyarrow as pa
import pytest

from ridecells.llm import main_text
from ridecells.llm.queries import QUERIES


@pytest.fixture(scope="module")
def tree(spark):
    return main_text.train(spark)


def kept(tree, source):
    blocks, = main_text._kept([source], tree)
    return [b[0] for b, keep in blocks if keep]


LONG = "The council met on Tuesday and agreed, after some hours, to mend the old bridge before winter, as the mayor had asked in spring. "


def test_labelled_table_is_learned(tree):
    wrong = 0
    for page in main_text.LABELLED:
        labels, rows = zip(*main_text._labelled(page))
        wrong += sum(a != b for a, b in zip(labels, tree.margin(rows)))
    assert wrong <= 4


def test_held_out_pages_of_the_table(spark):
    """Each fifth page judged by a tree of the others."""
    right = whole = 0
    for part in range(5):
        tree = main_text.train(spark, [p for i, p in enumerate(main_text.LABELLED) if i % 5 != part])
        for page in main_text.LABELLED[part::5]:
            labels, rows = zip(*main_text._labelled(page))
            right += sum(a == b for a, b in zip(labels, tree.margin(rows)))
            whole += len(labels)
    assert right / whole > 0.85


class ArticleParser(HTMLParser):
    """Texts of the article's blocks, for pages with one article and nothing else in it."""

    def __init__(self):
        super().__init__()
        self.inside, self.blocks = False, [""]

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        if tag in ("p", "h1"):
            self.blocks.append("")
        elif tag == "br":
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        self.inside &= tag != "article"
        if tag in ("p", "h1"):
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data


def test_given_pages_give_their_articles(spark):
    folder = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    found = QUERIES["op11_main_text"][0](spark, folder)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    found = found.collect()
    assert len(found) == len(pages)
    for row in found:
        parser = ArticleParser()
        parser.feed(pages[row["page_id"]]["html"])
        expected = [" ".join(b.split()) for b in parser.blocks]
        assert row["text"] == "\n\n".join(b for b in expected if b)
        assert row["n_chars"] == len(row["text"]) and row["url"] == pages[row["page_id"]]["url"]


def test_a_page_with_every_kind_of_surroundings(tree):
    source = f"""<html><body class="has-sidebar"><header id="masthead"><a href="/">Home</a><h2>The Daily</h2></header>
    <div class="cookie-notice">We use cookies. By reading on you agree to all of them, now and later, here and elsewhere.</div>
    <main><div class="main-menu"><a href=1>One</a></div>
    <article class="post has-comments"><header><h1>Bridge &amp; river</h1></header>
    <p>{LONG}</p><div class="advert">Buy our <b>boats</b> today!</div><p>Yes.</p>
    <aside>More by this author</aside><ul><li>first<li>second &lt;b&gt;</ul><p class='social-share'>Share this!</p>
    <form>Your mail: <label>please</label><button>Send</button></form><noscript>Turn scripts on</noscript>
    <p>{LONG}</p><footer>Filed under news</footer></article>
    <section class="comments"><article><p>{LONG}</p></article><div class="content"><p>{LONG}</p></div></section></main>
    <div class="sidebar"><p>{LONG}</p></div><footer>&copy; 2020</footer><script>var a = "<p>no</p>";</script></body></html>"""
    whole = " ".join(LONG.split())
    assert kept(tree, source) == ["Bridge & river", whole, "Yes.", "first", "second <b>", whole]


def test_a_page_without_markers(tree):
    menu = "".join(f'<div><a href="/{i}">Part {i}</a></div>' for i in range(6))
    source = f"{menu}<h1>Bridge and river mended</h1><p>{LONG}</p><p>{LONG * 2}</p><p>And so it was.</p><p>{LONG}</p>{menu}<div>Imprint</div>"
    whole, twice = " ".join(LONG.split()), " ".join((LONG * 2).split())
    assert kept(tree, source) == ["Bridge and river mended", whole, twice, "And so it was.", whole]


def test_a_form_or_soft_wrapper_around_the_article(tree):
    source = f'<form id="aspnet"><div class="header-offset"><article><p>{LONG}</p></article></div></form>'
    assert kept(tree, source) == [" ".join(LONG.split())]


@pytest.mark.parametrize("source, texts", [
    ("<article><p>a&nbsp;&nbsp;b<br>c\t\n d&#8217;s &copy &notit; &amp;lt;", ["a b c d’s © ¬it; &lt;"]),
    ("<article>1 < 2 <b title='a > b'>and</b> 3 > 2 </ >x<!-- no <p> -->y<!-->z<?php a ?>w", ["1 < 2 and 3 > 2 xyzw"]),
    ("<article>un<i>bro</i>ken<p>next<div>last</p>", ["unbroken", "next", "last"]),
    ("<article><p>before <button>no end<p>after", ["before no end", "after"]),
    ("<article><p>before<script>no end<p>after", ["before"]),
    ("<article><td>one<td>two<tr><td>three</table>", ["one", "two", "three"]),
    ("<ARTICLE><P>Upper</P></ARTICLE><SCRIPT>x</SCRIPT>", ["Upper"]),
    ("<article><p>a <b", ["a"]),
    ("<article><p>a<p class=comment>b<p>c", ["a", "c"]),
    ("", []), (None, []), ("<nav>only</nav>", []), (" \n ", []), ("</p></div></article>", []),
])
def test_markup(tree, source, texts):
    assert kept(tree, source) == texts


def test_reading_takes_time_in_proportion():
    def seconds(source):
        start = time.perf_counter()
        main_text.text_blocks(source)
        return time.perf_counter() - start
    for piece in ("<div>", "<button>x", "<a href='", '<a x="', "<!-- ", "</div>", "<p><b>x<br>", "<", "&amp", "<li>", "<ul><li>x"):
        assert seconds(piece * 100_000) < 5


def test_odd_tables(spark, rows):
    layout = "page_id long, url string, html string, text int, n_chars string"
    table = spark.createDataFrame([(None, None, "<article>x</article>", 1, "a"), (2, "u", None, 1, "a"), (2, "u", "", 1, None),
                                   (3, "u", "<article>" + "<p>w" * 30_000, 1, None), (3, "u", "<article>x", 1, None)], layout)
    found = main_text.main_text(table).collect()
    assert [(r["page_id"], r["url"], r["text"][:2], r["n_chars"]) for r in found] == [
        (None, None, "x", 1), (2, "u", "", 0), (2, "u", "", 0), (3, "u", "w\n", 3 * 30_000 - 2), (3, "u", "x", 1)]
    assert rows(main_text.main_text(table.limit(0))) == []
    assert main_text.classified_blocks(table).where("kept").count() == 30_002


def test_slices_cover_all_rows(monkeypatch):
    batch = pa.RecordBatch.from_pydict({"t": ["abc", None, "", "defg", "h"]})
    monkeypatch.setattr(main_text, "_AT_ONCE", 4)
    assert [p.column(0).to_pylist() for p in main_text._sliced(batch, 0)] == [["abc", None, "", "defg"], ["h"]]
