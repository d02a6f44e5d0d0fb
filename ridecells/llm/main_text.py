"""Main text of web pages from flat text blocks.

A page is cut at its block-level tags into blocks, in page order. A block has
its number of words, its share of words in links and whether it is a heading,
the same numbers of the blocks before and after it, and what its innermost
telling element says: part of a marked article (1), of something that is none
(-1), or nothing (0), with the share of the page's open words that marked
articles hold. A decision tree, fitted by Spark on the small table ``LABELLED``
and flattened into arrays, keeps or drops each block.

Telling elements are ``article``, ``main``, ``nav``, ``aside``, ``footer``,
``form``, a ``header`` outside an article, and elements with such a role or with
a telling word in class or id. ``main`` counts anywhere, ``article`` inside
anything but menus, footers, asides, adverts and comments.

Scripts, styles, titles, text fields, buttons, choices, drawings, embedded
objects, templates and comments have no text. A start tag of these without an
end is passed over, but a script or style without one ends the page. Character
references are decoded once; a line break counts as white space.

A null or empty page, or one without text blocks that are kept, has the text "".
Repeated rows each have their result, null ids and urls stay, an empty table
gives no rows; other columns are not read.
"""

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector

from ridecells.llm.common import arrow_batch, arrow_schema
from ridecells.llm.quality import FlatTrees
from ridecells.session import shared_folder

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)(?:>|\Z)"""
    r"|<(?:[!?]|/(?=[^a-zA-Z]))[^>]*+(?:>|\Z)", re.DOTALL)
_NAMES = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.IGNORECASE)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Elements of HTML, and words that name parts of a page.
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_NO_TEXT = frozenset(
    "script style title textarea xmp iframe noembed noframes noscript template button select datalist svg object canvas audio video".split())
_ENDS_PAGE = frozenset(["script", "style"])
_CLOSED_BY_LIKE = {
    "li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"}}
_NEVER_ARTICLE = frozenset(
    "ad ads adv advert advertisement adverts adsense sponsor sponsored promo promotion comment comments reply replies respond "
    "disqus nav navbar navigation breadcrumb breadcrumbs sidebar aside related recommended recommendations footer".split())
_SELDOM_ARTICLE = frozenset(
    "menu header masthead banner cookie cookies consent gdpr notice notification alert popup modal overlay dialog newsletter "
    "subscribe subscription signup login share sharing social pagination pager toolbar widget copyright legal contentinfo "
    "complementary search".split())
_ARTICLE_WORDS = frozenset("article content entry main post story body text".split())
_NO_ARTICLE_ITSELF = frozenset("ad advert comment promo related reply sponsored".split())

_ARTICLE, _OPEN, _FORM, _SELDOM, _NEVER = 1, 0, -1, -2, -3


def _region(name, attributes, outer):
    """What an element says of its content, given what the element around it says."""
    words, role = set(), ""
    for kind, *value in _NAMES.findall(attributes) if attributes else ():
        value = "".join(value)
        if kind.lower() == "role":
            role = value.strip().lower()
        else:
            words.update(w.lower() for w in _PART.findall(value))
    if name == "main" or role == "main":
        return _ARTICLE
    if name == "article":
        if words & _NO_ARTICLE_ITSELF:
            return _NEVER
        return outer if outer == _NEVER else _ARTICLE
    if name in ("body", "html"):
        return outer
    words.add(role)
    if name in ("nav", "aside", "footer") or words & _NEVER_ARTICLE:
        return _NEVER
    if words & _SELDOM_ARTICLE or name in ("header", "dialog"):
        if outer == _ARTICLE and (name == "header" or words & _SELDOM_ARTICLE <= {"header"}):
            return outer
        return min(outer, _SELDOM)
    if name == "form":
        return min(outer, _FORM)
    return _ARTICLE if outer in (_OPEN, _FORM) and words & _ARTICLE_WORDS else outer


class _Page:
    """Blocks of a page as (text, words, linked words, heading, region)."""

    def __init__(self, source):
        self.blocks, self.pieces, self.linked = [], [], 0
        self.open, self.counts, self.in_link, self.heading = [], {}, False, False
        at, missing = 0, set()
        while True:
            token = _TOKEN.search(source, at)
            self._text(source[at:token.start() if token else len(source)])
            if not token:
                break
            at = token.end()
            if not token[2]:
                continue
            name = token[2].lower()
            if name in _NO_TEXT and not token[1]:
                end = None if name in missing else re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE).search(source, at)
                if end:
                    at = end.start()
                elif name in _ENDS_PAGE:
                    break
                else:
                    missing.add(name)
            elif name == "br":
                self.pieces.append(" ")
            elif name == "a":
                self.in_link = not token[1] and "href" in token[3].lower()
            elif name in _BLOCKS:
                self._flush()
                self._end(name) if token[1] else self._start(name, token[3])
        self._flush()

    def _text(self, piece):
        if piece:
            piece = html.unescape(piece) if "&" in piece else piece
            self.pieces.append(piece)
            if self.in_link:
                self.linked += len(piece.split())

    def _flush(self):
        words = "".join(self.pieces).split()
        if words:
            self.blocks.append((" ".join(words), len(words), min(self.linked, len(words)), self.heading, self.open[-1][1] if self.open else _OPEN))
        self.pieces, self.linked = [], 0

    def _pop(self):
        name, _ = self.open.pop()
        self.counts[name] -= 1

    def _start(self, name, attributes):
        if self.open and self.open[-1][0] == "p":
            self._pop()
        while self.open and self.open[-1][0] in _CLOSED_BY_LIKE.get(name, ()):
            self._pop()
        self.heading = name in _HEADINGS
        if name != "hr" and not self.heading:
            self.open.append((name, _region(name, attributes, self.open[-1][1] if self.open else _OPEN)))
            self.counts[name] = self.counts.get(name, 0) + 1

    def _end(self, name):
        self.in_link = self.heading = False
        if self.counts.get(name):
            while self.open[-1][0] != name:
                self._pop()
            self._pop()


def text_blocks(source):
    """The page's blocks as (text, words, linked words, heading, region)."""
    return _Page(source).blocks if source else []


FEATURES = ["words", "linked", "heading", "words_before", "linked_before", "words_after", "linked_after", "in_article", "in_none", "article_share"]


def features(sizes):
    """One row of ``FEATURES`` per block of a page, from its (words, linked words, heading, region)."""
    words, linked, heading, region = (np.array(c, float) for c in zip(*sizes))
    density = linked / words
    marked, unmarked = words[region > 0].sum(), words[region == 0].sum()
    before, after = np.append(0, words[:-1]), np.append(words[1:], 0)
    share = np.full(len(words), marked / (marked + unmarked) if marked else 0.0)
    return np.column_stack([words, density, heading, before, np.append(0, density[:-1]), after, np.append(density[1:], 0), region > 0, region < 0, share])


#: One page a line, one block a word: + is article and - is not, then its words, /words in links, a or x for a
#: region that is marked as article or as none, h for a heading.
LABELLED = """
-1/1x -1/1x -1/1x -1/1x -9x +9ah +20a +85a +12a +60a -9x
-1/1x -2/2x -1/1x -14x +6ah +3a +1a +2a +40a +1a -7x
-5/5x +12ah +300a +2a +5a +140a +1a -12x -45x
-1/1 -1/1 -1/1 +8ah +70a +30a +7/5a +4/4a +52a -8/1
-40x +3ah +8a -6/2x
-11 -25 +7ah +65a +120a -30 -50/4
-2/2 -3/3 -60 +10ah +15a +18/18a +90a -22/22 -9
-4/1x +11ah +6a +7a +5a -80x -64x -33x -12x
+1a
+5ah +2a
+30/30a +20a
-1/1 -1/1 -2/2 -1/1 +7h +64 +48 +9 +71 +33 -6/3 -9
-3/3 -2/2 -12/12 +9h +105 +22 +18 +51 +4 +38 -3/3 -4/4 -8
-2/2 -2/2 +6h +26 +80 +3h +44 +31 +95 -5/5 -7/7 -6/2
-1/1 -1/1 -1/1 +55 +12 +47 +60 -2/2 -3/3
-6/6x -8x +5h +41 +10 +36 +8 +29 -7x
-7/7x +4h +19 +12 +9 +14 +22 -8x
-20/20 +8h +130 +64 -15/15 -14/14 -16/14
-2/2x -5x +40 +38 +3 +2 +45 -12x
+12h +60
+75
+4h +14 +11 +25
-3/3 -3/3 -9/9 -1/1 +90 +4/1 +66 -18/13 -12/11 -4
-1/1x -1/1x +30/4 +55/6 +24/2 -9/7 -11x
-2/2 -3/3 -5 +9h +45 +50 -5h -6/6 -5/5 -8/8 -4
-1/1 -4 -2/2 +6h +88 +33 -3h -9/9 -10/10 -7/7 -2/2
-25x -38x +5h +52 +27 +6 +41 -4x -70x -18x
-6x +7h +9 +6 +8 +10 +7 -5x
""".split("\n")[1:-1]


#: Where regions are marked they count at any length, so such pages are learned from with these multiples of their words too.
_LENGTHS = (1, 8, 1 / 8)


def _labelled(page, times=1):
    blocks = [re.fullmatch(r"([+-])(\d+)(?:/(\d+))?([ax]?)(h?)", b).groups() for b in page.split()]
    sizes = [(max(1, int(int(words) * times)), max(1, int(int(linked) * times)) if linked else 0, bool(heading), {"a": 1, "x": -1}.get(region, 0))
             for _, words, linked, region, heading in blocks]
    return [(float(b[0] == "+"), row) for b, row in zip(blocks, features(sizes).tolist())]


def train(spark, pages=LABELLED, depth=8):
    """The tree as flat arrays; 1 keeps a block."""
    rows = [row for page in pages for times in (_LENGTHS if "a" in page else (1,)) for row in _labelled(page, times)]
    table = spark.createDataFrame(rows, "label double, features array<double>").coalesce(1)
    model = DecisionTreeClassifier(maxDepth=depth, maxBins=128, seed=1).fit(table.select("label", array_to_vector("features").alias("features")))
    folder = shared_folder(spark, "block-tree")
    model.save(folder)
    saved = spark.read.parquet(f"{folder}/data").collect()  # a node per row; at most two per labelled block
    nodes = [(r["id"], r["split"]["featureIndex"], (r["split"]["leftCategoriesOrThreshold"] or [0.0])[0], r["leftChild"], r["rightChild"], r["prediction"])
             for r in saved]
    return FlatTrees([nodes], [1.0])


def _kept(sources, tree):
    """For each page, its blocks and which of them are kept."""
    pages = [text_blocks(s) for s in sources]
    rows = [features([b[1:] for b in blocks]) for blocks in pages if blocks]
    kept = iter((tree.margin(np.concatenate(rows)) > 0.5).tolist() if rows else [])
    return [[(block, next(kept)) for block in blocks] for blocks in pages]


#: Characters of pages whose blocks are classified at a time.
_AT_ONCE = 1 << 23


def _sliced(batch, column):
    """The batch in pieces of about ``_AT_ONCE`` characters of a text column."""
    start, size = 0, 0
    for row, text in enumerate(batch.column(column)):
        size += len(text.as_py() or "")
        if size >= _AT_ONCE or row == batch.num_rows - 1:
            yield batch.slice(start, row + 1 - start)
            start, size = row + 1, 0


def main_text(pages):
    """page_id, url, text and n_chars of every page."""
    tree = train(pages.sparkSession)
    kind = dict(pages.dtypes)

    def extract(batches):
        for whole in batches:
            for batch in _sliced(whole, 2):
                texts = ["\n\n".join(b[0] for b, keep in blocks if keep) for blocks in _kept(batch.column(2).to_pylist(), tree)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(extract, f"page_id {kind['page_id']}, url {kind['url']}, text string, n_chars bigint")


def classified_blocks(pages):
    """One row per block: page_id, place (from 0), text, words, linked, heading, region and kept."""
    tree = train(pages.sparkSession)
    layout = "page_id bigint, place int, text string, words bigint, linked bigint, heading boolean, region int, kept boolean"
    schema = arrow_schema(layout)

    def extract(batches):
        for whole in batches:
            for batch in _sliced(whole, 1):
                found = _kept(batch.column(1).to_pylist(), tree)
                yield arrow_batch([(page_id, i, *block, keep) for page_id, blocks in zip(batch.column(0).to_pylist(), found)
                                   for i, (block, keep) in enumerate(blocks)], schema)

    return pages.select("page_id", "html").mapInArrow(extract, layout)
