"""Main text of web pages by site style trees.

Every page is parsed into a tree of presentation nodes (tag, class and role,
without numbers).  The trees of one host are merged: a style node is a path of
presentation nodes, and over the pages of the host it gathers the child
sequences and the contents seen under it.  A node's importance joins the
entropy of its presentation (log base the number of pages, as in a site style
tree) and of its contents: a content that many pages share says little, one
that is found on a single page says most.  Pages are
counted once per article, so copies under headings or bylines of their own do
not make an article look like a notice: pages are one article if they share
the longest block of the style with the most text (of the next style, if over
``WIDE`` of the host's pages have that block: a notice).  Nodes of hosts with
few articles lean on the tree merged over all hosts.  From each page the low-importance branches
are cut; branches whose tag, class or role names them as menu, header, footer,
side bar, notice, advert, form or comments go whatever their importance.  A name
is no verdict over the article itself: a form, or a wrapper whose class tells of
a side bar, stays if it holds the page's article or main element or nearly all
of its running text, and so does the header of the block that has the paragraphs.

What is left is cut into blocks at block-level tags; references are decoded,
white space inside a block becomes one blank, blocks are joined by two line
ends in page order.  Importance never leaves a page with no text at all.

Defined cases: null html is empty text; a null url is the host ''; unclosed and
stray tags are repaired, markup cut off at the end is dropped; a page of bare
text is one block; only an unclosed script, style, textarea or title takes the
rest of its page; a null id and repeated rows are extracted each; an empty
table gives no rows.  Hosts may hold any share of the pages: contents are
counted per (host, node, content) before they meet per node.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from procura.llm.common import map_batches, read_table, stage, texts_of
from procura.llm.urls import host_of

#: Weight of the contents against the presentation in a node's importance.
CONTENT_WEIGHT = 0.9
#: Importance under which a branch is cut.
LEAST = 0.45
#: Share of a host's pages over which a block tells no article.
WIDE = 0.9
#: Styles of a page, by length of text, whose longest blocks may tell its article.
TELLING = 4
#: Length of a block that is running text, not a menu entry or a label.
RUNNING = 100
#: A named branch is the page's body if it has so many times the text beside it.
BODY_TIMES = 4
#: Depth of the style tree; styles below are not told apart.
MAX_DEPTH = 48
#: Articles at which a host's own tree weighs as much as the tree of all hosts.
BACKING_PAGES = 50

#: Attributes as in the HTML standard: a quote opens a value right after "="
#: only, elsewhere it is an ordinary character.
_ATTRIBUTES = (r"(?:[\s/]+|[^\s/>][^\s/>=]*(?:\s*=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|[^\s>\"'][^\s>]*)?)?)*+")
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
                    rf"<(/?)([A-Za-z][^\s/>]*)({_ATTRIBUTES})(>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"\b(class|role|id)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math xmp".split())
#: Of these, an element without end takes the rest of the page.
ENDLESS = frozenset("script style textarea title".split())
#: Foreign elements may close themselves; a tag of the page ends an open one.
FOREIGN = frozenset("svg math".split())
_RAW_END = {tag: re.compile(rf"</{tag}\b[^>]*>", re.I) for tag in RAW}
_HOLDS_HTML = re.compile(r"<(?:foreignobject|desc|annotation-xml)\b", re.I)
_BREAKOUT = re.compile(r"<(?:blockquote|body|br|center|code|dd|div|dl|dt|em|embed|h[1-6]|head|hr|img|li|listing|menu|meta|ol|p|"
                       r"pre|ruby|small|span|strong|table|ul)(?=[\s/>])", re.I)
BLOCK = frozenset(("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre "
                   "section select summary table tbody td tfoot th thead tr ul").split())
#: Tags that are no article text wherever they stand.
DROPPED = frozenset("head nav footer aside button select dialog menu canvas object audio video".split())
#: Class, id and role words that name a branch as no article text: these also
#: name layouts ("content-sidebar-wrap"), so the branch may be the page's body,
LAYOUT_NAMED = frozenset(("banner nav navbar navigation menu breadcrumb breadcrumbs sidebar side aside widget notice popup "
                          "modal overlay form login signup search share sharing social pagination pager toolbar masthead "
                          "topbar skip contentinfo complementary alert").split())
#: and these do not.
NAMED = LAYOUT_NAMED | frozenset((
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion footer cookie cookies consent gdpr "
    "comment comments disqus reply replies respond reactions newsletter subscribe subscription related recommended").split())
#: Names that begin so tell how an element is laid out ("has-sidebar"),
LAYOUT = frozenset("has no with without".split())
#: names that end so the state of a page ("comments-open").
STATE = frozenset("open opened closed enabled disabled allowed".split())
#: Ordinary words, which name a branch alone or with words of the second kind.
ORDINARY = frozenset("alert notice side form menu banner search share social skip".split())
PARTS = frozenset(("box bar list item items container wrap wrapper section block panel area inner outer group button buttons "
                   "link links icon icons widget info warning success danger error primary secondary dismissible dismissable top "
                   "bottom main site page global col column rail strip text title header footer content message msg body nav "
                   "left right toggle input field fields row form bar cta menu media fixed sticky floating mobile").split())
FRAME = frozenset("html body main article".split())
#: Opening one of these closes an open one of the same set, up to a border.
CLOSES = {"p": ("p",), "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"),
          "td": ("td", "th", "p"), "th": ("td", "th", "p"), "option": ("option",)}
BORDER = frozenset(("body html div article section main aside nav header footer ul ol dl table form blockquote td th "
                    "figure").split())
_SPLIT_NAME = re.compile(r"[^a-z]+")


def _named(words: list[str]) -> set[str]:
    """The words of a class, id or role that give its element away."""
    if not words or words[0] in LAYOUT or words[-1] in STATE:
        return set()
    return {w for w in words if w in NAMED and (w not in ORDINARY or all(x in PARTS or x in NAMED for x in words))}


def style_of(tag: str, attributes: str) -> tuple[str, set[str]]:
    """Presentation of an element, and the words that give it away."""
    names, shown = set(), []
    for m in _ATTRIBUTE.finditer(attributes):
        for name in (m[2] or m[3] or m[4] or "").lower().split():
            words = [w for w in _SPLIT_NAME.split(name) if w]
            names |= _named(words)
            if m[1].lower() != "id":
                shown += words
    return tag + "".join(f".{w}" for w in sorted(set(shown))), names


class Branches:
    """Branches of a page that tag or name give away, by number in page order.
    ``mild`` ones may turn out to be the page's body (see ``spared``)."""

    def __init__(self):
        self.parent: list[int] = []
        self.mild: list[bool] = []
        self.article: list[bool] = []   # holds an article or main element of its own
        self.header: list[int] = []     # element that a header stands in, else -1
        self.free_article = False       # such an element stands in no branch

    def open(self, parent: int, mild: bool, header: int = -1) -> int:
        self.parent.append(parent)
        self.mild.append(mild)
        self.article.append(False)
        self.header.append(header)
        return len(self.parent) - 1

    def note_article(self, branch: int) -> None:
        self.free_article |= branch < 0
        while branch >= 0 and not self.article[branch]:
            self.article[branch] = True
            branch = self.parent[branch]

    def spared(self, blocks: list[tuple[str, list[tuple[str, int]]]], paragraphs: set[int]) -> set[int]:
        """The branches that are no boilerplate: -1 (no branch), headers of the
        element that has the paragraphs, and the page's body."""
        kept, n = {-1}, len(self.parent)
        if not n:
            return kept
        beside, own = 0, [0] * n    # text in no branch; running text in each branch
        for _, pieces in blocks:
            running = sum(len(t.strip()) for t, _ in pieces) >= RUNNING
            for t, k in pieces:
                if k < 0:
                    beside += len(t.strip())
                elif running:
                    own[k] += len(t.strip())
        deep = own.copy()
        for k in range(n - 1, -1, -1):  # mild branches inside belong to a branch's text
            if self.mild[k] and self.parent[k] >= 0:
                deep[self.parent[k]] += deep[k]
        for k in range(n):
            body = self.mild[k] and not self.free_article and (
                self.article[k] and deep[k] > beside or deep[k] > BODY_TIMES * beside)
            if self.parent[k] in kept and (body or self.header[k] in paragraphs):
                kept.add(k)
                beside += own[k]
        return kept


def blocks_of(html: str) -> list[tuple[str, str]]:
    """(style path, text) of each text block in page order, without the text
    of branches that tag, class or role give away."""
    out: list[tuple[str, list[tuple[str, int]]]] = []
    open_: list[tuple[str, str, int, int, int]] = []  # tag, path, its depth, branch, element
    text: list[tuple[str, int]] = []
    branches, paragraphs, elements = Branches(), set(), 0
    n_open: Counter = Counter()
    at = 0

    def end_block():
        nonlocal text
        if text:
            out.append((open_[-1][1] if open_ else "", text))
            text = []

    def close(k):
        while len(open_) > k:
            if open_[-1][0] in BLOCK:
                end_block()
            n_open[open_.pop()[0]] -= 1

    def say(piece):
        if piece:
            text.append((piece, open_[-1][3] if open_ else -1))

    for m in _TOKEN.finditer(html):
        if m.start() < at:
            continue
        say(html[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if not m[4]:  # cut off inside the tag
            break
        if m[1]:
            k = next((i for i in range(len(open_) - 1, -1, -1) if open_[i][0] == tag), None) if n_open[tag] else None
            if k is not None and not (tag == "p" and any(open_[i][0] in BORDER for i in range(k + 1, len(open_)))):
                close(k)
            elif tag in BLOCK:
                end_block()
            continue
        if tag == "br":
            say("\n")
            continue
        if tag in RAW:
            if tag in FOREIGN and m[3].rstrip().endswith("/"):
                continue
            end = _RAW_END[tag].search(html, at)
            if not end:
                if tag in ENDLESS:
                    break
                continue
            out_at = _BREAKOUT.search(html, at, end.start()) if tag in FOREIGN else None
            if out_at and not _HOLDS_HTML.search(html, at, out_at.start()):
                at = out_at.start()
            else:
                at = end.end()
            continue
        if tag in BLOCK:
            k, ends = len(open_), CLOSES.get(tag, ("p",))
            if any(n_open[t] for t in ends):
                for i in range(len(open_) - 1, -1, -1):
                    if open_[i][0] in ends:
                        k = i
                    elif open_[i][0] in BORDER:
                        break
            close(k)  # formatting left open in a closed paragraph ends with it
            end_block()
        if tag in VOID or m[3].rstrip().endswith("/") and tag not in BLOCK:
            continue
        style, names = style_of(tag, m[3])
        _, path, depth, branch, inside = open_[-1] if open_ else ("", "", 0, -1, -1)
        elements += 1
        if tag == "p" and open_:
            paragraphs.add(inside)
        if tag in DROPPED or names and tag not in FRAME or tag == "form":
            branch = branches.open(branch, tag not in DROPPED and names <= LAYOUT_NAMED)
        elif tag == "header" and not any(o[0] in ("article", "main") for o in open_):
            branch = branches.open(branch, False, inside if open_ and open_[-1][0] not in ("html", "body") else -1)
        elif tag in ("article", "main") and not names:
            branches.note_article(branch)
        if tag in BLOCK and depth < MAX_DEPTH:
            path, depth = f"{path}/{style}", depth + 1
        open_.append((tag, path, depth, branch, elements))
        n_open[tag] += 1
    else:
        say(html[at:])
    close(0)
    end_block()
    kept = branches.spared(out, paragraphs)
    done = ((path, " ".join(unescape("".join(t for t, k in pieces if k in kept)).split())) for path, pieces in out)
    return [(path, joined) for path, joined in done if joined]


def _hosts(pages: DataFrame) -> DataFrame:
    return pages.select(F.col("page_id").cast("long"), "url", host_of(F.col("url")).alias("host"), "html")


def telling(blocks: list[tuple[str, str]]) -> list[str]:
    """Longest block of each of the styles with the most text, then all text."""
    size: dict[str, int] = {}
    longest: dict[str, str] = {}
    for path, text in blocks:
        size[path] = size.get(path, 0) + len(text)
        longest[path] = max(longest.get(path, ""), text, key=len)
    first = sorted(size, key=lambda path: (-size[path], path))[:TELLING]
    return [longest[path] for path in first] + ["\n\n".join(text for _, text in blocks)]


def node_rows(pages: DataFrame) -> DataFrame:
    """A row for each page and style node in it: ``host``, ``node``, the
    hashes ``children`` (of the styles under it) and ``contents``, and for the
    page's article ``telling`` (``first`` marks one row a page)."""
    def run(batches):
        import xxhash

        def signed(text):
            return int(np.uint64(xxhash.xxh64_intdigest(text)).view(np.int64))

        for batch in batches:
            out = {k: [] for k in ("host", "node", "children", "contents", "telling", "first")}
            for host, html in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                under: dict[str, list[tuple[str, int]]] = {}
                blocks = blocks_of(html)
                for path, text in blocks:
                    steps, content = path.split("/"), signed(text)
                    for depth in range(2, len(steps) + 1):
                        under.setdefault("/".join(steps[:depth]), []).append((path, content))
                tells = [signed(text) for text in telling(blocks)] if under else []
                for i, (node, found) in enumerate(under.items()):
                    out["host"].append(host)
                    out["node"].append(node)
                    out["children"].append(signed("|".join(sorted({path[len(node):] for path, _ in found}))))
                    out["contents"].append(sorted({content for _, content in found}))
                    out["telling"].append(tells)
                    out["first"].append(i == 0)
            yield out

    return map_batches(_hosts(pages).select("host", "html"), run, "host string, node string, children long, "
                       "contents array<long>, telling array<long>, first boolean")


def with_articles(nodes: DataFrame) -> DataFrame:
    """``nodes`` with the ``article`` of each row's page: the first telling
    block that is not on too many pages of the host, else the whole text."""
    firsts = nodes.filter("first")
    pages = firsts.groupBy("host").agg(F.count("*").alias("pages"))
    wide = (firsts.select("host", F.explode(F.array_distinct("telling")).alias("tell"))
            .groupBy("host", "tell").agg(F.count("*").alias("n")).filter("n > 1").join(pages, "host")
            .filter(F.col("n") > WIDE * F.col("pages")).groupBy("host").agg(F.collect_set("tell").alias("wide")))
    own = F.filter("telling", lambda t: ~F.coalesce(F.array_contains("wide", t), F.lit(False)))
    return nodes.join(stage(wide, "wide"), "host", "left").withColumn(
        "article", F.coalesce(F.get(own, F.lit(0)), F.element_at("telling", -1))).select(
        "host", "node", "children", "contents", "article")


def importance(nodes: DataFrame, by: list[str]) -> DataFrame:
    """Articles ``m`` and importance of each style node of the trees merged
    ``by`` (host and node, or node alone).  What the pages of one ``article``
    share counts once; without that column each row is an article."""
    def counted_by(rows, key):
        if "article" in rows.columns:
            rows = rows.select(*by, "article", key).distinct()
        return rows.groupBy(*by, key).agg(F.count("*").alias("n"))

    def entropy_sums(counts, total, nlogn):
        return counts.groupBy(*by).agg(F.sum("n").alias(total),
                                       F.sum(F.col("n") * F.log(F.col("n").cast("double"))).alias(nlogn))

    shown = entropy_sums(counted_by(nodes, "children"), "s", "slogs")
    if "article" in nodes.columns:
        articles = nodes.select(*by, "article").distinct().groupBy(*by).agg(F.count("*").alias("m"))
        shown = shown.join(articles, by)
    else:
        shown = shown.withColumn("m", F.col("s"))
    log = F.log(F.greatest(F.col("m"), F.lit(2)).cast("double"))
    # -sum p log_s p over the presentations; 1 for a node of one article
    s = F.col("s").cast("double")
    style = F.when(F.col("m") <= 1, 1.0).otherwise((F.log(s) - F.col("slogs") / s) / F.log(F.greatest(s, F.lit(2.0))))
    counted = entropy_sums(counted_by(nodes.withColumn("content", F.explode("contents")), "content"), "f", "klogk")
    # a content in k of m articles has entropy log_m k; the mean over all contents
    content = F.when(F.col("m") <= 1, 1.0).otherwise(1 - F.col("klogk") / F.col("f") / log)
    value = CONTENT_WEIGHT * content + (1 - CONTENT_WEIGHT) * style
    return shown.join(counted, by).select(*by, "m", value.alias("importance"))


def node_values(nodes: DataFrame) -> DataFrame:
    """Importance of each host's style nodes, few articles leaning on all hosts.
    Both trees are stored, so the shuffles of one go before the other's come."""
    own = stage(importance(nodes, ["host", "node"]), "own").toDF("host", "node", "m", "own")
    every = stage(importance(nodes, ["node"]), "every").select("node", F.col("importance").alias("every"))
    share = F.col("m") / (F.col("m") + BACKING_PAGES)
    return own.join(every, "node").select("host", "node", (share * F.col("own") + (1 - share) * F.col("every")).alias("value"))


def main_text(pages: DataFrame, least: float = LEAST) -> DataFrame:
    """``page_id``, ``url`` and ``html`` -> the main ``text`` of every page.

    The pages are parsed twice, for the trees and for the text, which is
    cheaper than storing the blocks in between.  The hosts' low nodes are a
    stored table: the optimizer broadcasts it while its files are under the
    threshold, else the join is shuffled and skewed hosts are split."""
    nodes = stage(node_rows(pages), "nodes")
    low = stage(node_values(with_articles(nodes)).filter(F.col("value") < least)
                .groupBy("host").agg(F.collect_set("node").alias("low")), "low-nodes")

    def run(batches):
        for batch in batches:
            html, cut, texts = texts_of(batch.column(2)), batch.column(3).to_pylist(), []
            for page, nodes_ in zip(html, cut):
                drop = tuple(n + "/" for n in nodes_ or ())
                blocks = blocks_of(page)
                # a host of copies shares all its contents: a page is never cut to nothing
                left = [t for path, t in blocks if not (path + "/").startswith(drop)] or [t for _, t in blocks]
                texts.append("\n\n".join(left))
            yield {"page_id": batch.column(0), "url": batch.column(1), "text": texts, "n_chars": [len(t) for t in texts]}

    joined = _hosts(pages).join(low, "host", "left").select("page_id", "url", "html", "low")
    return map_batches(joined, run, "page_id long, url string, text string, n_chars long")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(read_table(spark, sf_dir, "pages"))
