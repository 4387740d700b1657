"""Main text of web pages: boosted trees score DOM nodes, a tree decoder picks the text.

Training rows come from a bounded sample of pages. A node is a positive example if it lies in
an article or main element, or around one; pages that mark neither are labelled by text length
and link share. Scores are log-odds times text length. Decoding keeps the set of open nodes with
the greatest total such that nothing below a closed node is kept: a node is open only if its
parent is, and a subtree is closed if keeping the best of it gains nothing.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crossmart.llm.common import stage, unit_hash

SAMPLE_PAGES = 300
TREES, DEPTH = 12, 3
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg select".split())
#: Raw elements that last to the end of the page without an end tag; the others then end with their parent.
ENDLESS = frozenset("script style textarea title iframe".split())
#: Elements in which no text is shown, however deep.
HIDDEN = frozenset("noscript template svg select option button".split())
SILENT = frozenset("script style noscript template iframe svg head title select option button textarea form".split())
INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i ins kbd label mark q s samp small span strong sub sup time tt u var wbr".split())
#: Elements whose start tag ends an open p.
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main nav ol p pre section table ul".split())
#: An open element that a start tag of the same family ends.
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
GOOD = re.compile(r"article|content|entry|main|post|story|body|text", re.I)
BAD = re.compile(
    r"\bads?\b|advert|banner|breadcrumb|comment|cookie|consent|footer|form|header|menu|modal|nav|newsletter|notice|popup|promo|related|"
    r"share|sidebar|social|sponsor|subscribe|toolbar|widget|disqus|reply|replies", re.I)
#: Class names of the blocks that are added to sample pages as negative examples.
DECOYS = ("comments", "sidebar", "related", "newsletter", "cookie-notice", "advert", "promo", "share-bar", "menu")
BAD_TAGS = frozenset("nav header footer aside form menu dialog".split())
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|[^<]+|<", re.S)
END_TAG = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I) for tag in RAW}
ATTRIBUTE = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
SPACE = re.compile(r"\s+")
FEATURES = (
    "depth", "own_chars", "subtree_chars", "density", "link_share", "n_children", "siblings", "same_siblings", "place",
    "good_token", "bad_token", "under_good", "under_bad", "is_p", "is_heading", "is_list", "is_div", "is_a", "in_article", "around_article",
)


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "depth", "own", "total", "linked", "tags", "inside", "around", "bad", "hidden")

    def __init__(self, tag: str, attrs: str, parent: Node | None):
        self.tag, self.parent, self.children = tag, parent, []
        found = ATTRIBUTE.findall(attrs) if attrs else ()
        self.attrs = " ".join(x.strip("\"'") for x in found)
        self.depth = parent.depth + 1 if parent else 0
        self.own = self.total = self.linked = 0
        self.tags, self.around = 1, False
        self.hidden = bool(parent and parent.hidden) or tag in HIDDEN
        self.inside = bool(parent and parent.inside) or tag in ("article", "main") or "articleBody" in self.attrs
        self.bad = bool(parent and parent.bad) or tag in BAD_TAGS or bool(self.attrs and BAD.search(self.attrs) and not GOOD.search(self.attrs))


def parse(page: str | None) -> tuple[list[Node], list[tuple[int, str]]]:
    """Nodes in document order, and the page's text pieces as (node, text); a break is a piece of one space.

    Unclosed elements end with their parent, end tags without a start are ignored, an open
    p or list item ends where HTML says so. Text of scripts and the like is no text; what is
    between their start and the next end tag of the same name is not read as markup.
    """
    page = page or ""
    root = Node("#root", "", None)
    nodes, at, pieces, place, endless = [root], [0], [], 0, set()
    while m := TOKEN.match(page, place):
        place = m.end()
        close, tag, attrs = m.group(1), m.group(2), m.group(3)
        if tag is None:
            if m.group()[0] != "<" or m.group() == "<":
                top = nodes[at[-1]]
                if not (top.hidden or top.tag in SILENT):
                    text = references.unescape(m.group())
                    pieces.append((at[-1], text))
            continue
        tag = tag.lower()
        if close:
            for i in range(len(at) - 1, 0, -1):
                if nodes[at[i]].tag == tag:
                    del at[i:]
                    break
                if tag in INLINE and nodes[at[i]].tag not in INLINE:
                    break
            continue
        if tag in ENDS_P:
            for i in range(len(at) - 1, 0, -1):
                if nodes[at[i]].tag == "p":
                    del at[i:]
                    break
                if nodes[at[i]].tag not in INLINE:
                    break
        elif tag in SIBLINGS:
            for i in range(len(at) - 1, 0, -1):
                if nodes[at[i]].tag in SIBLINGS[tag]:
                    del at[i:]
                    break
                if nodes[at[i]].tag in ("ul", "ol", "dl", "table", "select", "datalist"):
                    break
        if tag in VOID:
            if tag in ("br", "hr"):
                pieces.append((at[-1], " "))
            continue
        if tag not in INLINE:
            pieces.append((at[-1], " "))
        node = Node(tag, attrs, nodes[at[-1]])
        nodes[at[-1]].children.append(len(nodes))
        at.append(len(nodes))
        nodes.append(node)
        if attrs.endswith("/") and tag not in INLINE and tag in RAW:
            at.pop()
        elif tag in RAW:
            end = None if tag in endless else END_TAG[tag].search(page, place)
            if not end:
                endless.add(tag)
            if end or tag in ENDLESS:
                place = end.end() if end else len(page)
                at.pop()
    return nodes, pieces


def features(nodes: list[Node], pieces: list[tuple[int, str]]) -> np.ndarray:
    """One row of ``FEATURES`` a node."""
    for i, text in pieces:
        nodes[i].own += len(text.strip())
    for node in reversed(nodes):
        node.total += node.own
        if node.tag == "a":
            node.linked = node.total
        if node.tag in ("article", "main"):
            node.around = True
        up = node.parent
        if up:
            up.total += node.total
            up.linked += node.linked
            up.tags += node.tags
            up.around |= node.around
    out = np.zeros((len(nodes), len(FEATURES)))
    under_good, under_bad = [False] * len(nodes), [False] * len(nodes)
    for i, node in enumerate(nodes):
        same = {}
        for c in node.children:
            same[nodes[c].tag] = same.get(nodes[c].tag, 0) + 1
        for place, c in enumerate(node.children):
            child = nodes[c]
            good, bad = bool(GOOD.search(child.attrs)), bool(BAD.search(child.attrs)) or child.tag in BAD_TAGS
            under_good[c], under_bad[c] = under_good[i] or good, under_bad[i] or bad
            out[c] = (
                child.depth, child.own, child.total, child.total / child.tags, child.linked / max(1, child.total), len(child.children),
                len(node.children), same[child.tag], place / len(node.children), good, bad, under_good[c], under_bad[c], child.tag == "p",
                child.tag[:1] == "h" and child.tag[1:].isdigit(), child.tag in ("ul", "ol", "li"), child.tag == "div", child.tag == "a",
                child.inside, child.around)
    return out


def with_decoy(page: str, nodes: list[Node], pieces: list[tuple[int, str]]) -> str:
    """The page with its article's text once more in a block that is no main text, inside or after the article.

    Few pages have long comments or notices, so the sample would never show that length alone
    does not make a main text.
    """
    copied = "".join(f"<p>{references.escape(t)}</p>" for i, t in pieces if nodes[i].inside and t != " ")
    block = f'<div class="{DECOYS[len(page) % len(DECOYS)]}">{copied}</div>'
    inside = page.rfind("</article>") if len(page) % 2 else -1
    return page[:inside] + block + page[inside:] if inside > 0 else page + block


def weak_labels(nodes: list[Node]) -> list[int]:
    """1 for nodes of the main text and around it, see the module text."""
    marked = any(n.inside for n in nodes)
    if marked:
        return [int((n.inside or n.around) and not n.bad and not n.hidden and n.tag not in SILENT) for n in nodes]
    return [int(not n.bad and not n.hidden and n.tag not in SILENT and n.total >= 25 and n.linked < 0.3 * n.total) for n in nodes]


def logits(trees: list[dict], x: np.ndarray) -> np.ndarray:
    """Summed outputs of the trees for every row; MLlib's margin is doubled into log-odds."""
    total = np.zeros(len(x))
    for tree in trees:
        at = np.zeros(len(x), dtype=np.int64)
        for _ in range(DEPTH):
            split = tree["feature"][at]
            left = x[np.arange(len(x)), np.maximum(split, 0)] <= tree["threshold"][at]
            at = np.where(split < 0, at, np.where(left, tree["left"][at], tree["right"][at]))
        total += tree["weight"] * tree["value"][at]
    return 2 * total


def decode(nodes: list[Node], scores: np.ndarray) -> list[bool]:
    """The open nodes: the best total of score x own characters with every open node under open nodes."""
    gain = [0.0] * len(nodes)
    for i in range(len(nodes) - 1, -1, -1):
        own = float(scores[i]) * max(nodes[i].own, 0.01)
        gain[i] = own + sum(g for c in nodes[i].children if (g := gain[c]) > 0)
    open_ = [False] * len(nodes)
    open_[0] = True
    for i, node in enumerate(nodes):
        if open_[i]:
            for c in node.children:
                open_[c] = gain[c] > 0
    return open_


def main_text(page: str | None, trees: list[dict]) -> str:
    nodes, pieces = parse(page)
    if len(nodes) == 1:
        return SPACE.sub(" ", "".join(t for _, t in pieces)).strip()
    scores = logits(trees, features(nodes, pieces))
    chosen = decode(nodes, scores)
    return SPACE.sub(" ", "".join(t if t != " " else " " for i, t in pieces if chosen[i] or t == " ")).strip()


def flat(node, out: list[list]) -> int:
    """A JVM tree node and all below it, appended as [feature, threshold, left, right, value]; returns its place."""
    at = len(out)
    out.append([-1, 0.0, at, at, node.prediction()])
    if node.subtreeDepth() > 0:
        out[at][:2] = [node.split().featureIndex(), node.split().threshold()]
        out[at][2] = flat(node.leftChild(), out)
        out[at][3] = flat(node.rightChild(), out)
    return at


def train(pages: DataFrame, key: str = "page_id", html: str = "html", sample: int = SAMPLE_PAGES) -> list[dict]:
    """Boosted trees from the nodes of about ``sample`` pages, drawn by a hash of their id and content.

    Rows of one id with other contents are drawn apart, equal rows count once.
    An empty sample, or one without both kinds of nodes, gives no tree; then every node scores
    0, and nothing is kept.
    """
    share = F.lit(float(sample)) / F.greatest(F.lit(1), F.lit(pages.count()))
    known = pages.select(F.col(key).cast("string").alias("id"), F.col(html).alias("html"), F.md5(F.encode(html, "UTF-8")).alias("digest"))
    drawn = known.where(unit_hash(F.lit("pages"), F.col("id"), F.col("digest")) < share).dropDuplicates(["id", "digest"]).select("id", "html")

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, page in zip(batch["id"], batch["html"], strict=True):
                nodes, pieces = parse(page)
                for shown in (page, with_decoy(page or "", nodes, pieces)):
                    nodes, pieces = parse(shown)
                    x, y = features(nodes, pieces)[1:], weak_labels(nodes)[1:]
                    yield pd.DataFrame({"id": name, "label": np.array(y, dtype=float), "x": list(x)}, columns=["id", "label", "x"])

    found = drawn.mapInPandas(rows, "id string, label double, x array<double>")
    nodes = stage(found.select("label", "x").repartition(1).sortWithinPartitions("label", "x"), "nodes")  # a bounded sample meets here, the pages are read by many tasks
    if nodes.select("label").distinct().count() < 2:
        return []
    ready = nodes.select("label", array_to_vector("x").alias("features"))
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=64, stepSize=0.3, seed=7).fit(ready)
    out = []
    for tree, weight in zip(model.trees, model.treeWeights, strict=True):
        grown: list[list] = []
        flat(tree._call_java("rootNode"), grown)
        feature, threshold, left, right, value = map(np.array, zip(*grown, strict=True))
        out.append({"feature": feature.astype(int), "threshold": threshold.astype(float), "left": left.astype(int), "right": right.astype(int), "value": value.astype(float), "weight": float(weight)})
    return out


def extracted(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", trees: list[dict] | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every page; null and empty pages give an empty text.

    A page without any element is text itself. Repeated rows give repeated rows; an empty
    table gives no rows; other columns are not read.
    """
    grown = train(pages, key, html) if trees is None else trees

    @F.pandas_udf("string")
    def extract(batch: pd.Series) -> pd.Series:
        return pd.Series([main_text(page, grown) for page in batch], dtype=object)

    found = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), extract(F.col(html)).alias("text"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
