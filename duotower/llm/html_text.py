"""Operator 9, HTML extraction: flat text blocks classified by a decision tree.

A page is cut into flat blocks of text at block-level tags. A block's features are its words and link density, those
of its neighbours, and what its surroundings are called (element names, class and id words). A decision tree, trained on
the small labelled table in ``labelled_pages``, decides which blocks are main text. A page is one row all the way, so
there is no shuffle.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duotower.llm.common import columns
from duotower.llm.labelled_pages import LABELLED_PAGES

MAX_DEPTH = 6
FEATURES = ("words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after", "in_article", "page_has_article",
            "in_furniture", "heading", "sentence")

# Element names: fixed values of the HTML standard.
_SKIPPED = {"script", "style", "noscript", "template", "svg", "iframe", "object", "canvas", "math", "head", "textarea", "select", "audio", "video"}
_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp"}
_FURNITURE = {"nav", "header", "footer", "aside", "form", "button", "menu", "dialog", "fieldset", "label", "legend", "option"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "mark", "q", "rp", "rt",
           "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "br", "input", "picture", "source"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# Words of class, id and role that name page furniture.
_FURNITURE_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising banner banners sponsor sponsored promo promotion promoted commercial
nav navbar navigation menu menus breadcrumb breadcrumbs header masthead topbar footer foot copyright colophon sidebar side aside widget widgets rail
cookie cookies consent gdpr notice notices alert popup modal overlay toast disclaimer newsletter subscribe subscription signup login search searchbox form
comment comments commentlist respond disqus reply replies discussion share sharing social related recommended recommendations pagination pager
toolbar tags hidden complementary contentinfo""".split())
# Words that make a class name say what a box holds or lacks, or that it is a wrapper, instead of what it is.
_NEGATED = frozenset("has no not with without hide show".split())
_WRAPPERS = frozenset("wrap wrapper wrapping container layout".split())
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""(?:^|\s)(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I | re.S)
_END = re.compile(r"""[.!?:;…。！？]["'”’»)\]]*$""")


class Block:
    __slots__ = ("text", "words", "linked", "article", "furniture", "heading")


def _furniture(name: str, attrs: str) -> bool:
    if name in _FURNITURE:
        return True
    for key, value in _ATTR.findall(attrs) if "=" in attrs or "hidden" in attrs.lower() else ():
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
        if key in ("class", "id", "role") and any(_names_furniture(word) for word in value.split()):
            return True
    return False


def _names_furniture(word: str) -> bool:
    """Whether a class or id names furniture: ``sidebar-left`` does; ``no-sidebar``, ``has-header`` and ``content-sidebar-wrap`` do not."""
    parts = [p for p in re.split(r"[^a-z]+", word) if p]
    if not _WRAPPERS.isdisjoint(parts):
        return False
    return any(p in _FURNITURE_WORDS and (not k or parts[k - 1] not in _NEGATED) for k, p in enumerate(parts))


def blocks_of(page: str | None) -> list[Block]:
    """The flat text blocks of a page, in order; blocks without text are left out."""
    out: list[Block] = []
    text: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, bool, bool, bool]] = []      # name, in article, in furniture, skipped
    opened: Counter[str] = Counter()                    # how often a name is on the stack: end tags without a partner cost nothing
    article = furniture = skipped = False
    in_link = 0
    heading = False
    page = page or ""

    def close():
        words = html.unescape("".join(text)).split()
        if words:
            b = Block()
            b.text, b.words = " ".join(words), len(words)
            b.linked = len(html.unescape("".join(linked)).split())
            b.article, b.furniture, b.heading = article, furniture, heading
            out.append(b)
        text.clear()
        linked.clear()

    def add(s: str):
        if s and not skipped:
            text.append(s)
            # white space between two links keeps their words apart
            linked.append(s if in_link else " " if any(map(str.isspace, s)) else "")

    at, raw_end = 0, None
    while True:
        m = _TAG.search(page, at)
        add(page[at:m.start() if m else len(page)])
        if not m:
            break
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        name = name.lower()
        closing, attrs = bool(m[1] or m[4]), m[3] or m[6] or ""
        if name in _INLINE:
            if name == "br":
                add(" ")
            elif name == "a":
                in_link = 0 if closing else 1
            continue
        if not skipped or closing:
            close()
        if closing:
            while opened[name]:     # what stood inside ends with it
                last, article, furniture, skipped = stack.pop()
                opened[last] -= 1
                if last == name:
                    break
            heading = heading and name not in _HEADINGS
            in_link = 0
            continue
        if name in _VOID or attrs.rstrip().endswith("/"):
            continue
        if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and stack and stack[-1][0] == name:
            article, furniture, skipped = stack.pop()[1:]      # their end tags may be left out
            opened[name] -= 1
        stack.append((name, article, furniture, skipped))
        opened[name] += 1
        if name in ("article", "main") and not article:
            article, furniture = True, False        # the outermost one is the main text, whatever its wrappers are called
        else:
            furniture = furniture or (name not in ("body", "html") and _furniture(name, attrs))
        skipped = skipped or name in _SKIPPED
        heading = name in _HEADINGS
        if name == "body":
            skipped = False
        if name in _RAW:
            raw_end = re.compile(rf"</{name}\b", re.I).search(page, at)
            if name != "title" and name != "textarea":
                at = raw_end.start() if raw_end else len(page)
            else:
                add(page[at:raw_end.start() if raw_end else len(page)])
                at = raw_end.start() if raw_end else len(page)
    close()
    return out


def features_of(blocks: list[Block]) -> np.ndarray:
    """One row of ``FEATURES`` per block."""
    n = len(blocks)
    words = np.array([0, *[b.words for b in blocks], 0], float)
    density = np.array([0, *[b.linked / b.words for b in blocks], 0], float)
    has_article = float(any(b.article and not b.furniture for b in blocks))
    own = [[float(b.article), has_article, float(b.furniture), float(b.heading), float(bool(_END.search(b.text)))] for b in blocks]
    return np.column_stack([words[1:-1], density[1:-1], words[:-2], density[:-2], words[2:], density[2:], np.array(own).reshape(n, 5)])


def train_tree(spark, labelled=LABELLED_PAGES, max_depth: int = MAX_DEPTH):
    """The decision tree as nested (feature, threshold, left, right) tuples with 0.0 / 1.0 leaves."""
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.linalg import Vectors

    rows = []
    for page in labelled:
        found = blocks_of("".join(piece for _, piece in page))
        labels = [label for label, piece in page for _ in blocks_of(piece)]
        if len(labels) != len(found):
            raise ValueError("a labelled piece must hold whole blocks")
        rows += [(Vectors.dense(x), float(y)) for x, y in zip(features_of(found), labels)]
    table = spark.createDataFrame(rows, ["features", "label"]).coalesce(1)
    model = DecisionTreeClassifier(maxDepth=max_depth, minInstancesPerNode=2, seed=7).fit(table)

    def walk(node):
        if node.numDescendants() == 0:
            return node.prediction()
        split = node.split()
        return split.featureIndex(), split.threshold(), walk(node.leftChild()), walk(node.rightChild())

    return walk(model._call_java("rootNode"))


def classify(tree, row) -> bool:
    while isinstance(tree, tuple):
        feature, threshold, left, right = tree
        tree = left if row[feature] <= threshold else right
    return tree > 0.5


def main_text(page: str | None, tree) -> str:
    blocks = blocks_of(page)
    if not blocks:
        return ""
    return "\n".join(b.text for b, row in zip(blocks, features_of(blocks)) if classify(tree, row))


def main_text_column(page: Column, tree) -> Column:
    @F.arrow_udf("string")
    def extract(col: pa.Array) -> pa.Array:
        return pa.array([main_text(x.as_py(), tree) for x in col], pa.string())

    return extract(page)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", tree=None) -> DataFrame:
    """One row per page: page_id, url, text (main text, blocks joined by line ends), n_chars.

    Defined results: null or empty html, and a page without main text, give the empty string; ids and urls are passed on,
    null or repeated; an empty table gives no rows; other columns are ignored.
    """
    pages = columns(pages, page_id=id_col, url=url_col, html=html_col)
    tree = tree if tree is not None else train_tree(pages.sparkSession)
    out = pages.select("page_id", "url", main_text_column(F.col("html"), tree).alias("text"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
