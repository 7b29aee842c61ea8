"""Operator 9's method: the tree decides by words, links and neighbours; blocks against a plain parser; wrappers and broken pages."""

import random
import time
from html.parser import HTMLParser

import pytest

from duotower.llm import labelled_pages as L
from duotower.llm.html_text import _FURNITURE_WORDS, _INLINE, _NEGATED, _SKIPPED, _WRAPPERS, FEATURES, blocks_of, classify, features_of, main_text, train_tree


@pytest.fixture(scope="module")
def tree(spark):
    return train_tree(spark)


class Plain(HTMLParser):
    """Block texts with their numbers of linked words, by the library's parser."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.out, self.text, self.link, self.linked, self.skip = [], [], False, [], 0
        self.feed(page)
        self.close()
        self.cut()

    def cut(self):
        words = "".join(self.text).split()
        if words:
            self.out.append((" ".join(words), len("".join(self.linked).split())))
        self.text, self.linked = [], []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.link = True
        elif tag not in _INLINE:
            self.skip += tag in _SKIPPED
            self.cut()

    def handle_endtag(self, tag):
        if tag == "a":
            self.link = False
        elif tag not in _INLINE:
            self.cut()
            self.skip -= tag in _SKIPPED

    def handle_data(self, data):
        if not self.skip:
            self.text.append(data)
            if self.link:
                self.linked.append(data)


def test_blocks_equal_a_plain_parser():
    for seed in range(300):
        page = "".join(piece for _, piece in L.made_page(seed))
        page = page.replace("river", "r&eacute;v &amp; <b>x</b>y").replace("</p>", "</p><script>var a = '<p>';</script>")
        assert [(b.text, b.linked) for b in blocks_of(page)] == Plain(page).out, seed


def used(tree):
    return {FEATURES[tree[0]]} | used(tree[2]) | used(tree[3]) if isinstance(tree, tuple) else set()


def test_the_tree_splits_on_words_and_a_neighbour(tree):
    assert "words" in used(tree) and used(tree) & {"words_before", "words_after", "link_density_before", "link_density_after"}
    # and they decide: the same short block is main text between long ones and furniture between short ones
    long, short = f"<p>{L._LONG} {L._LONG}</p>", "<p>Nothing new today</p>"
    between = main_text(f"<body>{long}{short}{long}</body>", tree)
    beside = main_text(f"<body>{long}{long}<p><a href='/a'>Home</a></p>{short}<p>Imprint</p></body>", tree)
    assert "Nothing new today" in between and "Nothing new today" not in beside and L._LONG in beside


def test_held_out_pages(tree):
    right = total = 0
    for seed in range(5000, 5200):
        page = L.made_page(seed)
        found = blocks_of("".join(piece for _, piece in page))
        labels = [label for label, piece in page for _ in blocks_of(piece)]
        right += sum(classify(tree, x) == y for x, y in zip(features_of(found), labels))
        total += len(labels)
    assert right / total >= 0.99


@pytest.mark.parametrize("name", ["content-sidebar-wrap", "has-header", "no-sidebar", "page-header-wrap", "post no-share", "header-container"])
@pytest.mark.parametrize("element", ["article", "main", "div"])
def test_wrappers_keep_their_article(tree, name, element):
    for seed in range(20):
        article = L._article(random.Random(seed))
        page = f'<html><body><div class="{name}"><nav>{L._LINKS}</nav><{element}>{article}</{element}></div><div class="footer">Made here.</div></body></html>'
        assert main_text(page, tree) == "\n".join(b.text for b in blocks_of(article)), (name, element, seed)


def test_furniture_inside_an_article_stays_out(tree):
    page = f'<div class="sidebar"><article><p>{L._LONG}</p><div class="share">Share this with all of your friends now.</div><p>{L._MID}</p></article></div>'
    assert main_text(page, tree) == f"{L._LONG}\n{L._MID}"
    assert _WRAPPERS.isdisjoint(_FURNITURE_WORDS) and _NEGATED.isdisjoint(_FURNITURE_WORDS)


def test_unclosed_and_stray_tags_take_linear_time(tree):
    for page in ("<div>" * 20000 + "</p>" * 20000 + "x", "<div><p>" * 20000 + "</div>" * 20000 + "x", "</div>" * 50000 + "<p>x"):
        began = time.process_time()
        assert [b.text for b in blocks_of(page)] == ["x"]
        assert time.process_time() - began < 2
