"""The small labelled table for the block classifier: pages as pieces of HTML, each labelled 1 (main text) or 0.

Each piece holds whole blocks, so the label holds for every block in it. A container may open in one piece and close in
a later one.
"""

import random

_LONG = ("The river had risen for three days before anyone in the valley thought of moving the animals to the upper fields, and by then "
         "the lower road was already gone.")
_MID = "Nobody had expected the bridge to hold, but it did, and the first carts crossed it at noon."
_SHORT = "They waited until morning."
_TINY = "Nothing."
_LINKS = '<li><a href="/a">Home</a></li><li><a href="/b">Latest news</a></li><li><a href="/c">About us</a></li>'

# a news page with semantic elements
_SEMANTIC = [
    (0, f"<html><body><nav><ul>{_LINKS}</ul></nav>"), (0, f"<div><p>{_LONG}</p></div><p>{_SHORT}</p>"), (0, '<div class="ad">Buy one lamp today and get a second one for half of the price.</div>'),
    (1, f"<article><h1>Flood in the valley</h1><p>{_LONG}</p><p>{_SHORT}</p><p>{_TINY}</p><p>{_LONG} {_MID}</p>"),
    (1, f"<ul><li>{_SHORT}</li><li>Two carts and a dog</li></ul><p>{_MID}</p>"), (0, f'<div class="share"><a href="/s">Share this</a></div><aside><p>{_MID}</p></aside>'),
    (1, f"<p>{_MID}</p>"), (0, f'</article><section class="comments"><p>{_MID}</p><p>{_SHORT}</p><p>First!</p></section>'),
    (0, "<footer><p>All rights reserved by the valley paper, its owners and its heirs.</p></footer></body></html>"),
]
# header and notices around a main element
_MAIN = [
    (0, f'<body><header><h1>The Valley Paper</h1><p>{_SHORT}</p></header><div class="cookie-notice"><p>We use cookies to make this page better for you.</p></div>'),
    (1, f"<main><h2>A second flood</h2><p>{_LONG}</p><blockquote>{_MID}</blockquote><p>{_TINY}</p><p>{_SHORT}</p><h3>What came after</h3><p>{_LONG}</p>"),
    (0, "<form><label>Your mail</label><p>Get a letter from us every week, free of charge, and stop it at any time.</p><button>Send</button></form>"),
    (1, f"<p>{_SHORT}</p><table><tr><td>Carts</td><td>12</td></tr><tr><td>Dogs</td><td>3</td></tr></table>"),
    (0, f"</main><div class=\"box-7\"><p>{_LONG} {_MID}</p><p>{_MID}</p><div>{_SHORT}</div></div>"),
    (0, f'<div id="sidebar"><h3>Most read</h3><p>{_MID}</p><ul>{_LINKS}</ul></div><div id="footer">Made in the valley.</div></body>'),
]
# plain divisions, named by class only
_NAMED = [
    (0, f'<body><div class="top-menu"><div><a href="/a">News</a> <a href="/b">Sport</a> <a href="/c">Weather</a></div></div><div class="banner"><p>{_MID}</p></div>'),
    (1, f'<div class="post"><h1>The third flood</h1><p>{_LONG}</p><p>{_MID}</p><p>{_SHORT}</p><p>{_LONG}</p></div>'),
    (0, f'<div class="related"><h4>Read on</h4><p><a href="/d">{_SHORT}</a></p></div><div class="comment-list"><div>{_MID}</div><div>{_LONG}</div></div>'),
    (0, '<div class="footer">Imprint and contact of the valley paper.</div></body>'),
]
# nothing is named: only words and links tell
_BARE = [
    (0, '<body><div><a href="/a">News</a> | <a href="/b">Sport</a> | <a href="/c">Weather</a></div><table><tr><td><a href="/d">Old issues</a></td></tr></table>'),
    (1, f"<div>{_LONG}</div><div>{_MID}</div><p>{_SHORT}</p><div>{_LONG} {_MID}</div><p>{_LONG}</p>"),
    (0, '<div><a href="/e">Back to the top</a></div><div><a href="/f">Imprint</a> <a href="/g">Contact</a></div></body>'),
]
_BARE_LONG = [
    (0, '<body><p><a href="/a">Home</a></p><p><a href="/b">Archive of all old issues</a></p>'),
    (1, f"<h1>The last flood of the year</h1><p>{_LONG}</p><p>{_LONG}</p><p>{_TINY}</p><p>{_MID}</p><p>{_SHORT}</p><p>{_LONG}</p>"),
    (0, '<p><a href="/c">Next page</a> <a href="/d">Previous page</a></p></body>'),
]
# an article that is mostly short paragraphs, and links inside the text
_TERSE = [
    (0, f'<body><nav>{_LINKS}</nav><div class="notice">Our office is closed on Monday and on the day after it.</div>'),
    (1, f'<article><h1>Short notes</h1><p>{_TINY}</p><p>{_SHORT}</p><p>See <a href="/x">the list</a>.</p><p><a href="/y">All of the notes of last year</a></p><p>{_TINY}</p></article>'),
    (0, f"<div class=\"b2\">{_MID}</div><div>{_LONG}</div>"), (0, f"<aside><ul>{_LINKS}</ul><p>{_LONG}</p></aside><footer>Made in the valley.</footer></body>"),
]

LABELLED_PAGES = [_SEMANTIC, _MAIN, _NAMED, _BARE, _BARE_LONG, _TERSE]


# More pages by rule: the same parts in other lengths and under other names, among them wrappers whose names mislead and pages
# that name nothing, so that only words, links and neighbours tell. The rule is the label: article parts are 1, all else 0.

_WORDS = ("river valley bridge cart morning road field winter letter paper garden window market stone horse village summer kitchen teacher "
          "engine harbour forest number reason evening mountain station doctor season corner answer island").split()
_WRAPPER_NAMES = ("content-sidebar-wrap", "has-header", "no-sidebar", "page-header-wrap", "post no-share", "site-container", "with-sidebar layout", "x1")
_BOX_NAMES = ("sidebar", "nav-top", "footer", "ad-box", "cookie-notice", "share", "related", "comments", "newsletter")


def _sentence(r: random.Random, low: int, high: int) -> str:
    words = [r.choice(_WORDS) for _ in range(r.randint(low, high))]
    return " ".join(words).capitalize() + r.choice("..!?")


def _article(r: random.Random) -> str:
    """A heading, then paragraphs; tiny ones stand between long ones."""
    tag = r.choice(("p", "p", "div"))
    out = [f"<{h}>{_sentence(r, 2, 7)[:-1]}</{h}>" for h in [r.choice(("h1", "h2"))]]
    for k in range(r.randint(4, 9)):
        low, high = (1, 6) if k % 3 == 2 else (18, 70)
        link = f' <a href="/{k}">{r.choice(_WORDS)}</a> {_sentence(r, 3, 6)}' if r.random() < 0.2 else ""
        out.append(f"<{tag}>{_sentence(r, low, high)[:r.choice((None, None, -1))]}{link}</{tag}>")
    return "".join(out) + f"<{tag}>{_sentence(r, 18, 50)}</{tag}>"


def _links(r: random.Random, n: int) -> str:
    return "".join(f'<div><a href="/{k}">{_sentence(r, 1, 3)[:-1]}</a></div>' for k in range(n))


def _boxes(r: random.Random) -> str:
    """Named furniture of any length."""
    return "".join(f'<div class="{r.choice(_BOX_NAMES)}"><p>{_sentence(r, 3, 40)}</p></div>' for _ in range(r.randint(1, 2)))


def _short_lines(r: random.Random) -> str:
    """Unnamed lines of few words, as at the head and foot of a page."""
    return "".join(f"<div>{_sentence(r, 2, 9)[:r.choice((None, -1))]}</div>" for _ in range(r.randint(1, 4)))


def made_page(seed: int) -> list[tuple[int, str]]:
    """Three kinds by turn: an article element, a named box, nothing named."""
    r = random.Random(seed)
    kind, name = ("element", "named", "bare")[seed % 3], r.choice(_WRAPPER_NAMES)
    if kind == "bare":
        return [(0, f'<body class="{name}">{_links(r, r.randint(2, 6))}{_short_lines(r)}{_links(r, 1)}'), (1, _article(r)),
                (0, f"{_links(r, r.randint(1, 4))}{_short_lines(r)}</body>")]
    open_, close = ("<article>", "</article>") if kind == "element" else ('<div class="story">', "</div>")
    outside = "".join(f"<p>{_sentence(r, 2, 60)}</p>" for _ in range(r.randint(4, 8))) if kind == "element" else ""
    return [(0, f'<body><div class="{name}">{_boxes(r)}{_links(r, 3)}{outside}'), (1, open_ + _article(r) + close),
            (0, f"{_links(r, 2)}{outside}{_boxes(r)}</div></body>")]


MADE_PAGES = 60
LABELLED_PAGES += [made_page(seed) for seed in range(MADE_PAGES)]
