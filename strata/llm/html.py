"""HTML extraction (3): flat text blocks with word counts and link densities of a block and its
neighbours, classified by a decision tree that is trained on the small labelled pages below.

A page is cut into tags and text by one regular expression (no tree is built). Text between
block tags is a block; each block has its own features, those of the blocks before and after it,
and which containers it stands in. The tree is grown with numpy when the operator is called.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'](?=[^<>]*>))*)(?:>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)", re.S)
HINT = re.compile(r"(?:\b(?:class|id|role|aria-label)\s*=\s*)(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
MAY_HIDE = re.compile(r"hidden|display\s*:\s*none", re.I)  # what the attributes of a hidden element contain at least
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
HIDING_STYLE = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.I)
# fixed values: HTML element names
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
SKIP = set("script style noscript template svg math iframe object embed canvas head title select option textarea button video audio map".split())
RAW = set("script style textarea title noscript iframe template svg math".split())
BOILER = set("nav header footer aside form menu dialog fieldset".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# fixed values: words of class and id attributes that name page furniture
FURNITURE = set("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion popup modal overlay cookie cookies consent gdpr notice notification alert sidebar side widget widgets menu navbar nav navigation breadcrumb breadcrumbs header masthead topbar footer foot copyright legal related recommended recommendations share sharing social subscribe subscription newsletter signup login search comment comments disqus reply replies respond discussion pager pagination toolbar tags teaser complementary contentinfo paywall".split())
BODY = set("article content main story post entry text body maincontent articlebody".split())
# fixed value: parts of such names that stand for the whole name wherever they occur in it
FURNITURE_PART = re.compile("cookie|comment|sidebar|footer|advert|sponsor|newsletter|breadcrumb|subscri|popup|masthead|navig|navbar|topnav|disqus|consent|gdpr|promo")
# fixed values: of these, names that also occur on the frame around an article
LAYOUT = set("sidebar side header masthead topbar footer foot menu navbar nav navigation banner search social share related widget widgets".split())
# fixed values: words that turn the meaning of a name (ad-free, no-sidebar, comments-open)
TURNS = set("no not non without with has have is free open opened closed enabled disabled on off".split())
# a furniture frame is none if it holds that share of the page's words, or this one together with main or h1
ALL_WORDS, MOST_WORDS = 0.9, 0.5
FEATURES = ["words", "links", "words_before", "links_before", "words_after", "links_after", "furniture", "article", "heading", "item"]


def furniture_level(name: str, hints: list[list[str]], article: bool) -> int:
    """2: page furniture; 1: named like it, but maybe the frame around an article; 0: neither. ``hints``: the
    words of each name; an article or main element is furniture only by a name that says nothing else."""
    if name in BOILER and not (name == "header" and article):
        return 2
    if name in ("html", "body"):
        return 0
    if name in ("article", "main"):
        return 2 if any(h and all(w in FURNITURE for w in h) and not LAYOUT.issuperset(h) for h in hints) else 0
    named = {w for h in hints for w in h if w in FURNITURE or FURNITURE_PART.search(w)}
    if article:
        named.discard("header")  # of the article
    if named - LAYOUT:
        return 2
    return 1 if named else 0


def _names(rest: str) -> list[list[str]]:
    """The words of each name in the attributes that name an element, but of names that are turned."""
    found = []
    for m in HINT.finditer(rest):
        for value in (m[1] or m[2] or m[3] or "").split():
            words = [w for w in re.split(r"[^a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()) if w]
            if not TURNS.intersection(words):
                found.append(words)
    return found


def _hidden(rest: str) -> bool:
    """Whether the attributes of a tag hide its element: hidden (but not =false), aria-hidden=true, or a
    style that does not display it. The words in other names and values say nothing."""
    if not MAY_HIDE.search(rest):
        return False
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(rest):
        found.setdefault(m[1].lower(), entities.unescape(m[2] or m[3] or m[4] or ""))  # the first of a name counts
    return (found.get("hidden", "false").strip().lower() != "false" or found.get("aria-hidden", "").strip().lower() == "true"
            or bool(HIDING_STYLE.search(found.get("style", ""))))


def blocks(page: str) -> list[tuple[str, int, int, bool, bool, bool, bool]]:
    """(text, words, words in links, furniture, article, heading, list item) of the text blocks."""
    out: list[list] = []
    stack: list[tuple[str, tuple, tuple, bool, bool]] = []  # name, furniture frames, those that may be layout, article, left out
    frames = 0
    central: set[int] = set()  # frames around a main or h1 element
    parts: list[str] = []
    linked: list[str] = []
    in_link, at = 0, 0
    hard, soft, article, skip = (), (), False, False
    heading = item = False

    def end() -> None:
        nonlocal parts, linked
        if parts:
            words = entities.unescape("".join(parts)).split()
            if words:
                of_links = sum(len(entities.unescape(x).split()) for x in linked)
                out.append([" ".join(words), len(words), min(of_links, len(words)), hard + soft, article, heading, item])
        parts, linked = [], []

    def text(piece: str) -> None:
        if piece and not skip:
            parts.append(piece)
            if in_link:
                linked.append(piece)

    while at < len(page):
        m = TOKEN.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at: m.start()])
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if m["close"]:
            if name == "a":
                in_link = max(0, in_link - 1)
            if name == "br" or (name not in INLINE and name not in SKIP):
                end()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    if name not in INLINE:
                        end()
                    del stack[k:]
                    hard, soft, article, skip = stack[-1][1:] if stack else ((), (), False, False)
                    in_link = sum(s[0] == "a" for s in stack)
                    break
            if re.fullmatch("h[1-6]", name):
                heading = False
            if name == "li":
                item = False
            continue
        rest = m["rest"]
        if name == "br":
            parts.append(" ")
            continue
        if name in RAW and not rest.rstrip().endswith("/"):
            close = re.compile(rf"</{name}\b[^>]*>?", re.I).search(page, at)
            at = close.end() if close else len(page)
            if name not in INLINE:
                parts.append(" ")
            continue
        if name in VOID or rest.rstrip().endswith("/"):
            if name not in INLINE:
                end()
            continue
        if name not in INLINE:
            end()
            heading = bool(re.fullmatch("h[1-6]", name))
            item = name == "li"
        elif name == "a":
            in_link += 1
        if name in INLINE and name != "a" and not rest.strip():
            continue
        if name in ("p", "li", "tr", "td", "dt", "dd") and stack and stack[-1][0] == name:
            hard, soft, article, skip = stack[-2][1:] if len(stack) > 1 else ((), (), False, False)
            stack.pop()
        hints = _names(rest) if rest.strip() else []
        off = bool(rest) and _hidden(rest)
        level = furniture_level(name, hints, article)
        if name in ("article", "main") and not level:
            soft = ()  # the name was that of the frame
        if name in ("h1", "main"):
            central.update(hard + soft)
        article = article or (not level and (name in ("article", "main") or any(w in BODY for h in hints for w in h)))
        frames += 1
        if level == 2:
            hard += (frames,)
        elif level:
            soft += (frames,)
        skip = skip or off or name in SKIP
        stack.append((name, hard, soft, article, skip))
    end()
    words: dict[int, int] = {}
    for b in out:
        for f in b[3]:
            words[f] = words.get(f, 0) + b[1]
    total = sum(b[1] for b in out)
    kept = {f for f, n in words.items() if n < ALL_WORDS * total and not (f in central and n >= MOST_WORDS * total)}
    return [(*b[:3], any(f in kept for f in b[3]), *b[4:]) for b in out]


def features(found: list[tuple]) -> np.ndarray:
    if not found:
        return np.zeros((0, len(FEATURES)))
    words = np.array([b[1] for b in found], float)
    links = np.array([b[2] for b in found], float) / words
    before, after = np.append(0, words[:-1]), np.append(words[1:], 0)
    links_before, links_after = np.append(0, links[:-1]), np.append(links[1:], 0)
    flags = np.array([b[3:7] for b in found], float)
    return np.column_stack([words, links, before, links_before, after, links_after, flags])


# -- labelled pages: every block of text begins with + (main text) or - (page furniture) ---

_LONG = " ".join(f"word{k}" for k in range(40))
_MID = " ".join(f"word{k}" for k in range(14))
LABELLED = [
    f"<nav><ul><li><a href=x>-Home</a></li><li><a href=x>-News</a></li></ul></nav><div class=ad>-{_MID}</div>"
    f"<article><h1>+{_MID}</h1><p>+{_LONG}</p><p>+Short.</p><p>+{_LONG}</p></article><footer>-{_MID}</footer>",
    f"<header><a href=x>-Logo</a><p>-{_MID}</p></header><main><h1>+Title</h1><p>+{_LONG}</p><ul><li>+item</li><li>+other item</li></ul></main>"
    f"<aside><p>-{_LONG}</p></aside><footer>-Imprint</footer>",
    f"<div class=cookie-notice><p>-{_LONG}</p></div><article><h1>+{_MID}</h1><p>+Of.</p><p>+{_MID}</p></article>"
    f"<section class=comments><p>-{_LONG}</p><p>-{_MID}</p></section>",
    f"<article><p>+One.</p><p>+Two words.</p><blockquote>+{_MID}</blockquote><p>+<a href=x>a linked phrase</a></p>"
    f"<div class=related><ul><li><a href=x>-{_MID}</a></li></ul></div><form><p>-{_MID}</p></form></article>",
    f"<div><p>+{_LONG}</p><p>+{_LONG}</p><p>+Short line.</p><p>+{_LONG}</p></div><div><a href=x>-Contact</a> <a href=x>-Help</a></div>",
    f"<table><tr><td><a href=x>-Home</a></td></tr></table><div><h2>+Heading here</h2><p>+{_LONG}</p><p>+{_MID}</p></div>"
    f"<p>-Copyright</p><p><a href=x>-{_MID}</a></p><p><a href=x>-More</a></p>",
    f"<div><a href=x>-{_MID}</a></div><div><a href=x>-{_MID}</a></div><div>+{_LONG}</div><div>+{_LONG}</div><div><a href=x>-{_MID}</a></div>",
    f"<div class=sidebar><p>-{_LONG}</p><h3>-Links</h3></div><div class=content><p>+{_MID}</p><p>+{_LONG}</p><p>+End.</p></div>",
    f"<main><p>+{_LONG}</p><div class=share><a href=x>-Share</a></div><p>+Last.</p></main><div class=footer-links><a href=x>-Terms</a></div>",
    f"<body><p>+{_LONG}</p></body>", f"<p>+{_MID}</p>", f"<div>+{_LONG}</div><div>+{_MID}</div><div>+{_LONG}</div>",
]


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    rows, labels = [], []
    for page in LABELLED:
        found = blocks(page)
        rows.append(features(found))
        labels += [b[0].startswith("+") for b in found]
    return np.vstack(rows), np.array(labels)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 8):
    """Decision tree by Gini impurity: (feature, threshold, low, high) or a leaf's label. Ties go to
    the first feature and the lowest threshold."""
    if depth == 0 or y.all() or not y.any():
        return bool(2 * y.sum() >= len(y))
    best = None
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, t = x[order, f], y[order]
        places = np.flatnonzero(v[1:] > v[:-1]) + 1
        ones = np.cumsum(t)
        for p in places:
            a, b = ones[p - 1], ones[-1] - ones[p - 1]
            score = a * (p - a) / p + b * (len(t) - p - b) / (len(t) - p)
            if best is None or score < best[0] - 1e-12:
                best = (score, f, (v[p - 1] + v[p]) / 2)
    if best is None:
        return bool(2 * y.sum() >= len(y))
    _, f, cutoff = best
    low = x[:, f] <= cutoff
    return f, cutoff, grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1)


def decide(tree, row: np.ndarray) -> bool:
    while not isinstance(tree, bool):
        f, cutoff, low, high = tree
        tree = low if row[f] <= cutoff else high
    return tree


def main_text(page: str, tree) -> str:
    found = blocks(page)
    return " ".join(b[0] for b, row in zip(found, features(found).tolist(), strict=True) if decide(tree, row))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars): main text of every page, from the whole html.

    Null or empty html, and a page without main text, give an empty text of 0 code points. Null ids
    and urls, repeated rows and an empty table pass through; other columns are ignored; pages of any
    length are looked at whole. Names alone do not take the page away: a frame with nearly all of its
    words, or with most of them and a main or h1 element, is none of its furniture.
    """
    x, y = labelled_table()
    tree = grow(x, y)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(p.as_py() or "", tree) for p in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return (pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
            .mapInArrow(run, "page_id long, url string, text string, n_chars long"))
