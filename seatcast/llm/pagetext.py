"""Main text of web pages by tree scoring.

A page is read into a tree.  Every paragraph gives points for its length and its
commas to the container around it, half of them to the container around that, a
quarter to the next, and so on; a container's points are discounted by the share
of its text that stands in links.  The container with the most points is kept,
with those siblings that look like more of the same text.

Before scoring, elements that are no article by their tag, role or class go:
menus, headers, footers, sidebars, notices, adverts, forms, reader comments,
hidden elements, and lists made of links.  An element that holds the page's
``main``, or an article and most of the page's text, is a wrapper and stays.

Each page is one row of a narrow map; the work is linear in the page: the scanner
never looks again at what it passed, points go up in one pass over the tree.

Defined cases: a null or empty page gives the empty text; a page without tags is
one block; a page without any paragraph gives what is left of its article, or of
the page; text after an unclosed comment, script or style is not text (as in a
browser); an unclosed attribute quote ends at the next ``>``.  White space is what
``str.split`` splits at, decoded no-break spaces included.  Repeated rows give one
row each; columns in ``keep`` pass unchanged, whatever their names; an empty table
gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_package, text_slices, unescape

# HTML element names and the words of class names, by use.
SKIPPED = {"script", "style", "title", "textarea", "xmp", "noframes", "noembed", "iframe"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog",
         "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2",
         "h3", "h4", "h5", "h6", "head", "header", "hgroup", "html", "legend", "li", "main", "menu",
         "nav", "ol", "option", "p", "pre", "search", "section", "select", "summary", "table",
         "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
CONTAINERS = {"article", "body", "center", "div", "html", "main", "section", "td"}
LISTS = {"dl", "menu", "ol", "ul"}
NO_ARTICLE_TAGS = {"aside", "button", "canvas", "datalist", "dialog", "fieldset", "footer", "form",
                   "head", "header", "label", "menu", "nav", "noscript", "object", "search",
                   "select", "svg", "template"}
NO_ARTICLE_ROLES = {"alert", "alertdialog", "banner", "complementary", "contentinfo", "dialog",
                    "form", "menu", "menubar", "navigation", "search", "toolbar"}
NO_ARTICLE_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "alert", "banner",
    "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "dialog",
    "disqus", "footer", "form", "gdpr", "header", "login", "masthead", "menu", "modal", "nav",
    "navbar", "navigation", "newsletter", "notice", "notification", "pager", "pagination", "paywall",
    "popup", "promo", "promotion", "recommended", "related", "replies", "respond", "search", "share",
    "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toc", "toolbar",
    "widget", "widgets"}
# A class name that begins or ends with one of these tells of a layout, not a part.
LAYOUT_WORDS = {"has", "with", "no", "without", "is", "layout", "page", "wrapper", "main"}
# Start tags that end an open element: name -> (ended names, names that stop the search).
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
}

_TAG_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_TAG_REST = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
_ATTRIBUTE = re.compile(
    r"""(?<![\w-])(class|id|role|hidden|aria-hidden|itemprop|style)"""
    r"""(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?![\w-])""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_COMMAS = re.compile("[,،、，]")

# A block below this many characters is a label rather than a paragraph.
SHORT = 25
# A sibling needs this many points, and this share of the best container's.
SIBLING_POINTS, SIBLING_SHARE = 10.0, 0.2


class _Tree:
    """Elements by number (a parent before its children) and the page's text as
    (element, text) in page order; None stands where one block ends."""

    def __init__(self) -> None:
        self.parent, self.tag, self.rest = [0], ["html"], [""]
        self.text: list[tuple[int, str] | None] = []

    def element(self, parent: int, tag: str, rest: str) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.rest.append(rest)
        return len(self.tag) - 1


def parse(page: str) -> _Tree:
    """The tree of ``page``, in one pass."""
    tree = _Tree()
    text, tag = tree.text, tree.tag
    open_, depths = [0], {"html": [0]}  # open elements; name -> their depths
    at, n, quotes = 0, len(page), True

    def innermost(names: Iterable[str]) -> int:
        return max((depths[x][-1] for x in names if depths.get(x)), default=-1)

    def close_to(depth: int) -> None:
        while len(open_) > depth:
            name = tag[open_.pop()]
            depths[name].pop()
            if name in BLOCK:
                text.append(None)

    def close(names: set[str], stop: set[str]) -> None:
        """End the innermost open element named so, unless one of ``stop`` is in it."""
        depth = innermost(names)
        if depth > innermost(stop):
            close_to(depth)

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            text.append((open_[-1], page[at:]))
            break
        if lt > at:
            text.append((open_[-1], page[at:lt]))
        mark = page[lt + 1:lt + 2]
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            if end < 0:
                break
            at = end + 3
            continue
        ending = mark == "/"
        name = _TAG_NAME.match(page, lt + 1 + ending)
        if name is None:
            if ending or mark in ("!", "?"):
                end = page.find(">", lt)
                if end < 0:
                    break
                at = end + 1
            else:
                text.append((open_[-1], "<"))
                at = lt + 1
            continue
        rest = _TAG_REST.match(page, name.end()) if quotes else None
        if rest is None:  # a quote or the tag itself never ends: from here on tags end at ">"
            quotes, end = False, page.find(">", name.end())
            if end < 0:
                break
            at = end + 1
        else:
            at = rest.end()
        what, rest = name.group().lower(), page[name.end():at - 1]
        if ending:
            if what == "br":
                text.append(None)
            elif what != "html" and depths.get(what):
                close_to(depths[what][-1])
            continue
        if what in SKIPPED and not rest.endswith("/"):
            found = re.compile(f"</{what}(?=[\\s/>])", re.I).search(page, at)
            if found is None:
                break
            end = page.find(">", found.end())
            at = n if end < 0 else end + 1
            continue
        if what in ("html", "body") and depths.get(what):
            continue
        if what in BLOCK:
            close({"p"}, {"td", "th", "button", "object"})
            if what in ENDS:
                close(*ENDS[what])
            text.append(None)
        elif what in ("br", "hr"):
            text.append(None)
        if what in VOID or rest.endswith("/") and what not in BLOCK and what != "a":
            continue
        depths.setdefault(what, []).append(len(open_))
        open_.append(tree.element(open_[-1], what, rest))
    return tree


def _no_article(tag: str, rest: str) -> bool:
    """Is an element, by its tag and attributes, no part of an article?"""
    if tag in ("html", "body", "main"):
        return False
    if tag in NO_ARTICLE_TAGS:
        return True
    if not rest or "=" not in rest and "hidden" not in rest.lower():
        return False
    for name, a, b, c in _ATTRIBUTE.findall(rest):
        name, value = name.lower(), unescape(a or b or c)
        if name == "hidden" and value.lower() != "until-found":
            return True
        if name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "style" and "display:none" in value.replace(" ", "").lower():
            return True
        if name == "role" and value.lower() in NO_ARTICLE_ROLES:
            return True
        if name in ("class", "id") and any(map(_part_name, value.split())):
            return True
    return False


def _part_name(name: str) -> bool:
    """Does a class name say advert, menu, comments and so on?"""
    words = [w.lower() for w in _WORDS.findall(name)]
    if not words or words[0] in LAYOUT_WORDS - {"page", "main"}:
        return False
    return (words[-1] in NO_ARTICLE_WORDS
            or words[0] in NO_ARTICLE_WORDS and words[-1] not in LAYOUT_WORDS)


def main_text(page: str | None) -> str:
    """The main text of one page: its blocks in page order, one blank between."""
    if not page:
        return ""
    tree = parse(page)
    parent, tag = tree.parent, tree.tag
    size = len(tag)
    # blocks: (element of the block, [(element, text)]); an inline element belongs to
    # the block element around it
    around, link, heart = list(range(size)), [False] * size, [False] * size
    for e in range(1, size):
        if tag[e] not in BLOCK:
            around[e] = around[parent[e]]
        link[e] = link[parent[e]] or tag[e] == "a"
        heart[e] = tag[e] == "main" or "main" in tree.rest[e].lower() and any(
            x.lower() == "role" and (a or b or c).lower() == "main"
            for x, a, b, c in _ATTRIBUTE.findall(tree.rest[e]))
    blocks: list[list[tuple[int, str]]] = [[]]
    chars, links, link_chars = [0] * size, [0] * size, [0] * size
    for found in tree.text:
        if found is None:
            if blocks[-1]:
                blocks.append([])
            continue
        e, raw = found
        decoded = unescape(raw)
        seen = len(decoded.strip())
        blocks[-1].append((e, decoded))
        chars[e] += seen
        if link[e]:
            link_chars[e] += seen
    holds_article, holds_heart = [t == "article" for t in tag], heart[:]
    for e in range(size - 1, 0, -1):
        p = parent[e]
        chars[p] += chars[e]
        link_chars[p] += link_chars[e]
        links[p] += links[e] + (tag[e] == "a")
        holds_article[p] |= holds_article[e]
        holds_heart[p] |= holds_heart[e]

    gone = [False] * size
    for e in range(1, size):
        if gone[parent[e]]:
            gone[e] = True
        elif tag[e] in LISTS and links[e] >= 3 and link_chars[e] >= 0.9 * chars[e]:
            gone[e] = True
        elif _no_article(tag[e], tree.rest[e]):
            wrapper = holds_heart[e] or (tag[e] != "article" and holds_article[e]
                                         and 2 * chars[e] > chars[0])
            gone[e] = not wrapper

    # points: from each block to the container around it, halved at each further one
    points, own, own_links = [0.0] * size, [0] * size, [0] * size
    texts: list[tuple[int, str]] = []
    for block in blocks:
        kept = [(e, t) for e, t in block if not gone[e]]
        words = " ".join("".join(t for _, t in kept).split())
        if not words:
            continue
        e = around[kept[0][0]]
        texts.append((e, words))
        own[e] += len(words)
        own_links[e] += min(len(words), sum(len(t.strip()) for x, t in kept if link[x]))
        if tag[e] not in HEADINGS:
            gain = min(len(words) / 100, 3)
            if len(words) >= SHORT:
                gain += 1 + len(_COMMAS.findall(words))
            points[e] += gain
    for e in range(size - 1, 0, -1):
        p = parent[e]
        points[p] += points[e] / (2 if tag[e] in CONTAINERS else 1)
        own[p] += own[e]
        own_links[p] += own_links[e]
    score = [points[e] * (1 - own_links[e] / own[e])
             if own[e] and (tag[e] in CONTAINERS) else 0.0 for e in range(size)]
    best = max(range(size), key=lambda e: (score[e], -e))
    roots = _family(best, parent, tag, heart, own, own_links, score)

    inside = [False] * size
    for e in range(size):
        inside[e] = e in roots or e > 0 and inside[parent[e]]
    return " ".join(t for e, t in texts if inside[e])


def _family(best: int, parent: list[int], tag: list[str], heart: list[bool], own: list[int],
            own_links: list[int], score: list[float]) -> set[int]:
    """The elements to keep: the best container, or the article it stands in, and
    the siblings that go with it."""
    if score[best] <= 0:  # no paragraph at all: an article's text, or what there is
        named = [e for e in range(len(tag)) if (tag[e] == "article" or heart[e]) and own[e]]
        return {max(named, key=lambda e: (own[e], -e)) if named else 0}
    at = best
    while at and tag[at] != "article" and not heart[at]:
        at = parent[at]
    if at:
        best = at
    else:  # containers about as good that are no siblings: what holds them all
        path, e = {best}, best
        while e:
            e = parent[e]
            path.add(e)
        met, first = list(range(len(tag))), best  # where each element meets the path
        for e in range(1, len(tag)):
            if e not in path:
                met[e] = met[parent[e]]
            if (score[e] >= 0.75 * score[first] and parent[e] != parent[first]
                    and tag[met[e]] not in ("html", "body")):
                best = min(best, met[e])  # an ancestor has the smaller number
    keep = {best}
    for e in range(1, len(tag)):
        if parent[e] != parent[best] or e == best or not own[e]:
            continue
        density = own_links[e] / own[e]
        if score[e] >= max(SIBLING_POINTS, SIBLING_SHARE * score[best]):
            keep.add(e)
        elif tag[e] == "p" and not (tag[best] == "article" or heart[best]):
            if own[e] > 80 and density < 0.25:
                keep.add(e)
    return keep


def extract(pages: DataFrame, *, id_col: str = "page_id", html_col: str = "html",
            keep: Iterable[str] = ("url",)) -> DataFrame:
    """One row per page: ``id_col``, the ``keep`` columns, text, n_chars (code
    points).  See the module's docstring."""
    ship_package(pages.sparkSession)
    keep = list(keep)
    clash = {"text", "n_chars", id_col.lower()} & {k.lower() for k in keep}
    if clash:
        raise ValueError(f"keep holds columns that the result has itself: {sorted(clash)}")
    names = [f"c{i}" for i in range(1 + len(keep))]
    rows = pages.select(*[F.col(c).alias(a) for c, a in zip([id_col, *keep], names, strict=True)],
                        F.col(html_col).cast("string").alias("html"))
    schema = rows.drop("html").withColumn("text", F.lit("")).withColumn(
        "n_chars", F.lit(0).cast("long")).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for (slice_,) in text_slices([batch], ["html"], text="html"):
                found = [main_text(page) for page in slice_]
                part = batch.slice(at, len(found))
                at += len(found)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names), pa.array(found, pa.string()),
                     pa.array(map(len, found), pa.int64())], names=[*names, "text", "n_chars"])

    out = rows.mapInArrow(run, schema)
    return out.select(*[F.col(a).alias(c) for c, a in zip([id_col, *keep], names, strict=True)],
                      "text", "n_chars")
