"""Main text of pages: hand-made pages, scoring by brute force over generated
trees, and the given pages against their known article."""

import html
import random
import re
import time
import xml.etree.ElementTree as ET

import pytest

from seatcast.llm import pagetext, queries
from seatcast.llm.pagetext import main_text

LONG = "Words of some length, then more of them, and a few to close the line with."
FRAME = ("<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body>"
         "<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav>{}"
         "<footer>&copy; us</footer><script>var a='<p>no</p>'</script></body></html>")


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("   ", ""), ("plain  text\n here", "plain text here"),
    ("a < b &amp; c &lt;d&gt;", "a < b & c <d>"),
    (FRAME.format(f"<article><h1>T</h1><p>{LONG}<p>{LONG}</article>"), f"T {LONG} {LONG}"),
    (FRAME.format(f"<main><div><p>{LONG}</p><aside>side</aside><div class='ad-slot'>buy</div>"
                  "<form>mail <input></form></div><div id=comments><p>" + LONG * 9 + "</p></div>"
                  "</main>"), LONG),
    # a wrapper with a telling name that holds the article stays
    (f"<form class=modal><article><p>{LONG}</p></article><p>x</p></form>", LONG),
    (f"<body class='no-sidebar with-ads'><div class=page-header-layout><p>{LONG}</p></div>", LONG),
    # reader comments as articles of their own
    (f"<div><article><p>{LONG}</p></article><article class=comment><p>{LONG}</p></article></div>",
     LONG),
    # siblings with enough points join, loose ones do not
    (f"<div><div class=a><p>{LONG * 16}</p></div><div class=b><p>{LONG * 5}</p></div>"
     "<div class=c>Short.</div></div>", f"{LONG * 16} {LONG * 5}"),
    # links make a bad container
    (f"<div><div>{'<a href=x>' + LONG + '</a>'}</div><div><p>{LONG}</p></div></div>", LONG),
    # blocks, breaks and inline elements
    ("<article>one<br>two<b>x</b>y <div>z</div>end</article>", "one twoxy z end"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "a b c d"),
    # unclosed things
    (f"<p>{LONG}<!-- never ends", LONG), (f"<p>{LONG}<script>x", LONG),
    (f"<p title=\"x>{LONG}</p><p>b", f"{LONG} b"), (f"<p>{LONG}</p><p class", LONG),
    ("<nav><a href=/>only a menu</a></nav>", ""), ("<p hidden>x</p><p style='display: none'>y", ""),
    ("<article><h1>Only a title</h1></article><div>", "Only a title"),
    ("<p>a&nbsp; b&#x20;&#99;</p>", "a b c"),
])
def test_pages(page, text):
    assert main_text(page) == text


def _random_page(rnd, depth=0):
    if depth == 4 or (depth > 1 and rnd.random() < 0.3):
        words = ", ".join("w" * rnd.randint(1, 12) for _ in range(rnd.randint(1, 30)))
        return f"<p>{words}</p>" if rnd.random() < 0.7 else f"<p><a>{words[:20]}</a> {words}</p>"
    inner = "".join(_random_page(rnd, depth + 1) for _ in range(rnd.randint(1, 4)))
    return f"<{(t := rnd.choice(['div', 'section']))}>{inner}</{t}>"


def _scores(root):
    """Score of every div and section, straight from the rule."""
    out = {}
    for box in root.iter():
        if box.tag == "p":
            continue
        points, chars, links = 0.0, 0, 0
        stack = [(box, 1.0)]
        while stack:
            e, share = stack.pop()
            for child in e:
                if child.tag == "p":
                    words = " ".join("".join(child.itertext()).split())
                    chars += len(words)
                    links += sum(len(a.text) for a in child)
                    n = min(len(words) / 100, 3)
                    points += share * (n + (1 + words.count(",") if len(words) >= 25 else 0))
                else:
                    stack.append((child, share / 2))
        out[box] = points * (1 - links / chars) if chars else 0
    return out


def test_best_container_by_brute_force():
    rnd = random.Random(4)
    for _ in range(150):
        page = f"<div>{_random_page(rnd)}</div>"
        root = ET.fromstring(page)
        scores, up = _scores(root), {c: p for p in root.iter() for c in p}
        order = [e for e in root.iter() if e in scores]
        top = max(order, key=lambda e: (round(scores[e], 9), -order.index(e)))
        best, path = top, [top]
        while path[-1] in up:
            path.append(up[path[-1]])
        for e in order:  # what holds all containers about as good
            if scores[e] >= 0.75 * scores[top] and up.get(e) is not up.get(top):
                while e not in path:
                    e = up[e]
                best = max(best, e, key=path.index)
        keep = {best}
        for e in up.get(best, ()):
            words = " ".join("".join(e.itertext()).split())
            if e.tag == "p":
                density = sum(len(a.text) for a in e) / len(words)
                if len(words) > 80 and density < 0.25:
                    keep.add(e)
            elif scores[e] >= max(10, 0.2 * scores[best]):
                keep.add(e)
        want = [" ".join("".join(p.itertext()).split()) for p in root.iter("p")
                if any(p in k.iter() for k in keep)]
        assert main_text(page) == " ".join(want), page


def test_work_is_linear_in_the_page():
    n = 40_000
    for page in ("<nav>" * n, "<div>" * n + "x", "<p><button>" + "<div>" * n, "<a b='" * n,
                 "<ul><li>" * n, "<!-- " * n, "<b><p>" * n, "< " * n, "<script>" * n,
                 "<p title=\"" + "<i>" * n, "&amp" * n, "<table>" + "<tr><td>a, b<p>x" * n):
        t = time.time()
        main_text(page)
        assert time.time() - t < 10, page[:20]


def test_query_gives_the_article_of_every_page(spark):
    got = {r.page_id: r for r in queries.op13_html_extraction(
        spark, "/root/testdata/sf0.01").collect()}
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        article = re.search(r"<article>(.*?)(?:</article>|$)", p.html, re.S).group(1)
        text = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", article)).split())
        r = got[p.page_id]
        assert (r.url, r.text, r.n_chars) == (p.url, text, len(text))


def test_nulls_repeats_clashing_columns_and_no_rows(spark):
    schema = "page_id long, url string, html string, text string, c0 int, n_chars int"
    rows = [(1, None, f"<p>{LONG}", "t", 7, 8), (1, None, f"<p>{LONG}", "t", 7, 8),
            (None, "u", None, None, None, None)]
    df = spark.createDataFrame(rows, schema)
    got = sorted(map(tuple, pagetext.extract(df, keep=["url", "c0"]).collect()), key=str)
    assert got == [(1, None, 7, LONG, len(LONG))] * 2 + [(None, "u", None, "", 0)]
    assert pagetext.extract(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        pagetext.extract(df, keep=["text"])


def test_references_of_very_many_digits():
    digits = "9" * 5000
    page = f"<article><p class='&#{digits};'>One, two &#{digits}; and &#{'0' * 5000}65; three.</p></article>"
    assert pagetext.main_text(page) == "One, two \ufffd and A three."
