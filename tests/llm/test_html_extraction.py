"""HTML extraction: the given pages, classes against plain vectors, templates without names,
broken markup, odd input."""

from __future__ import annotations

import html
import re
import time
from collections import Counter, defaultdict

import pytest

from strata.llm import html_extraction as hx
from strata.llm.page_events import events
from strata.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string"


def article(source):
    found = re.search("<article>(.*?)</article>", source or "", re.S)
    blocks = re.split("</?(?:p|h1)>", found[1] if found else "")
    return "\n\n".join(t for t in (" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in blocks) if t)


def text_of(source):
    """Without a template."""
    return hx.main_blocks(events(source), [], set())


def extracted(df):
    return {(r.page_id, r.url): r.text for r in hx.main_text(df).collect()}


def test_query_on_given_pages(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").collect()
    got = {(r.page_id, r.url): r for r in QUERIES["op11_html_extraction"](spark, FOLDER).collect()}
    assert len(got) == len(pages)
    for p in pages:
        r = got[p.page_id, p.url]
        assert r.text == article(p.html) and r.n_chars == len(r.text)


def test_classes_have_equal_vectors(spark):
    pages = hx._sources(spark.read.parquet(f"{FOLDER}/pages.parquet"))
    vectors, sizes = defaultdict(Counter), Counter()
    for r in pages.collect():
        sizes[r.host] += 1
        for token, n in Counter((e.token, e.text is None) for e in events(r.html)).items():
            vectors[r.host, token][r.page] += n
    alike = defaultdict(set)
    for (host, (token, markup)), v in vectors.items():
        if len(v) >= 2 and len(v) * 100 >= sizes[host] * hx.SUPPORT_PCT and (markup or sizes[host] >= hx.FIXED_TEXT_PAGES):
            alike[host, tuple(sorted(v.items()))].add((token, markup))
    expected = defaultdict(list)
    for (host, _), tokens in alike.items():
        if any(m for _, m in tokens):
            expected[host].append(sorted(t for t, _ in tokens))
    got = {r.host: r.classes for r in hx.classes(hx.occurrences(pages)).collect()}
    assert got == {h: sorted(c) for h, c in expected.items()}


# A site without a telling name: a link row, a fixed line before and within the story, and
# fixed lines behind it.
def plain_page(i, links=4):
    row = "".join(f"<span><a href='/{i}{j}'>Topic {i} {j}</a></span>" for j in range(links + i % 3))
    story = "".join(f"<p>Story {i} part {j} &amp; more.</p>" for j in range(1 + i % 4))
    return (f"<html><body><div class=c1>{row}</div><div class=c2>All rights ours</div><div class=c3><h2>Title {i}</h2>{story}"
            f"<p>Shared by some</p><div class=c4>Send this to a friend</div></div><div class=c5>Last updated daily</div></body></html>")


def story(i):
    return "\n\n".join([f"Title {i}", *(f"Story {i} part {j} & more." for j in range(1 + i % 4)), "Shared by some"])


def test_template_without_names(rows):
    data = [(i, f"https://plain.example/{i}", plain_page(i).replace("<p>Shared by some</p>", "" if i % 3 else "<p>Shared by some</p>")) for i in range(40)]
    got = extracted(rows(SCHEMA, data).repartition(5))
    for i, url, _ in data:
        assert got[i, url] == story(i).replace("\n\nShared by some", "" if i % 3 else "\n\nShared by some")
    # Too few pages for a template: fixed lines stay, link rows still go.
    few = extracted(rows(SCHEMA, data[:2]))
    assert few[1, data[1][1]].startswith("All rights ours\n\nTitle 1") and "Topic" not in few[1, data[1][1]]


def test_template_is_nested(rows):
    data = [(i, "https://plain.example/", plain_page(i)) for i in range(30)]
    found = hx.templates(hx._sources(rows(SCHEMA, data))).collect()
    assert len(found) == 1
    sizes = sorted(len(o) for o in found[0].orders)
    assert sizes[-1] > 12  # what every page has once, fixed lines among it
    assert 4 in sizes  # a link: span, a, /a, /span
    assert found[0].menus


def test_overlapping_classes_are_invalid():
    # 1 and 2 open before, and close after, each other: the smaller class goes.
    page = [hx.Event(t) for t in (1, 2, 3, 5, 4, 6)]
    member = {1: (1, 3), 3: (1, 3), 4: (1, 3), 2: (2, 2), 5: (2, 2), 6: (6, 1)}
    bad = set()
    hx._slots(page, member, {1: {1: 0, 3: 1, 4: 2}, 2: {2: 0, 5: 1}, 6: {6: 0}}, bad)
    assert bad == {2}
    assert hx._order([1, 2, 1, 2], 2) == (1, 2) and hx._order([1, 2, 2, 1], 2) is None and hx._order([1, 1], 2) is None


@pytest.mark.parametrize(("source", "expected"), [
    ("<article><header><h1>T</h1></header><p>a<aside>x</aside>b</article><aside>y</aside>", ["T", "a", "b"]),
    ("<main><h1>T</h1><p>a<form><p>x<input></form><p>b</main><footer>y</footer>", ["T", "a", "b"]),
    ("<article><p>a</p><section class='comments'><article class=comment><p>x</p></article></section></article>", ["a"]),
    ("<article><p>a</p><div id=reader-comments><p>x</p></div><div class='cookie-notice'>y</div></article>", ["a"]),
    ("<body class='with-sidebar'><div class='adSlot'>x</div><div class=sidebar>y</div><div class='shadow loader'><p>a</p></div>", ["a"]),
    ("<div role=navigation>x</div><div hidden>y</div><div style='display: none'>z</div><p>a<br>b", ["a b"]),
    ("<p>a <b>b</b>c\n\t d&nbsp;e&#x20AC;&amp;lt;&ampf &bogus; &#0;</p>", ["a bc d e€&lt;&f &bogus; �"]),
    ("<ul><li>one<li>two</ul><table><tr><td>x<td>y<tr><td>z</table>", ["one", "two", "x", "y", "z"]),
    ("<script>if (a<b) '</p>'</script><style>p{}</style><!-- <p>x</p> --><p>a</p><!-- open <p>y", ["a"]),
    ("<p>1 < 2 and 3 > 2</p><p title='>'>b</p></div></section>", ["1 < 2 and 3 > 2", "b"]),
    ("<p>a</p><p>cut <a href='x", ["a", "cut"]),
    ("<article><p>a<script>never closed <p>x", ["a"]),
    ("<article><p>a <button>x</button><span hidden>b</span> <label>y<b>z</b></label>c<p><select><option>1<option>2</select>d", ["a c", "d"]),
    ("<p><a href='/'>Home</a></p><p>see <a href='/x'>this</a> page for more</p>", ["see this page for more"]),
    ("<h2>Head<P CLASS=X>up<Br/>per</P>", ["Head", "up per"]),
    ("no markup at all", ["no markup at all"]),
    ("", []), ("<", ["<"]), ("<>", ["<>"]), ("&amp", ["&"]),
])
def test_pages(source, expected):
    assert text_of(source) == expected


@pytest.mark.parametrize("source", [
    "<" * 200_000, "<a" * 100_000, "<a '" * 50_000 + ">", "<div>" * 50_000, "<div>" * 3_000 + "</p></b>" * 50_000, "<!--" * 50_000,
    "<p>x" * 50_000, "&" * 200_000, "<script>" * 30_000, "</" * 100_000 + ">",
])
def test_long_pages_take_linear_time(source):
    start = time.process_time()
    text_of(source)
    assert time.process_time() - start < 10


def test_odd_rows(rows):
    page = "<article><p>same</p></article>"
    data = [(1, "https://a.example/x", page), (1, "https://a.example/x", page), (1, "https://a.example/y", None), (None, None, page), (2, None, ""),
            (3, "no host", "<p>b</p>"), (4, "https://A.example/", "x" * 300_000)]
    df = rows(SCHEMA + ", host string, text string, orders int", [(*r, "clash", "clash", 1) for r in data])
    out = hx.main_text(df)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = Counter((r.page_id, r.url, r.text) for r in out.collect())
    texts = ["same", "same", "", "same", "", "b", "x" * 300_000]
    assert got == Counter((i, u, t) for (i, u, _), t in zip(data, texts))
    assert hx.main_text(df.limit(0)).collect() == []


def test_copies_of_one_article_stay(rows):
    """A host whose pages are mostly copies: passages are no template."""
    body = "<html><body><nav><a href=/>x</a></nav><article><h1>{}</h1>{}</article></body></html>"
    copy = "".join(f"<p>Paragraph {i} of a copy.</p>" for i in range(6))
    data = [(i, f"https://c.example/{i}", body.format(i % 9, copy if i % 5 else f"<p>Own {i}.</p>" * (1 + i % 2))) for i in range(60)]
    got = extracted(rows(SCHEMA, data))
    assert all(got[i, u] == article(s) for i, u, s in data)
