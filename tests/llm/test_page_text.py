"""Operator 13: the parser on awkward markup, alignment and pairing against brute force, whole tables against a second reading."""

import html
import os.path
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docketlake.llm import page_text as P

SCHEMA = "page_id long, url string, html string"


def text_of(page, near=None):
    return P.main_text(P.lines_of_page(page), near)[0]


def test_markup():
    page = """<body class="has-sidebar page"><div id="top"><ul class="mainMenu"><li>Home<li>About</ul></div><main class="header-wide">
    <header class="entry-header"><h1>Title &amp; more</h1><p>by me</p></header><p>One<br>two <b>three<p>four&nbsp;five <span class="ad">BUY</span> six
    <table><tr><td>a<td>b<tr><td>c</table><div class=comments><p>hi</div></main><aside>x</aside><!-- <p>c --><p title="a > b">outside"""
    assert text_of(page) == "Title & more\nOne two three\nfour five six\na b\nc"


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("", ""),
        ("plain", "plain"),
        ("<p>a<p>b</p></p>c", "a\nb\nc"),
        ('<script>var t="</p><article>x</article>";</script><p>a', "a"),
        ("<style>p{}</style><title>t</title><noscript>n</noscript><p>a</p><!-- open", "a"),
        ("<p>a &lt;b&gt; &#233; &#x1F600; &amp &am &unknown; </p>", "a <b> é 😀 & &am &unknown;"),
        ("<p>2 < 3 & 4 > 1</p>", "2 < 3 & 4 > 1"),
        ("<nav><p>menu</div></p></nav><p>a", "a"),
        ("<div><nav>menu</div><p>a", "a"),
        ("<form><p>f</p></form><p hidden>h</p><p style='display: none'>h</p><p data-hidden=1 data-class='ad'>a", "a"),
        ("<article><p>a</p><footer>f</footer><section id=comments><article>c</article></section></article><p>b", "a"),
        ("<main><p>" + "long " * 9 + "</p><article>card</article></main>", "long " * 8 + "long\ncard"),
        ("<div class='adverse nonad'>a</div><div class='side_ad'>b</div><div id=adBox>c</div>", "a"),
        ("<ul><li>a<ul><li>b</ul><li>c</ul>", "a\nb\nc"),
        ("<DIV ROLE=Navigation>x</DIV><P>a</P>", "a"),
        ("<p>a</p><p class=", "a"),
        ("<a x=\"<a x='" * 3 + "<p>a", "a"),
        ("<p>a\tb\n\n c　d</p>", "a b c d"),
        ("<svg><title>s</title><text>s</text></svg><p>a</p><button>b</button><select><option>o<option>p</select>", "a"),
    ],
)
def test_pieces_of_markup(page, want):
    assert text_of(page) == want


def lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


@given(st.lists(st.integers(0, 5), max_size=40), st.lists(st.integers(0, 5), max_size=40))
@settings(max_examples=400, deadline=None)
def test_alignment(a, b):
    found = P.shared_lines(a, b)
    assert found == sorted(set(found)) and len(found) == lcs(a, b)
    rest = iter(b)
    assert all(any(y == a[i] for y in rest) for i in found)


def test_alignment_of_very_long_pages():
    r = random.Random(1)
    a = [r.randrange(2000) for _ in range(20_000)]
    b = a[:5000] + [-1] * 3000 + a[5000:]
    assert len(P.shared_lines(a, b)) == 20_000


def template(i, body, kind="div"):
    return f"<html><body><div>Daily Post</div><div>Terms of use</div><{kind}>{body}</{kind}><p>All rights reserved</p><p>Page {i} visited</p></body></html>"


def awkward_pages():
    r = random.Random(4)
    say = lambda n: " ".join(r.choice("alpha beta gamma delta eps zeta".split()) for _ in range(n))
    rows = [(i, f"http://h.example/{'ab'[i % 2]}/{i}", template(i, "".join(f"<p>{say(20)}</p>" for _ in range(3)))) for i in range(30)]
    rows += [(100 + i, f"https://W.example/x/{i}", f"<nav>Menu {i % 2}</nav><article><h1>{say(4)}</h1><p>{say(30)}</p><p>quoted everywhere</p></article><footer>f</footer>") for i in range(10)]
    rows += [(200, "http://one.example/", template(1, "<p>alone on its host</p>")), (201, None, "<p>no url"), (202, "no scheme", "<p>no scheme"), (203, "http://e.example", None), (204, "http://e.example/x", "")]
    rows += [(300 + i, "http://copy.example/same", rows[0][2]) for i in range(5)] + [(5, *rows[5][1:]), (5, *rows[5][1:]), (None, "http://h.example/a/0", "<p>null id")]
    long = "".join(f"<p>{say(12)} {i}</p>" for i in range(4000))
    return rows + [(400, "http://long.example/1", template(1, long)), (401, "http://long.example/2", template(2, say(50)))]


def brute(rows):
    """Pairs by sorting each host, distances by hand; texts by ``main_text``, whose parts are tested above."""
    split = lambda u: re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u).groups() if u and "://" in u else ("", "")
    hosts = {}
    for _, url, page in rows:
        host, path = split(url)
        held = hosts.setdefault(host.lower(), {})
        held[page or ""] = min(held.get(page or "", path), path)
    out = []
    for page_id, url, page in rows:
        held = hosts[split(url)[0].lower()]
        ours = held[page or ""]
        others = [(len(os.path.commonprefix([p, ours])), h) for h, p in held.items() if h != (page or "")]
        texts = {h: P.main_text(P.lines_of_page(page or ""), P.line_hashes(P.lines_of_page(h)).tolist()) for _, h in others}
        out.append((page_id, url, {texts[h] for n, h in others if n == max(others)[0]} or {P.main_text(P.lines_of_page(page or ""), None)}))
    return out


def test_pages(spark, tmp_path):
    rows = awkward_pages()
    clash = [c for c in ("host", "path", "key", "near", "lines", "text", "n_shared", "pid")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = sorted(map(tuple, P.page_texts(df).collect()), key=repr)
    assert sorted(map(tuple, P.page_texts(df.withColumns({c: F.lit("clash") for c in clash})).collect()), key=repr) == got
    want = sorted(brute(rows), key=repr)
    assert [g[:2] for g in got] == [w[:2] for w in sorted(want, key=lambda w: repr(w[:2]))]
    left = [w[:2] + (x,) for w in want for x in [w[2]]]
    for page_id, url, text, n in got:
        at = next(i for i, w in enumerate(left) if w[:2] == (page_id, url) and (text, n) in w[2])
        left.pop(at)
    texts = {g[0]: g[2] for g in got}
    assert texts[201] == "no url" and texts[203] == "" and "Daily Post" in texts[200] and texts[300] == texts[301]
    # Page 0 is nearest to one of another make.
    assert all("Daily Post" not in texts[i] and f"Page {i} visited" in texts[i] and texts[i].count("\n") == 3 for i in range(1, 30))
    assert all(texts[100 + i].endswith("quoted everywhere") and "Menu" not in texts[100 + i] for i in range(10))
    assert P.page_texts(spark.createDataFrame([], SCHEMA)).count() == 0


def test_pairs_over_partitions(spark):
    rows = [(f"h{i % 3}", f"/{i // 7}/{i}", i) for i in range(200)]
    df = spark.createDataFrame(rows, "host string, path string, key long").repartition(9)
    got = {r.key: r.near for r in P.nearest_pages(df).collect()}
    for host in {r[0] for r in rows}:
        held = sorted(r for r in rows if r[0] == host)
        for before, this, after in zip([None, *held], held, [*held[1:], None], strict=False):
            alike = [(len(os.path.commonprefix([x[1], this[1]])), -i, x[2]) for i, x in enumerate((before, after)) if x]
            assert got[this[2]] == max(alike)[2]


def test_query_on_its_table(spark, sf):
    """The articles of the given pages, cut out by another reading; repeated ids do not occur there."""
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = P.op13_page_text(spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        inner = pages[r.page_id].split("<article>", 1)[1].split("</article>", 1)[0]
        blocks = (" ".join(html.unescape(x).split()) for x in re.split(r"</?(?:p|h1|b|br)>", inner))
        assert r.text == "\n".join(x for x in blocks if x) and r.n_chars == len(r.text)


def test_shared_lines_of_menus_are_found(spark, sf):
    assert P.op13_page_text(spark, sf).where("n_shared > 0").count()
