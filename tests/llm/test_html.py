"""Extraction of main text: the given pages against a plain reading of their articles, made hosts, odd markup, classes by hand."""

from __future__ import annotations

import html as entities
import re
from collections import Counter, defaultdict

import pytest
from conftest import SF_SMALL

from entiprof.llm import html
from entiprof.llm.queries import QUERIES


def frame(spark, pages):
    return spark.createDataFrame([(i, u, h, "t", 1) for i, (u, h) in enumerate(pages)], "page_id long, url string, html string, text string, host int")


def texts(spark, pages):
    return {r.page_id: r.text for r in html.extract(frame(spark, pages)).collect()}


@pytest.mark.parametrize("sf", [SF_SMALL, "/root/testdata/sf0.01"])
def test_articles_of_the_given_pages(spark, sf):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = QUERIES["op12_html"](spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        (article,) = re.findall(r"<article>(.*?)(?:</article>|\Z)", pages[r.page_id].html, re.S)
        blocks = [" ".join(entities.unescape(re.sub(r"</?b>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>|<br>", article)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def made(i, body):
    return (
        f"<html><head><title>T{i}</title></head><body><div id=top>Welcome to the site</div><nav><a href=/>Home</a></nav>"
        f"<div class='wrap x'><div>{body}</div></div><div>Copyright of the house</div><div id='comments'><p>so good {i}</p></div></body></html>"
    )


def test_host_without_articles(spark):
    bodies = [f"<p>First words of text {i} are here.</p><ul><li>point {i} &amp; more</ul><p>Last  words\n{i}" + " and more" * i for i in range(6)]
    got = texts(spark, [(f"https://a.example/{i}", made(i, b)) for i, b in enumerate(bodies)])
    assert got == {i: f"First words of text {i} are here.\npoint {i} & more\nLast words {i}" + " and more" * i for i in range(6)}


def test_text_of_the_template_goes_and_text_of_articles_stays(spark):
    license = "<p>All rights reserved by the makers of this page, who thank you.</p>"
    plain = [(f"http://b.example/{i}", f"<body><div><p>Body {i} has its own words.</p>{license}</div></body>") for i in range(5)]
    inside = [(f"http://c.example/{i}", f"<body><article><p>Body {i} has its own words.</p>{license}</article></body>") for i in range(5)]
    got = texts(spark, plain + inside)
    assert [got[i] for i in range(5)] == [f"Body {i} has its own words." for i in range(5)]
    assert [got[5 + i] for i in range(5)] == [f"Body {i} has its own words.\nAll rights reserved by the makers of this page, who thank you." for i in range(5)]


ODD = [
    ("", ""),
    ("   ", ""),
    ("just text &lt; more", "just text < more"),
    ("<p>a<b>b</b>c <i>d</i></p>", "abc d"),
    ("<article><p>one<br>two<p>three&nbsp; four<script>var a='</p><p>no';</script></article><aside>side</aside>", "one two\nthree four"),
    ("<article><h1>T</h1><div class='ad box'>buy</div><p>text <span class=advert>now</span>goes</p><section id=comments><p>nice</section></article>", "T\ntext goes"),
    ("<header>site</header><main><header><h2>Title</h2></header><form><input>name</form><p>x</p></main><footer>f</footer>", "Title\nx"),
    ("<article><!-- <p>no</p> --><p title='a > b'>yes</p><p title=\"open>still</p></article>", "yes\nstill"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>1<td>2<tr><td>3</table></article>", "a\nb\n1\n2\n3"),
    ("<article><p>cut of", "cut of"),
    ("<article><p>5 < 6 and a&am", "5 < 6 and a&am"),
    ("<head><title>t</title><p>no head end <div class='loading'>download</div>", "no head end\ndownload"),
    ("<article><style>p{}</style><textarea>no</textarea><p hidden>no</p><pre>a\n  b</pre></article>", "a b"),
    ("<article><p>" + "long words " * 200_000 + "</p></article>", ("long words " * 200_000).strip()),
    ("<article>" + "<div>" * 3000 + "deep", "deep"),
    ("<article>" + "<p>" * 3000 + "<", "<"),
    ("<div>x" * 50_000 + "<svg>" * 20_000, "x\n" * 49_999 + "x"),
]


def test_odd_pages(spark):
    got = texts(spark, [(f"http://h{i}.example/", h) for i, (h, _) in enumerate(ODD)])
    assert got == {i: want for i, (_, want) in enumerate(ODD)}
    rows = [(None, None), ("", "<article>a</article>"), ("no url", "<article>b</article>"), (None, None), ("", "<article>a</article>")]
    assert texts(spark, rows) == {0: "", 1: "a", 2: "b", 3: "", 4: "a"}
    assert html.extract(frame(spark, rows).limit(0)).collect() == []


def test_classes_equal_plain_grouping(spark):
    pages = [(r.url, r.html) for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    pages += [(f"http://a.example/{i}", made(i, f"<p>x{i}" * (i % 3))) for i in range(8)]
    vectors, of = defaultdict(lambda: defaultdict(dict)), Counter()
    for i, (url, page) in enumerate(pages):
        host = re.match(r"[a-z]+://([^/?#]*)", url)[1]
        of[host] += 1
        for t, n in Counter(html._tokens(html.read_page(page))).items():
            vectors[host][t][i] = n
    want = set()
    for host, tokens in vectors.items():
        groups = defaultdict(list)
        for t, v in tokens.items():
            if len(v) >= 3 and len(v) * 100 >= 30 * of[host]:
                groups[tuple(sorted(v.items()))].append(t)
        want |= {(host, frozenset(g)) for g in groups.values() if len(g) >= 2}
    found = defaultdict(set)
    for r in html.token_classes(html._pages(frame(spark, pages))).collect():
        found[r.host, r["class"]].add(r.token)
    assert {(host, frozenset(g)) for (host, _), g in found.items()} == want and len(want) > 10


def test_order_and_nesting():
    tag = lambda k: html.Tag(k, 0, 0)
    classes = {1: 7, 2: 7, 3: 7, 10: 8, 11: 8, 20: 9, 21: 9}
    page = [tag(k) for k in (1, 10, 11, 10, 11, 2, 20, 5, 21, 3)]
    got = {c: (order, gap) for c, order, gap in html.place(page, classes)}
    assert all(order and gap for order, gap in got.values()) and got[8][1] != got[9][1]
    crossed = {c: (order, gap) for c, order, gap in html.place([tag(k) for k in (1, 10, 11, 2, 11, 10, 3)], classes)}
    assert crossed[8] == (0, 0) and crossed[7][0] == got[7][0]
