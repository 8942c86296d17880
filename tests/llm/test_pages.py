"""URL rules, HTML text and WARC archives on small tables."""

import base64
import hashlib
import random

import pytest

from newsflow.llm import htmltext, urlfilter, warc
from pyspark.sql import functions as F

URLS = [None, "", "no scheme", "http://A.Example.ORG/es/x", "https://example.org/en/12?q", "http://org/", "http://org", "http://example.org.evil.net/es/",
        "http://x.com/fr/#a", "ftp://com/de/", "http://notexample.org/es/", "http://example.org/en/2", "a://b://c/d", "http://é.com/de/ü", "http://h/" + "p" * 5000]


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
    path = path[:min([path.index(c) for c in "?#" if c in path] or [len(path)])]
    fits = [(len(h + p), h + p, v) for h, p, v in urlfilter.RULES if path.startswith(p) and (host == h or host.endswith("." + h))]
    _, rule, verdict = max(fits, default=(0, None, "allow"))
    return host, path, rule, verdict


def test_url_rules_against_all_rules(spark):
    pages = spark.createDataFrame([(i, u, 1) for i, u in enumerate(URLS * 2)], "page_id bigint, url string, verdict int")
    rules = spark.createDataFrame(urlfilter.RULES, "host string, path string, verdict string")
    got = urlfilter.judge(pages, rules).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in got] == [brute(u) for u in URLS * 2]
    assert urlfilter.judge(pages, rules.where("false")).where("rule IS NOT NULL").count() == 0
    assert urlfilter.judge(pages.where("false"), rules).count() == 0
    assert urlfilter.judge(pages, rules.union(rules)).count() == len(pages.collect())


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{a:b}</style><script>var t="</p>";</script></head><body>
<header><h2>Site</h2></header><nav><ul><li><a href="/a">Home</a></li></ul></nav><!-- ad <p>no</p> --><div class="ad">Buy &amp; save now, really, buy a lot of things here.</div>
%s<div id="comments"><p>First! This is a reader's comment of some length, and it goes on for a while.</p></div>
<aside><p>See also</p></aside><form><p>Mail:</p><input></form><footer>&copy; us &middot; legal text of the footer</footer></body></html>"""
TEXT = "A  long\n first paragraph, with <b>bold</b> and <i>more</i> &amp; caf&eacute; &#233; text that says something about the world."


def clean(t):
    return " ".join(t.replace("<b>", "").replace("</b>", "").replace("<i>", "").replace("</i>", "").replace("&amp;", "&").replace("&eacute;", "é").replace("&#233;", "é").split())


@pytest.mark.parametrize("body,want", [
    (f"<article><h1>Head</h1><p>{TEXT}<br><p>Short.</p></article>", f"Head {clean(TEXT)} Short."),
    (f"<div><h1>Head</h1><p>{TEXT}</p><p>{TEXT}</p></div>", f"Head {clean(TEXT)} {clean(TEXT)}"),
    (f"<main><p>{TEXT}<p><b>open {TEXT}<div class='newsletter'>Subscribe</div><p>End.</main>", f"{clean(TEXT)} open {clean(TEXT)} End."),
    ("<article><p>Tiny.</p></article>", "Tiny."),
    ("<article></article>", ""),
])
def test_main_text(body, want):
    assert htmltext.main_text(PAGE % body) == want


def test_html_of_odd_tables(spark):
    long = "<p>" + "word &lt; " * 60_000 + "</p>"
    rows = [(1, "u", None, 0), (2, None, "", 0), (3, "u", "plain text", 0), (4, "u", "<p>cut off <b", 0), (5, "u", long, 0), (5, "u", "a < b and c > d", 0), (6, "u", "<!-- x", 0)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text int")
    got = [(r.page_id, r.text, r.n_chars) for r in htmltext.extract(pages).orderBy("page_id", "n_chars").collect()]
    texts = ["", "", "plain text", "cut off <b", "a < b and c > d", ("word < " * 60_000).strip(), ""]
    assert got == [(i, t, len(t)) for i, t in zip((1, 2, 3, 4, 5, 5, 6), texts, strict=True)]
    assert htmltext.extract(pages.where("false")).count() == 0


@pytest.mark.parametrize("least", [0, 20])
def test_archives_hold_every_page(spark, tmp_path, least):
    r = random.Random(1)
    html = [None, "", "é", "<p>same</p>" * 4, "<p>same</p>" * 4] + ["<html>" + "".join(r.choice("<p>abc é</p> ") for _ in range(400)) + "</html>" for _ in range(60)]
    html += ["x" * 3_000_000, html[5], html[5]]
    rows = [(i - 3, f"http://h/{i} \n", h, "extra") for i, h in enumerate(html)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, hex string").repartition(4)
    out = warc.archive(spark, pages, str(tmp_path / "w"), least)
    got = {x.page_id: x for x in out.collect()}
    assert len(got) == out.count() == len(html)
    for i, h in enumerate(html):
        data, x = (h or "").encode(), got[i - 3]
        same = [k - 3 for k, o in enumerate(html) if (o or "").encode() == data]
        first = min(same) if len(data) >= least else i - 3
        assert x.payload_bytes == len(data) and x.payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert (x.record_type, x.refers_to) == (("response", None) if first == i - 3 else ("revisit", first))
        assert (x.payload or b"") == (data if first == i - 3 else b"")
    heads = {p.read_bytes()[:4] for p in (tmp_path / "w").glob("*.warc.zst")}
    assert heads == {b"\x5d\x2a\x4d\x18"}


def test_archives_of_odd_tables(spark, tmp_path):
    pages = spark.createDataFrame([(None, None, None), (None, "u", "a"), (4, "u", "a"), (4, "u", "a"), (2**62, "u", "b"), (-5, "u", "b")], "page_id bigint, url string, html string")
    got = sorted(((x.page_id, x.record_type, x.refers_to) for x in warc.archive(spark, pages, str(tmp_path / "a")).collect()), key=repr)
    assert got == sorted([(None, "response", None), (None, "revisit", 4), (4, "response", None), (4, "response", None), (2**62, "revisit", -5), (-5, "response", None)], key=repr)
    assert warc.archive(spark, pages.where("false"), str(tmp_path / "b")).count() == 0


def test_text_of_linked_and_unclosed_parts_stays():
    from newsflow.llm.htmltext import main_text
    body = "The council met on Monday and agreed to the plan for the bridge, which is to be built next year. " * 3
    text = body.strip()
    assert main_text(f"<article><h1><a href=x>Title</a></h1><p>{body}</p><p>Read <a>the full announcement</a>.</p><ul><li><a>Ref one</a><li><a>Ref two</a></ul></article>") \
        == f"Title {text} Read the full announcement . Ref one Ref two".replace("announcement .", "announcement.")
    cards = "<article class=teaser><p>See this too</p></article>" * 3
    assert text in main_text(f"<div><p>{body}</p></div>{cards}")
    assert main_text(f"<div><p>{body}</p></div><article class=comment><p>{body.upper() * 3}</p></article>") == text
    assert main_text(f"<article class='post related'><p>{body}</p></article>") == text
    for name in ("select", "object", "svg", "canvas", "audio", "video"):
        assert main_text(f"<body><div><{name}>lost</div><p>{body}</p></body>") == text
        assert main_text(f"<body><div><{name}>lost</div><p>{body}</p><{name}>x</{name}></body>") == text
    assert main_text(f"<p>{body}</p><nav>menu</nav><article><p>{body.upper()}</p></article>") == text.upper()
