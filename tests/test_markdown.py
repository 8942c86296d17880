"""HTML to Markdown: literal cases of nesting, and the expression against its oracle on random pages."""

import random

import pytest
from pyspark.sql import functions as F

from newsflow.functions import markdown as M
from newsflow.functions import text as T
from newsflow.plans import sqlgen

LITERAL = {
    "<p>a</p><p>b  c</p>": "a\n\nb c",
    "<ul><li>a<ul><li>b</li><li>c</li></ul></li><li>d</li></ul>end": "  * a\n    * b\n    * c\n  * d\n\nend",
    "<ol start='3'><li>a</li><li>b<ol><li>z</li></ol></li></ol>": "  3. a\n  4. b\n    1. z\n\n",
    "<ul><li>one</li></ul><ul><li>two</li></ul>": "  * one\n\n\n  * two\n\n",
    "<blockquote><p>q1</p><blockquote>q2</blockquote></blockquote>after": "> q1\n>\n>> q2\n\nafter",
    "<blockquote>a<br>b</blockquote>": "> a  \n> b",
    "a<em>b</em>c <strong> d </strong>.": "a _b_ c **d**.",
    "x <del>y</del>z<q>w</q>": 'x ~~y~~ z"w"',
    "<table><tr><th>A</th><th>B</th></tr><tr><td>1</td><td>2</td></tr></table>x": "A| B  \n---|---  \n1| 2  \nx",
    "<pre>a  b\n c</pre>t": "\n    a  b\n     c\n\nt",
    "<p>x</p><hr><p>y <code>1. z</code></p>": "x\n\n* * *\n\ny `1. z`",
    "1. no list<br>- x<br/>+ y": "1\\. no list  \n\\- x  \n\\+ y",
    "<head><title>t</title></head><body><h3>H <b>b</b></h3>x</body>": "### H **b**\n\nx",
    "<dl><dt>term</dt><dd>text</dd></dl>": "term\n    text",
    "x &lt;b&gt; &amp; y < z": "x <b> & y < z",
    "<DIV>a</DIV>\n\n<div>b": "a\n\nb",
    "<li>stray</ul></ol></blockquote>": "* stray\n\n",
    "": "",
}


@pytest.fixture(scope="module")
def pages():
    r = random.Random(9)
    names = ["p", "div", "h1", "h4", "ul", "ol", "li", "blockquote", "em", "b", "s", "code", "pre", "table", "tr", "td", "th", "br", "hr", "dl", "dt", "dd", "q", "head", "body", "span", "a"]
    texts = ["word", " two words ", "\n", " ", "1. one", "- dash", "+ plus\n2. two", "&amp;", "&nbsp;x", "&lt;p&gt;", ".", "a > b", "é", "< c", "  ", "--", "!x"]
    out = [*LITERAL]
    for _ in range(250):
        out.append("".join(r.choice([f"<{n}>", f"</{n}>", f"<{n} class='x'>", r.choice(texts), r.choice(texts), r.choice(texts)]) if n != "ol" else f"<ol start={r.randrange(30)}>"
                           for n in r.choices(names, k=r.randrange(1, 25))))
    return out


def test_literal_pages(spark):
    df = spark.createDataFrame([(x,) for x in LITERAL], "x string")
    assert {r.x: r.y for r in df.select("x", F.expr(M.to_markdown("x")).alias("y")).collect()} == LITERAL


def test_random_pages_against_the_oracle(spark, pages):
    import duckdb
    got = spark.createDataFrame([*enumerate(pages)], "i int, x string").select("i", F.expr(M.to_markdown("x")).alias("y"), T.clean_content("x").alias("z")).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE t(i INT, x VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", [[i, x] for i, x in enumerate(pages)])
    want = {i: (y, z) for i, y, z in con.execute(f"SELECT i, {sqlgen.markdown('x')}, {sqlgen.clean_content('x')} FROM t").fetchall()}
    assert len(got) == len(want)
    for r in got:
        assert (r.y, r.z) == want[r.i], pages[r.i]


def test_long_page(spark):
    page = "<ul>" + "<li>item <b>x</b> &amp; y</li>" * 3000 + "</ul>"
    row = spark.createDataFrame([(page,)], "x string").select(T.clean_content("x").alias("y")).first()
    assert row.y.count("\n") == 2999 and row.y.startswith("* item **x** & y\n * item")
