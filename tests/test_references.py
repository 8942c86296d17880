"""Character references against the standard library's reading of them."""

import html
import random
from html.entities import html5

from pyspark.sql import functions as F

from newsflow.functions import text as T
from newsflow.functions import sql as S
from newsflow.plans import sqlgen


def cases():
    r = random.Random(5)
    names = sorted(html5)
    out = ["&check;", "a&nbspb", "&notit;", "&notin;", "&amp;lt;", "&&amp&", "& amp;", "&#65;&#x41&#X41;z", "&#0;&#13;&#128;&#x81;&#xD800;&#1114112;&#99999999999;&#x00000041;", "&#;&#x;&#xg;",
           "&#1;&#11;&#127;&#64976;&#xFFFF;&#x1F600;", "&AMP;&amp&AMPx&ampx", "&unknown; &unknown &a", "&fjlig;&NewLine;&Tab;&bne;", "no reference", "", "&", "x&", "&lt", "&ngeqq;", "&CounterClockwiseContourIntegral;&CounterClockwiseContourIntegral"]
    out += [f"a&{n}b" for n in names] + [f"&{n.rstrip(';')}" for n in names]
    for _ in range(1500):
        out.append("".join(r.choice(["&", "#", "x", "X", ";", " ", "1", "9", "a", "F", "é", "\n", r.choice(names), "&" + r.choice(names), r.choice(names)[:3], f"&#{r.randrange(1200000)}", f"&#x{r.randrange(1200000):x};"])
                           for _ in range(r.randrange(1, 9))))
    return out


def test_references_are_read_as_html_does(spark):
    rows = cases()
    got = spark.createDataFrame([*enumerate(rows)], "i int, x string").select("i", F.expr(S.decode_entities("x")).alias("y")).collect()
    assert {rows[r.i]: r.y for r in got} == {x: html.unescape(x) for x in rows}


def test_the_oracle_reads_them_so_too():
    import duckdb
    rows = cases()
    con = duckdb.connect()
    con.execute("CREATE TABLE t(x VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?)", [[x] for x in rows[:23] + rows[23::9]])
    assert all(y == html.unescape(x) for x, y in con.execute(f"SELECT x, {sqlgen.decode_entities('x')} FROM t").fetchall())


def test_clean_html_decodes_after_the_tags(spark):
    df = spark.createDataFrame([("<p>&lt;b&gt;x&lt;/b&gt; &check; a&nbsp;b &copy 2024</p>",), (None,)], "x string")
    assert [r[0] for r in df.select(T.clean_html("x")).collect()] == ["<b>x</b> ✓ a b © 2024", ""]
