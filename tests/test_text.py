"""Literal rows for the semantics that are easy to get wrong (FIXTURES.md part C)."""

from pyspark.sql import functions as F

from conftest import one
from newsflow.functions import entry as E
from newsflow.functions import text as T


def test_title_case(spark):
    assert one(spark, T.title_case(F.col("x")), x="bbc-news o'neil x1y") == "Bbc-News O'Neil X1Y"
    assert one(spark, T.title_case(F.col("x")), x="ßver") == "Ssver"


def test_slug(spark):
    assert one(spark, T.slug(F.col("x")), x='It\'s  a "Test" – Été!') == "its-a-test-t"
    assert one(spark, T.slug(F.col("x")), x="") == ""


def test_source_name(spark):
    assert one(spark, T.source_name(F.col("u")), u="https://www.allrecipes.com/rss/daily-dish/") == "Allrecipes"
    assert one(spark, T.source_name(F.col("u")), u="https://feeds.bbci.co.uk/news/rss.xml") == "Feeds"
    assert one(spark, T.source_name(F.col("u")), u="http://localhost:8080/x") == "Localhost:8080"


def test_processor_source(spark):
    assert one(spark, T.processor_source(F.col("u")), u="https://www.npr.org/rss/rss.php?id=1001") == "npr_org"
    assert one(spark, T.processor_source(F.col("u")), u="https://kotaku.com/rss") == "kotaku"
    assert one(spark, T.processor_source(F.lit(None).cast("string"))) == "unknown"
    assert one(spark, T.processor_source(F.col("u")), u="") == "unknown"
    assert one(spark, T.processor_source(F.col("u")), u="feeds/world.rss") == "world"


def test_api_source(spark):
    assert one(spark, T.api_source(F.col("u")), u="https://feeds.bbci.co.uk/news/rss.xml") == "rss"
    assert one(spark, T.api_source(F.col("u")), u="https://pitchfork.com/rss/news/") == ""
    r = one(spark, T.api_id(F.col("t"), F.col("l"), F.col("u")), t="T", l="L", u="https://pitchfork.com/rss/news/")
    assert r.startswith("_") and len(r) == 33


def test_ids_md5(spark):
    import hashlib
    h = hashlib.md5("TitleLink".encode()).hexdigest()
    assert one(spark, T.dedup_key(F.col("t"), F.col("l")), t="Title", l="Link") == h
    assert one(spark, T.article_id(F.col("t"), F.col("l"), F.col("n")), t="Title", l="Link", n="") == "unknown_" + h


def test_clean_html(spark):
    assert one(spark, T.clean_html(F.col("x")), x="a<b>b</b>c&nbsp;d") == "a b c d"
    step1 = one(spark, T.clean_html(F.col("x")), x="&lt;script&gt;x&lt;/script&gt;y")
    assert step1 == "<script>x</script>y"
    assert one(spark, T.clean_content(F.col("x")), x=step1) == "y"
    assert one(spark, T.clean_html(F.col("x")), x="<script>var a='</p>';</script><!-- c --><p>t &amp;lt; u</p>") \
        == "t &lt; u"


def test_numeric_entities(spark):
    assert one(spark, T.decode_entities(F.col("x")), x="&#233;t&#xE9; &#x1F600; &#0; &#xD800; &amp;#65;") \
        == "été 😀 \ufffd \ufffd &#65;"          # no such characters: as HTML reads them


def test_clean_content_passthrough_and_rules(spark):
    assert one(spark, T.clean_content(F.col("x")), x="") == ""
    assert one(spark, T.clean_content(F.lit(None).cast("string"))) is None
    out = one(spark, T.clean_content(F.col("x")), x="<h2>Head</h2><p>a  \t b</p>\n \n\n<ul><li>x</li></ul>")
    assert out == "## Head\n\na b\n\n * x"


def test_strip_unicode_whitespace(spark):
    assert one(spark, T.strip(F.col("x")), x="\n a \t") == "a"
    assert one(spark, T.strip(F.col("x")), x="  a b　") == "a b"
    assert one(spark, T.word_count(F.col("x")), x="") == 0
    assert one(spark, T.word_count(F.col("x")), x=" a b\tc ") == 3


def test_truncate_ellipsis(spark):
    assert one(spark, T.truncate_ellipsis(F.col("x"), 3), x="abc") == "abc"
    assert one(spark, T.truncate_ellipsis(F.col("x"), 3), x="abcd") == "abc..."


def test_parse_published(spark):
    assert one(spark, T.parse_published(F.col("x")), x="Mon, 01 Jan 2024 12:00:00 GMT") == "2024-01-01T12:00:00"
    assert one(spark, T.parse_published(F.col("x")), x="2024-02-03T04:05:06Z") == "2024-02-03T04:05:06"
    assert one(spark, T.parse_published(F.col("x"), "2030-01-01T00:00:00"), x="garbage") == "2030-01-01T00:00:00"


def test_parse_batch_response(spark):
    r = one(spark, T.parse_batch_response(F.col("x"), 3),
            x="a ---SUMMARY_SEPARATOR---  ---SUMMARY_SEPARATOR--- b")
    assert list(r) == ["a", "b", ""]
    r = one(spark, T.parse_batch_response(F.col("x"), 1), x="a ---SUMMARY_SEPARATOR--- b")
    assert list(r) == ["a"]


def test_display_date_and_source(spark):
    assert one(spark, T.display_date(F.col("x")), x="2024-01-05T00:00:00") == "Jan 5, 2024"
    assert one(spark, T.display_date(F.col("x")), x="") == "Unknown date"
    assert one(spark, T.display_date(F.col("x")), x="not a date") == "Invalid Date"
    assert one(spark, T.display_source(F.col("x")), x="kotaku") == "Kotaku"
    assert one(spark, T.display_source(F.col("x")), x="") == "Unknown Source"
    assert one(spark, T.display_source(F.col("x")), x="https://www.theverge.com/rss/index.xml") == "theverge"
    # JS String.replace hits the first occurrence only
    assert one(spark, T.display_source(F.col("x")), x="https://a.com.com/") == "a.com"
    assert one(spark, T.display_source(F.col("x")), x="feeds/world.rss") == "world"


def test_entry_fields(spark):
    df = spark.createDataFrame(
        [([("",)], "d", "s", ("sd",), [("", "L"), ("T", None)], None, "", ("N",))],
        "content array<struct<value:string>>, description string, summary string, "
        "summary_detail struct<value:string>, tags array<struct<term:string,label:string>>, "
        "category array<string>, author string, author_detail struct<name:string>")
    r = df.select(E.content_coalesce("content", F.col("description"), F.col("summary"),
                                     F.col("summary_detail.value")).alias("c"),
                  E.entry_categories("tags", "category").alias("cats"),
                  E.entry_tags("tags", E.entry_categories("tags", "category")).alias("tags"),
                  E.entry_author(F.col("author"), F.col("author_detail.name")).alias("a")).first()
    assert r["c"] == ""                      # a non-empty content list wins with ''
    assert list(r["cats"]) == ["", "T"]      # blank terms kept
    assert list(r["tags"]) == ["L", "T"]     # term, else label
    assert r["a"] == "N"


def test_entry_tags_fall_back_to_categories(spark):
    df = spark.createDataFrame([([], ["x", "y"])],
                               "tags array<struct<term:string,label:string>>, category array<string>")
    r = df.select(E.entry_tags("tags", E.entry_categories("tags", "category")).alias("t")).first()
    assert list(r["t"]) == ["x", "y"]


def test_summary_batches_sizes(spark):
    from newsflow.operators.summarize import summary_batches
    df = spark.range(45).select(F.lit("f").alias("source_file"), F.col("id").alias("pos"))
    sizes = [r["n"] for r in summary_batches(df).groupBy("batch_id").count()
             .withColumnRenamed("count", "n").orderBy("batch_id").collect()]
    assert sizes == [20, 20, 5]


def test_dense_position_crosses_ranges(spark):
    from newsflow.operators.summarize import dense_position
    pos = [3, 5, 8, 13, 21, 34, 55, 89, 144, 233, 377]
    df = spark.createDataFrame([("a", p) for p in pos] + [("b", p * 2) for p in pos[:4]], "f string, pos long")
    got = {(r["f"], r["pos"]): r["_rn"] for r in dense_position(df, "f", "pos", width=7).collect()}
    assert [got[("a", p)] for p in pos] == list(range(1, len(pos) + 1))
    assert [got[("b", p * 2)] for p in pos[:4]] == [1, 2, 3, 4]


def test_bare_less_than_is_text_and_all_named_entities_decode(spark):
    src = "if a < b and c > d then caf&eacute; &agrave; &sum; <b>x</b><!-- y --></p>"
    assert one(spark, T.clean_html(F.col("t")), t=src) == "if a < b and c > d then café à ∑ x"
    assert one(spark, T.clean_content(F.col("t")), t="1 < 2 &eacute;<br>z") == "1 < 2 é \nz"      # a break is two blanks and a new line
