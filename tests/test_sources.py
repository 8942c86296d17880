"""Sources and sinks on small fixture files written to a temp directory."""

import datetime
import os
import tempfile
import time

from pyspark.sql import functions as F

from newsflow import schemas as SC
from newsflow.operators import ingest as IN
from newsflow.sources import feeds as FD
from newsflow.sources import files as FS
from newsflow.sources import tables as TB
from conftest import SF_SMALL

FEED_XML = """<rss xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:content="http://purl.org/rss/1.0/modules/content/">
<channel><title>F</title>
<item><title>A</title><link>http://a.example/1</link><pubDate>Mon, 01 Jan 2024 12:00:00 GMT</pubDate>
<category>x</category><category>y</category><dc:creator>Z</dc:creator>
<content:encoded><![CDATA[<p>hi</p>]]></content:encoded></item>
<item><title>B</title><category>q</category></item>
</channel></rss>
"""


def test_rss_scan_fixture(spark):
    d = tempfile.mkdtemp()
    with open(os.path.join(d, "feed.xml"), "w") as f:
        f.write(FEED_XML)
    items = FD.scan_rss(spark, d)
    rows = {r["title"]: r for r in IN.drop_unparsed(items).collect()}
    assert set(rows) == {"A", "B"}
    a = rows["A"]
    assert list(a["category"]) == ["x", "y"] and a["dc:creator"] == "Z" and a["content:encoded"] == "<p>hi</p>"
    ent = FD.rss_items_to_entries(items.withColumn("feed_url", F.lit("http://a.example/feed"))
                                  .withColumn("feed_category", F.lit("general"))
                                  .withColumn("entry_pos", F.lit(0)))
    raw = IN.parse_entry(IN.drop_unparsed(ent))
    got = {r["title"]: r for r in raw.collect()}
    assert got["A"]["date"] == "2024-01-01T12:00:00"
    assert got["A"]["content"] == "hi" and got["A"]["author"] == "Z"
    assert list(got["B"]["tags"]) == ["q"]


def test_raw_scan_skips_other_files_and_empty(spark):
    d = tempfile.mkdtemp()
    with open(os.path.join(d, "raw_news_2024_01_01_00_00.json"), "w") as f:
        f.write('[{"id": "a", "title": "T", "url": "u", "tags": ["x"]}, {"id": "b", "title": "U"}]')
    with open(os.path.join(d, "raw_news_2024_01_01_00_01.json"), "w") as f:
        f.write("[]")
    with open(os.path.join(d, "seen_articles.json"), "w") as f:
        f.write('["0123"]')
    df = FS.scan_raw(spark, d)
    rows = sorted(df.select("id", "url").collect())
    assert [r["id"] for r in rows] == ["a", "b"] and rows[1]["url"] is None


def test_latest_files_by_mtime(spark):
    d = tempfile.mkdtemp()
    old = os.path.join(d, "processed_news_20240101_000000.json")
    new = os.path.join(d, "api_articles_1.json")
    with open(old, "w") as f:
        f.write('[{"id": "old"}]')
    with open(new, "w") as f:
        f.write('[{"id": "n1"}, {"id": "n2"}]')
    os.utime(old, (time.time() - 3600, time.time() - 3600))
    df = FS.latest_files(spark, d)
    rows = df.select("id", "total_articles", "available_files").collect()
    assert sorted(r["id"] for r in rows) == ["n1", "n2"]
    assert {r["total_articles"] for r in rows} == {2} and {r["available_files"] for r in rows} == {2}


def test_registry_frame_keeps_feed_order(spark):
    urls = ["https://b.example/rss", "https://a.example/feed", "https://c.example/rss/"]
    reg = FD.registry_frame(spark, {"general": urls}).orderBy("category_pos", "feed_pos").collect()
    assert [r["feed_url"] for r in reg] == urls
    assert [r["feed_pos"] for r in reg] == [0, 1, 2]


def test_latest_file_may_be_empty_and_legacy_is_the_fallback(spark):
    d = tempfile.mkdtemp()

    def put(name, text, age):
        path = os.path.join(d, name)
        with open(path, "w") as f:
            f.write(text)
        os.utime(path, (1_700_000_000 + age, 1_700_000_000 + age))
    assert FS.latest_files(spark, d).count() == 0
    put("latest_articles.json", '[{"id": "old"}]', 0)
    assert [r["id"] for r in FS.latest_files(spark, d).collect()] == ["old"]
    put("processed_news_1.json", '[{"id": "n1"}]', 1)
    assert [(r["id"], r["available_files"]) for r in FS.latest_files(spark, d).collect()] == [("n1", 1)]
    put("processed_news_2.json", "[]", 2)
    assert FS.latest_files(spark, d).count() == 0


def test_unreadable_seen_table_is_an_error(spark):
    d = tempfile.mkdtemp()
    with open(os.path.join(d, "part-0.parquet"), "w") as f:
        f.write("not parquet")
    import pytest
    with pytest.raises(Exception):
        FS.read_seen(spark, d).count()


def test_all_entries_of_a_feed_are_fetched_unless_capped(spark):
    e = TB.page_entries(spark, SF_SMALL).withColumn("feed_url", F.lit("http://one.example/f/")).withColumn("feed_category", F.lit("c"))
    more = e.unionByName(e.withColumn("title", F.concat("title", F.lit(" again"))).withColumn("entry_pos", F.col("entry_pos") + 1000))
    reg = FD.registry_from_entries(more)
    n = more.select("title", "link").distinct().count()
    assert n > 50 and FD.fetch_all_feeds(more, reg, None).count() == n
    assert FD.fetch_all_feeds(more, reg, None, cap=50).count() <= 50


def test_broken_items_are_dropped(spark):
    d = tempfile.mkdtemp()
    with open(os.path.join(d, "f.xml"), "w") as f:
        f.write("<rss><channel><item><title>good</title></item><item><title>bad</wrong></item><item><title>fine</title></item></channel></rss>")
    items = FD.scan_rss(spark, d).cache()
    assert items.filter("_corrupt_record IS NOT NULL").count() == 1
    assert sorted(r["title"] for r in IN.drop_unparsed(items).collect()) == ["fine", "good"]


def test_feed_health_of_broken_and_silent_feeds(spark):
    e = TB.page_entries(spark, SF_SMALL).limit(3).withColumn("feed_url", F.lit("http://a.example/f"))
    broken = e.limit(1).withColumn("_corrupt_record", F.lit("<item>")).withColumn("title", F.lit(None).cast("string"))
    entries = e.withColumn("_corrupt_record", F.lit(None).cast("string")).unionByName(broken).unionByName(
        broken.withColumn("feed_url", F.lit("http://b.example/f")))
    reg = spark.createDataFrame([(f"http://{x}.example/f",) for x in "abc"], "feed_url string")
    rows = IN.feed_health(entries, registry=reg).select("feed_url", "entries", "missing_title", "malformed", "sample_pos").collect()
    assert len(rows) == 5 and {tuple(r) for r in rows} == {
        *[("http://a.example/f", 3, 0, True, i) for i in (1, 2, 3)],
        ("http://b.example/f", 0, 0, True, None), ("http://c.example/f", 0, 0, False, None)}


def test_first_wins_by_row_ids_equals_whole_rows(spark):
    rows = [(i, f"f{i % 3}", i // 3, f"t{i % 7}", f"u{i % 2}") for i in range(60)]
    raw = spark.createDataFrame(rows, "page_id bigint, source_feed string, entry_pos int, title string, url string")
    seen = IN.seen_hashes(raw.limit(2))
    narrow, whole = IN.new_articles(raw, seen, row_id=("page_id",)), IN.new_articles(raw, seen)
    assert 0 < whole.count() < 14
    assert sorted(narrow.select(*whole.columns).collect()) == sorted(whole.collect())


def test_trending_over_its_seed(spark, tmp_path):
    from newsflow.operators import recommend as RC
    from newsflow.operators.textindex import TextIndex
    texts = {1: "news today", 2: "current events today", 3: "a recipe for plain bread and butter"}
    docs = spark.createDataFrame([(i, t, f"Election {t}", "c") for i, t in texts.items()], "id bigint, text string, title string, category string")
    index = TextIndex(spark, str(tmp_path / "index"))
    index.add(docs.selectExpr("*", "'' link", "'' summary", "'' published", "'' source_name", "array('t') tags", "'' content_preview"))
    topics = RC.trending_now(index).orderBy("topic_pos").collect()
    assert [(t.topic, t.article_count, t.mention_count) for t in topics][:2] == [("C", 2, None), ("Election", None, 2)]


def test_stream_keeps_null_keys_apart_and_replays_without_copies(spark):
    from newsflow.sinks.seen import SeenTable
    from newsflow.sinks.versions import VersionedTable
    from newsflow.streaming import ingest as ST
    d = tempfile.mkdtemp()
    rows = [(None, "a"), ("a", None), ("", "a"), ("a", "b"), ("a", "b")]
    spark.createDataFrame(rows, "k1 string, k2 string").write.parquet(d + "/in")
    out, seen = VersionedTable(spark, d + "/out", ("_batch",)), SeenTable(spark, d + "/seen", digits=1)
    for run in (1, 2):           # the second run has lost its checkpoint: the same rows again
        s = ST.event_stream(spark, d + "/in", spark.read.parquet(d + "/in").schema)
        ST.run_with_seen_table(s, ["k1", "k2"], out, seen, d + f"/ckpt{run}")
        got = out.read().select("k1", "k2").collect()
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, set(rows)))


def test_stream_on_a_new_checkpoint_loses_nothing(spark):
    import glob
    import shutil

    from newsflow.sinks.seen import SeenTable
    from newsflow.sinks.versions import VersionedTable
    from newsflow.streaming import ingest as ST
    d = tempfile.mkdtemp()
    out, seen = VersionedTable(spark, d + "/out", ("_batch",)), SeenTable(spark, d + "/seen", digits=1)

    def land(name, keys):
        spark.createDataFrame([(k,) for k in keys], "k string").coalesce(1).write.mode("append").parquet(d + "/" + name)

    def run(folder, checkpoint):
        ST.run_with_seen_table(ST.event_stream(spark, d + "/" + folder, spark.read.parquet(d + "/" + folder).schema, 1), ["k"], out, seen, d + "/" + checkpoint)
        return sorted(r.k for r in out.read().collect())
    land("one", "ab")
    assert run("one", "c1") == ["a", "b"]
    land("two", "bcd")
    assert run("two", "c2") == ["a", "b", "c", "d"]              # both streams begin at epoch 0
    land("one", "ae")
    assert run("one", "c1") == ["a", "b", "c", "d", "e"]
    offsets = max(glob.glob(d + "/c1/commits/[0-9]*"))
    os.remove(offsets)                                        # the batch was written, but not marked as done
    for f in glob.glob(d + "/c1/commits/.*.crc"):
        os.remove(f)
    assert run("one", "c1") == ["a", "b", "c", "d", "e"]
    shutil.copytree(d + "/seen", d + "/old")
    land("three", "f")
    assert run("three", "c3")[-1] == "f"
    stale = SeenTable(spark, d + "/old", digits=1)            # the hashes of the last batch were lost
    land("four", "fg")
    ST.run_with_seen_table(ST.event_stream(spark, d + "/four", spark.read.parquet(d + "/four").schema), ["k"], out, stale, d + "/c4")
    assert sorted(r.k for r in out.read().collect()) == list("abcdefg")


def test_large_groups_become_several_files(spark):
    d = tempfile.mkdtemp() + "/raw"
    rows = [(f"id{i}", "hot" if i % 3 else "cold", i) for i in range(60)]
    df = spark.createDataFrame(rows, "id string, feed string, pos bigint")
    FS.land_json_arrays(df, d, "feed", "pos", per_file=10)
    got = FS.scan_raw(spark, d, schema=df.schema)
    assert sorted(r[:3] for r in map(tuple, got.collect())) == sorted(rows)
    assert got.select("source_file").distinct().count() == 12


def test_upsert_takes_the_latest_of_a_batch(spark):
    from newsflow.sinks import tables as SK
    d = tempfile.mkdtemp()
    schema = "id string, embedding array<double>, at timestamp_ntz"
    times = [datetime.datetime(2024, 1, day) for day in range(1, 10)]
    first = spark.createDataFrame([("a", [float(i)], t) for i, t in enumerate(times)] + [("b", [0.5], times[0])], schema)
    one, n1 = SK.upsert_vectors(None, first.repartition(4, "embedding"), d + "/v1", 1, order="at")
    two, n2 = SK.upsert_vectors(one, spark.createDataFrame([("b", [7.0], times[0])], schema), d + "/v2", 2, order="at")
    assert (n1, n2) == (10, 1)
    assert sorted((r.id, r.embedding[0], r.version) for r in two.collect()) == [("a", 8.0, 1), ("b", 7.0, 2)]


def test_seen_missing_table_is_empty(spark):
    assert FS.read_seen(spark, tempfile.mkdtemp() + "/nope").count() == 0


def test_schemas_declared():
    assert "ai_summary" in SC.PROCESSED_ARTICLE.fieldNames()
    assert SC.API_ARTICLE.fieldNames()[-1] == "similarity_score"


ATOM_XML = """<feed xmlns="http://www.w3.org/2005/Atom"><title>F</title>
<entry><title>A</title><link rel="alternate" href="http://a.example/1"/><updated>2024-02-03T04:05:06Z</updated>
<author><name>Ann</name></author><category term="t1" label="L1"/><category term="" label="L2"/>
<content>&lt;p&gt;hi&lt;/p&gt;</content></entry>
</feed>
"""


def test_atom_scan_fixture(spark):
    d = tempfile.mkdtemp()
    with open(os.path.join(d, "feed.atom"), "w") as f:
        f.write(ATOM_XML)
    items = FD.scan_atom(spark, d)
    ent = FD.atom_items_to_entries(items.withColumn("feed_url", F.lit("http://a.example/atom"))
                                   .withColumn("feed_category", F.lit("general")).withColumn("entry_pos", F.lit(0)))
    r = IN.parse_entry(IN.drop_unparsed(ent)).first()
    assert r["url"] == "http://a.example/1" and r["date"] == "2024-02-03T04:05:06"
    assert r["author"] == "Ann" and r["content"] == "hi"
    assert list(r["categories"]) == ["t1", ""] and list(r["tags"]) == ["t1", "L2"]


def test_api_summary_is_the_models_first(spark):
    from newsflow.operators import api as AP
    rows = [("a", "ai", "plain"), ("b", None, "plain"), ("c", None, None)]
    got = AP.api_projection(spark.createDataFrame(rows, "title string, ai_summary string, summary string")).collect()
    assert {r.title: r.summary for r in got} == {"a": "ai", "b": "plain", "c": ""}


def test_landing_asks_the_driver_little_for_each_file(spark, monkeypatch):
    client = spark.sparkContext._gateway._gateway_client
    def calls(n):
        rows = spark.createDataFrame([(f"id{i}", f"f{i}" if i else None, i) for i in range(n)], "id string, feed string, pos bigint")
        d, asked = tempfile.mkdtemp() + "/raw", []
        with monkeypatch.context() as m:
            m.setattr(client, "send_command", lambda c, *a, _send=client.send_command, **b: asked.append(not c.startswith("m\n")) or _send(c, *a, **b))
            FS.land_json_arrays(rows, d, "feed", "pos", per_file=10)
        got = FS.scan_raw(spark, d, schema=rows.schema)
        assert sorted(r.id for r in got.collect()) == sorted(f"id{i}" for i in range(n))
        assert len([f for f in os.listdir(d) if f.endswith(".json")]) == n + 1
        return sum(asked)
    few, many = calls(20), calls(220)
    assert (many - few) / 200 < 6


def test_landing_no_articles_lands_no_file(spark):
    d = tempfile.mkdtemp() + "/raw"
    FS.land_json_arrays(spark.createDataFrame([], "id string, feed string, pos bigint"), d, "feed", "pos")
    assert [f for f in os.listdir(d) if not f.startswith(".")] == ["seen_articles.json"]
