"""Landed feed documents: positions in split files, broken documents, and the registry's pruning."""

import os

import pytest
from pyspark.sql import functions as F

from newsflow.operators import ingest as IN
from newsflow.sources import feeds as FD


@pytest.fixture
def small_splits(spark):
    """Files are read in splits of 2 kB."""
    keys = {"spark.sql.files.maxPartitionBytes": "2k", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def write(folder, feed, name, text):
    os.makedirs(f"{folder}/feed_url={feed}", exist_ok=True)
    with open(f"{folder}/feed_url={feed}/{name}", "w", encoding="utf-8") as f:
        f.write(text)


def document(items):
    return "<?xml version='1.0'?>\n<rss version='2.0'><channel><title>F</title><link>x</link>\n" + "".join(items) + "</channel>\n</rss>\n"


def item(title, extra=""):
    return f"<item>\n <title>{title}</title><link>http://x/{title}</link><description><![CDATA[<p>é {'y' * (len(title) * 37 % 90)}</p>]]></description>{extra}</item>\n"


def test_positions_in_a_file_of_many_splits(spark, tmp_path, small_splits):
    names = [f"t{i}" for i in range(400)]
    write(tmp_path, "a", "one.xml", document(map(item, names)))
    write(tmp_path, "a", "two.xml", document(map(item, names[:3])))
    write(tmp_path, "b", "one.xml", document(map(item, names[::-1])).replace("\n", " "))      # one line
    lines = FD.item_texts(spark, str(tmp_path))
    assert lines.select("file_path", "_block").distinct().count() > 30
    got = {}
    for r in FD.scan_items(spark, str(tmp_path)).collect():
        got.setdefault((r.feed_url, r.file_path.rsplit("/", 1)[1]), []).append((r.entry_pos, r.title))
        assert r._corrupt_record is None and r.description.startswith("<p>é")
    want = {("a", "one.xml"): names, ("a", "two.xml"): names[:3], ("b", "one.xml"): names[::-1]}
    assert {k: sorted(v) for k, v in got.items()} == {k: [*enumerate(v)] for k, v in want.items()}


def test_broken_documents_and_items(spark, tmp_path):
    good = item("good")
    write(tmp_path, "ok", "f.xml", document([good, "<item a='1'/>", item("second", "<dc:creator>Z</dc:creator>")]))
    write(tmp_path, "item", "f.xml", document([good, "<item><title>bad</wrong></item>", item("after")]))
    write(tmp_path, "open", "f.xml", document([good, "<item><title>never closed</title>", item("after")]))
    write(tmp_path, "cut", "f.xml", document([good, item("lost")])[:-120])
    write(tmp_path, "html", "f.xml", "<html><body>error 500</body></html>")
    write(tmp_path, "empty", "f.xml", "<rss><channel></channel></rss>")
    documents = FD.feed_documents(spark, str(tmp_path))
    flags = {r.file_path.split("feed_url=")[1].split("/")[0]: (r["items"], r.malformed) for r in documents.collect()}
    assert flags == {"ok": (2, False), "item": (3, False), "open": (3, True), "cut": (2, True), "html": (0, True), "empty": (0, False)}
    items = FD.with_feed_flag(FD.scan_items(spark, str(tmp_path)), documents)
    rows = {}
    for r in items.orderBy("feed_url", "entry_pos").collect():
        rows.setdefault(r.feed_url, []).append((r.title if r._corrupt_record is None else None, r.malformed))
    assert rows == {"ok": [("good", False), ("second", False)], "item": [("good", True), (None, True), ("after", True)],
                    "open": [("good", True), ("never closed", True), ("after", True)], "cut": [("good", True), (None, True)]}


def test_only_registered_feeds_are_opened(spark, tmp_path):
    for feed in "abc":
        write(tmp_path / "feeds", feed, "f.xml", document([item(f"{feed}{i}") for i in range(3)]))
    rows = [("x", 0, "a"), ("y", 0, "b"), ("y", 1, "a"), ("z", 0, "none")]
    spark.createDataFrame(rows, "feed_category string, feed_pos int, feed_url string").write.parquet(str(tmp_path / "registry"))
    registry = spark.read.parquet(str(tmp_path / "registry"))
    one = registry.where("feed_category = 'x'")
    lines = FD.item_texts(spark, str(tmp_path / "feeds"), registry=one)
    plan = spark._jvm.PythonSQLUtils.explainString(lines._jdf.queryExecution(), "formatted")
    assert "dynamicpruningexpression(feed_url" in plan
    got = FD.scan_items(spark, str(tmp_path / "feeds"), registry=registry)
    assert sorted((r.feed_category, r.feed_pos, r.entry_pos, r.title) for r in got.collect()) == sorted(
        (c, p, i, f"{f}{i}") for c, p, f in rows if f != "none" for i in range(3))
    entries = FD.rss_items_to_entries(IN.drop_unparsed(FD.scan_items(spark, str(tmp_path / "feeds"), registry=registry)))
    new = FD.fetch_entries(entries, None, cap=2).collect()       # a feed of two categories: the first in registry order wins
    assert sorted((r.category, r.title) for r in new) == [("x", "a0"), ("x", "a1"), ("y", "b0"), ("y", "b1")]
    none = FD.scan_items(spark, str(tmp_path / "feeds"), registry=registry.where("feed_category = 'z'"))
    assert none.count() == 0


def test_documents_are_landed_whole(spark, tmp_path):
    rows = spark.createDataFrame([(f"f{i % 2}", f"t<{i}>&", i) for i in range(50)], "feed_url string, title string, guid bigint")
    empty = F.lit(None).cast("string")
    full = rows.select("*", *[empty.alias(c) for c in ("link", "description", "pubDate", "creator", "content")], F.array().cast("array<string>").alias("category"))
    path = FD.land_feed_documents(full.repartition(5), str(tmp_path / "feeds"))
    assert {(r["items"], r.malformed) for r in FD.feed_documents(spark, path).collect()} == {(25, False)}
    got = FD.scan_items(spark, path).select("feed_url", "entry_pos", "title").collect()
    assert sorted(map(tuple, got)) == sorted((f"f{i % 2}", i // 2, f"t<{i}>&") for i in range(50))
