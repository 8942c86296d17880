"""Raw files to processed runs."""

import json
import os

from pyspark.sql import functions as F

from newsflow.operators import pipeline as PL
from newsflow.operators import summarize as SU
from newsflow.sinks.versions import VersionedTable
from newsflow.sources import files as FS


def article(i):
    return {"id": f"r{i}", "title": f" T{i} ", "url": f"http://x/{i}", "content": f"word{i} " * 3, "source_feed": "http://f.example/rss", "tags": ["a", "b"], "date": "2024-01-01"}


def land(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
        f.write(text)


def test_each_file_has_its_run(spark, tmp_path):
    raw = str(tmp_path / "raw")
    land(raw, "raw_news_1.json", json.dumps([article(i) for i in (3, 1, 2)], indent=2))
    land(raw, "raw_news_2.json", json.dumps([article(i) for i in range(4)])[:-9])
    land(raw, "raw_news_3.json", "[]")
    land(raw, "raw_news_4.json", "")
    land(raw, "raw_news_7.json", " \n")
    land(raw, "raw_news_5.json", json.dumps({"title": "no array"}))
    land(raw, "raw_news_6.json", json.dumps(["text", None, article(7), 5, {"title": 8, "tags": "none"}, []]))
    land(raw, "seen_articles.json", '["abc"]')
    files = {r.source_file: r.status for r in FS.scan_raw_files(spark, raw).collect()}
    assert files == {"raw_news_1.json": "ok", "raw_news_2.json": "broken", "raw_news_3.json": "empty", "raw_news_5.json": "broken", "raw_news_6.json": "ok", "raw_news_7.json": "empty"}
    processed, done = (VersionedTable(spark, str(tmp_path / n), ("source_file",)) for n in ("processed", "done"))
    report = {r.source_file: (r.status, r.articles) for r in PL.process_raw_files(spark, raw, processed, done).collect()}
    assert report == {"raw_news_1.json": ("ok", 3), "raw_news_2.json": ("broken", 0), "raw_news_3.json": ("empty", 0), "raw_news_7.json": ("empty", 0),
                      "raw_news_5.json": ("broken", 0), "raw_news_6.json": ("ok", 2)}
    rows = [(r.source_file, r.pos, r.title, r.ai_summary) for r in processed.read().orderBy("source_file", "pos").collect()]
    assert rows == [("raw_news_1.json", i, f"T{n}", f"word{n} word{n} word{n}") for i, n in enumerate((3, 1, 2))] + [
        ("raw_news_6.json", 2, "T7", "word7 word7 word7"), ("raw_news_6.json", 4, "8", None)]
    assert len(processed.partitions()) == 2

    first = processed.partitions(lambda k: k["source_file"] == "raw_news_1.json")
    land(raw, "raw_news_2.json", json.dumps([article(9)]))    # the broken one comes again
    land(raw, "raw_news_6.json", "[]")
    os.utime(f"{raw}/raw_news_2.json", (2e9, 2e9))
    os.utime(f"{raw}/raw_news_6.json", (2e9, 2e9))
    report = {r.source_file: (r.status, r.articles) for r in PL.process_raw_files(spark, raw, processed, done).collect()}
    assert report == {"raw_news_2.json": ("ok", 1), "raw_news_6.json": ("empty", 0)}
    assert processed.partitions(lambda k: k["source_file"] == "raw_news_1.json") == first       # not written again
    assert sorted((r.source_file, r.title) for r in processed.read().collect()) == [("raw_news_1.json", f"T{n}") for n in (1, 2, 3)] + [("raw_news_2.json", "T9")]

    before = sorted(map(str, processed.read().collect()))     # a replay: the runs were committed, the report was not
    again = PL.process_raw_files(spark, raw, processed, VersionedTable(spark, str(tmp_path / "lost"), ("source_file",)))
    assert again.count() == 6 and sorted(map(str, processed.read().collect())) == before
    assert PL.process_raw_files(spark, raw, processed, done).count() == 0


def test_model_sees_batches_in_file_order(spark, tmp_path):
    import pandas as pd
    raw = str(tmp_path / "raw")
    land(raw, "raw_news_1.json", json.dumps([article(i) for i in range(45)]))

    def model(prompts: pd.Series) -> pd.Series:
        return prompts.map(lambda p: "\n---SUMMARY_SEPARATOR---\n".join(f"s{n}" for n in [x.split("word")[1].split()[0] for x in p.split("ARTICLE ")[1:] if "word" in x]))
    tables = [VersionedTable(spark, str(tmp_path / n), ("source_file",)) for n in ("processed", "done")]
    PL.process_raw_files(spark, raw, *tables, summarize_fn=model)
    rows = tables[0].read().orderBy("pos").collect()
    assert [(r.pos, r.batch_id, r.ai_summary) for r in rows] == [(i, i // 20, f"s{i}") for i in range(45)]


def test_repeated_positions_keep_their_rows(spark):
    rows = [("f", 5, "a"), ("f", 5, "b"), ("f", 5, "b"), ("f", 2, "c"), ("g", None, "d"), (None, 1, "e"), ("f", 99_999, "z")]
    df = spark.createDataFrame(rows, "source_file string, pos bigint, title string")
    got = SU.dense_position(df, "source_file", "pos").collect()
    assert sorted((r.source_file or "", r._rn) for r in got) == [("", 1)] + [("f", i) for i in range(1, 6)] + [("g", 1)]
    by = {r._rn: r.title for r in got if r.source_file == "f"}
    assert by[1] == "c" and by[5] == "z" and sorted([by[2], by[3], by[4]]) == ["a", "b", "b"]
    assert SU.summary_batches(df.where("pos IS NOT NULL")).count() == 6
