"""Versioned tables, the vector table and the stored text index."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from newsflow.operators import embed as EM
from newsflow.operators import recommend as RC
from newsflow.operators import retention as RT
from newsflow.operators import vectors as VE
from newsflow.operators.textindex import TextIndex
from newsflow.sinks.vectors import VectorTable
from newsflow.sinks.versions import CommitConflict, VersionedTable
from newsflow.sources import stored as SD
from newsflow.sources import tables as TB


def files_of(table, where=None):
    """The files of the partitions, with size and time of change."""
    found = {}
    for p in table.partitions(where):
        fs, path = table._fs(), table._path(p["path"])
        for s in fs.listStatus(path):
            found[s.getPath().toString()] = (s.getLen(), s.getModificationTime())
    return found


def test_versions_of_a_table(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), ("k", "n"))
    assert t.version() == 0 and t.partitions() == []
    with pytest.raises(FileNotFoundError):
        t.read()
    rows = [("a/b=c %d", 1, 10), ("a/b=c %d", 2, 20), (None, 1, 30), ("", 1, 40), ("a/b=c %d", 1, 50)]
    frame = spark.createDataFrame(rows, "k string, n int, v int")
    assert t.replace(frame) == 1
    assert sorted(map(tuple, t.read().collect()), key=str) == sorted(rows, key=str)
    assert sorted(p["rows"] for p in t.partitions()) == [1, 1, 1, 2]
    before = files_of(t)
    assert t.replace(spark.createDataFrame([("", 1, 41), ("new", 1, 60)], frame.schema)) == 2
    assert sorted(r.v for r in t.read().collect()) == [10, 20, 30, 41, 50, 60]
    assert sorted(r.v for r in t.read(version=1).collect()) == [10, 20, 30, 40, 50]
    after = files_of(t, lambda k: k["k"] not in ("", "new"))
    assert after.items() <= before.items() and len(after) == len(files_of(t, lambda k: k["k"] not in ("", "new")))
    assert [r.v for r in t.read(lambda k: k["k"] is None).collect()] == [30]
    assert t.drop(lambda k: k["n"] == 2) == 3 and t.drop(lambda k: k["n"] == 2) == 3
    with pytest.raises(CommitConflict):
        t.commit([], lambda k: False, frame.schema, 2)
    t.write(frame)                                            # a commit that died: no manifest names it
    assert t.vacuum() == 4 + 2 and t.versions() == [3] and t.vacuum() == 0
    assert sorted(r.v for r in t.read().collect()) == [10, 30, 41, 50, 60]


def test_upsert_leaves_other_buckets_alone(spark, tmp_path):
    t = VectorTable(spark, str(tmp_path / "v"), buckets=8)
    first = spark.createDataFrame([(i, [float(i), 1.0], f"t{i}") for i in range(200)], "id bigint, embedding array<double>, title string")
    assert t.upsert(first) == 200
    before = files_of(t.table)
    again = spark.createDataFrame([(7, [1.0, 2.0], "late", 2), (7, [9.0, 9.0], "early", 1), (500, [0.0, 1.0], "new", 1)], "id bigint, embedding array<double>, title string, at int")
    assert t.upsert(again, order="at") == 3                   # repeats count
    assert t.read().count() == 201 and t.fetch(7).first()["title"] == "late" and t.fetch(500).first()["version"] == 2
    assert t.fetch(8).first()["version"] == 1 and t.fetch(9999).count() == 0
    after = files_of(t.table)
    same = [f for f in after if f in before]
    assert all(after[f] == before[f] for f in same)
    touched = {p["path"] for p in t.table.partitions()} - {p["path"] for p in t.table.partitions(version=1)}
    assert 1 <= len(touched) <= 2 and len({f.rsplit("/", 1)[0] for f in same}) == 8 - len(touched)
    one = t.fetch(7)
    assert len({f.rsplit("/", 1)[0] for f in one.inputFiles()}) == 1      # a point lookup reads one bucket
    assert t.upsert(again.where("false"), order="at") == 0 and t.table.version() == 2


def test_namespaces_of_the_vector_table(spark, tmp_path):
    t = VectorTable(spark, str(tmp_path / "v"), buckets=2)
    rows = [("007", "x", [1.0, 0.0]), ("7", "x", [0.0, 1.0]), (None, "x", [1.0, 1.0]), ("7", "y", [0.1, 1.0]), ("7", "z", [0.2, 1.0])]
    t.upsert(spark.createDataFrame(rows, "namespace string, id string, embedding array<double>").withColumn("category", F.lit("c")))
    assert {r.namespace: r.total_articles for r in t.namespaces().collect()} == {"007": 1, "7": 3, "default": 1}
    got = VE.similar_by_id(t.read("7"), "x", source=t.fetch("x", "7")).collect()       # one id in three namespaces
    assert [r.id for r in got] == ["y", "z"]
    assert [r.id for r in VE.similar_by_id(t.read(None), "x", namespace="7").collect()] == ["y", "z"]
    kept = files_of(t.table, lambda k: k["namespace"] != "7")
    assert t.clear("7") and not t.clear("7") and not t.clear("never")
    assert files_of(t.table) == kept and t.read("7").count() == 0 and t.read(None).count() == 2


def test_articles_end_to_end(spark, tmp_path):
    t = VectorTable(spark, str(tmp_path / "v"), buckets=2)
    schema = "title string, url string, summary string, ai_summary string, content string, date string, source_name string, category string, categories array<string>, tags array<string>, processed_id string"
    rows = [("Red ship", "http://a/1", "s1", "ai", "the red ship sails", "2024", "Npr", "world", ["x", "y"], ["t"], None),
            ("Blue ship", "http://a/2", "s2", None, "the blue ship sails", "2024", None, None, [], None, "own-1"),
            ("", None, None, None, None, None, None, None, None, None, ""), ("Red ship", "http://a/1", "s1", "ai", "the red ship sails", "2024", "Npr", "world", ["x"], ["t"], None)]
    assert t.add_articles(spark.createDataFrame(rows, schema)) == 4
    got = {r.id: r for r in t.read().collect()}
    import hashlib
    red = "Npr_" + hashlib.md5(b"Red shiphttp://a/1").hexdigest()
    empty = "unknown_" + hashlib.md5(b"").hexdigest()
    assert set(got) == {red, "own-1", empty}
    assert (got[red].summary, got[red].category, got["own-1"].summary, got["own-1"].category, got[empty].title) == ("ai", "x", "s2", "general", "")
    assert got[red].content_preview.startswith("Title: Red ship") and len(got[red].embedding) == 1024 and sum(got[red].embedding) == 10
    found = RC.similar_articles(t.read(), red, source=t.fetch(red)).collect()
    assert [r.id for r in found] == ["own-1"] + [empty] * (len(found) - 1) and found[0].title == "Blue ship"
    import pandas as pd
    model = VectorTable(spark, str(tmp_path / "m"))
    model.add_articles(spark.createDataFrame(rows, schema), embed=lambda texts: pd.Series([[float(len(x)), 1.0] for x in texts]))
    assert len(model.fetch("own-1").first()["embedding"]) == 2


def test_recommendations_read_no_pages(spark):
    table = SD.vector_table(spark, SF_SMALL)
    v = table.read()
    top = RC.similar_articles(v, 7, attach=lambda d: SD.with_stored_meta(v, d), source=table.fetch(7))
    assert top.count() == 10 and not any("pages.parquet" in f for f in top.inputFiles())
    plan = spark._jvm.PythonSQLUtils.explainString(top._jdf.queryExecution(), "formatted")
    tree = plan.split("\n\n")[0]                             # without the subqueries of the source record
    assert tree.count("Scan parquet") == 2                    # scores, then metadata


def small_docs(spark, n=300, seed=1):
    r = random.Random(seed)
    topics = [[a + b for b in ("ship", "tree", "gold", "song", "rain")] for a in ("red", "old", "far", "big", "wet", "hot")]
    rows = []
    for i in range(n):
        own = topics[i % 6]
        text = " ".join(r.choice(own if r.random() < 0.8 else r.choice(topics)) for _ in range(r.randrange(1, 60)))
        rows.append((i, text, None if i % 6 == 5 else f"c{i % 6 % 3}", f"title {i}"))
    rows += [(n, "", "c0", "no words"), (n + 1, None, None, "null"), (n + 2, rows[0][1], "c1", "a copy")]
    return spark.createDataFrame(rows, "id bigint, text string, category string, title string")


@pytest.mark.parametrize("n,threshold", [(3, 0.25), (1, 0.6), (40, 0.05)])
def test_index_search_is_exact(spark, tmp_path, n, threshold):
    docs = small_docs(spark).cache()
    index = TextIndex(spark, str(tmp_path / "ix"), block_docs=16)
    index.add(docs)
    queries = spark.createDataFrame([(f"q{i}", t) for i, t in enumerate(["red red ship redship", "oldtree oldgold", "wetrain", "nothing here", "", None, "bigsong farsong hotsong redsong", "redship"])],
                                    "id string, text string")
    report = {}
    got = sorted(map(tuple, index.search(queries, n, threshold, report=report).collect()))
    want = sorted(map(tuple, EM.search_text(queries, docs, n=n, threshold=threshold).collect()))
    assert got == want and len(got) >= 4
    assert report["scored"] <= report["pairs"] + 1 and report["scored"] < report["blocks"] * report["queries"]
    one = sorted(map(tuple, index.search(queries, n, threshold, category="c1").collect()))
    assert one == sorted(map(tuple, EM.search_category(queries, docs, "c1", n=n, threshold=threshold).collect()))
    meta = index.with_meta(index.search(queries, n, threshold))
    assert {r.title for r in meta.collect()} <= {r.title for r in docs.collect()} and "title" in meta.columns


def test_index_skips_blocks(spark, tmp_path):
    """On texts of few topics most blocks of the other topics are never scored."""
    r = random.Random(4)
    rows = [(i, " ".join(f"w{chr(97 + i // 100)}{r.choice('abcdefghij')}" for _ in range(30)), "c") for i in range(2000)]
    docs = spark.createDataFrame(rows, "id bigint, text string, category string")
    index = TextIndex(spark, str(tmp_path / "ix"), block_docs=8)
    index.add(docs)
    queries = spark.createDataFrame([(i, f"w{chr(97 + i)}a w{chr(97 + i)}b") for i in range(10)], "id bigint, text string")
    report = {}
    assert index.search(queries, 5, report=report).count() == 50
    assert report["scored"] < 0.5 * report["blocks"] * report["queries"]


def test_index_grows_by_batches(spark, tmp_path):
    docs = small_docs(spark).cache()
    index = TextIndex(spark, str(tmp_path / "ix"), block_docs=16)
    index.add(docs.where("id < 120"))
    before = files_of(index.postings)
    index.meta.replace(docs.where("id > 200").select("id", "category", "title").withColumn("batch", F.lit(2)))      # an attempt that died half-way
    index.add(docs.where("id >= 120"))
    assert before.items() <= files_of(index.postings).items() and index.meta.read().count() == docs.count()
    queries = spark.createDataFrame([(1, "red redship"), (2, "wetrain bigsong")], "id int, text string")
    got = sorted(map(tuple, index.search(queries, 7).collect()))
    assert got == sorted(map(tuple, EM.search_text(queries, docs, n=7).collect()))


def test_index_of_odd_tables(spark, tmp_path):
    queries = spark.createDataFrame([(1, "red")], "id int, text string")
    index = TextIndex(spark, str(tmp_path / "ix"))
    index.add(small_docs(spark).where("false"))
    assert index.search(queries).count() == 0
    index.add(small_docs(spark).where("id >= 300 AND id < 302"))       # no words
    assert index.search(queries).count() == 0 and index.search(queries.where("false")).count() == 0
    with pytest.raises(ValueError):
        index.search(queries, 0)


def test_search_groups(spark, tmp_path, monkeypatch):
    from newsflow.operators import textindex
    monkeypatch.setattr(textindex, "GROUP", 3)
    docs = small_docs(spark).cache()
    index = TextIndex(spark, str(tmp_path / "ix"))
    index.add(docs)
    queries = docs.where("id < 10").select("id", "text")
    assert sorted(map(tuple, index.search(queries, 4).collect())) == sorted(map(tuple, EM.search_text(queries, docs, n=4).collect()))


def test_old_runs_leave_the_disk(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "runs"), ("run_ts",))
    rows = spark.createDataFrame([(i, f"2024-05-{i:02d}T00:00:00") for i in range(1, 16)], "id int, run_ts string")
    t.replace(rows)
    all_files = files_of(t)
    t.drop(lambda k: k["run_ts"] < "2024-05-06")              # a call that died before the files went
    assert RT.drop_old_runs(t) == 0 and RT.drop_old_runs(t, keep=4) == 6
    assert sorted(r.id for r in t.read().collect()) == [12, 13, 14, 15]
    import os
    assert sum(os.path.exists(f.removeprefix("file:")) for f in all_files) == 4 * len(all_files) // 15


def test_archive_can_be_repeated(spark, tmp_path):
    live, archive = (VersionedTable(spark, str(tmp_path / n), ("run_ts",)) for n in ("live", "archive"))
    rows = spark.createDataFrame([(i, f"2024-05-{i:02d}T00:00:00") for i in range(1, 11) for _ in range(2)], "id int, run_ts string")
    live.replace(rows)
    archive.replace(live.read(lambda k: k["run_ts"] < "2024-05-02"))      # died after the archive's commit
    assert RT.archive_old_runs(live, archive, "2024-06-05T00:00:00") == 5
    assert RT.archive_old_runs(live, archive, "2024-06-05T00:00:00") == 0
    assert sorted(r.id for r in archive.read().collect()) == [i for i in range(1, 6) for _ in range(2)]
    assert sorted(r.id for r in live.read().collect()) == [i for i in range(6, 11) for _ in range(2)]


def test_documents_of_one_row_group_are_read_by_many_tasks(spark, tmp_path):
    rows = spark.range(4000).selectExpr("id AS doc_id", "concat('word', id, ' some text') AS text", "'en' AS lang", "'s' AS source")
    rows.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    docs = SD.doc_records(spark, str(tmp_path))
    assert docs.rdd.getNumPartitions() > 1
    assert sorted(r.id for r in docs.select("id").collect()) == list(range(4000))


def test_embedding_in_batches_equals_the_projection(spark):
    from newsflow.operators.embed import embed_rows, embed_sparse
    texts = ["The cat's THE\tthe\ncat 42 x9y", "", None, "İstanbul Kelvin Ärger straße", "...!", "a" * 300, " one  one two "]
    docs = spark.createDataFrame([(i, t, "c" if i % 2 else None) for i, t in enumerate(texts)], "id bigint, body string, category string")
    got = {r.id: (r.category, r.idx, r.val) for r in embed_rows(docs, "body", dim=64, keep=["category"]).collect()}
    assert got == {r.id: (r.category, r.idx, r.val) for r in embed_sparse(docs, "body", dim=64, keep=["category"]).collect()}
    assert all(abs(r.norm ** 2 - sum(x * x for x in r.val)) < 1e-9 for r in embed_rows(docs, "body").collect())
