"""The stages and the whole pipeline on a planted table."""

import corpus_pipeline
from newsflow.llm import stages
from pyspark.sql import functions as F

from .test_documents import DOCS, prose


def planted(spark, folder):
    bench = prose(1, 30)
    rows = [(i, prose(100 + i, 80), "en", "src0", 0) for i in range(30)]
    rows += [(40, rows[3][1], "en", "s", 0), (41, rows[3][1] + " and", "en", "s", 0), (42, prose(7, 40) + " " + bench + " " + prose(8, 40), "en", "s", 0),
             (43, "123 456 %%", "en", "s", 0), (44, None, "en", "s", 0), (45, "", None, None, None), (46, prose(9, 50) + ' token = "' + "0a9f" * 10 + '" end', "en", "s", 0),
             (5, rows[5][1], "en", "src0", 0)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, bench)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows


def test_pipeline(spark, tmp_path):
    folder = str(tmp_path)
    planted(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("Score", F.lit(1)).withColumn("kept", F.lit(2))
    want = [(stages.language, {43, 44, 45}), (stages.near_dedup, {40, 41}), (stages.decontaminate, {42}), (stages.secrets, set())]
    for stage, gone in want:
        out = stage(spark, docs, folder).cache()
        assert out.columns == docs.columns
        before, after = ([r.doc_id for r in d.select("doc_id").collect()] for d in (docs, out))
        assert set(before) - set(after) == gone and set(after) <= set(before)
        docs = out
    assert docs.where("doc_id = 5").count() == 1
    assert "[SECRET]" in docs.where("doc_id = 46").first()["text"] and docs.where("text LIKE '%SECRET%'").count() == 1
    packed = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in packed} == set(range(30)) | {46}


def test_pipeline_of_empty_tables(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_stages_judge_rows(spark, tmp_path):
    """Null and repeated ids: every row is judged for itself."""
    folder, bench = str(tmp_path), prose(1, 30)
    spark.createDataFrame([(1, bench), (2, "text"), (3, "yes and no")], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    key = 'token = "' + "0a9f" * 10 + '" end'
    rows = [(None, prose(2, 40) + " " + bench + " " + prose(3, 40)), (None, prose(4, 60) + " text yes and no"), (None, prose(5, 50) + " " + key),
            (7, prose(6, 60)), (7, prose(8, 60)), (7, prose(9, 40) + " " + bench), (7, prose(6, 60)), (8, prose(10, 50) + " " + key), (-3, prose(11, 60)), (9, None)]
    rows += [(100 + i, prose(200 + i, 60)) for i in range(30)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS).repartition(3)
    near = stages.near_dedup(spark, docs, folder)
    assert near.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in near.collect()) == sorted({(i or 0, t or "") for i, t in rows})      # only the copy of one row went
    clean = stages.decontaminate(spark, docs, folder)
    assert sorted((r.doc_id or 0, r.text or "") for r in clean.collect()) == sorted((i or 0, t or "") for i, t in rows if bench not in (t or ""))
    masked = {(r.doc_id, r.text) for r in stages.secrets(spark, docs, folder).collect()}
    hidden = {(i, t and t.replace("0a9f" * 10, "[SECRET]")) for i, t in rows}
    assert masked == hidden
