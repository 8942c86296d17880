"""The stages of the corpus pipeline: ``(spark, docs, sf_dir) -> DataFrame``. All but the last return the columns of their input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, langid, minhash, packing, secretscan
from .common import byte_batches, give_back_heap, keyed, stored, table, unkeyed, with_ids
from .queries import TOKENIZER, tokenizer_file

LEAST_WORDS = 5                  # a leaked benchmark item of fewer words drops no document
MIN_SCORE = 0.5                  # a document whose best language has less of the likelihood is rejected


def _begin(spark: SparkSession) -> None:
    """Memory for a stage: a few MB of texts in an Arrow batch, and no heap of the stage before."""
    byte_batches(spark)
    give_back_heap(spark)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language: those with letters whose best language has at least ``MIN_SCORE`` stay."""
    _begin(spark)
    model = langid.fit(docs.select("doc_id", "text", "lang"))
    judged = langid.predict(docs, model, "_lang_pred", "_score")
    return judged.where((F.col("_lang_pred") != "und") & (F.col("_score") >= MIN_SCORE)).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8), that with the smallest doc_id.

    Every row is judged for itself: rows with one doc_id, or none, are different documents unless their texts are near copies."""
    _begin(spark)
    rows = keyed(docs)
    decided = stored(minhash.near_duplicates(rows.select("doc_id", "text")).select("doc_id", "kept"), "pipeline-kept")
    return unkeyed(with_ids(rows, decided.where("NOT kept").select("doc_id"), "doc_id", "left_anti"), docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item of ``LEAST_WORDS`` words or more, not even with small edits.

    Shorter items (``yes``, ``the answer``) stand in clean documents too: the operator finds them, but they say nothing about a leak."""
    _begin(spark)
    rows = keyed(docs)
    found = decontam.leaks(rows.select("doc_id", "text"), table(spark, sf_dir, "benchmark")).where(F.col("n_words") >= LEAST_WORDS)
    found = stored(found.select("doc_id").distinct(), "pipeline-leaks")
    return unkeyed(with_ids(rows, found, "doc_id", "left_anti"), docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every value that the forest takes for a secret masked."""
    _begin(spark)
    rows = keyed(docs)
    model = secretscan.train(secretscan.labelled_findings(rows), rows)
    found = stored(secretscan.scan(rows, model).where("is_secret").select("doc_id", "value").distinct(), "pipeline-secrets")
    return unkeyed(secretscan.redact(rows, found), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces of training sequences, with their token ids."""
    _begin(spark)
    return packing.pack(docs, tokenizer_file(TOKENIZER))
