"""The stored forms of the driver tables: the text index and the vector table.

Both are built once from whole tables, in the shared folder, under the digest of the
names, sizes and change times of the source files: a changed table gets a new one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sql as S
from ..operators.textindex import TextIndex
from ..session import shared_dir
from ..sinks.vectors import META, VectorTable
from ..sinks.versions import CommitConflict
from .tables import DOC_TITLE_SQL, read_table, spread, vector_records


def source_stamp(spark: SparkSession, *paths: str) -> str:
    """A digest of the files of tables; their contents are not read."""
    files = [spark.read.format("binaryFile").load(p).select("path", "length", "modificationTime") for p in paths]
    rows = files[0]
    for f in files[1:]:
        rows = rows.unionByName(f)
    one = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    r = rows.agg(F.count("*").alias("n"), F.sum(one).alias("s"), F.sum("length").alias("b")).first()
    return f"{r.n}-{r.b}-{int(r.s or 0) % 16**12:012x}"


def doc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as articles of the text index: id, text to embed, and the metadata of a match."""
    docs = spread(read_table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"), "doc_id", "text")
    return docs.selectExpr(
        "doc_id AS id", f"{S.embedding_text(DOC_TITLE_SQL, chr(39) * 2, 'text', None)} AS text",
        f"{DOC_TITLE_SQL} AS title", "'' AS link", f"{S.lead_words('text')} AS summary", "'' AS published", "source AS source_name",
        "lang AS category", "CAST(array() AS ARRAY<STRING>) AS tags",
        f"substring({S.embedding_text(DOC_TITLE_SQL, chr(39) * 2, 'text')}, 1, 500) AS content_preview")


def text_index(spark: SparkSession, sf_dir: str) -> TextIndex:
    """The text index over ``documents``, built at its first use."""
    stamp = source_stamp(spark, f"{sf_dir.rstrip('/')}/documents.parquet")
    index = TextIndex(spark, f"{shared_dir(spark).rstrip('/')}/text-index-{stamp}")
    if not index.exists():
        try:
            index.add(doc_records(spark, sf_dir))
        except CommitConflict:                                # another session was faster
            pass
    return index


def vector_table(spark: SparkSession, sf_dir: str) -> VectorTable:
    """``embeddings`` with the metadata of the articles (``pages``), built at its first use."""
    base = sf_dir.rstrip("/")
    stamp = source_stamp(spark, f"{base}/embeddings.parquet", f"{base}/pages.parquet")
    table = VectorTable(spark, f"{shared_dir(spark).rstrip('/')}/vectors-{stamp}")
    if not table.table.version():
        try:
            table.upsert(vector_records(spark, sf_dir, caps=True))
        except CommitConflict:
            pass
    return table


def with_stored_meta(vectors: DataFrame, rows: DataFrame) -> DataFrame:
    """A search's few ``rows`` (bounded by its limit, so broadcast) with the metadata stored in ``vectors``."""
    meta = vectors.select("id", *[c for c in META if c in vectors.columns and c not in rows.columns])
    return meta.join(F.broadcast(rows), "id").select(*rows.columns, *[c for c in meta.columns if c != "id"])
