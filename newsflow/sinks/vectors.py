"""The vector table: vectors with their metadata, by namespace and bucket of ids.

A record is searched by ``(id, embedding, category)`` and answered from the metadata
stored beside it, so a search never goes back to the articles. An upsert rewrites the
buckets that its batch touches and no other; a namespace is cleared without reading it.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from .. import config as C
from ..functions import sql as S
from ..session import scratch_path
from .versions import VersionedTable

BUCKETS = 16                     # of one namespace; a point lookup reads one of them
META = ("title", "link", "summary", "published", "source_name", "category", "tags", "ai_enhanced", "added_to_db", "content_preview")


class VectorTable:
    """Records ``(namespace, id, embedding, <metadata>, version)`` under ``root``; one writer at a time."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.buckets = spark, buckets
        self.table = VersionedTable(spark, root, ("namespace", "bucket"))

    def _bucket(self, column="id"):
        return F.pmod(F.xxhash64(F.col(column).cast("string")), F.lit(self.buckets)).cast("int")

    def read(self, namespace: str | None = C.NAMESPACE, version: int | None = None) -> DataFrame:
        """The records of one namespace, or of all (None); files of other namespaces are not listed."""
        return self.table.read(None if namespace is None else lambda k: k["namespace"] == namespace, version).drop("bucket")

    def fetch(self, record_id, namespace: str = C.NAMESPACE) -> DataFrame:
        """The record of one id in one namespace, from its bucket's files only; no row if there is none."""
        bucket = self.spark.range(1).select(F.lit(record_id).alias("id")).select(self._bucket()).first()[0]
        found = self.table.read(lambda k: k["namespace"] == namespace and k["bucket"] == bucket).drop("bucket")
        return found.where(F.col("id") == F.lit(record_id))

    def namespaces(self) -> DataFrame:
        """``namespace, total_articles`` from the manifest."""
        counts: dict[str, int] = {}
        for p in self.table.partitions():
            counts[p["keys"][0]] = counts.get(p["keys"][0], 0) + p["rows"]
        return self.spark.createDataFrame([*counts.items()], "namespace string, total_articles bigint")

    def upsert(self, batch: DataFrame, namespace: str = C.NAMESPACE, order: str | None = None) -> int:
        """Insert the records of ``batch`` or replace those of the same ``(namespace, id)``; their number, repeats included.

        A batch may bring its own ``namespace`` column (null: ``namespace``). Of records with one id that with the
        largest ``order`` value stays; without ``order``, or at equal values, the one whose content hashes highest, so
        that a repeated task decides alike. Records of earlier versions always give way. The batch is worked out once."""
        base = self.table.version()
        own = F.coalesce(F.col("namespace"), F.lit(namespace)) if "namespace" in batch.columns else F.lit(namespace)
        staged_at = scratch_path(self.spark, "upsert")
        staged = batch.withColumn("namespace", own).withColumn("version", F.lit(base + 1)).withColumn("bucket", self._bucket())
        staged.write.parquet(staged_at)
        staged = self.spark.read.schema(staged.schema).parquet(staged_at)
        counts = staged.groupBy("namespace", "bucket").count().collect()          # a row for each partition touched
        touched = {(r["namespace"], r["bucket"]) for r in counts}
        if not touched:
            return 0
        merged = staged
        if base:
            old = self.table.read(lambda k: (k["namespace"], k["bucket"]) in touched, base)
            merged = staged.unionByName(old, allowMissingColumns=True)
        rest = [c for c in merged.columns if c not in ("namespace", "id", "bucket")]
        latest = F.struct(F.col("version"), *([F.col(order)] if order else []), F.xxhash64(*rest))
        merged = (merged.groupBy("namespace", "bucket", "id").agg(F.max_by(F.struct(*rest), latest).alias("_r"))
                  .select("namespace", "bucket", "id", "_r.*"))
        self.table.commit(self.table.write(merged), lambda k: False, merged.schema, base)
        return sum(r["count"] for r in counts)

    def clear(self, namespace: str) -> bool:
        """Remove a namespace: the next manifest leaves its folders out. False if it had no record."""
        before = self.table.version()
        return self.table.drop(lambda k: k["namespace"] == namespace) > before

    def add_articles(self, articles: DataFrame, embed: Callable[[pd.Series], pd.Series] | None = None, namespace: str = C.NAMESPACE,
                     run_ts: str = C.DEFAULT_RUN_TS, order: str | None = None) -> int:
        """Articles into the table: id, embedding text, vector and metadata in one plan, then the upsert; the number of records.

        The id is ``processed_id`` if the articles have a non-empty one, else the source name (or ``unknown``) and the
        digest of title and link. ``embed`` is a vectorised model (text to floats); the default is the hashed bag of
        words, which a text without words gives no direction: such a record is found by no search."""
        from ..functions.udf import series_udf
        from ..operators.embed import with_dense_vector
        from ..operators.vectors import vector_metadata
        cols = articles.columns
        link = "url" if "url" in cols else "link"
        own = F.coalesce(F.col("processed_id"), F.lit("")) if "processed_id" in cols else F.lit("")
        digest = F.md5(F.concat(F.coalesce("title", F.lit("")), F.coalesce(link, F.lit(""))))
        name = F.coalesce(F.col("source_name"), F.lit("unknown")) if "source_name" in cols else F.lit("unknown")
        ready = articles.withColumn("_id", F.when(own != "", own).otherwise(F.concat(name, F.lit("_"), digest)))
        ready = ready.withColumn("_text", F.expr(S.embedding_text("title", "summary", "content")))
        records = vector_metadata(ready, run_ts, keep=("_id", "_text", *([order] if order else [])))
        if embed is None:
            records = with_dense_vector(records, "_text")
        else:
            records = records.withColumn("embedding", series_udf(embed, Ty.ArrayType(Ty.FloatType()))(F.col("_text")))
        return self.upsert(records.drop("_text").withColumnRenamed("_id", "id"), namespace, order)
