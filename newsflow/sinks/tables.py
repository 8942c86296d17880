"""Sinks: run-partitioned raw/processed tables, the seen table, and the vector
table with latest-wins upserts and namespace clears.

Storage is plain parquet (no MERGE): an upsert or a clear writes a *new
version directory* and the caller switches to it; a path that is being read is
never overwritten. Everything is written by executors; nothing passes through
the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators import ingest as IN


def read_back(spark: SparkSession, path: str, written: DataFrame) -> DataFrame:
    """Read a partitioned table with the schema it was written with: partition
    discovery would otherwise infer types from directory names (a namespace
    "3" would come back as an integer, "007" as 7)."""
    return spark.read.schema(written.schema).parquet(path)


def write_raw(raw: DataFrame, path: str, run_ts: str = C.DEFAULT_RUN_TS) -> DataFrame:
    """Append one run of raw articles (partition ``run_ts``) and return the
    table as written. Two runs never overwrite each other (the reference's
    minute-stamped file did)."""
    out = raw.withColumn("run_ts", F.lit(run_ts))
    out.write.mode("append").partitionBy("run_ts").parquet(path)
    return read_back(raw.sparkSession, path, out)


def write_processed(processed: DataFrame, path: str, run_ts: str = C.DEFAULT_RUN_TS,
                    file_col: str = "source_file") -> DataFrame:
    """Append processed articles of one run, keyed by (run_ts, source file): one
    output per input file, and two files processed in the same second do not
    collide."""
    out = processed if file_col in processed.columns else processed.withColumn(file_col, F.lit(""))
    out = out.withColumn("run_ts", F.lit(run_ts))
    out.write.mode("append").partitionBy("run_ts").parquet(path)
    return read_back(processed.sparkSession, path, out)


def write_seen(new_hashes: DataFrame, path: str) -> DataFrame:
    """Append the hashes of newly written articles to the seen table. Call it
    *after* the articles are written: a crash in between re-fetches articles
    (harmless) instead of losing them."""
    new_hashes.select("article_hash").distinct().write.mode("append").parquet(path)
    return new_hashes.sparkSession.read.parquet(path)


def upsert_vectors(current: DataFrame | None, batch: DataFrame, path: str, version: int,
                   namespace: str = C.NAMESPACE, order: str | None = None) -> tuple[DataFrame, int]:
    """Latest-wins upsert by ``(namespace, id)``; returns the new table and the
    count of upserted records (repeats included, as the reference counts).
    Of a batch's records with one id the one with the largest ``order`` value
    stays; without ``order`` the ids in a batch have to differ, or which record
    stays is only sure for a batch in file order.

    The merge is a grouped ``max_by`` over (version, seq): combined map-side,
    so an id repeated millions of times is reduced before the shuffle. The new
    version is written to ``path`` (a fresh directory).
    """
    b = batch.withColumn("namespace", F.coalesce(F.col("namespace"), F.lit(namespace))
                         if "namespace" in batch.columns else F.lit(namespace))
    b = b.withColumn("version", F.lit(version)).withColumn("seq", F.col(order) if order else F.monotonically_increasing_id())
    allv = b if current is None else current.withColumn("seq", F.lit(None).cast(b.schema["seq"].dataType)).unionByName(
        b, allowMissingColumns=True)
    cols = [c for c in allv.columns if c != "seq"]
    merged = (allv.groupBy("namespace", "id")
              .agg(F.max_by(F.struct(*[F.col(c) for c in cols if c not in ("namespace", "id")]),
                            F.struct("version", "seq")).alias("_r"))
              .select("namespace", "id", "_r.*"))
    merged.write.mode("errorifexists").partitionBy("namespace").parquet(path)
    return read_back(batch.sparkSession, path, merged), batch.count()


def clear_namespace(current: DataFrame, namespace: str, path: str) -> DataFrame:
    """Delete every vector of one namespace: a new version without that
    partition (the filter is a partition filter, so it prunes files)."""
    current.filter(F.col("namespace") != F.lit(namespace)).write.mode("errorifexists") \
        .partitionBy("namespace").parquet(path)
    return read_back(current.sparkSession, path, current)
