"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

BROADCAST_IDS = 500_000          # ids (8 bytes each) that may be broadcast; more are joined by a shuffle


BATCH_ROWS = 2_500               # rows of an Arrow batch of texts: what a task holds of them on either side


def bounded_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches than Spark's usual ones, unless the session has its own setting."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(BATCH_ROWS))


BATCH_BYTES = 4 << 20            # bytes of an Arrow batch on its way to Python


def byte_batches(spark: SparkSession) -> None:
    """Arrow batches bounded by bytes too (a few long texts fill one), unless the session has its own settings."""
    bounded_batches(spark)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) in ("67108864b", "64MB", "67108864"):
        spark.conf.set(key, str(BATCH_BYTES))


def give_back_heap(spark: SparkSession) -> None:
    """Have the executors' JVMs collect, so that heap which the work before has filled, and left, goes back to the system.

    JVM and Python workers share an executor's memory and are busy in turns; a JVM alone would keep its largest heap for good."""
    n = 2 * spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).select(F.java_method(F.lit("java.lang.System"), F.lit("gc"))).collect()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts the lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_ids(rows: DataFrame, ids: DataFrame, key: str, how: str) -> DataFrame:
    """``rows`` joined (``left_semi`` or ``left_anti``) with the distinct ``key`` values of ``ids``.

    The ids are broadcast only when a count shows at most ``BROADCAST_IDS`` of
    them; otherwise both sides are shuffled on the key.
    """
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return rows.join(F.broadcast(ids) if few else ids, key, how)


ROW, OWN = "_row_key", "_own_doc_id"


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a unique, non-null ``doc_id``; the own one is kept in ``OWN`` (see ``unkeyed``).

    Unique ids stay as they are. Rows whose id is null or repeated get a negative key of their own; as two scans
    need not number rows alike, the rows are then written with their keys."""
    ids = docs.groupBy("doc_id").count().where("doc_id IS NULL OR doc_id < 0 OR count > 1").select("doc_id")
    ids = stored(ids, "repeated-ids")
    out = docs.withColumn(OWN, F.col("doc_id"))
    if ids.isEmpty():
        return out
    repeated = ids.where("doc_id IS NOT NULL").withColumn("_repeated", F.lit(True))
    out = out.withColumn(ROW, F.monotonically_increasing_id()).join(repeated, "doc_id", "left")
    key = F.when(F.col("doc_id").isNull() | F.col("_repeated"), -1 - F.col(ROW)).otherwise(F.col("doc_id"))
    return stored(out.withColumn("doc_id", key).select(*docs.columns, OWN), "keyed")


def unkeyed(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of ``keyed`` with their own ids again."""
    return rows.withColumn("doc_id", F.col(OWN)).select(*columns)
