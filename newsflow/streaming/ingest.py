"""Streaming ingest with a persistent seen set.

The reference refetches feeds on a schedule and drops every article whose key
it has seen before, with a seen set that never expires. Two Structured
Streaming forms of that:

* ``mode="state"``: ``dropDuplicates(keys)`` -- exact, the state store holds
  every key ever seen (unbounded, like the reference). Fine while the key set
  fits the state store.
* ``mode="table"`` (the one to prefer at scale): ``foreachBatch`` looks each
  micro-batch up in the stored seen set (``sinks.seen``: filters first, then only
  the buckets that may hold its keys), commits the new rows, then their keys.
  State lives in files, not executor memory; the order (rows first, keys second)
  loses no article, and what a crash left between both is made good by the next batch.
* ``dropDuplicatesWithinWatermark`` is offered as a bounded-state option that
  *changes* the semantics (keys expire after the watermark delay).

Runs use ``trigger(availableNow=True)`` (one scheduled refresh drains what has
landed); ``processingTime`` gives the periodic refresh. Checkpoints go to the
shared folder, so a lost executor or driver restarts from the last batch.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from ..session import scratch_path
from ..sinks.seen import SeenTable
from ..sinks.versions import VersionedTable


def event_stream(spark: SparkSession, landing_dir: str, schema: Ty.StructType, files_per_trigger: int = 100
                 ) -> DataFrame:
    """A file stream over landed parquet files (each landed file is one fetch)."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
            .parquet(landing_dir))


def dedup_stream(stream: DataFrame, keys: list[str], mode: str = "state", watermark_col: str | None = None,
                 delay: str = "1 day") -> DataFrame:
    """Streaming dedup on ``keys`` (``mode`` 'state' or 'watermark')."""
    if mode == "watermark":
        if watermark_col is None:
            raise ValueError("watermark mode needs watermark_col")
        return (stream.withColumn(watermark_col, F.col(watermark_col).cast("timestamp"))
                .withWatermark(watermark_col, delay).dropDuplicatesWithinWatermark(keys))
    return stream.dropDuplicates(keys)


def run_to_table(stream: DataFrame, out_path: str, checkpoint: str, trigger_once: bool = True,
                 interval: str | None = None):
    """Append a stream to a parquet table and wait for the scheduled run."""
    w = stream.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint) \
        .outputMode("append")
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime=interval or "6 hours")
    q = w.start()
    if trigger_once:
        q.awaitTermination()
    return q


def run_with_seen_table(stream: DataFrame, keys: list[str], out: VersionedTable, seen: SeenTable, checkpoint: str,
                        trigger_once: bool = True, interval: str | None = None):
    """``foreachBatch`` dedup against a stored seen set (see module doc).

    A batch is named by the checkpoint's own id and its epoch: a replay replaces what its first attempt wrote, and a
    stream on a new checkpoint starts new batches. The rows are committed to ``out`` (partitioned by ``_batch``) before
    their hashes go to ``seen``; rows whose hashes were lost in between are added by the next batch, whosever it is."""
    spark = stream.sparkSession
    key = F.md5(F.to_json(F.struct(*[F.col(k).cast("string").alias(f"k{i}") for i, k in enumerate(keys)])))      # a null is no empty text

    def batch(df: DataFrame, epoch: int):
        name = f"{json.loads(spark.read.text(f'{checkpoint}/metadata').first()[0])['id']}-{epoch}"
        for lost in sorted({p["keys"][0] for p in out.partitions()} - {name}):
            if seen.has(lost):
                continue
            seen.add(out.read(lambda k, lost=lost: k["_batch"] == lost).select(F.col("_key").alias("article_hash")), lost)
        firsts = df.withColumn("_key", key).dropDuplicates(["_key"])       # first of the micro-batch (any copy: keys are compared)
        staged_at = scratch_path(spark, "stream-batch")
        firsts.write.parquet(staged_at)
        firsts = spark.read.schema(firsts.schema).parquet(staged_at)
        known = seen.seen(firsts.select(F.col("_key").alias("article_hash")), but=name)
        new = firsts.join(known.withColumnRenamed("article_hash", "_key"), "_key", "left_anti").withColumn("_batch", F.lit(name))
        out.replace(new, drop=lambda k: k["_batch"] == name)
        seen.add(out.read(lambda k: k["_batch"] == name).select(F.col("_key").alias("article_hash")), name)
        seen.compact()

    w = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime=interval or "6 hours")
    q = w.start()
    if trigger_once:
        q.awaitTermination()
    return q


def land_events(events: DataFrame, landing_dir: str, by: str = "day") -> str:
    """Land a table as many files (one per day), the way fetches arrive."""
    # no repartition by day: a busy day must not land in one task
    events.withColumn(by, F.to_date(F.col("ts"))).write.mode("overwrite").partitionBy(by).parquet(landing_dir)
    return landing_dir


def ingest_events(spark: SparkSession, events: DataFrame, keys: list[str], mode: str = "state",
                  files_per_trigger: int = 100) -> DataFrame:
    """Land ``events``, stream them through the dedup and return the table the
    stream wrote (whole run: availableNow)."""
    landing = land_events(events, scratch_path(spark, "landing"))
    schema = spark.read.parquet(landing).schema
    out, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    s = event_stream(spark, landing, schema, files_per_trigger)
    if mode == "table":
        table = VersionedTable(spark, out, ("_batch",))
        run_with_seen_table(s, keys, table, SeenTable(spark, scratch_path(spark, "seen"), digits=1), ckpt)
        return table.read()
    run_to_table(dedup_stream(s, keys, mode, watermark_col="ts"), out, ckpt)
    return spark.read.parquet(out)
