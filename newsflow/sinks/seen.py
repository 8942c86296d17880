"""The seen set, by bucket of hashes, with membership filters.

Hashes (hexadecimal digests) lie in buckets by their first digits, and every batch adds
a partition to the buckets that it hits. Beside each partition lies its filter: bitmaps in
which every hash has set two bits. A batch is looked up in the filters first, which are a
small part of the set; only partitions that may hold one of its hashes are read, and only
for the hashes that they may hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .versions import VersionedTable

DIGITS = 2                       # of a hash that name its bucket: 16 ** DIGITS buckets
BITMAPS = 4                      # of 32768 bits each, for a partition; more hashes let more pass, never fewer
WIDTH = 32_768                   # bits of a bitmap of Spark's bitmap functions
BATCHES = 16                     # partitions of a bucket from which ``compact`` joins them


class SeenTable:
    def __init__(self, spark: SparkSession, root: str, digits: int = DIGITS, bitmaps: int = BITMAPS):
        self.spark, self.digits, self.bitmaps = spark, digits, bitmaps
        self.hashes = VersionedTable(spark, f"{root}/hashes", ("bucket", "batch"))
        self.filters = VersionedTable(spark, f"{root}/filters", ("bucket", "batch"))

    def _keys(self, rows: DataFrame) -> DataFrame:
        return rows.select("article_hash").distinct().withColumn("bucket", F.substring("article_hash", 1, self.digits))

    def _bits(self, keys: DataFrame) -> DataFrame:
        """Two rows for each hash: which bitmap, which bit of it. The digits after the bucket's are the draws."""
        draw = [F.conv(F.substring("article_hash", self.digits + 1 + 8 * i, 8), 16, 10).cast("bigint") % (self.bitmaps * WIDTH) for i in range(2)]
        at = F.explode(F.array(*draw)).alias("_at")
        return keys.select("*", at).select(*keys.columns, F.floor(F.col("_at") / WIDTH).cast("int").alias("bitmap"), (F.col("_at") % WIDTH).alias("bit"))

    def has(self, batch: str) -> bool:
        """Whether the batch ``<source>-<number>`` was added, or a later one of its source (their numbers ascend)."""
        source, _, number = batch.rpartition("-")
        return int(number) <= self.hashes.notes().get(source, -1)

    def read(self) -> DataFrame:
        """All hashes, ``article_hash``."""
        if not self.hashes.version():
            return self.spark.createDataFrame([], "article_hash string")
        return self.hashes.read().select("article_hash").distinct()

    def seen(self, rows: DataFrame, but: str | None = None, report: dict | None = None) -> DataFrame:
        """Those of ``rows(article_hash)`` that are in the set (in another batch than ``but``).

        ``report`` is filled with the partitions there are, those that were read, and their rows."""
        keys = self._keys(rows)
        there = [p for p in self.hashes.partitions() if p["keys"][1] != but]
        if report is not None:
            report.update(partitions=len(there), read=0, rows=0)
        if not there:
            return self.spark.createDataFrame([], "article_hash string")
        hit = {r["bucket"] for r in keys.select("bucket").distinct().collect()}               # 16 ** digits at most
        filters = self.filters.read(lambda k: k["bucket"] in hit and k["batch"] != but)
        byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        may = (self._bits(keys).join(filters, ["bucket", "bitmap"]).withColumn("_byte", byte)
               .where("(shiftright(_byte, cast(bit % 8 as int)) & 1) = 1")
               .groupBy("bucket", "batch", "article_hash").agg(F.count("*").alias("_set")).where("_set = 2"))      # both bits, which may be the same
        from ..session import scratch_path
        at = scratch_path(self.spark, "seen-candidates")
        may.select("bucket", "batch", "article_hash").write.parquet(at)
        may = self.spark.read.schema("bucket string, batch string, article_hash string").parquet(at)
        wanted = {(r["bucket"], r["batch"]) for r in may.select("bucket", "batch").distinct().collect()}
        if report is not None:
            report.update(read=len(wanted), rows=sum(p["rows"] for p in there if tuple(p["keys"]) in wanted))
        held = self.hashes.read(lambda k: (k["bucket"], k["batch"]) in wanted).select("article_hash")
        return may.select("article_hash").distinct().join(held, "article_hash", "left_semi")

    def add(self, rows: DataFrame, batch: str) -> None:
        """Add ``rows(article_hash)`` as the batch of this name, ``<source>-<number>``, or in its place; its filters are there before its hashes."""
        source, _, number = batch.rpartition("-")
        notes = self.hashes.notes()
        keys = self._keys(rows).withColumn("batch", F.lit(batch))
        base = self.hashes.version()
        new = self.hashes.write(keys)
        written = self.spark.read.schema(keys.schema).parquet(*[f"{self.hashes.root}/{p['path']}" for p in new]) if new else keys
        bits = self._bits(written).groupBy("bucket", "batch", "bitmap").agg(F.bitmap_construct_agg("bit").alias("bits"))
        self.filters.replace(bits, drop=lambda k: k["batch"] == batch)
        self.hashes.commit(new, lambda k: k["batch"] == batch, keys.schema, base, {**notes, source: max(int(number), notes.get(source, -1))})

    def compact(self, least: int = BATCHES) -> int:
        """Join the partitions of the buckets that have ``least`` or more of them; the number of such buckets."""
        count: dict[str, int] = {}
        for p in self.hashes.partitions():
            count[p["keys"][0]] = count.get(p["keys"][0], 0) + 1
        many = {b for b, n in count.items() if n >= least}
        if many:
            name = f"joined-{self.hashes.version() + 1}"
            old = self.hashes.read(lambda k: k["bucket"] in many)
            joined = self._keys(old).withColumn("batch", F.lit(name))
            bits = self._bits(joined).groupBy("bucket", "batch", "bitmap").agg(F.bitmap_construct_agg("bit").alias("bits"))
            self.filters.replace(bits)                        # beside the old ones: nothing is missed in between
            self.hashes.replace(joined, drop=lambda k: k["bucket"] in many and k["batch"] != name)
            self.filters.drop(lambda k: k["bucket"] in many and k["batch"] != name)
        return len(many)
