"""File sources: raw/processed article JSON files, the latest snapshot, the
seen table and point lookups in the vector table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from .. import schemas as SC

def scan_raw(spark: SparkSession, raw_dir: str, pattern: str = "raw_news_*.json",
             schema: Ty.StructType = SC.RAW_ARTICLE) -> DataFrame:
    """All raw article files of a directory (one JSON array per file), other
    files such as ``seen_articles.json`` excluded by the glob; empty files give
    no rows. Explicit schema: a missing key reads as NULL."""
    df = (spark.read.option("multiLine", True).option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
          .option("mode", "PERMISSIVE").schema(schema).json(raw_dir))
    return df.withColumn("source_file", F.col("_metadata.file_path"))


def scan_raw_files(spark: SparkSession, raw_dir: str, pattern: str = "raw_news_*.json") -> DataFrame:
    """One row for each raw file: ``source_file`` (its name), ``changed``, ``status`` and ``articles``, the file's JSON as a variant.

    ``ok``: a non-empty array; ``empty``: no article; ``broken``: no JSON, or no array. Files are read whole by the tasks,
    as JSON arrays are; they are landed with a bounded number of articles. A file without a byte gives no row: Spark's readers pass it over."""
    whole = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(raw_dir)
    text = F.col("content").cast("string")
    parsed = whole.select(F.element_at(F.split("path", "/"), -1).alias("source_file"), F.col("modificationTime").alias("changed"),
                          F.try_parse_json(text).alias("articles"), (~text.rlike(r"\S")).alias("_blank"))
    kind = F.schema_of_variant("articles")
    status = (F.when(F.col("_blank") | kind.isin("ARRAY<VOID>", "ARRAY<>"), "empty").when(F.col("articles").isNull() | ~kind.startswith("ARRAY"), "broken").otherwise("ok"))
    return parsed.select("source_file", "changed", status.alias("status"), "articles")


def raw_articles_of(files: DataFrame, schema: Ty.StructType = SC.RAW_ARTICLE) -> DataFrame:
    """The articles of the ``ok`` files of ``scan_raw_files`` in the order of their file: ``source_file``, ``pos`` (from 0) and the
    fields of ``schema``; a missing field, or one of another type, is null. Elements that are no objects are left out."""
    spark = files.sparkSession
    rows = spark.sql("SELECT f.source_file, e.pos, e.value FROM {files} f, LATERAL variant_explode(f.articles) e WHERE f.status = 'ok'", files=files)
    fields = [F.try_variant_get("value", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in schema.fields]
    return rows.where(F.schema_of_variant("value").startswith("OBJECT")).select("source_file", F.col("pos").cast("bigint").alias("pos"), *fields)


def latest_files(spark: SparkSession, out_dir: str, patterns=("processed_news_*.json", "api_articles_*.json"),
                 legacy: str = "latest_articles.json", schema: Ty.StructType | None = None) -> DataFrame:
    """Rows of the newest file (by modification time, then path) among the processed and
    API snapshot files, or of the legacy ``latest_articles.json`` when there is
    none. Adds ``source_file``, ``mtime``, ``last_processed``, ``available_files`` and
    ``total_articles``. Files are found by listing, so a newest file without
    articles counts (and gives no rows); only the newest is read."""
    schema = schema or SC.SNAPSHOT_ARTICLE

    def listed(pattern: str) -> DataFrame:
        return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(out_dir).select("path", "modificationTime")

    files = listed(patterns[0])
    for p in patterns[1:]:
        files = files.union(listed(p))
    by_age = [F.desc("modificationTime"), F.desc("path")]
    newest, found = files.orderBy(*by_age).first(), files.count()
    if newest is None:
        files = listed(legacy)
        newest, found = files.orderBy(*by_age).first(), files.count()
    rows = spark.read.option("multiLine", True).schema(schema)
    rows = rows.json(newest["path"]) if newest else spark.createDataFrame([], schema)
    meta = (F.col("_metadata.file_path"), F.col("_metadata.file_modification_time")) if newest else (
        F.lit(None).cast("string"), F.lit(None).cast("timestamp"))
    rows = rows.withColumn("source_file", meta[0]).withColumn("mtime", meta[1])
    return (rows.withColumn("last_processed", F.date_format(F.col("mtime"), "yyyy-MM-dd'T'HH:mm:ss"))
            .withColumn("available_files", F.lit(found).cast("bigint"))
            .withColumn("total_articles", rows.agg(F.count(F.lit(1))).scalar()))


def latest_run(table: DataFrame, run_col: str = "run_ts") -> DataFrame:
    """Rows of the newest run of a table partitioned by ``run_ts``. The max is a
    scalar subquery, so the filter prunes partitions at execution time."""
    newest = table.agg(F.max(run_col)).scalar()
    return table.filter(F.col(run_col) == newest)


def read_seen(spark: SparkSession, path: str) -> DataFrame:
    """The seen-hash table; an empty table when it does not exist yet. A table
    that exists but cannot be read is an error."""
    if not exists(spark, path):
        return spark.createDataFrame([], "article_hash string")
    return spark.read.parquet(path).select("article_hash")


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def article_by_id(vectors: DataFrame, article_id) -> DataFrame:
    """Point lookup (pushed to the parquet scan); zero rows when unknown.
    Batch form: join with a table of ids."""
    return vectors.filter(F.col("id") == F.lit(article_id)).select(
        "id", "title", "link", "summary", F.col("content_preview").alias("content"), "published", "source_name")


def land_json_arrays(df: DataFrame, path: str, group_col: str, order_col: str, prefix: str = "raw_news_",
                     per_file: int = 1000, spoil=None, empty: bool = False) -> str:
    """Write JSON-array files (the reference's file layout: one array of article
    objects per file), named ``{prefix}{n}.json``.

    A file holds the rows of a group within ``per_file`` values of the integer
    ``order_col`` (at most ``per_file`` rows if its values differ), so a
    large group becomes many files. The array is built on an executor
    (``to_json(collect_list)``) and written by the text writer, one row per
    file. Only the renames run on the driver (file-system metadata).
    """
    cols = [c for c in df.columns]
    g = (df.groupBy(group_col, F.floor(F.col(order_col) / per_file).alias("_c"))
         .agg(F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("_o"), F.struct(*cols).alias("r"))))
              .alias("xs"))
         .select(F.col(group_col).alias("_g"), "_c", F.to_json(F.transform("xs", lambda x: x["r"])).alias("value")))
    if spoil is not None:                                     # files that arrive cut off, by group (_g) and range (_c)
        g = g.withColumn("value", F.when(spoil, F.expr("substring(value, 1, length(value) - 2)")).otherwise(F.col("value")))
    tmp = path.rstrip("/") + "/_staging"
    # a file for each row, without folders; tasks put their files in place themselves (committer 2), not the driver one by one
    g.select("value").write.option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", 2).text(tmp)
    spark = df.sparkSession
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path    # looked up once: each step of the name is a call
    src = at(tmp)
    fs = src.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(f.rpartition("/")[2] for f in spark.read.text(tmp).inputFiles())
    for n, name in enumerate(names):
        staged = at(f"{tmp}/{name}")
        if name.endswith("-c000.txt") and not fs.getFileStatus(staged).getLen():     # a task without rows
            continue
        if not fs.rename(staged, at(f"{path.rstrip('/')}/{prefix}{n:05d}.json")):
            raise OSError(f"{name} could not be renamed")
    fs.delete(src, True)
    # a non-article file next to the runs, as in the reference's directory, and (``empty``) a run without articles
    for name in ["seen_articles.json"] + [f"{prefix}none.json"] * empty:
        out = fs.create(at(f"{path.rstrip('/')}/{name}"))
        out.write(bytearray(b"[]"))
        out.close()
    return path
