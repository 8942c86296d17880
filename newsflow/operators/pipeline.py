"""Composite jobs: raw articles -> processed articles with summaries, from files to files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from .. import schemas as SC
from ..session import scratch_path
from ..sinks.versions import VersionedTable
from . import ingest as IN
from . import summarize as SU


def process_raw(raw: DataFrame, file_col: str = "source_file", pos_col: str = "pos", summarize_fn=None,
                single_fn=None, cleaning: bool = True) -> DataFrame:
    """Every raw file -> processed articles with ``ai_summary``: processor id,
    stripped title, cleaned content, then batch summaries per file. One plan
    over all files (keyed by ``file_col``), no per-file loop."""
    processed = IN.process_article(raw, cleaning=cleaning, keep=("page_id", "entry_pos", file_col, pos_col))
    return SU.summarize(processed, file_col=file_col, pos_col=pos_col, summarize_fn=summarize_fn,
                        single_fn=single_fn)


def process_raw_files(spark: SparkSession, raw_dir: str, processed: VersionedTable, done: VersionedTable, schema: Ty.StructType = SC.RAW_ARTICLE,
                      again: bool = False, summarize_fn=None, single_fn=None, cleaning: bool = True) -> DataFrame:
    """Every raw file -> its processed run: a partition of ``processed`` for each source file; the report of this call.

    Files whose name and time of change ``done`` knows are left alone, unless ``again``. The others are parsed once; a broken
    file costs only itself and is reported, an empty one has no run (one that it had before goes). The runs of this call
    replace those of the same files in one commit, then the report is committed, so a call that dies is done again from
    the start and leaves no copies. ``report(source_file, changed, status, articles)``."""
    from ..sources.files import raw_articles_of, scan_raw_files
    files = scan_raw_files(spark, raw_dir)
    if not again and done.version():
        files = files.join(done.read().select("source_file", "changed"), ["source_file", "changed"], "left_anti")
    at = scratch_path(spark, "raw-files")
    files.write.parquet(at)
    files = spark.read.schema(files.schema).parquet(at)
    articles = process_raw(raw_articles_of(files, schema), summarize_fn=summarize_fn, single_fn=single_fn, cleaning=cleaning)
    base = processed.version()
    new = processed.write(articles, order=("pos",))
    written = {p["keys"][processed.keys.index("source_file")]: p["rows"] for p in new}
    names = {r["source_file"] for r in files.select("source_file").collect()}          # partitions of this commit
    processed.commit(new, lambda k: k["source_file"] in names, articles.schema, base)
    counts = spark.createDataFrame([*written.items()], "source_file string, articles bigint")
    report = files.drop("articles").join(counts, "source_file", "left").select("source_file", "changed", "status", F.coalesce("articles", F.lit(0)).alias("articles"))
    done.replace(report)
    return report
