"""Retention and run status over run-partitioned tables.

``retain_newest_runs`` and ``archive_split`` are filters; ``drop_old_runs`` and
``archive_old_runs`` remove and move the files of a versioned table of runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import text as T
from ..sinks.versions import VersionedTable


def retain_newest_runs(table: DataFrame, keep: int = C.KEEP_RUNS, run_col: str = "run_ts") -> DataFrame:
    """Rows of the newest ``keep`` runs. The run list is distinct and tiny; the
    kept list (<= ``keep`` rows, a proven bound) is broadcast to a semi join."""
    newest = table.select(run_col).distinct().orderBy(F.desc(run_col)).limit(keep)
    return table.join(F.broadcast(newest), run_col, "left_semi")


def archive_split(table: DataFrame, run_ts: str = C.DEFAULT_RUN_TS, days: int = C.ARCHIVE_AFTER_DAYS,
                  date_col: str = "date") -> DataFrame:
    """Tag rows older than ``days`` before the run as 'archive', others 'live'
    (write with ``partitionBy('tier')`` to move them in one pass)."""
    cutoff = F.date_format(F.to_timestamp(F.lit(run_ts)) - F.expr(f"INTERVAL {int(days)} DAYS"), T.ISO_FMT)
    return table.withColumn("tier", F.when(F.col(date_col) < cutoff, "archive").otherwise("live"))


def drop_old_runs(table: VersionedTable, keep: int = C.KEEP_RUNS, run_col: str = "run_ts") -> int:
    """Remove all but the newest ``keep`` runs, files included; the number of runs removed.

    The next manifest leaves them out, then their folders go. Ended in between, a second call removes the folders."""
    runs = sorted({p["keys"][table.keys.index(run_col)] for p in table.partitions()}, reverse=True)
    old = set(runs[keep:])
    table.drop(lambda k: k[run_col] in old)
    table.vacuum()
    return len(old)


def archive_old_runs(live: VersionedTable, archive: VersionedTable, run_ts: str = C.DEFAULT_RUN_TS, days: int = C.ARCHIVE_AFTER_DAYS,
                     run_col: str = "run_ts") -> int:
    """Move the runs from before ``days`` ago to ``archive``; the number of runs moved.

    The runs are committed to the archive as whole partitions, then dropped from ``live``, then their files go. Ended after
    any of these steps, a second call ends the move: a run that is in the archive already is replaced, not added."""
    from datetime import datetime, timedelta
    cutoff = (datetime.fromisoformat(run_ts) - timedelta(days=days)).isoformat()

    def old(k: dict) -> bool:
        return k[run_col] < cutoff
    moved = len(live.partitions(old))
    if moved:
        archive.replace(live.read(old))
        live.drop(old)
    live.vacuum()
    archive.vacuum()
    return moved


def run_status(raw_runs: DataFrame, processed_runs: DataFrame, vector_runs: DataFrame,
               run_col: str = "run_ts") -> DataFrame:
    """Per run: raw, processed and vector counts (aggregate first, then a full
    outer join of three small per-run tables)."""
    r = raw_runs.groupBy(run_col).agg(F.count(F.lit(1)).alias("raw"))
    p = processed_runs.groupBy(run_col).agg(F.count(F.lit(1)).alias("processed"))
    v = vector_runs.groupBy(run_col).agg(F.count(F.lit(1)).alias("vectors"))
    j = r.join(p, run_col, "full_outer").join(v, run_col, "full_outer")
    return j.select(run_col, *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
                               for c in ("raw", "processed", "vectors")])
