"""Exact top-k of all vectors against all, without shipping pairs that cannot matter.

A few vectors are drawn as pivots; every vector lies in the cell of its nearest pivot, and
a cell has a radius, the largest angle to its pivot. For a vector x and a cell with pivot p
and radius r, no member is nearer to x than ``angle(x, p) - r`` (the triangle inequality of
angles). So, after each vector has met its own cell, it is sent only to those cells that may
hold a neighbour over the threshold and over its k-th best score so far.

Cells are cut into blocks of at most ``rows`` vectors, and so are the vectors sent to a cell:
a task scores one block against another, and emits the k best of each vector. Equal vectors,
however many, are many blocks of one cell.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from .. import config as C
from ..session import scratch_path
from .vectors import _block_topk_fn

PIVOTS = 1024                    # at most: their vectors travel with the tasks
ROWS, MOST_ROWS = 4096, 32768    # vectors of a block, and of a large table's
CELLS = 24                       # that many blocks before they grow: a vector is shipped to each of them
ANGLE_SLACK, SCORE_SLACK = 1e-6, 1e-8      # what rounding may hide in an angle near 0, and in a score


def _unit(column) -> tuple[np.ndarray, np.ndarray]:
    v = np.stack([np.asarray(x, dtype=np.float64) for x in column.to_pylist()]) if len(column) else np.zeros((0, 1))
    norm = np.linalg.norm(v, axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        return v / norm[:, None], norm


def _angles(units: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(units @ pivots.T, -1, 1))


def _to_cells(pivots: np.ndarray):
    def run(batches):
        for b in batches:
            units, norm = _unit(b.column(1))
            ok = norm > 0                                     # a vector without direction has no score
            angle = _angles(units[ok], pivots)
            cell = angle.argmin(1) if len(angle) else np.zeros(0, int)
            kept = b.filter(pa.array(ok))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1), pa.array(cell.astype(np.int32)), pa.array(angle[np.arange(len(cell)), cell])],
                                             names=["id", "vec", "cell", "angle"])
    return run


def _partners(pivots: np.ndarray, radius: np.ndarray, threshold: float):
    """Rows (id, vec, own cell, k-th score) in; the other cells that may hold a better neighbour out."""
    def run(batches):
        for b in batches:
            units, _ = _unit(b.column(1))
            nearest = np.maximum(0, _angles(units, pivots) - radius - ANGLE_SLACK)
            floor = np.maximum(threshold, np.array(b.column(3).to_pylist(), dtype=float))
            may = np.cos(nearest) >= floor[:, None] - SCORE_SLACK
            may[np.arange(len(units)), b.column(2).to_numpy()] = False
            may[:, radius < 0] = False                        # an empty cell
            row, cell = np.nonzero(may)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), b.column(1).take(pa.array(row)), pa.array(cell.astype(np.int32)), pa.array(floor[row])],
                                             names=["id", "vec", "cell", "floor"])
    return run


def _meet(probe: DataFrame, build: DataFrame, k: int, threshold: float | None, rows: int, sizes: dict[int, int], asked: dict[int, int], schema) -> DataFrame:
    """The k best in ``build``'s cell for each row of ``probe(id, vec, cell)``, of at least its ``floor`` if it has one; ``sizes`` and ``asked`` count both by cell (at most ``PIVOTS`` entries)."""
    def blocks(counts):
        return F.create_map(*[F.lit(x) for c, n in counts.items() for x in (c, -(-n // rows))])
    if not sizes or not asked:
        return probe.sparkSession.createDataFrame([], schema)
    nb, np_ = F.try_element_at(blocks(sizes), F.col("cell")), F.try_element_at(blocks(asked), F.col("cell"))
    p = (probe.withColumn("pb", F.pmod(F.xxhash64("id"), np_).cast("int")).withColumn("bb", F.explode(F.sequence(F.lit(0), nb - 1)))
         .select("id", "vec", "cell", "pb", "bb", *[c for c in ("floor",) if c in probe.columns]))
    b = (build.select(F.col("id").alias("b_id"), F.col("vec").alias("b_vec"), "cell").where(F.col("cell").isin(list(asked)))
         .withColumn("bb", F.pmod(F.xxhash64("b_id"), nb).cast("int")).withColumn("pb", F.explode(F.sequence(F.lit(0), np_ - 1)))
         .select("b_id", "b_vec", "cell", "pb", "bb"))
    return p.groupBy("cell", "pb", "bb").cogroup(b.groupBy("cell", "pb", "bb")).applyInPandas(_block_topk_fn(k, threshold, True, None), schema)


def knn_all_pruned(vectors: DataFrame, k: int = C.MAX_RESULTS, threshold: float | None = C.SIMILARITY_THRESHOLD, rows: int | None = None,
                   pivots: int | None = None, report: dict | None = None) -> DataFrame:
    """``(id, neighbor_id, score, rank)``: the ``k`` most similar other vectors of every row of ``vectors(id, embedding)``, exactly.

    Scores are cosines, of at least ``threshold`` if given; ties (to 1e-9) by id. Null vectors and vectors without direction have
    no neighbours. ``rows`` is the size of a block (default: ``ROWS``, in large tables a ``CELLS``-th of all up to ``MOST_ROWS``, so that
    vectors are shipped less often), ``pivots`` the number of cells (default: as many as blocks, ``PIVOTS`` at most).
    ``report`` is filled with the pairs of vectors there are and the pairs that were scored."""
    spark = vectors.sparkSession
    v = vectors.select("id", F.col("embedding").alias("vec")).where("vec IS NOT NULL")
    kind = v.schema["id"].dataType
    schema = Ty.StructType([Ty.StructField("id", kind), Ty.StructField("neighbor_id", kind), Ty.StructField("score", Ty.DoubleType())])
    least = -1.0 if threshold is None else threshold
    if rows is None or pivots is None:
        n = v.count()
        rows = rows or max(ROWS, min(MOST_ROWS, -(-n // CELLS)))
        pivots = min(PIVOTS, -(-n // rows)) if pivots is None else pivots
    drawn = v.orderBy(F.xxhash64("id"), "id").limit(max(1, min(PIVOTS, pivots))).collect()
    units = [np.asarray(r["vec"], dtype=np.float64) for r in drawn]
    units = [u / np.linalg.norm(u) for u in units if np.linalg.norm(u) > 0]
    if not units:
        units = [np.ones(len(drawn[0]["vec"]) if drawn else 1)]
    centres = np.stack(units) / np.linalg.norm(np.stack(units), axis=1)[:, None]
    dealt = v.mapInArrow(_to_cells(centres), Ty.StructType([v.schema["id"], v.schema["vec"], Ty.StructField("cell", Ty.IntegerType()), Ty.StructField("angle", Ty.DoubleType())]))
    at = scratch_path(spark, "cells")
    dealt.write.parquet(at)
    dealt = spark.read.schema(dealt.schema).parquet(at)
    facts = dealt.groupBy("cell").agg(F.count("*").alias("n"), F.max("angle").alias("r")).collect()       # a row for each pivot
    sizes = {r["cell"]: r["n"] for r in facts}
    radius = np.full(len(centres), -1.0)
    for r in facts:
        radius[r["cell"]] = r["r"]
    own = _meet(dealt.select("id", "vec", "cell"), dealt, k, threshold, rows, sizes, sizes, schema)
    if report is not None:
        report["pairs"] = sum(sizes.values()) ** 2
        report["scored"] = sum(n * n for n in sizes.values())
    best = Window.partitionBy("id").orderBy(F.round("score", 9).desc(), F.asc("neighbor_id"))
    hits = own.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    if len(sizes) > 1:
        at = scratch_path(spark, "cells-own")
        hits.write.parquet(at)
        hits = spark.read.schema(hits.schema).parquet(at)
        kth = hits.where(F.col("rank") == k).select("id", F.col("score").alias("kth"))
        sent = (dealt.join(kth, "id", "left").select("id", "vec", "cell", F.coalesce("kth", F.lit(least)).alias("kth"))
                .mapInArrow(_partners(centres, radius, least), Ty.StructType([v.schema["id"], v.schema["vec"], Ty.StructField("cell", Ty.IntegerType()), Ty.StructField("floor", Ty.DoubleType())])))
        at = scratch_path(spark, "cells-sent")
        sent.write.parquet(at)
        sent = spark.read.schema(sent.schema).parquet(at)
        asked = {r["cell"]: r["count"] for r in sent.groupBy("cell").count().collect()}
        if report is not None:
            report["scored"] += sum(n * sizes[c] for c, n in asked.items())
        others = _meet(sent, dealt, k, threshold, rows, sizes, asked, schema)
        hits = hits.drop("rank").unionByName(others).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return hits
