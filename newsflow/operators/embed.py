"""Embedding stage and text search.

The reference calls a remote embedding model. Here the stage is pluggable:

* default (deterministic, offline): a hashed bag of words. Tokens are
  lower-case ASCII letter runs; each token goes to bucket
  ``md5(token)[:8] (hex) mod dim`` and the weight of a bucket is its token
  count. It is a reproducible stand-in, **not** a reproduction of the remote
  model's vectors. It is kept *sparse*: per row the list of token buckets, so
  embedding is a pure projection (no shuffle) and the scorer densifies one
  block at a time.
* hook: ``embed_with(df, text_col, fn)`` applies any Arrow-batched pandas
  function ``Series[str] -> Series[list[float]]`` (a real model) and yields
  dense vectors; ``query_fn`` may differ from the document function
  (asymmetric models embed queries with another input type).
"""

from __future__ import annotations

import hashlib
import re
from typing import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from .. import config as C
from ..functions import text as T
from ..functions.udf import series_udf
from .vectors import blocked_topk


def embed_sparse(df: DataFrame, text_col: str = "text", id_col: str = "id", dim: int = C.EMBED_DIM, keep=()) -> DataFrame:
    """``(id, idx ARRAY<INT>, val ARRAY<DOUBLE>)``: one entry per bucket with its
    token count; ``keep`` names further columns to carry along. A projection: no shuffle."""
    from ..functions import sql as S
    idx = f"transform({S.tokens(S.ident(text_col))}, w -> CAST({S.hash_bucket('w', dim)} AS INT))"
    kept = [S.ident(c) for c in keep]
    # sorted, a bucket's first place and count are where it begins and its next one begins
    return df.selectExpr(*kept, f"{S.ident(id_col)} AS id", f"array_sort({idx}) AS _all").selectExpr(
        *kept, "id", "filter(transform(_all, (x, i) -> IF(i = 0 OR _all[i - 1] <> x, i, -1)), i -> i >= 0) AS _at", "_all").selectExpr(
        *kept, "id", "transform(_at, i -> _all[i]) AS idx",
        "transform(_at, (i, k) -> CAST(IF(k + 1 < size(_at), get(_at, k + 1), size(_all)) - i AS DOUBLE)) AS val")


KNOWN_WORDS = 1 << 18            # words whose buckets a task remembers


class _Buckets(dict):
    def __init__(self, dim: int):
        self.dim = dim

    def __missing__(self, word: str) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = bucket = int.from_bytes(hashlib.md5(word.encode()).digest()[:4], "big") % self.dim
        return bucket


def _counted(dim: int):
    """Rows whose last column is a lower-cased text; its buckets, their counts and the vector's length instead."""
    def run(batches):
        known, letters = _Buckets(dim), re.compile("[a-z]+")
        for b in batches:
            idx, val, norms = [np.zeros(0, np.int32)], [np.zeros(0)], []
            for text in b.column(b.num_columns - 1).to_pylist():
                bucket, count = np.unique(np.array([known[w] for w in letters.findall(text)], dtype=np.int32), return_counts=True)
                idx.append(bucket)
                val.append(count.astype(float))
                norms.append(float(val[-1] @ val[-1]) ** 0.5)
            ends = pa.array(np.cumsum([len(x) for x in idx]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], *(pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x))) for x in (idx, val)), pa.array(norms, pa.float64())],
                names=[*b.schema.names[:-1], "idx", "val", "norm"])
    return run


def embed_rows(df: DataFrame, text_col: str = "text", id_col: str = "id", dim: int = C.EMBED_DIM, keep=()) -> DataFrame:
    """The rows of ``embed_sparse`` with the length ``norm`` of their vector, for many whole texts: words are cut and
    counted in Arrow batches, and a task works out the bucket of a word once."""
    from ..functions import sql as S
    rows = df.selectExpr(*[S.ident(c) for c in keep], f"{S.ident(id_col)} AS id", f"lower({S.nz(S.ident(text_col))}) AS _text")
    return rows.mapInArrow(_counted(dim), Ty.StructType([*rows.schema.fields[:-1], Ty.StructField("idx", Ty.ArrayType(Ty.IntegerType())),
                                                         Ty.StructField("val", Ty.ArrayType(Ty.DoubleType())), Ty.StructField("norm", Ty.DoubleType())]))


def with_dense_vector(df: DataFrame, text_col: str = "text", out: str = "embedding", dim: int = C.EMBED_DIM) -> DataFrame:
    """The rows with the same embedding as ``out ARRAY<FLOAT>`` of ``dim`` counts: the sorted entries with zeros between them."""
    rows = df.withColumn("_nf_id", F.lit(0))
    sparse = embed_sparse(rows, text_col, "_nf_id", dim, keep=df.columns).drop("id")
    between = "array_repeat(CAST(0 AS FLOAT), idx[i] - IF(i = 0, -1, get(idx, i - 1)) - 1)"
    tail = f"array_repeat(CAST(0 AS FLOAT), {int(dim)} - 1 - coalesce(get(idx, size(idx) - 1), -1))"
    return sparse.withColumn(out, F.expr(
        f"concat(flatten(transform(val, (v, i) -> concat({between}, array(CAST(v AS FLOAT))))), {tail})")).drop("idx", "val")


def sparse_terms(df: DataFrame, text_col: str = "text", id_col: str = "id", dim: int = C.EMBED_DIM) -> DataFrame:
    """Long form ``(id, bucket, weight)`` of the same embedding."""
    return (df.select(F.col(id_col).alias("id"), F.explode(T.tokens(text_col)).alias("tok"))
            .groupBy("id", T.hash_bucket(F.col("tok"), dim).alias("bucket"))
            .agg(F.count(F.lit(1)).cast("double").alias("weight")))


def embed_with(df: DataFrame, fn: Callable[[pd.Series], pd.Series], text_col: str = "text",
               id_col: str = "id") -> DataFrame:
    """Dense vectors from a user model, Arrow-batched (``pandas_udf``)."""
    udf = series_udf(fn, Ty.ArrayType(Ty.FloatType()))
    return df.select(F.col(id_col).alias("id"), udf(F.col(text_col)).alias("vec"))


def search_text(queries: DataFrame, docs: DataFrame, n: int = C.MAX_RESULTS,
                threshold: float = C.SIMILARITY_THRESHOLD, dim: int = C.EMBED_DIM,
                query_text: str = "text", doc_text: str = "text", block_rows: int = 4096) -> DataFrame:
    """Top ``n`` documents per query text by cosine of the default embedding,
    score >= threshold. ``queries(id, text)``, ``docs(id, text)``. Output
    ``(query_id, id, similarity_score, rank)``."""
    q = embed_sparse(queries, query_text, dim=dim)
    d = embed_sparse(docs, doc_text, dim=dim)
    top = blocked_topk(q, d, k=n, threshold=threshold, exclude_self=False, block_rows=block_rows,
                       sparse_dim=dim)
    return top.select(F.col("id").alias("query_id"), F.col("neighbor_id").alias("id"),
                      F.col("score").alias("similarity_score"), "rank")


def search_category(queries: DataFrame, docs: DataFrame, category: str, n: int = C.MAX_RESULTS,
                    threshold: float = C.SIMILARITY_THRESHOLD, category_col: str = "category",
                    **kw) -> DataFrame:
    """``search_text`` restricted to one category; the filter is applied to the
    documents before scoring (pushed to the scan when the column is stored).
    Asking for 2n and stopping at n equals top n."""
    return search_text(queries, docs.filter(F.col(category_col) == F.lit(category)), n=n,
                       threshold=threshold, **kw)


def search_text_with(queries: DataFrame, docs: DataFrame, embed_fn: Callable[[pd.Series], pd.Series],
                     query_embed_fn: Callable[[pd.Series], pd.Series] | None = None, n: int = C.MAX_RESULTS,
                     threshold: float = C.SIMILARITY_THRESHOLD, query_text: str = "text", doc_text: str = "text",
                     block_rows: int = 4096) -> DataFrame:
    """Text search with a user embedding model: documents through
    ``embed_fn``, queries through ``query_embed_fn`` (asymmetric models embed
    queries with another input type; defaults to ``embed_fn``). Both run as
    Arrow-batched pandas UDFs; scoring is the same exact blocked top-k."""
    q = embed_with(queries, query_embed_fn or embed_fn, query_text)
    d = embed_with(docs, embed_fn, doc_text)
    top = blocked_topk(q, d, k=n, threshold=threshold, exclude_self=False, block_rows=block_rows)
    return top.select(F.col("id").alias("query_id"), F.col("neighbor_id").alias("id"),
                      F.col("score").alias("similarity_score"), "rank")
