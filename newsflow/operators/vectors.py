"""Vector index operators: metadata, matches, single-source and all-sources
top-k cosine search.

Physical choices (see README "Similarity search"):

* one source (``similar_by_id``): the source vector is a *scalar subquery*
  (one row, size = the dimension), so the scan of the index is a plain
  projection + ``TakeOrderedAndProject``: no join, no shuffle of the index.
* many sources (``knn_all``, text search for a whole query table): an exact
  blocked matrix product. Rows are hashed into blocks of at most
  ``block_rows``; every (probe block, build block) pair is one
  ``cogroup().applyInPandas`` group that scores the pair with numpy and emits
  only the top k of each probe row, so no task ever holds more than two blocks
  and no pair list is materialised. The per-row top k of all blocks are merged
  with ``row_number() <= k`` (partial WindowGroupLimit before the shuffle).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from .. import config as C
from ..functions import vector as V

MATCH_COLUMNS = ["id", "title", "link", "summary", "published", "source_name", "category", "tags",
                 "similarity_score", "content_preview"]


def vector_metadata(articles: DataFrame, run_ts: str = C.DEFAULT_RUN_TS, keep=("page_id", "article_id"),
                    caps: bool = True) -> DataFrame:
    """Article rows -> the metadata stored with each vector.

    With ``caps`` title <= 1000 chars, summary <= 2000, tags <= 10; without, whole values.
    summary = ai_summary when present else summary; tags = enhanced_tags when present else tags;
    categories = enhanced_categories when present; category = first of categories, else category, else 'general';
    content_preview = first 500 chars of the *embedding text* (which uses the
    plain summary, not ai_summary).
    """
    from ..functions import sql as S
    cols = set(articles.columns)
    ai = "ai_summary" if "ai_summary" in cols else "CAST(NULL AS STRING)"
    cat = "category" if "category" in cols else "CAST(NULL AS STRING)"
    enhanced = "ai_enhanced" if "ai_enhanced" in cols else "false"
    kept = [S.ident(c) for c in keep if c in cols]
    no_text = "CAST(NULL AS ARRAY<STRING>)"
    tags = f"coalesce({'enhanced_tags' if 'enhanced_tags' in cols else no_text}, tags, CAST(array() AS ARRAY<STRING>))"
    categories = f"coalesce({'enhanced_categories' if 'enhanced_categories' in cols else no_text}, categories)"
    cut = (lambda x, n: f"substring({x}, 1, {n})") if caps else (lambda x, n: x)
    return articles.selectExpr(
        *kept,
        f"{cut("coalesce(title, '')", C.TITLE_CAP)} AS title",
        "coalesce(url, '') AS link",
        f"{cut(f"coalesce({ai}, summary, '')", C.SUMMARY_CAP)} AS summary",
        "coalesce(date, '') AS published",
        "coalesce(source_name, '') AS source_name",
        f"coalesce(get({categories}, 0), {cat}, {S.lit(C.DEFAULT_CATEGORY)}) AS category",
        f"slice({tags}, 1, {C.TAGS_CAP}) AS tags" if caps else f"{tags} AS tags",
        f"coalesce({enhanced}, false) AS ai_enhanced",
        f"{S.lit(run_ts)} AS added_to_db",
        f"substring({S.embedding_text('title', 'summary', 'content')}, 1, {C.PREVIEW_CHARS}) AS content_preview",
    )


def match_projection(matches: DataFrame) -> DataFrame:
    """Scored vectors -> MATCH rows with the reference's defaults."""
    return matches.select(
        "id",
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("title", "link", "summary", "published", "source_name")],
        F.coalesce(F.col("category"), F.lit(C.DEFAULT_CATEGORY)).alias("category"),
        F.coalesce(F.col("tags"), F.array().cast("array<string>")).alias("tags"),
        F.col("similarity_score").cast("double").alias("similarity_score"),
        F.coalesce(F.col("content_preview"), F.lit("")).alias("content_preview"),
        *[c for c in ("query_id", "rank", "rerank_score", "final_pos") if c in matches.columns],
    )


def source_vector(vectors: DataFrame, source_id, vec_col: str = "embedding"):
    """The vector of one id as a scalar-subquery column (NULL if unknown). ``vectors`` holds one namespace:
    an id stands in it once."""
    return vectors.filter(F.col("id") == F.lit(source_id)).select(F.col(vec_col)).scalar()


def topk_search(scored: DataFrame, n: int, threshold: float | None = C.SIMILARITY_THRESHOLD,
                score: str = "similarity_score") -> DataFrame:
    """Threshold then top n by score (ties by id), ranked 1..n.

    Score order is monotone, so thresholding first is the same as the
    reference's top-k-then-threshold and lets the filter run before the sort.
    Planned as TakeOrderedAndProject (no global sort).
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    if threshold is not None:
        scored = scored.filter(F.col(score) >= threshold)
    # order on the score rounded to 1e-9 so that ulp noise cannot reorder exact ties
    key = F.round(F.col(score), 9)
    top = scored.orderBy(key.desc(), F.asc("id")).limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.round(F.col(score), 9).desc(), F.asc("id"))))


def similar_by_id(vectors: DataFrame, source_id, n: int = C.MAX_RESULTS, exclude_source: bool = True,
                  threshold: float = C.SIMILARITY_THRESHOLD, namespace: str | None = None, source: DataFrame | None = None) -> DataFrame:
    """Top ``n`` vectors most similar to the vector of ``source_id`` (cosine),
    without the source itself, score >= threshold. Unknown id -> empty.

    ``namespace``: search this one only; needed where an id may stand in several.
    ``source``: the record of ``source_id``, where it can be had without a scan
    (``VectorTable.fetch``)."""
    if namespace is not None:
        vectors = vectors.filter(F.col("namespace") == F.lit(namespace))
    q = source_vector(vectors if source is None else source, source_id)
    cands = vectors.filter(F.col("id") != F.lit(source_id)) if exclude_source else vectors
    scored = cands.withColumn("_q", q).withColumn(
        "similarity_score", V.cosine_similarity(F.col("embedding"), F.col("_q"))).drop("_q")
    return topk_search(scored, n, threshold).drop("embedding")


SCORES = 1 << 22                 # scores that a task holds at a time
MANY = 16                        # times as many near scores as are wanted: then a row is scored densely
TIE = 1e-8                       # more than rounding to 9 places moves a score

# --- blocked exact top-k ------------------------------------------------------

def _pair_schema(probe: DataFrame, build: DataFrame) -> Ty.StructType:
    return Ty.StructType([Ty.StructField("id", probe.schema["id"].dataType), Ty.StructField("neighbor_id", build.schema["id"].dataType),
                          Ty.StructField("score", Ty.DoubleType())])


def _block_topk_fn(k: int, threshold: float | None, exclude_self: bool, dim: int | None, chunk: int = 1024):
    """pandas function for one (probe block, build block) group."""

    # columns arrive by position: id, vec | (idx, val), pb, bb
    def to_matrix(pdf: pd.DataFrame) -> np.ndarray:
        if dim is None:                                     # dense ARRAY<FLOAT|DOUBLE>
            if len(pdf) == 0:
                return np.zeros((0, 0))
            return np.stack([np.asarray(v, dtype=np.float64) for v in pdf.iloc[:, 1].values])
        if len(pdf) == 0:                                  # sparse (idx, val) -> dense, all rows at once
            return np.zeros((0, dim))
        idx, val = pdf.iloc[:, 1].values, pdf.iloc[:, 2].values
        row = np.repeat(np.arange(len(pdf)), [len(x) for x in idx])
        cell = row * dim + np.concatenate([np.asarray(x, dtype=np.int64) for x in idx])
        return np.bincount(cell, np.concatenate([np.asarray(v, dtype=np.float64) for v in val]), len(pdf) * dim).reshape(-1, dim)

    def best(S: np.ndarray, kk: int) -> np.ndarray:
        """Of a dense matrix of rounded scores, exactly kk in a row: all above the kk-th score, then the first (by id) that tie it."""
        kth = np.partition(S, S.shape[1] - kk, axis=1)[:, S.shape[1] - kk][:, None]
        above, tied = S > kth, S == kth
        return (above | tied & (np.cumsum(tied, axis=1) <= kk - above.sum(axis=1, keepdims=True))) & np.isfinite(S)

    def own_pairs(pid: np.ndarray, bid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of equal ids; ``bid`` is sorted."""
        if pid.dtype == object or bid.dtype == object:
            return np.nonzero(pid[:, None] == bid[None, :])
        first, last = np.searchsorted(bid, pid, "left"), np.searchsorted(bid, pid, "right")
        n = np.where(pid == pid, last - first, 0)             # null ids (nan) equal none
        r = np.repeat(np.arange(len(pid)), n)
        return r, np.repeat(first - np.cumsum(n) + n, n) + np.arange(len(r))

    def units(m: np.ndarray, norm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Single-precision unit vectors, and which have none."""
        with np.errstate(divide="ignore", invalid="ignore"):
            u = (m / norm[:, None]).astype(np.float32)
        dead = ~np.isfinite(u).all(axis=1)
        u[dead] = 0
        return u, dead

    def fn(probe: pd.DataFrame, build: pd.DataFrame) -> pd.DataFrame:
        if len(probe) == 0 or len(build) == 0:
            return pd.DataFrame({"id": probe.iloc[:0, 0], "neighbor_id": build.iloc[:0, 0], "score": pd.Series([], dtype="float64")})
        build = build.sort_values(build.columns[0])        # ties: the smaller id
        P, B = to_matrix(probe), to_matrix(build)
        pn, bn = np.linalg.norm(P, axis=1), np.linalg.norm(B, axis=1)
        pid, bid = probe.iloc[:, 0].to_numpy(), build.iloc[:, 0].to_numpy()
        (pu, pdead), (bu, bdead) = units(P, pn), units(B, bn)
        known = probe["floor"].to_numpy(dtype=float, na_value=-2.0) if "floor" in probe.columns else None
        least = -2.0 if threshold is None else threshold
        slack = 1e-7 * (P.shape[1] + 16)                   # what single precision may be wrong by, at most
        out_i, out_j, out_s = [], [], []
        kk = min(k, len(bid))
        rows = max(1, min(chunk, SCORES // len(bid)))
        for lo in range(0, len(pid), rows):                # bounded memory: SCORES scores at a time
            S = pu[lo:lo + rows] @ bu.T
            S[pdead[lo:lo + rows]] = -np.inf               # no direction -> no score
            S[:, bdead] = -np.inf
            if exclude_self:
                S[own_pairs(pid[lo:lo + rows], bid)] = -np.inf
            # scores in single precision rule out nearly all pairs; what they leave is scored in double precision
            if known is not None:
                floor = known[lo:lo + rows] - TIE
            else:
                some = S[:, ::max(1, len(bid) // max(512, 4 * kk))]      # the kk-th of some is none better than the kk-th of all
                floor = np.partition(some, some.shape[1] - kk, axis=1)[:, some.shape[1] - kk].astype(float) - slack
            may = np.maximum(np.maximum(floor, least) - slack - TIE, -2.0).astype(np.float32)
            left = S >= may[:, None]
            many = left.sum(axis=1) > MANY * kk + MANY
            left[many] = False
            r, c = np.nonzero(left)
            with np.errstate(divide="ignore", invalid="ignore"):
                raw = np.einsum("ij,ij->i", P[lo + r], B[c]) / (pn[lo + r] * bn[c])
            key = np.round(raw, 9)                         # ulp noise must not order exact ties
            ok = np.isfinite(key) if threshold is None else key >= threshold
            r, c, raw, key = r[ok], c[ok], raw[ok], key[ok]
            order = np.lexsort((c, -key, r))
            r, c, raw = r[order], c[order], raw[order]
            place = np.arange(len(r)) - np.searchsorted(r, r, "left")
            out_i.append(pid[lo + r[place < kk]])
            out_j.append(bid[c[place < kk]])
            out_s.append(raw[place < kk])
            rest = lo + np.flatnonzero(many)               # many that are alike (copies): all their scores in double precision
            for at in range(0, len(rest), max(1, rows // 4)):
                q = rest[at:at + max(1, rows // 4)]
                with np.errstate(divide="ignore", invalid="ignore"):
                    raw = (P[q] @ B.T) / np.outer(pn[q], bn)
                raw[~np.isfinite(raw)] = -np.inf
                key = np.round(raw, 9)
                if exclude_self:
                    key[own_pairs(pid[q], bid)] = -np.inf
                if threshold is not None:
                    key[key < threshold] = -np.inf
                r, c = np.nonzero(best(key, kk))
                out_i.append(pid[q[r]])
                out_j.append(bid[c])
                out_s.append(raw[r, c])
        return pd.DataFrame({"id": np.concatenate(out_i), "neighbor_id": np.concatenate(out_j),
                             "score": np.concatenate(out_s)})

    return fn


def blocked_topk(probe: DataFrame, build: DataFrame, k: int = C.MAX_RESULTS,
                 threshold: float | None = C.SIMILARITY_THRESHOLD, exclude_self: bool = True,
                 block_rows: int = 4096, sparse_dim: int | None = None, within: str | None = None) -> DataFrame:
    """Exact top-``k`` cosine neighbours in ``build`` for every row of ``probe``.

    Dense inputs: ``(id, vec ARRAY<numeric>)`` with ids of any type. Sparse inputs (set
    ``sparse_dim``): ``(id, idx ARRAY<INT>, val ARRAY<DOUBLE>)``.
    Output ``(id, neighbor_id, score, rank)``; ties broken by ``neighbor_id``.

    Block counts come from scalar subqueries over the inputs (lazy, no driver
    round trip). Each side is replicated once per block of the other side and
    every group holds at most ``block_rows`` rows of each side.

    ``within``: a column present on both sides (namespace, category); only
    pairs with equal values are scored (groups are (value, probe block, build
    block)), so the work is the sum of the squared partition sizes instead of
    N squared, and a partition holding a third of the rows still splits into
    bounded groups.
    """
    vec_cols = ["vec"] if sparse_dim is None else ["idx", "val"]
    # memory bound: <= block_rows rows per block; parallelism: the build side is
    # cut into at least as many blocks as the cluster has cores (blocks of >= 256
    # rows), so a single query or a small probe table still uses every core
    cores = probe.sparkSession.sparkContext.defaultParallelism
    n = F.count(F.lit(1))
    nb_probe = probe.agg(F.greatest(F.lit(1), F.ceil(n / block_rows)).cast("int")).scalar()
    nb_build = build.agg(F.greatest(F.lit(1), F.ceil(n / block_rows),
                                    F.least(F.lit(cores), F.ceil(n / 256))).cast("int")).scalar()
    part = [within] if within else []
    p = (probe.select("id", *vec_cols, *part)
         .withColumn("pb", F.pmod(F.xxhash64("id"), nb_probe).cast("int"))
         .withColumn("bb", F.explode(F.sequence(F.lit(0), nb_build - 1))))
    # the build side gets its own column names: a self-cogroup (probe is build)
    # must not resolve both sides to the same attributes
    b = (build.select(F.col("id").alias("b_id"), *[F.col(c).alias("b_" + c) for c in vec_cols], *part)
         .withColumn("bb", F.pmod(F.xxhash64("b_id"), nb_build).cast("int"))
         .withColumn("pb", F.explode(F.sequence(F.lit(0), nb_probe - 1)))
         .select("b_id", *["b_" + c for c in vec_cols], "pb", "bb", *part))
    fn = _block_topk_fn(k, threshold, exclude_self, sparse_dim)
    p = p.select("id", *vec_cols, "pb", "bb", *part)
    pairs = p.groupBy(*part, "pb", "bb").cogroup(b.groupBy(*part, "pb", "bb")).applyInPandas(fn, _pair_schema(probe, build))
    w = Window.partitionBy("id").orderBy(F.round("score", 9).desc(), F.asc("neighbor_id"))
    return pairs.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def knn_all(vectors: DataFrame, k: int = C.MAX_RESULTS, threshold: float | None = C.SIMILARITY_THRESHOLD,
            block_rows: int | None = None, within: str | None = None) -> DataFrame:
    """For every vector, its top ``k`` most similar other vectors (exact);
    with ``within``, only among vectors with the same value of that column.
    Without it, cells of near vectors keep pairs apart that cannot matter (``cells``)."""
    if within is None:
        from .cells import knn_all_pruned
        return knn_all_pruned(vectors, k, threshold, block_rows)
    v = vectors.select("id", F.col("embedding").alias("vec"), within)
    return blocked_topk(v, v, k=k, threshold=threshold, exclude_self=True, block_rows=block_rows or 4096, within=within)


def attach_embeddings(texts: DataFrame, embedded: DataFrame) -> DataFrame:
    """Pair each text with its vector by id (never by position)."""
    return texts.join(embedded, "id")


def collection_stats(vectors: DataFrame, namespace_col: str | None = None) -> DataFrame:
    """Vectors per namespace with the index name (one grouped aggregate)."""
    ns = F.col(namespace_col) if namespace_col else F.lit(C.NAMESPACE)
    return (vectors.groupBy(ns.alias("namespace")).agg(F.count(F.lit(1)).alias("total_articles"))
            .withColumn("index_name", F.lit(C.INDEX_NAME)))
