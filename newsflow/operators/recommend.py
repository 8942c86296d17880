"""Re-ranking, recommendations and trending topics.

The reference re-ranks with a remote model. The default here is a
deterministic lexical re-ranker (a stand-in, not the model):
``rerank_score = sum over distinct query tokens found in the document of
ln((1 + N) / (1 + df)) + 1`` where N is the number of candidates of that query
and df the number of those candidates containing the token. Ties keep the
vector order. A real model plugs in as ``rerank_fn`` (Arrow-batched).

Every group here (candidates of one query) is bounded by the candidate count
(2 x max results, or the 50-match trending sample), so per-group windows are
safe even when one query dominates.
"""

from __future__ import annotations

from typing import Callable

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from .. import config as C
from ..functions import text as T
from ..functions.udf import series2_udf
from .textindex import TextIndex
from .vectors import match_projection, similar_by_id


def doc_text(title="title", summary="summary"):
    """The document text handed to the re-ranker: ``title + ' ' + summary``."""
    return F.concat(F.coalesce(F.col(title), F.lit("")), F.lit(" "), F.coalesce(F.col(summary), F.lit("")))


def rerank(cands: DataFrame, query_col: str = "query_text", doc_col: str = "doc_text", group: str = "query_id",
           rerank_fn: Callable[[pd.Series, pd.Series], pd.Series] | None = None) -> DataFrame:
    """Add ``rerank_score`` to candidates. ``cands`` has ``group``, ``id``,
    ``rank`` (vector order) and the two text columns; output has a new
    ``rerank_pos`` (1 = best) ordered by (rerank_score desc, rank asc)."""
    if rerank_fn is not None:
        udf = series2_udf(rerank_fn, Ty.DoubleType())
        scored = cands.withColumn("rerank_score", udf(F.col(query_col), F.col(doc_col)))
    else:
        # one pass over the candidates (they are used once: no recomputation of
        # the search that produced them); all windows share the partitioning
        # by ``group`` and every group is bounded by the candidate count
        cols = [c for c in cands.columns]
        wg = Window.partitionBy(group)
        c = (cands.withColumn("_n", F.count(F.lit(1)).over(wg))
             .withColumn("_tok", F.explode_outer(F.array_intersect(F.array_distinct(T.tokens(query_col)),
                                                                   F.array_distinct(T.tokens(doc_col))))))
        c = c.withColumn("_df", F.count("_tok").over(Window.partitionBy(group, "_tok")))
        contrib = F.when(F.col("_tok").isNotNull(), F.log((F.col("_n") + 1) / (F.col("_df") + 1)) + 1).otherwise(0.0)
        scored = (c.groupBy(group, "id")
                  .agg(*[F.first(x).alias(x) for x in cols if x not in (group, "id")],
                       F.round(F.sum(contrib), 9).alias("rerank_score"))
                  .select(*cols, "rerank_score"))
    # a NULL score (failed model call) keeps the vector order
    w = Window.partitionBy(group).orderBy(F.desc_nulls_last("rerank_score"), F.asc("rank"))
    return scored.withColumn("rerank_pos", F.row_number().over(w))


def similar_articles(vectors: DataFrame, source_id, max_results: int = C.MAX_RESULTS,
                     threshold: float = C.SIMILARITY_THRESHOLD, rerank_fn=None,
                     attach: Callable[[DataFrame], DataFrame] | None = None, source: DataFrame | None = None) -> DataFrame:
    """Similar articles of one vector: 2 x max candidates by cosine; re-ranked
    only when there are more candidates than ``max_results`` (query = source
    title + ' ' + source summary); cut to ``max_results``.

    The re-rank condition is data-dependent and evaluated in the plan (a
    window count over the bounded candidate set), not on the driver.
    ``attach`` adds title/summary/... to rows keyed by ``id`` (default: join
    the metadata columns of ``vectors``); it runs on the candidates only.
    ``source`` is the stored record of ``source_id`` (vector, title, summary),
    where it can be had without a scan.
    """
    if max_results < 1:
        raise ValueError("max_results must be >= 1")
    narrow = [c for c in ("id", "embedding", "category") if c in vectors.columns]
    attach = attach or (lambda d: vectors.drop("embedding", *[c for c in d.columns if c != "id"]).join(F.broadcast(d), "id"))
    cands = attach(similar_by_id(vectors.select(*narrow), source_id, n=2 * max_results, threshold=threshold, source=source))
    own = attach(vectors.filter(F.col("id") == F.lit(source_id)).select("id")) if source is None else source
    src = own.select(F.concat(F.col("title"), F.lit(" "), F.col("summary")).alias("query_text"))
    cands = (cands.withColumn("query_id", F.lit(source_id))
             .withColumn("query_text", src.scalar())
             .withColumn("doc_text", doc_text())
             .withColumn("_cnt", F.count(F.lit(1)).over(Window.partitionBy("query_id"))))
    rr = rerank(cands, rerank_fn=rerank_fn)
    out = (rr.withColumn("rerank_score", F.when(F.col("_cnt") > max_results, F.col("rerank_score")))
           .withColumn("final_pos", F.when(F.col("_cnt") > max_results, F.col("rerank_pos")).otherwise(F.col("rank")))
           .filter(F.col("final_pos") <= max_results))
    return out.drop("_cnt", "query_text", "doc_text", "rerank_pos")


def recommend_query(matches: DataFrame, queries: DataFrame, max_results: int = C.MAX_RESULTS,
                    rerank_fn=None) -> DataFrame:
    """Text recommendations: ``matches`` are the 2 x max search candidates per
    query (``query_id``, ``id``, ``rank``, title, summary, ...); re-ranked when a
    query has more than one candidate; cut to ``max_results``."""
    cands = (matches.join(queries.select(F.col("id").alias("query_id"), F.col("text").alias("query_text")),
                          "query_id")
             .withColumn("doc_text", doc_text())
             .withColumn("_cnt", F.count(F.lit(1)).over(Window.partitionBy("query_id"))))
    rr = rerank(cands, rerank_fn=rerank_fn)
    out = (rr.withColumn("rerank_score", F.when(F.col("_cnt") > 1, F.col("rerank_score")))
           .withColumn("final_pos", F.when(F.col("_cnt") > 1, F.col("rerank_pos")).otherwise(F.col("rank")))
           .filter(F.col("final_pos") <= max_results))
    return out.drop("_cnt", "query_text", "doc_text", "rerank_pos")


def category_counts(matches: DataFrame, group: str = "query_id") -> DataFrame:
    """Matches per category (missing -> 'general'), with the first rank seen."""
    return (matches.withColumn("category", F.coalesce(F.col("category"), F.lit(C.DEFAULT_CATEGORY)))
            .groupBy(group, "category")
            .agg(F.count(F.lit(1)).alias("article_count"), F.min("rank").alias("first_seen")))


def keyword_counts(matches: DataFrame, group: str = "query_id") -> DataFrame:
    """Title words longer than 4 characters, lower-cased, punctuation kept;
    every occurrence counts. ``first_seen`` = (rank, position in title)."""
    words = matches.select(group, "rank", F.posexplode(T.words("lower(title)")).alias("wpos", "word"))
    return (words.filter(F.length("word") > 4)
            .groupBy(group, "word")
            .agg(F.count(F.lit(1)).alias("mention_count"), F.min(F.struct("rank", "wpos")).alias("first_seen")))


def trending_topics(matches: DataFrame, limit: int = 10, group: str = "query_id") -> DataFrame:
    """``limit // 2`` top categories then ``limit // 2`` top keywords of the
    matches of each query; ties in first-seen order. ``matches`` must already be
    the top-50 sample (``rank`` 1..50).

    One pass over the matches: every match yields one category term and its
    title keywords, then one grouped count and one ranking window per (query,
    kind). Groups are bounded by the sample size.
    """
    half = limit // 2
    kw = F.filter(F.transform(T.words("lower(title)"), lambda w, i: F.struct(
        F.lit(1).alias("kind"), w.alias("term"), i.alias("wpos"))), lambda x: F.length(x["term"]) > 4)
    cat = F.array(F.struct(F.lit(0).alias("kind"),
                           F.coalesce(F.col("category"), F.lit(C.DEFAULT_CATEGORY)).alias("term"),
                           F.lit(0).alias("wpos")))
    terms = matches.select(group, "rank", F.explode(F.concat(cat, kw)).alias("t")).select(
        group, "rank", "t.kind", "t.term", "t.wpos")
    counts = (terms.groupBy(group, "kind", "term")
              .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("rank", "wpos")).alias("first_seen")))
    w = Window.partitionBy(group, "kind").orderBy(F.desc("n"), F.asc("first_seen"))
    top = counts.withColumn("pos", F.row_number().over(w)).filter(F.col("pos") <= half)
    is_cat = F.col("kind") == 0
    n = F.col("n").cast("string")
    out = top.select(
        group,
        (F.col("pos") + F.col("kind") * half).alias("pos"),
        T.title_case("term").alias("topic"),
        F.when(is_cat, F.concat(F.lit("Popular category with "), n, F.lit(" recent articles")))
         .otherwise(F.concat(F.lit("Frequently mentioned keyword in "), n, F.lit(" articles"))).alias("description"),
        F.when(is_cat, F.concat(F.lit("High activity in "), F.col("term"), F.lit(" news")))
         .otherwise(F.lit("High frequency in recent headlines")).alias("reason"),
        F.when(is_cat, F.col("n")).cast("bigint").alias("article_count"),
        F.when(~is_cat, F.col("n")).cast("bigint").alias("mention_count"))
    # categories first; fewer categories leave a gap that the renumbering closes
    wp = Window.partitionBy(group).orderBy("pos")
    return out.withColumn("topic_pos", F.row_number().over(wp)).drop("pos")


def trending_now(index: TextIndex, seed: str = C.TRENDING_QUERY, sample: int = C.TRENDING_SAMPLE, limit: int = 10,
                 threshold: float = C.SIMILARITY_THRESHOLD) -> DataFrame:
    """Trending topics of a stored text index: the topics among the ``sample`` best
    matches of the fixed ``seed`` text. No match, no topics."""
    query = index.spark.createDataFrame([(0, seed)], "id bigint, text string")
    hits = index.search(query, sample, threshold)
    return trending_topics(match_projection(index.with_meta(hits)), limit).drop("query_id")
