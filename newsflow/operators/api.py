"""Response projections: the API article shape, the recommend endpoint, the
latest-snapshot preview and the browser card fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import text as T
from .recommend import similar_articles
from .vectors import match_projection

API_COLUMNS = ["id", "title", "content", "date", "url", "source", "categories", "tags", "summary", "author",
               "slug", "similarity_score"]

def _empty():
    return F.array().cast("array<string>")


def _opt(df: DataFrame, name: str, dtype: str = "string"):
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)


def recommend_projection(matches: DataFrame) -> DataFrame:
    """MATCH -> API_ARTICLE: content = preview, date = published, url = link,
    source = source name, categories = [category], author/slug empty."""
    return matches.select(
        "id", "title",
        F.col("content_preview").alias("content"),
        F.col("published").alias("date"),
        F.col("link").alias("url"),
        F.col("source_name").alias("source"),
        F.array(F.coalesce(F.col("category"), F.lit(C.DEFAULT_CATEGORY))).alias("categories"),
        F.coalesce(F.col("tags"), _empty()).alias("tags"),
        F.coalesce(F.col("summary"), F.lit("")).alias("summary"),
        F.lit("").alias("author"), F.lit("").alias("slug"),
        F.coalesce(F.col("similarity_score"), F.lit(0.0)).alias("similarity_score"),
        *[c for c in ("final_pos", "rank", "query_id") if c in matches.columns],
    )


def recommend_endpoint(vectors: DataFrame, article_id, max_results: int = C.MAX_RESULTS, attach=None,
                       source: DataFrame | None = None) -> DataFrame:
    """``/recommend-news``: similar articles of one id projected for the API,
    with ``total_results``. Unknown id -> empty (the caller maps it to 404)."""
    sim = similar_articles(vectors, article_id, max_results, attach=attach, source=source)
    out = recommend_projection(match_projection(sim))
    return out.withColumn("total_results", F.count(F.lit(1)).over(Window.partitionBy(F.lit(article_id))))


def api_projection(articles: DataFrame) -> DataFrame:
    """Any article row -> API_ARTICLE with the fallbacks of the response
    formatter: date/published, url/link, source_feed/source_url, categories or
    [category] or [], and the API id (last feed path segment + md5)."""
    title = F.coalesce(_opt(articles, "title"), F.lit(""))
    url = F.coalesce(_opt(articles, "url"), _opt(articles, "link"), F.lit(""))
    source = F.coalesce(_opt(articles, "source_feed"), _opt(articles, "source_url"))
    cat = _opt(articles, "category")
    cats = F.coalesce(_opt(articles, "categories", "array<string>"),
                      F.when(F.coalesce(cat, F.lit("")) != "", F.array(cat)).otherwise(_empty()))
    base = articles.withColumn("_t", title).withColumn("_u", url).withColumn("_s", source)
    return base.select(
        *[c for c in ("page_id", "pos") if c in articles.columns],
        T.api_id("_t", "_u", "_s").alias("id"),
        F.col("_t").alias("title"),
        F.coalesce(_opt(articles, "content"), F.lit("")).alias("content"),
        F.coalesce(_opt(articles, "date"), _opt(articles, "published"), F.lit("")).alias("date"),
        F.col("_u").alias("url"),
        F.coalesce(F.col("_s"), F.lit("")).alias("source"),
        cats.alias("categories"),
        F.coalesce(_opt(articles, "tags", "array<string>"), _empty()).alias("tags"),
        F.coalesce(_opt(articles, "ai_summary"), _opt(articles, "summary"), F.lit("")).alias("summary"),
        F.coalesce(_opt(articles, "author"), F.lit("")).alias("author"),
        F.coalesce(_opt(articles, "slug"), F.lit("")).alias("slug"),
    )


def card_view(api: DataFrame) -> DataFrame:
    """Fields the page shows per card: title, link, source label, date label,
    summary (default text when empty) and the first 3 tags."""
    return api.select(
        *[c for c in ("page_id", "id") if c in api.columns],
        "title", "url",
        T.display_source(F.col("source")).alias("source_label"),
        T.display_date(F.col("date")).alias("date_label"),
        F.coalesce(T.nullif_empty(F.col("summary")), F.lit(C.NO_SUMMARY_TEXT)).alias("summary_text"),
        F.slice(F.coalesce(F.col("tags"), _empty()), 1, 3).alias("card_tags"),
    )


def preview(articles: DataFrame, pos_col: str = "pos", n: int = C.PREVIEW_ROWS) -> DataFrame:
    """First ``n`` rows in stored order, plus the total row count (a scalar
    subquery: one aggregate job, no driver round trip)."""
    total = articles.agg(F.count(F.lit(1)).alias("t")).scalar()
    return articles.orderBy(pos_col).limit(n).withColumn("total_articles", total)
