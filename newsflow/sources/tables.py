"""The driver tables and the article views derived from them.

There is no news data in the test tables, so the news records are *derived*
from them, as Spark plans over the whole table (nothing is sampled):

* ``page_entries``  -- one RSS-like entry per row of ``pages`` (RSS_ENTRY shape),
  feed = ``scheme://host/<first path segment>/``.
* ``raw_articles``  -- ``parse_entry`` over the entries (RAW_ARTICLE).
* ``processed_articles`` -- ``process_article`` over the raw articles.
* ``vector_records`` -- ``embeddings`` + article metadata (VECTOR + MATCH fields).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


SPREAD_ROWS, LEAST_ROWS = 2048, 256       # whole texts of a task, and of one of the few tasks of a small table


def spread(df: DataFrame, *by: str) -> DataFrame:
    """The rows dealt by ``by`` to tasks of about ``SPREAD_ROWS``: work on whole texts that follows no longer depends on how
    the table was written (a file may be one row group, which is one task however large it is)."""
    rows = df.count()
    few = min(df.sparkSession.sparkContext.defaultParallelism, -(-rows // LEAST_ROWS))
    return df.repartition(max(1, few, -(-rows // SPREAD_ROWS)), *by)


FEED_RE = r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/)([^/?#]*)"


def page_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RSS_ENTRY rows derived from every row of ``pages``."""
    return entries_from_pages(read_table(spark, sf_dir, "pages"))


def entries_from_pages(p: DataFrame, keep=()) -> DataFrame:
    """RSS_ENTRY rows from ``(page_id, url, html)`` rows (plus ``keep`` columns).

    title <- <title>; link <- url; summary <- first <p>; description <- the ad
    block; content <- [<article>] (empty list when absent); summary_detail <-
    footer; tags <- nav links (term = href path, label = anchor text);
    author <- meta author (absent in the data, so the author_detail fallback
    = host is exercised); published <- RFC-822 text of 2024-01-01 + page_id h.
    """
    from ..functions import sql as S
    link_re = S.lit(r'<a href="/([^"]*)">([^<]*)</a>')
    article = f"regexp_extract(html, {S.lit(r'(?is)<article[^>]*>(.*?)</article>')}, 1)"
    category = f"regexp_extract(url, {S.lit(FEED_RE)}, 2)"
    exprs = [S.ident(c) for c in keep if c != "page_id"] + [
        "page_id",
        f"concat(regexp_extract(url, {S.lit(FEED_RE)}, 1), {category}, '/') AS feed_url",
        f"{category} AS feed_category",
        "page_id AS entry_pos",
        f"{S.html_title('html')} AS title",
        "url AS link",
        f"regexp_extract(html, {S.lit(r'(?is)<p(?:\s[^>]*)?>(.*?)</p>')}, 1) AS summary",
        f"regexp_extract(html, {S.lit(r'(?is)<div class="ad">(.*?)</div>')}, 1) AS description",
        f"CASE WHEN {article} = '' THEN CAST(array() AS ARRAY<STRUCT<value: STRING>>) "
        f"ELSE array(named_struct('value', {article})) END AS content",
        f"named_struct('value', regexp_extract(html, {S.lit(r'(?is)<footer[^>]*>(.*?)</footer>')}, 1)) "
        "AS summary_detail",
        f"transform(regexp_extract_all(html, {link_re}, 1), (t, i) -> named_struct('term', t, 'label', "
        f"get(regexp_extract_all(html, {link_re}, 2), i))) AS tags",
        f"array({category}) AS category",
        f"regexp_extract(html, {S.lit('<meta name="author" content="([^"]*)"')}, 1) AS author",
        f"named_struct('name', lower({S.url_authority('url')})) AS author_detail",
        f"{S.rfc822("timestampadd(HOUR, page_id, TIMESTAMP '2024-01-01 00:00:00')")} AS published",
    ]
    return p.selectExpr(*exprs)


def raw_articles(spark: SparkSession, sf_dir: str, run_ts: str = C.DEFAULT_RUN_TS) -> DataFrame:
    from ..operators.ingest import parse_entry
    return parse_entry(page_entries(spark, sf_dir), run_ts=run_ts)


def processed_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.ingest import process_article
    return process_article(raw_articles(spark, sf_dir))


def vector_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vector index as searched: ``(id, embedding, category)``."""
    return read_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), "embedding", F.col("label").cast("string").alias("category"))


META_COLUMNS = ("title", "link", "summary", "published", "source_name", "tags", "ai_enhanced", "content_preview")


def attach_vector_meta(spark: SparkSession, sf_dir: str, rows: DataFrame, caps: bool = False) -> DataFrame:
    """Add the vector metadata to rows keyed by ``id`` (a vector id).

    The raw page is joined to the rows first and the metadata (HTML parsing,
    cleaning, embedding text) is computed only for the joined rows, so
    attaching metadata to a top-k result parses k pages, not the whole table.
    Rows without a page get the empty metadata of the reference's defaults.
    """
    from ..operators.ingest import parse_entry
    from ..operators.vectors import vector_metadata
    pages = read_table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), "url", "html")
    # the big side (pages) is streamed and the small key set is the build side;
    # only matched pages are parsed
    matched = pages.join(rows.select("id").distinct(), "id")
    e = entries_from_pages(matched.withColumn("page_id", F.col("id")))
    meta = vector_metadata(parse_entry(e, keep=("page_id",)), keep=("page_id",), caps=caps).withColumnRenamed("page_id", "id")
    j = rows.join(meta.select("id", *[F.col(c).alias("_m_" + c) for c in META_COLUMNS if c != "ai_enhanced"]),
                  "id", "left")
    has = F.col("_m_title").isNotNull()
    empty = F.array().cast("array<string>")
    return j.select(
        *rows.columns,
        *[F.when(has, F.col("_m_" + c)).otherwise(F.lit("")).alias(c)
          for c in ("title", "link", "summary", "published", "source_name")],
        F.when(has, F.col("_m_tags")).otherwise(empty).alias("tags"),
        F.lit(False).alias("ai_enhanced"),
        F.when(has, F.col("_m_content_preview")).otherwise(F.lit("")).alias("content_preview"),
    )


def vector_records(spark: SparkSession, sf_dir: str, caps: bool = False) -> DataFrame:
    """Every vector of the index with its metadata (VECTOR + MATCH fields).

    ``category`` = the vector's label; title/link/summary/... come from the
    article with ``page_id = vec_id`` (left join: vectors without an article keep
    empty metadata). ``content_preview`` = first 500 chars of the embedding text.
    """
    return attach_vector_meta(spark, sf_dir, vector_index(spark, sf_dir), caps)


def _doc_title_sql() -> str:
    from ..functions import sql as S
    return S.strip(f"regexp_extract(text, {S.lit('^([^' + chr(10) + ']*)')}, 1)")


DOC_TITLE_SQL = _doc_title_sql()


def doc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text index over ``documents``: ``(id, category, embed_text)``, with
    title = first line (stripped) inside the embedding text."""
    from ..functions import sql as S
    d = read_table(spark, sf_dir, "documents")
    return d.selectExpr("doc_id AS id", "lang AS category",
                        f"{S.embedding_text(DOC_TITLE_SQL, chr(39) * 2, 'text', None)} AS embed_text")


def attach_doc_meta(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """MATCH metadata for rows keyed by ``id`` (a document id): title = first
    line, summary = the default summary (lead 175 words), category = lang,
    source_name = source; computed after the join, for the joined rows only."""
    d = read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", "lang", "source")
    j = d.join(rows.drop("category"), "id")          # documents streamed, the hits are the build side
    from ..functions import sql as S
    return j.selectExpr(
        *[S.ident(c) for c in rows.columns if c != "category"],
        f"{DOC_TITLE_SQL} AS title", "'' AS link", f"{S.lead_words('text')} AS summary",
        "'' AS published", "source AS source_name", "lang AS category", "CAST(array() AS ARRAY<STRING>) AS tags",
        f"substring({S.embedding_text(DOC_TITLE_SQL, chr(39) * 2, 'text')}, 1, {C.PREVIEW_CHARS}) AS content_preview")


def queries_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query texts: every row of ``benchmark`` as ``(id, text)``."""
    return read_table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text")
