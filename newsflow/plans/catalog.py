"""Registered queries: one per operator of the inventory, each with a DuckDB
oracle where the semantics are SQL-expressible.

Every query reads the driver tables (or data Spark derives from them) in
full. Output columns are aliased identically on both sides; arrays are joined
with ``|`` and scores rounded to 6 places (ordering always uses the unrounded
score) so both engines hash the same values.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import entry as E
from ..functions import text as T
from ..functions import vector as V
from ..operators import embed as EM
from ..operators import ingest as IN
from ..operators import recommend as RC
from ..operators import vectors as VE
from ..sources import stored as SD
from ..sources import tables as TB
from . import sqlgen as S


@dataclass
class Query:
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    note: str = ""


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, note: str = ""):
    def deco(fn):
        REGISTRY[name] = Query(fn, sql.strip() if sql else None, note)
        return fn
    return deco


def J(c) -> F.Column:
    return F.array_join(F.col(c) if isinstance(c, str) else c, "|")


def R(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


SEED_ID = 7            # the source vector of the single-source queries
SEED_CATEGORY = "3"    # a label of ``embeddings``
TEXT_CATEGORY = "en"   # a lang of ``documents``
FEED_CATEGORY = "en"   # a category of the derived feed registry
PREV_RUN_CUTOFF = "2024-01-03T00:00:00"   # entries published before it were fetched by the previous run

# ======================================================================================
# 2.3 projections and scalar functions (over every row of pages / documents / embeddings)
# ======================================================================================

A_SQL = "WITH " + S.articles_cte()
P_SQL = "WITH " + S.processed_cte()
V_SQL = "WITH " + S.vectors_cte(caps=True)       # the stored metadata is capped


@register("parse_entry", A_SQL + """
SELECT page_id, id, title, url, summary, content, date, author, slug,
  array_to_string(categories, '|') AS categories, array_to_string(tags, '|') AS tags,
  source_feed, source_name, category, fetched_at FROM articles""")
def q_parse_entry(spark, sf):
    a = TB.raw_articles(spark, sf)
    return a.select("page_id", "id", "title", "url", "summary", "content", "date", "author", "slug",
                    J("categories").alias("categories"), J("tags").alias("tags"), "source_feed",
                    "source_name", "category", "fetched_at")


@register("content_coalesce", "WITH " + S.entries_cte() + """
SELECT page_id, (CASE WHEN article_html <> '' THEN article_html ELSE coalesce(nullif(description, ''),
  nullif(summary, ''), nullif(footer, ''), '') END) AS content FROM entries""")
def q_content_coalesce(spark, sf):
    e = TB.page_entries(spark, sf)
    return e.select("page_id", E.content_coalesce("content", F.col("description"), F.col("summary"),
                                                  F.col("summary_detail.value")).alias("content"))


@register("entry_categories", "WITH " + S.entries_cte() + """
SELECT page_id, array_to_string(CASE WHEN len(tag_terms) > 0 THEN tag_terms ELSE [feed_category] END, '|')
  AS categories FROM entries""")
def q_entry_categories(spark, sf):
    e = TB.page_entries(spark, sf)
    return e.select("page_id", J(E.entry_categories("tags", "category")).alias("categories"))


@register("entry_tags", A_SQL + "\nSELECT page_id, array_to_string(tags, '|') AS tags FROM articles")
def q_entry_tags(spark, sf):
    e = TB.page_entries(spark, sf)
    return e.select("page_id", J(E.entry_tags("tags", E.entry_categories("tags", "category"))).alias("tags"))


@register("entry_author", A_SQL + "\nSELECT page_id, author FROM articles")
def q_entry_author(spark, sf):
    e = TB.page_entries(spark, sf)
    return e.select("page_id", E.entry_author(F.col("author"), F.col("author_detail.name")).alias("author"))


@register("parse_published", "WITH " + S.entries_cte() + """, a AS (SELECT * FROM entries)
SELECT page_id, published, """ + S.iso_text("try_strptime(regexp_replace(published, '^[A-Za-z]{3},\\s*', ''), "
                                           "'%d %b %Y %H:%M:%S GMT')") + """ AS date FROM a""")
def q_parse_published(spark, sf):
    e = TB.page_entries(spark, sf)
    return e.select("page_id", "published", T.parse_published(F.col("published")).alias("date"))


@register("slug", A_SQL + "\nSELECT page_id, title, slug FROM articles")
def q_slug(spark, sf):
    return TB.raw_articles(spark, sf).select("page_id", "title", "slug")


@register("clean_html", f"SELECT page_id, {S.clean_html('html')} AS text FROM pages")
def q_clean_html(spark, sf):
    return TB.read_table(spark, sf, "pages").select("page_id", T.clean_html(F.col("html")).alias("text"))


@register("source_name", f"SELECT page_id, url, {S.source_name('url')} AS source_name FROM pages")
def q_source_name(spark, sf):
    return TB.read_table(spark, sf, "pages").select("page_id", "url", T.source_name(F.col("url")).alias("source_name"))


@register("article_id", A_SQL + "\nSELECT page_id, id FROM articles")
def q_article_id(spark, sf):
    return TB.raw_articles(spark, sf).select("page_id", "id")


@register("dedup_key", A_SQL + f"\nSELECT page_id, {S.md5_of('title', 'url')} AS dedup_key FROM articles")
def q_dedup_key(spark, sf):
    return TB.raw_articles(spark, sf).select("page_id", T.dedup_key(F.col("title"), F.col("url")).alias("dedup_key"))


@register("processor_id", A_SQL + f"""
SELECT page_id, {S.processor_id('title', 'url', 'source_feed')} AS id_feed,
  {S.processor_id('title', 'url', "source_name")} AS id_name,
  {S.processor_id('title', 'url', "NULL")} AS id_missing FROM articles""")
def q_processor_id(spark, sf):
    a = TB.raw_articles(spark, sf)
    return a.select("page_id", T.processor_id(F.col("title"), F.col("url"), F.col("source_feed")).alias("id_feed"),
                    T.processor_id(F.col("title"), F.col("url"), F.col("source_name")).alias("id_name"),
                    T.processor_id("title", "url", "CAST(NULL AS STRING)").alias("id_missing"))


@register("api_id", A_SQL + f"""
SELECT page_id, {S.api_id('title', 'url', 'source_feed')} AS id_feed,
  {S.api_id('title', 'url', 'url')} AS id_page FROM articles""")
def q_api_id(spark, sf):
    a = TB.raw_articles(spark, sf)
    return a.select("page_id", T.api_id(F.col("title"), F.col("url"), F.col("source_feed")).alias("id_feed"),
                    T.api_id(F.col("title"), F.col("url"), F.col("url")).alias("id_page"))


@register("clean_content", f"SELECT page_id, {S.clean_content('html')} AS content FROM pages")
def q_clean_content(spark, sf):
    return TB.read_table(spark, sf, "pages").select("page_id", T.clean_content(F.col("html")).alias("content"))


@register("process_article", P_SQL + """
SELECT page_id, id, title, content, url, date, author, slug, array_to_string(categories, '|') AS categories,
  array_to_string(tags, '|') AS tags, source_feed FROM processed""")
def q_process_article(spark, sf):
    p = TB.processed_articles(spark, sf)
    return p.select("page_id", "id", "title", "content", "url", "date", "author", "slug",
                    J("categories").alias("categories"), J("tags").alias("tags"), "source_feed")


@register("embedding_text", A_SQL + f"""
SELECT page_id, {S.embedding_text('title', 'summary', 'content')} AS text FROM articles""")
def q_embedding_text(spark, sf):
    a = TB.raw_articles(spark, sf)
    return a.select("page_id", T.embedding_text(F.col("title"), F.col("summary"), F.col("content")).alias("text"))


@register("vector_metadata", "WITH " + S.vectors_cte(caps=True) + """
SELECT id, title, link, summary, published, source_name, category, array_to_string(tags, '|') AS tags,
  content_preview FROM vectors""")
def q_vector_metadata(spark, sf):
    v = TB.vector_records(spark, sf, caps=True)
    return v.select("id", "title", "link", "summary", "published", "source_name", "category",
                    J("tags").alias("tags"), "content_preview")


@register("display_date", P_SQL + f"""
SELECT page_id, {S.display_date('date')} AS date_label, {S.display_date("''")} AS empty_label,
  {S.display_date('slug')} AS bad_label FROM processed""")
def q_display_date(spark, sf):
    p = TB.processed_articles(spark, sf)
    return p.select("page_id", T.display_date(F.col("date")).alias("date_label"),
                    T.display_date("''").alias("empty_label"),
                    T.display_date(F.col("slug")).alias("bad_label"))


@register("display_source", A_SQL + f"""
SELECT page_id, {S.display_source('source_feed')} AS from_url, {S.display_source('source_name')} AS from_name,
  {S.display_source(S.api_source('source_feed'))} AS from_segment,
  {S.display_source("substr(url, strpos(url, '://') + 3)")} AS from_path FROM articles""")
def q_display_source(spark, sf):
    a = TB.raw_articles(spark, sf)
    no_scheme = "substring(url, instr(url, '://') + 3)"
    return a.select("page_id", T.display_source(F.col("source_feed")).alias("from_url"),
                    T.display_source(F.col("source_name")).alias("from_name"),
                    T.display_source(T.api_source(F.col("source_feed"))).alias("from_segment"),
                    T.display_source(no_scheme).alias("from_path"))


@register("title_case", f"""
SELECT page_id, {S.title_case("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")} AS topic FROM pages""")
def q_title_case(spark, sf):
    p = TB.read_table(spark, sf, "pages")
    return p.select("page_id", T.title_case(T.html_title(F.col("html"))).alias("topic"))


@register("word_count", f"SELECT doc_id, {S.word_count('text')} AS words FROM documents")
def q_word_count(spark, sf):
    return TB.read_table(spark, sf, "documents").select("doc_id", T.word_count(F.col("text")).alias("words"))


@register("truncate_ellipsis", f"""
SELECT doc_id, {S.truncate_ellipsis('text', C.BATCH_CONTENT_CHARS)} AS t_batch,
  {S.truncate_ellipsis('text', C.SINGLE_CONTENT_CHARS)} AS t_single,
  {S.truncate_ellipsis('text', C.EMBED_TEXT_CHARS)} AS t_embed FROM documents""")
def q_truncate_ellipsis(spark, sf):
    d = TB.read_table(spark, sf, "documents")
    return d.select("doc_id", T.truncate_ellipsis(F.col("text"), C.BATCH_CONTENT_CHARS).alias("t_batch"),
                    T.truncate_ellipsis(F.col("text"), C.SINGLE_CONTENT_CHARS).alias("t_single"),
                    T.truncate_ellipsis(F.col("text"), C.EMBED_TEXT_CHARS).alias("t_embed"))


@register("cosine_similarity", """
SELECT a.vec_id, b.vec_id AS next_id,
  round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS score
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def q_cosine(spark, sf):
    e = TB.read_table(spark, sf, "embeddings")
    b = e.select(F.col("vec_id").alias("next_id"), F.col("embedding").alias("next_emb"))
    return (e.join(b, F.col("next_id") == F.col("vec_id") + 1)
            .select("vec_id", "next_id", R(V.cosine_similarity(F.col("embedding"), F.col("next_emb"))).alias("score")))


@register("ingest_time", A_SQL + f"""
SELECT page_id, fetched_at, {S.q(C.DEFAULT_RUN_TS)} AS added_to_db FROM articles""")
def q_ingest_time(spark, sf):
    a = TB.raw_articles(spark, sf)
    return a.select("page_id", "fetched_at", F.lit(C.DEFAULT_RUN_TS).alias("added_to_db"))


@register("strip", f"""
SELECT conv_id, turn, {S.strip('text')} AS text FROM conversations""")
def q_strip(spark, sf):
    c = TB.read_table(spark, sf, "conversations")
    return c.select("conv_id", "turn", T.strip(F.col("text")).alias("text"))


# ======================================================================================
# 2.1 / 2.5 / 2.6 ingest: feeds, caps, dedup, statistics
# ======================================================================================

E_SQL = "WITH " + S.entries_cte()


def _seen_prev(spark, sf):
    """``seen`` of the previous run: hashes of the articles published before it."""
    prev = TB.raw_articles(spark, sf).filter(F.col("date") < PREV_RUN_CUTOFF)
    return IN.seen_hashes(prev)


NEW_SQL = f""",
seen AS (SELECT DISTINCT {S.md5_of('title', 'url')} AS article_hash FROM articles
         WHERE date < {S.q(PREV_RUN_CUTOFF)}),
firsts AS (SELECT * FROM (SELECT *, {S.md5_of('title', 'url')} AS dedup_key,
    row_number() OVER (PARTITION BY {S.md5_of('title', 'url')} ORDER BY source_feed, entry_pos) AS r
    FROM articles) WHERE r = 1),
new AS (SELECT * FROM firsts WHERE dedup_key NOT IN (SELECT article_hash FROM seen))"""


@register("cap_per_feed", E_SQL + f"""
SELECT feed_url, page_id, rn AS feed_rank FROM (
  SELECT feed_url, page_id, row_number() OVER (PARTITION BY feed_url ORDER BY entry_pos) AS rn FROM entries)
WHERE rn <= {C.MAX_PER_FEED}""")
def q_cap_per_feed(spark, sf):
    e = TB.page_entries(spark, sf)
    from pyspark.sql import Window
    w = Window.partitionBy("feed_url").orderBy("entry_pos")
    return (IN.cap_per_feed(e).withColumn("feed_rank", F.row_number().over(w))
            .select("feed_url", "page_id", "feed_rank"))


@register("new_articles", A_SQL + NEW_SQL + """
SELECT dedup_key, id, page_id, source_feed, title, url FROM new""")
def q_new_articles(spark, sf):
    raw = TB.raw_articles(spark, sf)
    new = IN.new_articles(raw, _seen_prev(spark, sf), row_id=("page_id",))
    return new.select("dedup_key", "id", "page_id", "source_feed", "title", "url")


@register("seen_union", A_SQL + NEW_SQL + """
SELECT article_hash FROM seen UNION SELECT dedup_key FROM new""")
def q_seen_union(spark, sf):
    raw = TB.raw_articles(spark, sf)
    seen = _seen_prev(spark, sf)
    new = IN.new_articles(raw, seen, row_id=("page_id",))
    return IN.seen_union(seen, new.select(F.col("dedup_key").alias("article_hash")))


@register("fetch_stats", A_SQL + NEW_SQL + """
SELECT (CASE GROUPING(category, source_feed) WHEN 3 THEN 0 WHEN 1 THEN 1 ELSE 2 END)::BIGINT AS level,
  coalesce(category, '') AS category, coalesce(source_feed, '') AS source_feed, count(*) AS new_articles
FROM new GROUP BY ROLLUP (category, source_feed)""")
def q_fetch_stats(spark, sf):
    raw = TB.raw_articles(spark, sf)
    return IN.fetch_stats(IN.new_articles(raw, _seen_prev(spark, sf), row_id=("page_id",)))


BROKEN_ENDING = "n"            # in feed_health and drop_unparsed, items whose title ends so arrive broken
SILENT_FEED = "https://silent.example/none/"      # registered, but nothing has landed for it


@register("feed_health", E_SQL + f""",
e AS (SELECT *, right(coalesce(title, ''), 1) <> {S.q(BROKEN_ENDING)} AS ok FROM entries),
cnt AS (SELECT feed_url, count(*) FILTER (WHERE ok) AS entries,
    count(*) FILTER (WHERE ok AND coalesce(title, '') = '') AS missing_title,
    count(*) FILTER (WHERE ok AND coalesce(link, '') = '') AS missing_link,
    count(*) FILTER (WHERE ok AND coalesce(description, '') = '') AS missing_summary,
    count(*) FILTER (WHERE ok AND coalesce(published, '') = '') AS missing_date,
    count(*) FILTER (WHERE ok AND NOT (article_html <> '' OR coalesce(description, '') <> '')) AS missing_content,
    bool_or(NOT ok) AS malformed
  FROM e GROUP BY feed_url UNION ALL SELECT {S.q(SILENT_FEED)}, 0, 0, 0, 0, 0, 0, false),
smp AS (SELECT * FROM (SELECT feed_url, row_number() OVER (PARTITION BY feed_url ORDER BY entry_pos) AS sample_pos,
    coalesce(title, '') AS sample_title, coalesce(link, '') AS sample_link,
    left(coalesce(description, ''), 100) AS summary_preview,
    left(CASE WHEN article_html <> '' THEN article_html ELSE coalesce(nullif(description, ''), '') END, 100)
      AS content_preview
  FROM e WHERE ok) WHERE sample_pos <= 3)
SELECT cnt.*, coalesce(sample_pos, 0) AS sample_pos, coalesce(sample_title, '') AS sample_title, coalesce(sample_link, '') AS sample_link,
  coalesce(summary_preview, '') AS summary_preview, coalesce(content_preview, '') AS content_preview FROM cnt LEFT JOIN smp USING (feed_url)""")
def q_feed_health(spark, sf):
    """Landed documents with broken items, and a registered feed that is silent (its sample is empty)."""
    from ..sources import feeds as FD
    root = _land_feeds(spark, sf, broken=F.coalesce(F.col("title"), F.lit("")).endswith(BROKEN_ENDING))
    registry = _registry(spark, sf).select("feed_url").union(spark.createDataFrame([(SILENT_FEED,)], "feed_url string"))
    items = FD.scan_items(spark, root).withColumn("feed_category", F.lit(None).cast("string"))
    health = IN.feed_health(FD.rss_items_to_entries(items), registry=registry)
    return health.na.fill(0, ["sample_pos"]).na.fill("", ["sample_title", "sample_link", "summary_preview", "content_preview"])


def _registry(spark, sf):
    from ..sources import feeds as FD
    return FD.registry_from_entries(TB.page_entries(spark, sf))


@register("feed_registry", E_SQL + """
SELECT category, row_number() OVER (PARTITION BY category ORDER BY feed_url) - 1 AS feed_pos, feed_url
FROM (SELECT DISTINCT feed_category AS category, feed_url FROM entries)""")
def q_feed_registry(spark, sf):
    return _registry(spark, sf).select("category", "feed_pos", "feed_url")


@register("available_categories", E_SQL + "\nSELECT DISTINCT feed_category AS category FROM entries")
def q_available_categories(spark, sf):
    from ..sources import feeds as FD
    return FD.available_categories(_registry(spark, sf))


FETCH_ROW = ("category", "feed_pos", "page_id")      # an entry of a feed, as listed under a category


FETCH_SQL = f""",
reg AS (SELECT category, row_number() OVER (PARTITION BY category ORDER BY feed_url) - 1 AS feed_pos, feed_url
        FROM (SELECT DISTINCT feed_category AS category, feed_url FROM entries)),
fetched AS (SELECT a.*, reg.feed_pos FROM articles a JOIN reg ON reg.feed_url = a.source_feed),
seen AS (SELECT DISTINCT {S.md5_of('title', 'url')} AS article_hash FROM articles
         WHERE date < {S.q(PREV_RUN_CUTOFF)}),
firsts AS (SELECT * FROM (SELECT *, {S.md5_of('title', 'url')} AS dedup_key,
    row_number() OVER (PARTITION BY {S.md5_of('title', 'url')} ORDER BY category, feed_pos, entry_pos) AS r
    FROM fetched) WHERE r = 1),
new AS (SELECT * FROM firsts WHERE dedup_key NOT IN (SELECT article_hash FROM seen))"""


def _landed_entries(spark, sf, category=None):
    """The entries of landed feed documents, read for the feeds of the stored registry (of one category) only."""
    from ..session import scratch_path
    from ..sources import feeds as FD
    root, path = _land_feeds(spark, sf), scratch_path(spark, "registry")
    _registry(spark, sf).withColumnRenamed("category", "feed_category").write.parquet(path)
    registry = spark.read.parquet(path)
    if category is not None:
        registry = registry.filter(F.col("feed_category") == category)
    items = FD.scan_items(spark, root, _guid_schema(), registry=registry)
    return FD.rss_items_to_entries(IN.drop_unparsed(items).withColumnRenamed("guid", "page_id"))


@register("fetch_all_feeds", A_SQL + FETCH_SQL + """
SELECT dedup_key, id, page_id, category, feed_pos, source_feed, title FROM new""")
def q_fetch_all_feeds(spark, sf):
    from ..sources import feeds as FD
    new = FD.fetch_entries(_landed_entries(spark, sf), _seen_prev(spark, sf), row_id=FETCH_ROW)
    return new.select("dedup_key", "id", "page_id", "category", "feed_pos", "source_feed", "title")


@register("fetch_by_category", A_SQL + FETCH_SQL + f"""
SELECT dedup_key, id, page_id, category, feed_pos, source_feed, title FROM (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dedup_key ORDER BY feed_pos, entry_pos) AS r2
                 FROM (SELECT c.*, {S.md5_of('title', 'url')} AS dedup_key FROM fetched c
                       WHERE category = {S.q(FEED_CATEGORY)})) WHERE r2 = 1)
WHERE dedup_key NOT IN (SELECT article_hash FROM seen)""")
def q_fetch_by_category(spark, sf):
    from ..sources import feeds as FD
    new = FD.fetch_entries(_landed_entries(spark, sf, FEED_CATEGORY), _seen_prev(spark, sf), row_id=FETCH_ROW)
    return new.select("dedup_key", "id", "page_id", "category", "feed_pos", "source_feed", "title")


@register("union_feeds", A_SQL + f"""
SELECT page_id, id FROM articles WHERE category = {S.q(FEED_CATEGORY)}
UNION ALL SELECT page_id, id FROM articles WHERE category <> {S.q(FEED_CATEGORY)}""")
def q_union_feeds(spark, sf):
    a = TB.raw_articles(spark, sf).select("page_id", "id", "category")
    parts = [a.filter(F.col("category") == FEED_CATEGORY), a.filter(F.col("category") != FEED_CATEGORY)]
    return IN.union_all(parts).select("page_id", "id")


@register("keyword_length", A_SQL + """
SELECT page_id, wpos, word FROM (
  SELECT page_id, unnest(ws) AS word, unnest(range(len(ws))) AS wpos FROM (
    SELECT page_id, """ + S.words("lower(title)") + """ AS ws FROM articles))
WHERE length(word) > 4""")
def q_keyword_length(spark, sf):
    a = TB.raw_articles(spark, sf)
    w = a.select("page_id", F.posexplode(T.words("lower(title)")).alias("wpos", "word"))
    return w.filter(F.length("word") > 4)


# ======================================================================================
# 2.5 / 2.7 vector search and recommendations (embeddings = the vector index)
# ======================================================================================

def _vindex(spark, sf):
    """The stored vectors of the default namespace, with their metadata."""
    return SD.vector_table(spark, sf).read()


def _vmeta(spark, sf, rows):
    return SD.with_stored_meta(_vindex(spark, sf), rows)


def _source(spark, sf):
    return SD.vector_table(spark, sf).fetch(SEED_ID)


def _narrow(spark, sf):
    return _vindex(spark, sf).select("id", "embedding", "category")


def _match_cols(df):
    return df.select("id", "title", "link", "summary", "published", "source_name", "category",
                     J("tags").alias("tags"), R("similarity_score").alias("similarity_score"), "content_preview",
                     "rank")


def _vec_search_sql(n: int, threshold: float | None, exclude: bool, extra_where: str = "") -> str:
    thr = f"AND score >= {threshold}" if threshold is not None else ""
    exc = f"AND v.id <> {SEED_ID}" if exclude else ""
    return f""",
scored AS (
  SELECT v.*, list_cosine_similarity(v.embedding, src.embedding) AS score
  FROM vectors v, (SELECT embedding FROM vectors WHERE id = {SEED_ID}) src WHERE TRUE {exc} {extra_where}),
top AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY round(score, 9) DESC, id) AS rank
                       FROM scored WHERE score IS NOT NULL {thr}) WHERE rank <= {n})"""


MATCH_SELECT = """
SELECT id, title, link, summary, published, source_name, category, array_to_string(tags, '|') AS tags,
  round(score, 6) AS similarity_score, content_preview, rank FROM top"""


@register("similar_by_id", V_SQL + _vec_search_sql(C.MAX_RESULTS, C.SIMILARITY_THRESHOLD, True) + MATCH_SELECT)
def q_similar_by_id(spark, sf):
    top = VE.similar_by_id(_narrow(spark, sf), SEED_ID, source=_source(spark, sf))
    return _match_cols(VE.match_projection(_vmeta(spark, sf, top)))


@register("knn_single", V_SQL + _vec_search_sql(C.MAX_RESULTS, None, False)
          + "\nSELECT id, round(score, 6) AS similarity_score, rank FROM top")
def q_knn_single(spark, sf):
    r = VE.similar_by_id(_narrow(spark, sf), SEED_ID, exclude_source=False, threshold=None, source=_source(spark, sf))
    return r.select("id", R("similarity_score").alias("similarity_score"), "rank")


@register("topk_search", V_SQL + _vec_search_sql(25, C.SIMILARITY_THRESHOLD, True)
          + "\nSELECT id, round(score, 6) AS similarity_score, rank FROM top")
def q_topk_search(spark, sf):
    r = VE.similar_by_id(_narrow(spark, sf), SEED_ID, n=25, source=_source(spark, sf))
    return r.select("id", R("similarity_score").alias("similarity_score"), "rank")


@register("exclude_source", V_SQL + _vec_search_sql(C.MAX_RESULTS, C.SIMILARITY_THRESHOLD, True)
          + "\nSELECT id, round(score, 6) AS similarity_score, rank FROM top")
def q_exclude_source(spark, sf):
    r = VE.similar_by_id(_narrow(spark, sf), SEED_ID, exclude_source=True, source=_source(spark, sf))
    return r.select("id", R("similarity_score").alias("similarity_score"), "rank")


@register("similarity_threshold", V_SQL + f""",
scored AS (SELECT v.id, list_cosine_similarity(v.embedding, src.embedding) AS score
           FROM vectors v, (SELECT embedding FROM vectors WHERE id = {SEED_ID}) src WHERE v.id <> {SEED_ID})
SELECT id, round(score, 6) AS similarity_score FROM scored WHERE score >= {C.SIMILARITY_THRESHOLD}""")
def q_similarity_threshold(spark, sf):
    v = _narrow(spark, sf)
    q = VE.source_vector(_source(spark, sf), SEED_ID)
    s = (v.filter(F.col("id") != SEED_ID).withColumn("_q", q)
         .withColumn("similarity_score", V.cosine_similarity(F.col("embedding"), F.col("_q"))))
    return s.filter(F.col("similarity_score") >= C.SIMILARITY_THRESHOLD).select(
        "id", R("similarity_score").alias("similarity_score"))


@register("category_filter", V_SQL + _vec_search_sql(C.MAX_RESULTS, C.SIMILARITY_THRESHOLD, True,
                                                     f"AND v.category = {S.q(SEED_CATEGORY)}") + MATCH_SELECT)
def q_category_filter(spark, sf):
    v = _narrow(spark, sf)
    q = VE.source_vector(_source(spark, sf), SEED_ID)
    cands = v.filter((F.col("category") == SEED_CATEGORY) & (F.col("id") != SEED_ID)).withColumn("_q", q)
    scored = cands.withColumn("similarity_score", V.cosine_similarity(F.col("embedding"), F.col("_q")))
    top = VE.topk_search(scored.drop("_q", "embedding"), C.MAX_RESULTS)
    return _match_cols(VE.match_projection(_vmeta(spark, sf, top)))


@register("knn_all", """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS emb FROM embeddings),
p AS (SELECT a.vec_id AS id, b.vec_id AS neighbor_id, list_cosine_similarity(a.emb, b.emb) AS sc
      FROM e a JOIN e b ON a.vec_id <> b.vec_id),
f AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(sc, 9) DESC, neighbor_id) AS rank
      FROM p WHERE sc >= 0.25)
SELECT id, neighbor_id, round(sc, 6) AS score, rank FROM f WHERE rank <= 10""",
          note="exact all-pairs top-k; the oracle enumerates all pairs, the Spark plan does not")
def q_knn_all(spark, sf):
    v = TB.read_table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return VE.knn_all(v).select("id", "neighbor_id", R("score").alias("score"), "rank")


@register("attach_embeddings", A_SQL + """
SELECT a.page_id, a.title, len(e.embedding) AS dims, round(list_cosine_similarity(e.embedding::DOUBLE[],
  e.embedding::DOUBLE[]), 6) AS self_score
FROM articles a JOIN embeddings e ON e.vec_id = a.page_id""")
def q_attach_embeddings(spark, sf):
    a = TB.raw_articles(spark, sf).select(F.col("page_id").alias("id"), "title")
    e = TB.read_table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    j = VE.attach_embeddings(a, e)
    return j.select(F.col("id").alias("page_id"), "title", F.size("embedding").cast("bigint").alias("dims"),
                    R(V.cosine_similarity(F.col("embedding"), F.col("embedding"))).alias("self_score"))


@register("collection_stats", f"""
SELECT {S.q(C.NAMESPACE)} AS namespace, count(*) AS total_articles, {S.q(C.INDEX_NAME)} AS index_name
FROM embeddings""")
def q_collection_stats(spark, sf):
    return SD.vector_table(spark, sf).namespaces().withColumn("index_name", F.lit(C.INDEX_NAME))


@register("article_by_id", V_SQL + f"""
SELECT id, title, link, summary, content_preview AS content, published, source_name FROM vectors
WHERE id = {SEED_ID}""")
def q_article_by_id(spark, sf):
    from ..sources import files as FS
    return FS.article_by_id(_source(spark, sf), SEED_ID)


def _similar_sql(max_results: int) -> str:
    n2 = 2 * max_results
    return V_SQL + _vec_search_sql(n2, C.SIMILARITY_THRESHOLD, True) + f""",
cand AS (SELECT t.*, (SELECT title || ' ' || summary FROM vectors WHERE id = {SEED_ID}) AS query_text,
    title || ' ' || summary AS doc_text, count(*) OVER () AS cnt FROM top t),
ov AS (SELECT id, unnest(list_intersect(list_distinct({S.tokens('query_text')}),
                                        list_distinct({S.tokens('doc_text')}))) AS tok FROM cand),
df AS (SELECT tok, count(*) AS df FROM ov GROUP BY tok),
sc AS (SELECT ov.id, round(sum(ln(((SELECT count(*) FROM cand) + 1.0) / (df.df + 1.0)) + 1), 9) AS rs
       FROM ov JOIN df USING (tok) GROUP BY ov.id),
rr AS (SELECT c.*, coalesce(sc.rs, 0.0) AS rs0,
    row_number() OVER (ORDER BY coalesce(sc.rs, 0.0) DESC, c.rank) AS rerank_pos FROM cand c LEFT JOIN sc USING (id)),
fin AS (SELECT *, CASE WHEN cnt > {max_results} THEN rs0 END AS rerank_score,
    CASE WHEN cnt > {max_results} THEN rerank_pos ELSE rank END AS final_pos FROM rr)"""


@register("similar_articles", _similar_sql(C.MAX_RESULTS) + f"""
SELECT id, rank, final_pos, round(score, 6) AS similarity_score, round(rerank_score, 6) AS rerank_score
FROM fin WHERE final_pos <= {C.MAX_RESULTS}""")
def q_similar_articles(spark, sf):
    r = RC.similar_articles(_vindex(spark, sf), SEED_ID, attach=lambda d: _vmeta(spark, sf, d), source=_source(spark, sf))
    return r.select("id", "rank", "final_pos", R("similarity_score").alias("similarity_score"),
                    R("rerank_score").alias("rerank_score"))


API_SELECT = """
SELECT id, title, content, date, url, source, array_to_string(categories, '|') AS categories,
  array_to_string(tags, '|') AS tags, summary, author, slug, round(similarity_score, 6) AS similarity_score"""


@register("recommend_endpoint", _similar_sql(C.MAX_RESULTS) + API_SELECT.replace("round(similarity_score", "final_pos, count(*) OVER () AS total_results, round(score") + f"""
FROM (SELECT *, content_preview AS content, published AS date, link AS url, source_name AS source,
        [coalesce(category, 'general')] AS categories, '' AS author, '' AS slug
      FROM fin WHERE final_pos <= {C.MAX_RESULTS})""")
def q_recommend_endpoint(spark, sf):
    from ..operators import api as AP
    r = AP.recommend_endpoint(_vindex(spark, sf), SEED_ID, attach=lambda d: _vmeta(spark, sf, d), source=_source(spark, sf))
    return r.select("id", "title", "content", "date", "url", "source", J("categories").alias("categories"),
                    J("tags").alias("tags"), "summary", "author", "slug", "final_pos", "total_results",
                    R("similarity_score").alias("similarity_score"))


@register("recommend_projection", V_SQL + _vec_search_sql(C.MAX_RESULTS, C.SIMILARITY_THRESHOLD, True)
          + API_SELECT.replace("round(similarity_score", "round(score") + """
FROM (SELECT *, content_preview AS content, published AS date, link AS url, source_name AS source,
        [coalesce(category, 'general')] AS categories, '' AS author, '' AS slug FROM top)""")
def q_recommend_projection(spark, sf):
    from ..operators import api as AP
    m = VE.match_projection(_vmeta(spark, sf, VE.similar_by_id(_narrow(spark, sf), SEED_ID, source=_source(spark, sf))))
    r = AP.recommend_projection(m)
    return r.select("id", "title", "content", "date", "url", "source", J("categories").alias("categories"),
                    J("tags").alias("tags"), "summary", "author", "slug",
                    R("similarity_score").alias("similarity_score"))


# ======================================================================================
# 2.7 text search over documents (benchmark texts are the queries)
# ======================================================================================

DOC_SQL = "WITH " + S.doc_index_cte()


def _text_hits(spark, sf, n, category=None):
    return SD.text_index(spark, sf).search(TB.queries_table(spark, sf), n, category=category)


def _hit_meta(spark, sf, hits):
    return SD.text_index(spark, sf).with_meta(hits)


@register("embed_documents", DOC_SQL + ",\n" + S.sparse_cte("dv", "doc_index", "id", "embed_text")
          + "\nSELECT id, b AS bucket, w AS weight FROM dv_w")
def q_embed_documents(spark, sf):
    idx = TB.doc_index(spark, sf)
    return EM.sparse_terms(idx, "embed_text").select("id", F.col("bucket").cast("bigint").alias("bucket"), "weight")


@register("embed_query", "WITH " + S.sparse_cte("qv", "benchmark", "item_id", "text")
          + "\nSELECT id, b AS bucket, w AS weight FROM qv_w")
def q_embed_query(spark, sf):
    return EM.sparse_terms(TB.queries_table(spark, sf), "text").select(
        "id", F.col("bucket").cast("bigint").alias("bucket"), "weight")


def _text_sql(n: int, category: str | None = None, queries: str = "benchmark",
              threshold: float = C.SIMILARITY_THRESHOLD) -> str:
    src = "doc_index" if category is None else f"(SELECT * FROM doc_index WHERE category = {S.q(category)})"
    return DOC_SQL + ",\n" + S.text_search_cte(queries, "item_id", "text", src, "id", "embed_text", n, threshold)


@register("search_text", _text_sql(C.MAX_RESULTS) + """
SELECT h.query_id, h.id, d.title, d.category, round(h.score, 6) AS similarity_score, h.rank
FROM hits h JOIN doc_index d ON d.id = h.id""")
def q_search_text(spark, sf):
    hits = _text_hits(spark, sf, C.MAX_RESULTS)
    return _hit_meta(spark, sf, hits).select("query_id", "id", "title", "category",
                                                      R("similarity_score").alias("similarity_score"), "rank")


@register("search_category", _text_sql(C.MAX_RESULTS, TEXT_CATEGORY) + """
SELECT h.query_id, h.id, d.category, round(h.score, 6) AS similarity_score, h.rank
FROM hits h JOIN doc_index d ON d.id = h.id""")
def q_search_category(spark, sf):
    hits = _text_hits(spark, sf, C.MAX_RESULTS, TEXT_CATEGORY)
    return _hit_meta(spark, sf, hits).select("query_id", "id", "category",
                                             R("similarity_score").alias("similarity_score"), "rank")


def _doc_matches(spark, sf, n):
    hits = _text_hits(spark, sf, n)
    return VE.match_projection(_hit_meta(spark, sf, hits))


RERANK_SQL = f""",
cand AS (SELECT h.query_id, h.id, h.rank, h.score, d.title, d.summary, q.text AS query_text,
    d.title || ' ' || d.summary AS doc_text, count(*) OVER (PARTITION BY h.query_id) AS cnt
  FROM hits h JOIN doc_index d ON d.id = h.id JOIN benchmark q ON q.item_id = h.query_id),
ov AS (SELECT query_id, id, unnest(list_intersect(list_distinct({S.tokens('query_text')}),
                                                  list_distinct({S.tokens('doc_text')}))) AS tok FROM cand),
df AS (SELECT query_id, tok, count(*) AS df FROM ov GROUP BY ALL),
sc AS (SELECT ov.query_id, ov.id, round(sum(ln((c.cnt + 1.0) / (df.df + 1.0)) + 1), 9) AS rs
       FROM ov JOIN df USING (query_id, tok) JOIN (SELECT DISTINCT query_id, cnt FROM cand) c USING (query_id)
       GROUP BY ALL),
rr AS (SELECT c.*, coalesce(sc.rs, 0.0) AS rerank_score,
    row_number() OVER (PARTITION BY c.query_id ORDER BY coalesce(sc.rs, 0.0) DESC, c.rank) AS rerank_pos
  FROM cand c LEFT JOIN sc USING (query_id, id))"""


@register("rerank", _text_sql(2 * C.MAX_RESULTS) + RERANK_SQL + """
SELECT query_id, id, rank, round(rerank_score, 6) AS rerank_score, rerank_pos FROM rr""")
def q_rerank(spark, sf):
    m = _doc_matches(spark, sf, 2 * C.MAX_RESULTS)
    qs = TB.queries_table(spark, sf).select(F.col("id").alias("query_id"), F.col("text").alias("query_text"))
    cands = m.join(qs, "query_id").withColumn("doc_text", RC.doc_text())
    rr = RC.rerank(cands)
    return rr.select("query_id", "id", "rank", R("rerank_score").alias("rerank_score"), "rerank_pos")


@register("attach_rerank", _text_sql(2 * C.MAX_RESULTS) + RERANK_SQL + """
SELECT query_id, rerank_pos, id, title, round(score, 6) AS similarity_score FROM rr""")
def q_attach_rerank(spark, sf):
    m = _doc_matches(spark, sf, 2 * C.MAX_RESULTS)
    qs = TB.queries_table(spark, sf).select(F.col("id").alias("query_id"), F.col("text").alias("query_text"))
    cands = m.select("query_id", "id", "rank", "title", "summary", "similarity_score").join(qs, "query_id")
    rr = RC.rerank(cands.withColumn("doc_text", RC.doc_text()))
    return rr.select("query_id", "rerank_pos", "id", "title", R("similarity_score").alias("similarity_score"))


@register("recommend_query", _text_sql(2 * C.MAX_RESULTS) + RERANK_SQL + f"""
SELECT query_id, final_pos, id, title, round(score, 6) AS similarity_score, round(rerank_score, 6) AS rerank_score
FROM (SELECT * REPLACE (CASE WHEN cnt > 1 THEN rerank_score END AS rerank_score),
        CASE WHEN cnt > 1 THEN rerank_pos ELSE rank END AS final_pos FROM rr)
WHERE final_pos <= {C.MAX_RESULTS}""")
def q_recommend_query(spark, sf):
    m = _doc_matches(spark, sf, 2 * C.MAX_RESULTS)
    r = RC.recommend_query(m, TB.queries_table(spark, sf))
    return r.select("query_id", "final_pos", "id", "title", R("similarity_score").alias("similarity_score"),
                    R("rerank_score").alias("rerank_score"))


TREND_STEPS = """,
m AS (SELECT h.query_id, h.rank, d.title, coalesce(d.category, 'general') AS category
      FROM hits h JOIN doc_index d ON d.id = h.id),
cats AS (SELECT query_id, category, count(*) AS article_count, min(rank) AS first_seen FROM m GROUP BY ALL),
kw AS (SELECT query_id, word, count(*) AS mention_count, min(rank::BIGINT * 1000000 + wpos) AS first_seen
       FROM (SELECT query_id, rank, unnest(ws) AS word, unnest(range(len(ws))) AS wpos
             FROM (SELECT query_id, rank, """ + S.words("lower(title)") + """ AS ws FROM m))
       WHERE length(word) > 4 GROUP BY ALL)"""
TREND_SQL = _text_sql(C.TRENDING_SAMPLE) + TREND_STEPS


@register("category_counts", TREND_SQL + "\nSELECT query_id, category, article_count, first_seen FROM cats")
def q_category_counts(spark, sf):
    return RC.category_counts(_doc_matches(spark, sf, C.TRENDING_SAMPLE))


@register("keyword_counts", TREND_SQL + """
SELECT query_id, word, mention_count, first_seen // 1000000 AS first_rank, first_seen % 1000000 AS first_wpos FROM kw""")
def q_keyword_counts(spark, sf):
    k = RC.keyword_counts(_doc_matches(spark, sf, C.TRENDING_SAMPLE))
    return k.select("query_id", "word", "mention_count", F.col("first_seen.rank").cast("bigint").alias("first_rank"),
                    F.col("first_seen.wpos").cast("bigint").alias("first_wpos"))


TOPICS_SQL = f""",
c5 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY article_count DESC, first_seen)
                      AS pos FROM cats) WHERE pos <= 5),
k5 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY mention_count DESC, first_seen)
                      AS pos FROM kw) WHERE pos <= 5),
u AS (
  SELECT query_id, pos, {S.title_case('category')} AS topic,
    'Popular category with ' || article_count || ' recent articles' AS description,
    'High activity in ' || category || ' news' AS reason, article_count, NULL::BIGINT AS mention_count FROM c5
  UNION ALL
  SELECT query_id, pos + 5, {S.title_case('word')},
    'Frequently mentioned keyword in ' || mention_count || ' articles',
    'High frequency in recent headlines', NULL::BIGINT, mention_count FROM k5)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY pos) AS topic_pos, topic, description, reason,
  coalesce(article_count, mention_count) AS topic_count,
  CASE WHEN article_count IS NOT NULL THEN 'article_count' ELSE 'mention_count' END AS count_kind FROM u"""


def _topic_cols(t, *first):
    return t.select(*first, "topic_pos", "topic", "description", "reason",
                    F.coalesce("article_count", "mention_count").alias("topic_count"),
                    F.when(F.col("article_count").isNotNull(), "article_count").otherwise("mention_count")
                    .alias("count_kind"))


@register("trending_topics", TREND_SQL + TOPICS_SQL)
def q_trending_topics(spark, sf):
    return _topic_cols(RC.trending_topics(_doc_matches(spark, sf, C.TRENDING_SAMPLE), limit=10), "query_id")


SEED_THRESHOLD = 0.05          # the given texts are no news: none reaches the usual threshold for the seed
SEED_QUERY_SQL = f"(SELECT 0::BIGINT AS item_id, {S.q(C.TRENDING_QUERY)} AS text)"


@register("trending_seed", _text_sql(C.TRENDING_SAMPLE, queries=SEED_QUERY_SQL, threshold=SEED_THRESHOLD) + TREND_STEPS
          + TOPICS_SQL.replace("SELECT query_id, row_number()", "SELECT row_number()"))
def q_trending_seed(spark, sf):
    return _topic_cols(RC.trending_now(SD.text_index(spark, sf), threshold=SEED_THRESHOLD))


@register("match_projection", _text_sql(C.MAX_RESULTS) + """
SELECT h.query_id, h.id, d.title, '' AS link, d.summary, '' AS published, d.source_name, d.category, '' AS tags,
  round(h.score, 6) AS similarity_score, left(d.embed_text, 500) AS content_preview, h.rank
FROM hits h JOIN doc_index d ON d.id = h.id""")
def q_match_projection(spark, sf):
    m = _doc_matches(spark, sf, C.MAX_RESULTS)
    return m.select("query_id", "id", "title", "link", "summary", "published", "source_name", "category",
                    J("tags").alias("tags"), R("similarity_score").alias("similarity_score"), "content_preview",
                    "rank")


# ======================================================================================
# 2.8 summaries (documents: file = source, position = doc_id)
# ======================================================================================

from ..operators import summarize as SU  # noqa: E402


def _doc_articles(spark, sf):
    d = TB.read_table(spark, sf, "documents")
    return d.select("doc_id", F.col("source").alias("source_file"), F.col("doc_id").alias("pos"),
                    F.expr(TB.DOC_TITLE_SQL).alias("title"),
                    F.col("text").alias("content"))


DOC_TITLE = S.strip(f"regexp_extract(text, {S.q('^([^' + chr(92) + 'n]*)')}, 1)")
BATCH_SQL = f"""WITH b AS (
  SELECT doc_id, source AS source_file, (rn - 1) // {C.SUMMARY_BATCH} AS batch_id,
    ((rn - 1) % {C.SUMMARY_BATCH}) + 1 AS slot, {DOC_TITLE} AS title, text AS content
  FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents))"""
SUMMARY_SQL = BATCH_SQL + f""",
r AS (SELECT source_file, batch_id, count(*) AS n,
        list_filter(list({S.lead_words('content', SU.TARGET_WORDS)} ORDER BY slot), lambda x: x <> '') AS kept
      FROM b GROUP BY ALL),
s AS (SELECT b.*, nullif(coalesce(list_concat(r.kept, list_transform(range(r.n), lambda i: ''))[b.slot], ''), '')
        AS ai_summary FROM b JOIN r USING (source_file, batch_id))"""


@register("summary_batches", BATCH_SQL + "\nSELECT doc_id, source_file, batch_id, slot FROM b")
def q_summary_batches(spark, sf):
    return SU.summary_batches(_doc_articles(spark, sf)).select("doc_id", "source_file", "batch_id", "slot")


@register("batch_prompt", BATCH_SQL + f""",
g AS (SELECT source_file, batch_id, count(*) AS n,
        string_agg({S.template(SU.BATCH_BLOCK, i='slot', title='title',
                               content=S.truncate_ellipsis('content', C.BATCH_CONTENT_CHARS))}, '' ORDER BY slot)
          AS blocks
      FROM b GROUP BY ALL)
SELECT source_file, batch_id, n AS expected_count,
  {S.template(SU.BATCH_HEADER, n='n', w=str(SU.TARGET_WORDS))} || blocks
    || {S.template(SU.BATCH_FOOTER, n='n', w=str(SU.TARGET_WORDS))} AS prompt,
  floor({SU.TARGET_WORDS} * n * 1.5)::BIGINT AS max_tokens
FROM g""")
def q_batch_prompt(spark, sf):
    return SU.batch_prompt(SU.summary_batches(_doc_articles(spark, sf)))


@register("single_prompt", f"""
SELECT doc_id, {S.template(SU.SINGLE_PROMPT, w=str(SU.TARGET_WORDS), title=DOC_TITLE,
                           content=S.truncate_ellipsis('text', C.SINGLE_CONTENT_CHARS))} AS prompt,
  {int(SU.TARGET_WORDS * 1.5)}::BIGINT AS max_tokens
FROM documents""")
def q_single_prompt(spark, sf):
    return SU.single_prompt(_doc_articles(spark, sf)).select("doc_id", "prompt", "max_tokens")


CONV_SEP = "\n" + C.SUMMARY_SEPARATOR + "\n"


@register("parse_batch_response", f"""
WITH r AS (
  SELECT conv_id, coalesce(string_agg(text, {S.lit_text(CONV_SEP)} ORDER BY turn) FILTER (WHERE role = 'assistant'), '')
      AS response,
    count(*) FILTER (WHERE role = 'user') AS n
  FROM conversations GROUP BY conv_id),
p AS (SELECT conv_id, {S.parse_batch_response('response', 'n')} AS parts FROM r)
SELECT conv_id, unnest(range(1, len(parts) + 1)) AS slot, unnest(parts) AS summary FROM p""")
def q_parse_batch_response(spark, sf):
    c = TB.read_table(spark, sf, "conversations")
    g = c.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("role") == "assistant", F.struct("turn", "text")))).alias("a"),
        F.count_if(F.col("role") == "user").alias("n"))
    reply = g.withColumn("reply", F.array_join(F.transform("a", lambda x: x["text"]), CONV_SEP))
    parsed = reply.select("conv_id", T.parse_batch_response("reply", "n").alias("parts"))
    return parsed.select("conv_id", F.posexplode("parts").alias("p", "summary")).select(
        "conv_id", (F.col("p") + 1).alias("slot"), "summary")


@register("summarize", BATCH_SQL + f""",
s AS (SELECT doc_id, nullif({S.lead_words('content', SU.TARGET_WORDS)}, '') AS ai_summary FROM b)
SELECT doc_id, ai_summary, {S.word_count('ai_summary')} AS summary_words FROM s""")
def q_summarize(spark, sf):
    s = SU.summarize(_doc_articles(spark, sf))
    return s.select("doc_id", "ai_summary", T.word_count(F.col("ai_summary")).alias("summary_words"))


@register("attach_summaries", SUMMARY_SQL + "\nSELECT doc_id, source_file, batch_id, slot, ai_summary FROM s")
def q_attach_summaries(spark, sf):
    b = SU.summary_batches(_doc_articles(spark, sf))
    s = SU.attach_summaries(b, SU.parse_replies(SU.default_batch_reply(b)))
    return s.select("doc_id", "source_file", "batch_id", "slot", "ai_summary")


@register("summary_stats", SUMMARY_SQL + f"""
SELECT source_file, batch_id, count(*) AS summaries, sum({S.word_count('ai_summary')})::BIGINT AS total_words,
  round(sum({S.word_count('ai_summary')}) / count(*), 6) AS avg_words
FROM s GROUP BY ALL""")
def q_summary_stats(spark, sf):
    b = SU.summary_batches(_doc_articles(spark, sf))
    parsed = SU.parse_replies(SU.default_batch_reply(b))
    return SU.summary_stats(parsed)


FAILED_EVERY = 3               # in summary_fallback, the call of every third batch of a file has failed


@register("summary_fallback", SUMMARY_SQL + f"""
SELECT doc_id, source_file, batch_id, slot, CASE WHEN batch_id % {FAILED_EVERY} = 0
  THEN nullif({S.lead_words('content', SU.TARGET_WORDS)}, '') ELSE ai_summary END AS ai_summary FROM s""")
def q_summary_fallback(spark, sf):
    b = SU.summary_batches(_doc_articles(spark, sf))
    replies = SU.default_batch_reply(b)
    failed = replies.filter(F.col("batch_id") % FAILED_EVERY == 0).select("source_file", "batch_id")
    done = SU.attach_summaries(b, SU.parse_replies(replies.filter(F.col("batch_id") % FAILED_EVERY != 0)))
    return SU.summary_fallback(done, failed, None).select("doc_id", "source_file", "batch_id", "slot", "ai_summary")


PER_FILE = 500                 # page_ids of a landed raw file
BROKEN_CATEGORY = "fr"         # in process_raw, the files of this category arrive broken


@register("process_raw", P_SQL + f""",
f AS (SELECT page_id, category, row_number() OVER (PARTITION BY category, page_id // {PER_FILE} ORDER BY page_id) - 1 AS pos FROM articles)
SELECT p.page_id, p.id, p.title, p.source_feed, f.pos, nullif({S.lead_words('content', SU.TARGET_WORDS)}, '') AS ai_summary
FROM processed p JOIN f USING (page_id) WHERE f.category <> {S.q(BROKEN_CATEGORY)}""")
def q_process_raw(spark, sf):
    """Landed raw files, some broken and one empty, to the written table of processed runs."""
    from pyspark.sql import types as Ty
    from ..operators import pipeline as PL
    raw, path = TB.raw_articles(spark, sf), scratch_path(spark, "rawjson")
    FS.land_json_arrays(raw, path, group_col="category", order_col="page_id", per_file=PER_FILE, spoil=F.col("_g") == BROKEN_CATEGORY, empty=True)
    schema = Ty.StructType([*SC.RAW_ARTICLE.fields, Ty.StructField("page_id", Ty.LongType())])
    processed = SVT.VersionedTable(spark, scratch_path(spark, "processed"), ("source_file",))
    PL.process_raw_files(spark, path, processed, SVT.VersionedTable(spark, scratch_path(spark, "done"), ("source_file",)), schema)
    return processed.read().select("page_id", "id", "title", "source_feed", "pos", "ai_summary")


# ======================================================================================
# 2.1 / 2.2 sources and sinks (written under the shared folder, then read back)
# ======================================================================================

from ..session import scratch_path  # noqa: E402
from ..sinks import tables as SK  # noqa: E402
from ..sinks import vectors as SV  # noqa: E402
from ..sinks import versions as SVT  # noqa: E402
from ..sources import feeds as FDS  # noqa: E402
from ..sources import files as FS  # noqa: E402
from ..operators import api as AP  # noqa: E402
from ..operators import retention as RT  # noqa: E402
from ..streaming import ingest as ST  # noqa: E402
from .. import schemas as SC  # noqa: E402

RUN_A, RUN_B = "2024-06-01T00:00:00", "2024-06-01T06:00:00"


def _land_feeds(spark, sf, broken=None) -> str:
    """Land the page entries as RSS documents, one for each feed; the items for which ``broken`` holds are not well-formed."""
    e = TB.page_entries(spark, sf)
    items = e.select(
        "feed_url", "title", "link", "description", F.col("published").alias("pubDate"),
        F.transform("tags", lambda t: t["term"]).alias("category"),
        F.col("author_detail.name").alias("creator"),
        F.col("content")[0]["value"].alias("content"),
        F.col("page_id").alias("guid"))
    item = FDS.rss_item()
    if broken is not None:
        item = F.when(broken, F.replace(item, F.lit("</title>"), F.lit("</broken>"))).otherwise(item)
    return FDS.land_feed_documents(items, scratch_path(spark, "feeds"), item=item)


def _guid_schema():
    from pyspark.sql import types as Ty
    return Ty.StructType([*FDS.RSS_ITEM_SCHEMA.fields[:-1], Ty.StructField("guid", Ty.LongType()), FDS.RSS_ITEM_SCHEMA.fields[-1]])


@register("rss_scan", E_SQL + """
SELECT page_id AS guid, feed_url, row_number() OVER (PARTITION BY feed_url ORDER BY page_id) - 1 AS entry_pos, false AS malformed, title, link,
  description, published AS pubDate, array_to_string(tag_terms, '|') AS category, author_name AS creator, article_html AS content
FROM entries""")
def q_rss_scan(spark, sf):
    path = _land_feeds(spark, sf)
    items = FDS.with_feed_flag(FDS.scan_items(spark, path, _guid_schema()), FDS.feed_documents(spark, path))
    return IN.drop_unparsed(items).select(
        "guid", "feed_url", "entry_pos", "malformed", "title", "link", "description", "pubDate", J("category").alias("category"),
        F.col("`dc:creator`").alias("creator"), F.col("`content:encoded`").alias("content"))


@register("drop_unparsed", E_SQL + f"""
SELECT title, link FROM entries WHERE right(coalesce(title, ''), 1) <> {S.q(BROKEN_ENDING)}""")
def q_drop_unparsed(spark, sf):
    path = _land_feeds(spark, sf, broken=F.coalesce(F.col("title"), F.lit("")).endswith(BROKEN_ENDING))
    return IN.drop_unparsed(FDS.scan_items(spark, path)).select("title", "link")


@register("write_raw", A_SQL + f"""
SELECT page_id, id, title, {S.q(RUN_A)} AS run_ts FROM articles
UNION ALL SELECT page_id, id, title, {S.q(RUN_B)} FROM articles""")
def q_write_raw(spark, sf):
    path = scratch_path(spark, "raw")
    raw = TB.raw_articles(spark, sf)
    SK.write_raw(raw, path, RUN_A)
    return SK.write_raw(raw, path, RUN_B).select("page_id", "id", "title", "run_ts")


@register("raw_scan", A_SQL + """
SELECT page_id, id, title, url, content, date, array_to_string(tags, '|') AS tags FROM articles""")
def q_raw_scan(spark, sf):
    """Landed JSON-array files (one per feed, reference layout) read back with
    the explicit schema; a non-article file next to them is skipped by the glob."""
    path = scratch_path(spark, "rawjson")
    raw = TB.raw_articles(spark, sf)
    FS.land_json_arrays(raw, path, group_col="source_feed", order_col="page_id", prefix="raw_news_")
    from pyspark.sql import types as Ty
    schema = Ty.StructType(list(SC.RAW_ARTICLE.fields) + [Ty.StructField("page_id", Ty.LongType())])
    got = FS.scan_raw(spark, path, schema=schema)
    return got.select("page_id", "id", "title", "url", "content", "date", J("tags").alias("tags"))


@register("write_processed", P_SQL + f"""
SELECT page_id, id, source_feed AS source_file, {S.q(RUN_A)} AS run_ts FROM processed""")
def q_write_processed(spark, sf):
    path = scratch_path(spark, "processed")
    p = TB.processed_articles(spark, sf).withColumn("source_file", F.col("source_feed"))
    return SK.write_processed(p, path, RUN_A).select("page_id", "id", "source_file", "run_ts")


SNAPSHOT = 40                  # page_ids of the newest snapshot file


@register("latest_snapshot", P_SQL + f"""
SELECT page_id, id, title, content, array_to_string(tags, '|') AS tags, count(*) OVER () AS total_articles,
  (SELECT count(DISTINCT (source_feed, page_id // 1000)) + 1 FROM processed) AS available_files
FROM processed WHERE page_id < {SNAPSHOT}""")
def q_latest_snapshot(spark, sf):
    """The newest of the landed snapshot files: one range of articles, landed after all others."""
    from pyspark.sql import types as Ty
    path, p = scratch_path(spark, "snapshots"), TB.processed_articles(spark, sf)
    FS.land_json_arrays(p, path, group_col="source_feed", order_col="page_id", prefix="processed_news_a", per_file=1000)
    FS.land_json_arrays(p.filter(F.col("page_id") < SNAPSHOT).withColumn("_all", F.lit("all")), path, group_col="_all", order_col="page_id",
                        prefix="processed_news_b", per_file=SNAPSHOT)
    schema = Ty.StructType([*SC.SNAPSHOT_ARTICLE.fields, Ty.StructField("page_id", Ty.LongType())])
    got = FS.latest_files(spark, path, schema=schema)
    return got.select("page_id", "id", "title", "content", J("tags").alias("tags"), "total_articles", "available_files")


@register("latest_run", P_SQL + f"""
SELECT page_id, id, {S.q(RUN_B)} AS run_ts, count(*) OVER () AS total_articles FROM processed""")
def q_latest_run(spark, sf):
    path = scratch_path(spark, "processed")
    p = TB.processed_articles(spark, sf)
    SK.write_processed(p, path, RUN_A)
    SK.write_processed(p, path, RUN_B)
    latest = FS.latest_run(spark.read.parquet(path))
    return latest.select("page_id", "id", "run_ts").withColumn(
        "total_articles", latest.agg(F.count(F.lit(1))).scalar())


def _seen_sql() -> str:
    return A_SQL + NEW_SQL


@register("write_seen", _seen_sql() + "\nSELECT article_hash FROM seen UNION SELECT dedup_key FROM new")
def q_write_seen(spark, sf):
    path = scratch_path(spark, "seen")
    seen = _seen_prev(spark, sf)
    SK.write_seen(seen, path)
    raw = TB.raw_articles(spark, sf)
    new = IN.new_articles(raw, FS.read_seen(spark, path), row_id=("page_id",))
    SK.write_seen(new.select(F.col("dedup_key").alias("article_hash")), path)
    return FS.read_seen(spark, path).distinct()


@register("seen_scan", A_SQL + f"""
SELECT DISTINCT {S.md5_of('title', 'url')} AS article_hash FROM articles WHERE date < {S.q(PREV_RUN_CUTOFF)}""")
def q_seen_scan(spark, sf):
    path = scratch_path(spark, "seen")
    SK.write_seen(_seen_prev(spark, sf), path)
    missing = FS.read_seen(spark, scratch_path(spark, "absent"))      # absent table -> empty
    return FS.read_seen(spark, path).unionByName(missing).distinct()


UPSERT_SQL = f""",
a AS (SELECT vec_id AS id, 1 AS version, embedding[1] AS x FROM embeddings),
b AS (SELECT vec_id AS id, 2 AS version, -embedding[1] AS x FROM embeddings WHERE CAST(label AS VARCHAR) = {S.q(SEED_CATEGORY)}),
u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY version DESC) AS r
                     FROM (SELECT * FROM a UNION ALL SELECT * FROM b)) WHERE r = 1)"""


@register("upsert_vectors", "WITH x AS (SELECT 1)" + UPSERT_SQL + f"""
SELECT {S.q(C.NAMESPACE)} AS namespace, id, version::BIGINT AS version, round(x::DOUBLE, 6) AS first_value FROM u""")
def q_upsert_vectors(spark, sf):
    e = TB.read_table(spark, sf, "embeddings")
    a = e.select(F.col("vec_id").alias("id"), "embedding", F.col("label").cast("string").alias("category"))
    upd = a.filter(F.col("category") == SEED_CATEGORY).withColumn(
        "embedding", F.transform("embedding", lambda v: -v))
    table = SV.VectorTable(spark, scratch_path(spark, "vectors"))
    table.upsert(a)
    table.upsert(upd)
    return table.read().select("namespace", "id", F.col("version").cast("bigint").alias("version"),
                               R(F.col("embedding")[0].cast("double")).alias("first_value"))


@register("clear_namespace", f"""
SELECT CAST(label AS VARCHAR) AS namespace, count(*) AS vectors FROM embeddings
WHERE CAST(label AS VARCHAR) <> {S.q(SEED_CATEGORY)} GROUP BY label""")
def q_clear_namespace(spark, sf):
    e = TB.read_table(spark, sf, "embeddings")
    v = e.select(F.col("label").cast("string").alias("namespace"), F.col("vec_id").alias("id"), "embedding")
    table = SV.VectorTable(spark, scratch_path(spark, "vectors"), buckets=4)
    table.upsert(v)
    table.clear(SEED_CATEGORY)
    return table.read(None).groupBy("namespace").agg(F.count(F.lit(1)).alias("vectors"))


@register("add_articles", A_SQL + f""",
t AS (SELECT id, left(title, {C.TITLE_CAP}) AS title, url AS link, left(summary, {C.SUMMARY_CAP}) AS summary, date AS published, source_name,
        categories[1] AS category, array_to_string(tags[1:{C.TAGS_CAP}], '|') AS tags, fetched_at AS added_to_db,
        {S.embedding_text('title', 'summary', 'content')} AS txt FROM articles)
SELECT id, title, link, summary, published, source_name, category, tags, added_to_db, left(txt, {C.PREVIEW_CHARS}) AS content_preview,
  {C.EMBED_DIM}::BIGINT AS dims, len({S.tokens('txt')})::DOUBLE AS words,
  len(list_distinct(list_transform({S.tokens('txt')}, lambda w: {S.hash_bucket('w')})))::BIGINT AS buckets FROM t""")
def q_add_articles(spark, sf):
    table = SV.VectorTable(spark, scratch_path(spark, "articles"))
    table.add_articles(TB.raw_articles(spark, sf))
    return table.read().select("id", "title", "link", "summary", "published", "source_name", "category", J("tags").alias("tags"), "added_to_db",
                               "content_preview", F.size("embedding").cast("bigint").alias("dims"),
                               F.aggregate("embedding", F.lit(0.0), lambda s, v: s + v).alias("words"),
                               F.size(F.filter("embedding", lambda v: v > 0)).cast("bigint").alias("buckets"))


@register("ingest_stream", f"""
SELECT DISTINCT user_id, event_type, md5(CAST(user_id AS VARCHAR) || event_type) AS dedup_key FROM events""",
          note="stream output compared on keys: which copy survives depends on arrival order")
def q_ingest_stream(spark, sf):
    ev = TB.read_table(spark, sf, "events")
    out = ST.ingest_events(spark, ev, ["user_id", "event_type"], mode="table")
    return out.select("user_id", "event_type",
                      F.md5(F.concat(F.col("user_id").cast("string"), F.col("event_type"))).alias("dedup_key"))


@register("ingest_stream_state", f"""
SELECT DISTINCT user_id, event_type FROM events""")
def q_ingest_stream_state(spark, sf):
    ev = TB.read_table(spark, sf, "events")
    out = ST.ingest_events(spark, ev, ["user_id", "event_type"], mode="state")
    return out.select("user_id", "event_type")


# ======================================================================================
# 2.3 API projections
# ======================================================================================

API_P_SQL = P_SQL + f""",
api AS (SELECT page_id, {S.api_id('title', 'url', 'source_feed')} AS id, title, content, date, url,
    source_feed AS source, categories, tags, '' AS summary, author, slug FROM processed)"""


@register("api_projection", API_P_SQL + """
SELECT page_id, id, title, content, date, url, source, array_to_string(categories, '|') AS categories,
  array_to_string(tags, '|') AS tags, summary, author, slug FROM api""")
def q_api_projection(spark, sf):
    a = AP.api_projection(TB.processed_articles(spark, sf))
    return a.select("page_id", "id", "title", "content", "date", "url", "source", J("categories").alias("categories"),
                    J("tags").alias("tags"), "summary", "author", "slug")


@register("card_view", API_P_SQL + f"""
SELECT page_id, id, title, url, {S.display_source('source')} AS source_label, {S.display_date('date')} AS date_label,
  coalesce(nullif(summary, ''), {S.q(C.NO_SUMMARY_TEXT)}) AS summary_text, array_to_string(tags[1:3], '|') AS card_tags
FROM api""")
def q_card_view(spark, sf):
    c = AP.card_view(AP.api_projection(TB.processed_articles(spark, sf)))
    return c.select("page_id", "id", "title", "url", "source_label", "date_label", "summary_text",
                    J("card_tags").alias("card_tags"))


@register("preview_50", API_P_SQL + f"""
SELECT page_id, id, title, (SELECT count(*) FROM api) AS total_articles FROM api ORDER BY page_id
LIMIT {C.PREVIEW_ROWS}""")
def q_preview_50(spark, sf):
    a = AP.api_projection(TB.processed_articles(spark, sf))
    return AP.preview(a, "page_id").select("page_id", "id", "title", "total_articles")


@register("union_outputs", API_P_SQL + """
SELECT id, title, NULL AS source, 'processed' AS kind FROM processed
UNION ALL SELECT id, title, source, 'api' FROM api""")
def q_union_outputs(spark, sf):
    p = TB.processed_articles(spark, sf).select("id", "title").withColumn("kind", F.lit("processed"))
    a = AP.api_projection(TB.processed_articles(spark, sf)).select("id", "title", "source") \
        .withColumn("kind", F.lit("api"))
    return IN.union_all([p, a]).select("id", "title", "source", "kind")


# ======================================================================================
# 2.10 retention and run status
# ======================================================================================

RUNS_SQL = A_SQL + """,
runs AS (SELECT a.*, strftime(TIMESTAMP '2024-01-01' + (a.page_id // 24) * INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%S')
           AS run_ts FROM articles a)"""


def _runs(spark, sf):
    """Raw articles as daily runs: the run of an article is the day it was
    published (one fetch per day)."""
    a = TB.raw_articles(spark, sf)
    return a.withColumn("run_ts", F.date_format(F.date_trunc("day", F.to_timestamp("date")), T.ISO_FMT))


@register("retain_newest_runs", RUNS_SQL + f""",
keep AS (SELECT run_ts FROM (SELECT DISTINCT run_ts FROM runs) ORDER BY run_ts DESC LIMIT {C.KEEP_RUNS})
SELECT page_id, run_ts FROM runs WHERE run_ts IN (SELECT run_ts FROM keep)""")
def q_retain_newest_runs(spark, sf):
    """What is on disk after the old runs are gone."""
    table = SVT.VersionedTable(spark, scratch_path(spark, "runs"), ("run_ts",))
    table.replace(_runs(spark, sf).select("page_id", "run_ts"))
    RT.drop_old_runs(table)
    return table.read().select("page_id", "run_ts")


@register("archive_old", RUNS_SQL + f"""
SELECT page_id, CASE WHEN date < strftime(TIMESTAMP '{C.DEFAULT_RUN_TS.replace('T', ' ')}'
    - INTERVAL {C.ARCHIVE_AFTER_DAYS} DAY, '%Y-%m-%dT%H:%M:%S') THEN 'archive' ELSE 'live' END AS tier FROM runs""")
def q_archive_old(spark, sf):
    """What is on disk in the live and the archive table afterwards."""
    live = SVT.VersionedTable(spark, scratch_path(spark, "runs"), ("run_ts",))
    archive = SVT.VersionedTable(spark, scratch_path(spark, "archive"), ("run_ts",))
    live.replace(_runs(spark, sf).select("page_id", "date", "run_ts"))
    RT.archive_old_runs(live, archive)
    left = [t.read().withColumn("tier", F.lit(name)) for t, name in ((live, "live"), (archive, "archive")) if t.version()]
    return IN.union_all(left).select("page_id", "tier")


@register("run_status", P_SQL + RUNS_SQL.removeprefix(A_SQL) + """,
p AS (SELECT run_ts, count(*) AS processed FROM processed JOIN runs USING (page_id) GROUP BY run_ts),
r AS (SELECT run_ts, count(*) AS raw FROM runs GROUP BY run_ts),
v AS (SELECT r2.run_ts, count(*) AS vectors FROM runs r2 JOIN embeddings e ON e.vec_id = r2.page_id GROUP BY r2.run_ts)
SELECT coalesce(r.run_ts, p.run_ts, v.run_ts) AS run_ts, coalesce(raw, 0) AS raw, coalesce(processed, 0) AS processed,
  coalesce(vectors, 0) AS vectors
FROM r FULL OUTER JOIN p USING (run_ts) FULL OUTER JOIN v USING (run_ts)""")
def q_run_status(spark, sf):
    runs = _runs(spark, sf)
    e = TB.read_table(spark, sf, "embeddings").select(F.col("vec_id").alias("page_id"))
    vec = runs.join(e, "page_id").select("run_ts")
    path = scratch_path(spark, "processed-runs")
    done = IN.process_article(runs, keep=("page_id", "run_ts"))
    done.write.partitionBy("run_ts").parquet(path)
    return RT.run_status(runs.select("run_ts"), SK.read_back(spark, path, done).select("run_ts"), vec)
