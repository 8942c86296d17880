"""Ingest operators: entries -> raw articles -> processed articles, dedup, caps,
per-feed statistics and feed health.

All are lazy DataFrame transformations. Ordering within a feed is carried as
data (``feed_pos``, ``entry_pos``), never taken from physical row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import entry as E
from ..functions import sql as S
from ..functions import text as T

RAW_COLUMNS = ["id", "title", "url", "summary", "content", "date", "author", "slug",
               "categories", "tags", "source_feed", "source_name", "category", "fetched_at"]

PROCESSED_COLUMNS = ["id", "title", "content", "url", "date", "author", "slug", "categories",
                     "tags", "source_feed"]


def parse_entry(entries: DataFrame, run_ts: str = C.DEFAULT_RUN_TS, keep=("page_id", "entry_pos")) -> DataFrame:
    """RSS_ENTRY rows -> RAW_ARTICLE rows (one ``select``).

    Expects ``feed_url``, ``feed_category`` and the entry fields. Summary and
    content are HTML-cleaned; ``fetched_at`` is the run timestamp, one value per
    run, so reruns compare equal. Rows whose XML failed to parse are dropped by
    ``drop_unparsed`` before this step.
    """
    content = S.content_coalesce("content", "description", "summary", "summary_detail.value")
    cats = S.entry_categories("tags", "category")
    name = S.source_name("feed_url")
    title, link = "coalesce(title, '')", "coalesce(link, '')"
    kept = [S.ident(c) for c in keep if c in entries.columns]
    return entries.selectExpr(
        *kept,
        f"{S.article_id(title, link, name)} AS id",
        f"{title} AS title",
        f"{link} AS url",
        f"{S.clean_html('summary')} AS summary",
        f"{S.clean_html(content)} AS content",
        f"{S.parse_published('published', run_ts)} AS date",
        f"{S.entry_author('author', 'author_detail.name')} AS author",
        f"{S.slug(title)} AS slug",
        f"{cats} AS categories",
        f"{S.entry_tags('tags', cats)} AS tags",
        "feed_url AS source_feed",
        f"{name} AS source_name",
        f"coalesce(feed_category, {S.lit(C.DEFAULT_CATEGORY)}) AS category",
        f"{S.lit(run_ts)} AS fetched_at",
    )



def process_article(raw: DataFrame, cleaning: bool = True, keep=("page_id", "entry_pos")) -> DataFrame:
    """RAW_ARTICLE -> PROCESSED_ARTICLE: processor id, stripped title, cleaned
    content; drops summary, link, published, source_name and category."""
    content = S.clean_content("content") if cleaning else "content"
    kept = [S.ident(c) for c in keep if c in raw.columns]
    return raw.selectExpr(
        *kept,
        f"{S.processor_id('title', 'url', 'source_feed')} AS id",
        S.strip("coalesce(title, '')") + " AS title",
        f"{content} AS content",
        *[f"coalesce({S.ident(c)}, '') AS {S.ident(c)}" for c in ("url", "date", "author", "slug")],
        "coalesce(categories, CAST(array() AS ARRAY<STRING>)) AS categories",
        "coalesce(tags, CAST(array() AS ARRAY<STRING>)) AS tags",
        "coalesce(source_feed, '') AS source_feed",
    )


def drop_unparsed(df: DataFrame, corrupt_col: str = "_corrupt_record") -> DataFrame:
    """Drop rows the source could not parse (PERMISSIVE mode marks them)."""
    if corrupt_col in df.columns:
        return df.filter(F.col(corrupt_col).isNull()).drop(corrupt_col)
    return df


def cap_per_feed(entries: DataFrame, n: int = C.MAX_PER_FEED, feed: str | list[str] = "feed_url",
                 order: str = "entry_pos") -> DataFrame:
    """First ``n`` entries of every feed, in feed order.

    ``row_number() <= n`` is planned as a partial WindowGroupLimit before the
    shuffle, so a feed holding a third of all rows ships at most ``n`` rows per
    map task.
    """
    w = Window.partitionBy(feed).orderBy(F.col(order).asc())
    return entries.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def first_wins(df: DataFrame, key: Column | str, order: list[str]) -> DataFrame:
    """One row per ``key``: the first in ``order``.

    Done as ``min_by(struct(row), struct(order))`` in a grouped aggregate, which
    is combined map-side: a key with millions of copies is reduced before the
    shuffle (a window over the key would pull all copies into one task).
    """
    key_col = F.col(key) if isinstance(key, str) else key
    cols = df.columns
    packed = df.withColumn("_k", key_col).groupBy("_k").agg(
        F.min_by(F.struct(*[F.col(c) for c in cols]), F.struct(*[F.col(c) for c in order])).alias("_r"))
    return packed.select("_r.*")


def new_articles(raw: DataFrame, seen: DataFrame | None, dedup: bool = True,
                 order=("source_feed", "entry_pos"), row_id=None) -> DataFrame:
    """Articles of this run not seen before (anti join on ``md5(title+url)``),
    first-wins inside the run. ``seen`` has one column ``article_hash``.

    ``row_id`` names non-null columns that together tell all rows apart. With
    them only keys, order and row ids are aggregated (map-side combined) and the
    articles are semi-joined on the row ids of the winners, a join that the
    optimizer moves below the cleaning of texts. Without them whole rows go
    through the aggregate.

    Cap the entries per feed *before* this step (the cap applies before dedup).
    """
    with_key = raw.withColumn("dedup_key", T.dedup_key(F.col("title"), F.col("url")))
    if not dedup:
        return with_key
    if row_id is None:
        firsts = first_wins(with_key, "dedup_key", list(order))
    else:
        narrow = [*order, *[c for c in row_id if c not in order]]
        firsts = with_key.groupBy("dedup_key").agg(F.min(F.struct(*narrow)).alias("_first"))
    if seen is not None:
        firsts = firsts.join(seen.select(F.col("article_hash").alias("dedup_key")), "dedup_key", "left_anti")
    if row_id is None:
        return firsts
    return with_key.join(firsts.select(*[F.col("_first")[c].alias(c) for c in row_id]), list(row_id), "left_semi")


def seen_hashes(articles: DataFrame) -> DataFrame:
    """The ``seen`` rows an article set adds (``article_hash``), distinct."""
    return articles.select(T.dedup_key(F.col("title"), F.col("url")).alias("article_hash")).distinct()


def seen_union(seen: DataFrame, new_hashes: DataFrame) -> DataFrame:
    return seen.select("article_hash").union(new_hashes.select("article_hash")).distinct()


def fetch_stats(new: DataFrame) -> DataFrame:
    """New articles per (category, feed), per category and in total, in one pass
    (``rollup``); ``level`` = 0 total, 1 category, 2 feed."""
    return (new.rollup("category", "source_feed")
            .agg(F.count(F.lit(1)).alias("new_articles"),
                 F.grouping_id().alias("_g"))
            .select(F.when(F.col("_g") == 3, 0).when(F.col("_g") == 1, 1).otherwise(2).alias("level"),
                    F.coalesce("category", F.lit("")).alias("category"),
                    F.coalesce("source_feed", F.lit("")).alias("source_feed"),
                    "new_articles"))


def feed_health(entries: DataFrame, sample: int = 3, preview: int = 100, registry: DataFrame | None = None) -> DataFrame:
    """Per feed: entry count, how many entries lack a title / link / summary /
    date / content, whether an item of it could not be parsed (``malformed``),
    and the first ``sample`` entries with 100-char previews.

    Entries with a ``_corrupt_record`` only set the flag. With a ``registry``
    its feeds without entries are listed too, with counts of 0; a feed without
    (parsed) entries has null samples.

    Counts are a grouped aggregate (partial + final); the sample is a
    ``row_number() <= 3`` per feed (partial WindowGroupLimit), joined back on the
    feed key. No per-feed driver loop.
    """
    broken = F.col("_corrupt_record").isNotNull() if "_corrupt_record" in entries.columns else F.lit(False)
    has_content = (F.coalesce(F.size("content"), F.lit(0)) > 0) | (F.coalesce(F.col("description"), F.lit("")) != "")
    counts = entries.groupBy("feed_url").agg(
        F.count_if(~broken).alias("entries"),
        *[F.count_if(~broken & (F.coalesce(F.col(c), F.lit("")) == "")).alias(f"missing_{name}")
          for c, name in (("title", "title"), ("link", "link"), ("summary", "summary"), ("published", "date"))],
        F.count_if(~broken & ~has_content).alias("missing_content"),
        F.coalesce(F.bool_or(broken), F.lit(False)).alias("malformed"),
    )
    if registry is not None:
        zeros = {c: False if c == "malformed" else 0 for c in counts.columns if c != "feed_url"}
        counts = registry.select("feed_url").distinct().join(counts, "feed_url", "full_outer").na.fill(zeros)
    entries = drop_unparsed(entries)
    w = Window.partitionBy("feed_url").orderBy("entry_pos")
    content_text = E.content_coalesce("content", "description", "''", "''")
    firsts = (entries.withColumn("sample_pos", F.row_number().over(w)).filter(F.col("sample_pos") <= sample)
              .select("feed_url", "sample_pos",
                      F.coalesce(F.col("title"), F.lit("")).alias("sample_title"),
                      F.coalesce(F.col("link"), F.lit("")).alias("sample_link"),
                      F.substring(F.coalesce(F.col("summary"), F.lit("")), 1, preview).alias("summary_preview"),
                      F.substring(content_text, 1, preview).alias("content_preview")))
    return counts.join(firsts, "feed_url", "left")


def union_all(parts: list[DataFrame]) -> DataFrame:
    """Concatenate feeds (UNION ALL by column name; duplicates were removed
    upstream)."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
