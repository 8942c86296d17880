"""Feed sources: the feed registry, landed feed files (RSS/Atom XML), and the
fetch operators that turn feed entries into new raw articles.

Network download is not part of this library: feeds arrive as landed files
(one directory per feed, or a file per fetch) and are scanned with Spark's XML
source in one multi-path scan; the registry is joined on the landing path
(``_metadata.file_path``), not looped over on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from .. import config as C
from ..operators import ingest as IN
from ..session import scratch_path

# RSS <item> as Spark's XML source reads it (rowTag=item). Namespaced names
# arrive verbatim (``content:encoded``, ``dc:creator``).
RSS_ITEM_SCHEMA = Ty.StructType([
    Ty.StructField("title", Ty.StringType()),
    Ty.StructField("link", Ty.StringType()),
    Ty.StructField("description", Ty.StringType()),
    Ty.StructField("pubDate", Ty.StringType()),
    Ty.StructField("category", Ty.ArrayType(Ty.StringType())),
    Ty.StructField("dc:creator", Ty.StringType()),
    Ty.StructField("author", Ty.StringType()),
    Ty.StructField("content:encoded", Ty.StringType()),
    Ty.StructField("_corrupt_record", Ty.StringType()),
])

# Atom <entry>: link is an element with an href attribute.
ATOM_ENTRY_SCHEMA = Ty.StructType([
    Ty.StructField("title", Ty.StringType()),
    Ty.StructField("link", Ty.ArrayType(Ty.StructType([Ty.StructField("_href", Ty.StringType()),
                                                       Ty.StructField("_rel", Ty.StringType())]))),
    Ty.StructField("summary", Ty.StringType()),
    Ty.StructField("content", Ty.StringType()),
    Ty.StructField("published", Ty.StringType()),
    Ty.StructField("updated", Ty.StringType()),
    Ty.StructField("author", Ty.StructType([Ty.StructField("name", Ty.StringType())])),
    Ty.StructField("category", Ty.ArrayType(Ty.StructType([Ty.StructField("_term", Ty.StringType()),
                                                           Ty.StructField("_label", Ty.StringType())]))),
    Ty.StructField("_corrupt_record", Ty.StringType()),
])


def registry_frame(spark: SparkSession, registry: dict[str, list[str]],
                   landing_root: str | None = None) -> DataFrame:
    """The configured registry ``category -> [feed urls]`` as rows
    ``(category, category_pos, feed_pos, feed_url, landing_path)``. The registry
    is configuration (a handful of feeds), so it is created from the driver."""
    rows = [(cat, ci, urls) for ci, (cat, urls) in enumerate(registry.items())]
    df = spark.createDataFrame(rows, "category string, category_pos int, feed_urls array<string>")
    out = df.select("category", "category_pos", F.posexplode("feed_urls").alias("feed_pos", "feed_url"))
    if landing_root:
        out = out.withColumn("landing_path", F.concat(F.lit(landing_root.rstrip("/") + "/"),
                                                      F.regexp_replace("feed_url", "[^A-Za-z0-9]+", "_")))
    return out


def registry_from_entries(entries: DataFrame) -> DataFrame:
    """A registry derived from the feeds seen in an entry table: categories
    with their distinct feeds in url order (``feed_pos`` 0-based). A window
    over the *distinct feed list*, never over the entries."""
    feeds = entries.select(F.col("feed_category").alias("category"), "feed_url").distinct()
    w = Window.partitionBy("category").orderBy("feed_url")
    return feeds.withColumn("feed_pos", (F.row_number().over(w) - 1).cast("int"))


def available_categories(registry: DataFrame) -> DataFrame:
    return registry.select("category").distinct()


def scan_rss(spark: SparkSession, paths: list[str] | str, schema: Ty.StructType = RSS_ITEM_SCHEMA,
             row_tag: str = "item") -> DataFrame:
    """Landed RSS files -> one row per item, with the file path.

    PERMISSIVE mode keeps malformed items as ``_corrupt_record`` (a malformed
    feed only warns in the reference); ``drop_unparsed`` removes them. A broken item
    costs only itself (Spark's other XML parser ends the file there). A file is read by
    one task; ``scan_items`` cuts large files and numbers the items.
    """
    r = (spark.read.format("xml").option("rowTag", row_tag).option("mode", "PERMISSIVE")
         .option("useLegacyXMLParser", True)
         .option("ignoreSurroundingSpaces", False)
         .option("columnNameOfCorruptRecord", "_corrupt_record").schema(schema))
    df = r.load(paths)
    return df.withColumn("file_path", F.col("_metadata.file_path"))


def rss_items_to_entries(items: DataFrame, feed_url: str = "feed_url", category: str = "feed_category",
                         entry_pos: str = "entry_pos") -> DataFrame:
    """RSS items -> the RSS_ENTRY columns the ingest operators read."""
    empty_tags = F.array().cast("array<struct<term:string,label:string>>")
    content = F.col("`content:encoded`")
    return items.select(
        *[c for c in ("page_id", "feed_pos") if c in items.columns],
        F.col(feed_url).alias("feed_url"), F.col(category).alias("feed_category"), F.col(entry_pos).alias("entry_pos"),
        "title", "link",
        F.col("description").alias("summary"),
        F.col("description"),
        F.when(content.isNull(), F.array().cast("array<struct<value:string>>"))
         .otherwise(F.array(F.struct(content.alias("value")))).alias("content"),
        F.struct(F.lit(None).cast("string").alias("value")).alias("summary_detail"),
        F.coalesce(F.transform("category", lambda c: F.struct(c.alias("term"), F.lit(None).cast("string")
                                                             .alias("label"))), empty_tags).alias("tags"),
        F.col("category"),
        F.coalesce(F.col("`dc:creator`"), F.col("author")).alias("author"),
        F.struct(F.lit(None).cast("string").alias("name")).alias("author_detail"),
        F.col("pubDate").alias("published"),
        *[c for c in ("_corrupt_record",) if c in items.columns],
    )


def fetch_all_feeds(entries: DataFrame, registry: DataFrame, seen: DataFrame | None,
                    cap: int | None = None, run_ts: str = C.DEFAULT_RUN_TS, row_id=None) -> DataFrame:
    """All feeds of all categories in registry order: cap per feed (if given), parse, drop
    entries seen before or earlier in the run (first wins in (category,
    feed_pos, entry_pos) order). ``row_id``: see ``new_articles``.

    The registry may itself be derived from data, so how it is joined is left to the planner.
    """
    reg = registry.select(F.col("category").alias("_reg_category"), "feed_pos", F.col("feed_url").alias("_feed"))
    e = (entries.join(reg, entries["feed_url"] == reg["_feed"])
         .withColumn("feed_category", F.col("_reg_category")).drop("_feed", "_reg_category"))
    return fetch_entries(e, seen, cap, run_ts, row_id)


def fetch_entries(entries: DataFrame, seen: DataFrame | None, cap: int | None = None, run_ts: str = C.DEFAULT_RUN_TS, row_id=None) -> DataFrame:
    """Entries that know their registered feed (``feed_category``, ``feed_pos``, ``entry_pos``) -> new raw articles: cap per
    feed, parse, drop what was seen before or earlier in the run."""
    if cap is not None:
        entries = IN.cap_per_feed(entries, cap, ["feed_category", "feed_url"])      # a feed's list in each category
    raw = IN.parse_entry(entries, run_ts=run_ts, keep=("page_id", "entry_pos", "feed_pos"))
    return IN.new_articles(raw, seen, order=("category", "feed_pos", "entry_pos"), row_id=row_id)


def fetch_by_category(entries: DataFrame, registry: DataFrame, category: str, seen: DataFrame | None,
                      cap: int | None = None, run_ts: str = C.DEFAULT_RUN_TS, row_id=None) -> DataFrame:
    """Feeds of one category only; an unknown category gives an empty result.
    The category filter is applied to the registry (and, through the join, to
    the entries)."""
    return fetch_all_feeds(entries, registry.filter(F.col("category") == F.lit(category)), seen, cap, run_ts, row_id)


def _xml_escape(c):
    return F.replace(F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")),
                               F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _el(name: str, c):
    return F.concat(F.lit(f"<{name}>"), _xml_escape(c), F.lit(f"</{name}>"))


def rss_item():
    """An ``<item>`` from the columns title, link, description, pubDate, category
    (array), creator, content, guid."""
    return F.concat(
        F.lit("<item>"), _el("guid", F.col("guid").cast("string")), _el("title", F.col("title")),
        _el("link", F.col("link")), _el("description", F.col("description")), _el("pubDate", F.col("pubDate")),
        F.array_join(F.transform(F.coalesce(F.col("category"), F.array().cast("array<string>")),
                                 lambda c: _el("category", c)), ""),
        _el("dc:creator", F.col("creator")), _el("content:encoded", F.col("content")), F.lit("</item>"))


def land_rss_files(items: DataFrame, path: str, feed_col: str = "feed_url", item=None) -> str:
    """Write feeds as RSS items, a directory per feed (``feed_url=...``).

    An item (``rss_item`` unless given) is a row of a text file: no feed is
    gathered in one place, and a feed of any size is written by many tasks.
    """
    items.select(feed_col, (rss_item() if item is None else item).alias("value")).write.partitionBy(feed_col).text(path)
    return path


# --- landed feeds, with positions -------------------------------------------------------

REGISTRY_ROWS = 100_000          # feeds of a registry that may be broadcast; more are joined by a shuffle
_DOCUMENT = ('<rss xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel>', "</channel></rss>")


def land_feed_documents(items: DataFrame, path: str, feed_col: str = "feed_url", order_col: str = "guid", item=None) -> str:
    """Write every feed as one RSS document with its items in order, in a directory of its own (``feed_url=...``).

    A document is streamed through one task from a sort that spills; it is never held in memory."""
    lines = items.select(feed_col, F.lit(1).alias("_part"), F.col(order_col).cast("bigint").alias("_o"), (rss_item() if item is None else item).alias("value"))
    feeds = items.select(feed_col).distinct()
    for part, text in ((0, _DOCUMENT[0]), (2, _DOCUMENT[1])):
        lines = lines.unionByName(feeds.select(feed_col, F.lit(part).alias("_part"), F.lit(0).cast("bigint").alias("_o"), F.lit(text).alias("value")))
    lines.repartition(feed_col).sortWithinPartitions(feed_col, "_part", "_o").select(feed_col, "value").write.partitionBy(feed_col).text(path)
    return path


def _registered(rows: DataFrame, registry: DataFrame, feed_col: str) -> DataFrame:
    few = registry.limit(REGISTRY_ROWS + 1).count() <= REGISTRY_ROWS
    return rows.join(F.broadcast(registry) if few else registry, feed_col)


def item_texts(spark: SparkSession, path: str, row_tag: str = "item", registry: DataFrame | None = None, feed_col: str = "feed_url") -> DataFrame:
    """The texts of items (``_xml``, without their tags' ends) with file, split, and the columns of directories; of registered feeds only, if given."""
    text = spark.read.option("lineSep", f"</{row_tag}>").text(path)
    cut = F.split(F.col("value"), f"<{row_tag}(?=[\\s>])")      # an item that was not closed becomes a piece of its own
    place = (F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("_block"))
    kept = [c for c in text.columns if c != "value"]
    lines = text.select(*kept, *place, cut.alias("_cut"))
    if registry is not None:
        lines = _registered(lines, registry.select(feed_col).distinct(), feed_col)
    pieces = F.filter(F.slice("_cut", 2, F.lit(1 << 30)), lambda x: ~x.rlike(r"^[^<>]*/>\s*$"))      # an empty element is no item
    return lines.select(*kept, "file_path", "_block", F.explode(pieces).alias("_xml"))


def scan_items(spark: SparkSession, path: str, schema: Ty.StructType = RSS_ITEM_SCHEMA, row_tag: str = "item",
               registry: DataFrame | None = None, feed_col: str = "feed_url") -> DataFrame:
    """The items of landed feed documents with their place: the fields of ``schema``, ``_corrupt_record``, ``file_path``,
    ``entry_pos`` (from 0, in each file) and the columns of partition directories.

    Files are read as text that ends at ``</item>``, so a large document is read by many tasks and a broken item costs only
    itself. Items are numbered inside the splits they were read in; the items of earlier splits of the file are counted
    and added. With a ``registry`` (``feed_url`` and any other columns), only its feeds' directories are opened: its feeds
    prune the partitions of the scan when the query runs, and its columns are added; a feed that is registered twice gives
    its items twice. The items are written once, to the shared folder."""
    lines = item_texts(spark, path, row_tag, registry, feed_col).withColumn("_n", F.monotonically_increasing_id())
    at = scratch_path(spark, "items")
    lines.write.parquet(at)
    lines = spark.read.schema(lines.schema).parquet(at)
    splits = lines.groupBy("file_path", "_block").agg(F.min("_n").alias("_first"), F.count("*").alias("_items"))
    before = Window.partitionBy("file_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_before", F.coalesce(F.sum("_items").over(before), F.lit(0)))
    numbered = lines.join(splits, ["file_path", "_block"]).withColumn("entry_pos", F.col("_n") - F.col("_first") + F.col("_before"))
    if registry is not None:
        numbered = _registered(numbered, registry, feed_col)
    parsed = F.from_xml(F.concat(F.lit(f"<{row_tag}"), F.col("_xml"), F.lit(f"</{row_tag}>")), schema,
                        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record", "ignoreSurroundingSpaces": "false"})
    own = [c for c in numbered.columns if c not in ("_xml", "_n", "_block", "_first", "_items", "_before")]
    fields = [f.name for f in schema.fields if f.name not in own]
    return numbered.withColumn("_r", parsed).select(*own, *[F.col(f"_r.`{f}`").alias(f) for f in fields])


def feed_documents(spark: SparkSession, path: str, row_tag: str = "item", roots=("rss", "feed", "rdf:RDF")) -> DataFrame:
    """``file_path, items, malformed`` for every landed document: it is malformed if an item, or the document itself, is opened and
    not closed (or the other way round), or if it has no root element. Read tag by tag, in splits; counts only are shuffled."""
    tag = F.col("value")
    opened = lambda name: F.count_if(tag.rlike(rf"<{name}(\s[^<>]*[^/<>])?$"))        # noqa: E731
    closed = lambda name: F.count_if(tag.rlike(rf"</{name}\s*$"))                      # noqa: E731
    counts = (spark.read.option("lineSep", ">").text(path).groupBy(F.col("_metadata.file_path").alias("file_path"))
              .agg(opened(row_tag).alias("items"), closed(row_tag).alias("_closed"),
                   *[opened(r).alias(f"_o{i}") for i, r in enumerate(roots)], *[closed(r).alias(f"_c{i}") for i, r in enumerate(roots)]))
    whole = F.lit(False)
    for i in range(len(roots)):
        whole = whole | ((F.col(f"_o{i}") == 1) & (F.col(f"_c{i}") == 1))
    return counts.select("file_path", "items", (~whole | (F.col("items") != F.col("_closed"))).alias("malformed"))


def with_feed_flag(items: DataFrame, documents: DataFrame) -> DataFrame:
    """``items`` with ``malformed`` of their document: it is broken itself, or one of its items is."""
    broken = items.groupBy("file_path").agg(F.bool_or(F.col("_corrupt_record").isNotNull()).alias("_bad"))
    flags = documents.join(broken, "file_path", "left").select("file_path", (F.col("malformed") | F.coalesce("_bad", F.lit(False))).alias("malformed"))
    return items.join(flags, "file_path", "left")


def scan_atom(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Landed Atom files -> one row per ``<entry>`` (see ``scan_rss``)."""
    return scan_rss(spark, paths, ATOM_ENTRY_SCHEMA, row_tag="entry")


def atom_items_to_entries(items: DataFrame, feed_url: str = "feed_url", category: str = "feed_category",
                          entry_pos: str = "entry_pos") -> DataFrame:
    """Atom entries -> RSS_ENTRY columns: link = the ``alternate`` (or first)
    href, tags = category term/label, content = ``<content>``, date =
    published else updated."""
    links = F.coalesce(F.col("link"), F.array().cast("array<struct<_href:string,_rel:string>>"))
    alt = F.filter(links, lambda l: F.coalesce(l["_rel"], F.lit("alternate")) == "alternate")
    href = F.coalesce(F.get(alt, 0)["_href"], F.get(links, 0)["_href"])
    empty_tags = F.array().cast("array<struct<term:string,label:string>>")
    return items.select(
        F.col(feed_url).alias("feed_url"), F.col(category).alias("feed_category"), F.col(entry_pos).alias("entry_pos"),
        "title", href.alias("link"), "summary",
        F.lit(None).cast("string").alias("description"),
        F.when(F.col("content").isNull(), F.array().cast("array<struct<value:string>>"))
         .otherwise(F.array(F.struct(F.col("content").alias("value")))).alias("content"),
        F.struct(F.lit(None).cast("string").alias("value")).alias("summary_detail"),
        F.coalesce(F.transform("category", lambda c: F.struct(c["_term"].alias("term"), c["_label"].alias("label"))),
                   empty_tags).alias("tags"),
        F.array().cast("array<string>").alias("category"),
        F.lit(None).cast("string").alias("author"),
        F.struct(F.col("author.name").alias("name")).alias("author_detail"),
        F.coalesce(F.col("published"), F.col("updated")).alias("published"),
        *[c for c in ("_corrupt_record",) if c in items.columns],
    )
