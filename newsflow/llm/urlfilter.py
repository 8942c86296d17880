"""URL filtering by host and path rules, looked up by short hash prefixes.

Every distinct (host, path) is expanded into expressions: each suffix of the host
at a dot with each prefix of the path of a length that some rule has. Expressions
meet rules by an equi-join on the first bytes of their digests; the full digests
confirm, and the longest rule wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX = 8                       # hex digits of a digest that are joined on
BROADCAST_RULES = 100_000        # rules that may be broadcast; more are joined by a shuffle
DEFAULT = "allow"                # verdict for urls that no rule fits

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://``, A-Z lower-cased) and path of a url; both empty if there is no ``://``."""
    rest = F.when(F.locate("://", url) > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """``pages(url, ...)`` with ``host, path, rule, verdict`` added (columns of these names are replaced).

    ``rules(host, path, verdict)``: a rule fits its host and all subdomains if the
    url's path starts with the rule's. The longest rule (characters of host and path)
    wins, then the longer host, then ``block``. No rule: ``rule`` null, verdict ``default``.
    Null urls and urls without ``://``: host and path empty. Null parts of rules count as
    empty; repeated rules and rows are fine. No rules: all default. Empty table: no rows.
    """
    rules = rules.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("host", "path", "verdict")]).distinct()
    lengths = [r[0] for r in rules.select(F.length("path")).distinct().orderBy(F.length("path")).collect()]      # no more than the longest path
    lookup = rules.select(F.sha2(F.concat_ws("\n", "host", "path"), 256).alias("digest"), F.concat("host", "path").alias("rule"),
                          F.length("host").alias("host_length"), "verdict")
    lookup = lookup.withColumn("prefix", F.substring("digest", 1, PREFIX))
    if lookup.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES:
        lookup = F.broadcast(lookup)

    host, path = host_path(F.col("url"))
    rows = pages.drop("host", "path", "rule", "verdict").withColumn("host", host).withColumn("path", path)
    if not lengths:
        return rows.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(default))
    parts = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    prefixes = F.array_distinct(F.transform(F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length("path")),
                                            lambda n: F.substring(F.col("path"), F.lit(1), n)))
    made = F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: F.concat_ws("\n", h, p))))
    seen = (rows.select("host", "path").distinct()
            .select("host", "path", F.explode(made).alias("expression"))
            .withColumn("full", F.sha2("expression", 256)).drop("expression").withColumn("prefix", F.substring("full", 1, PREFIX)))
    best = F.max_by(F.struct("rule", "verdict"), F.struct(F.length("rule"), "host_length", F.col("verdict") == "block", "rule", "verdict"))
    fits = (seen.join(lookup, "prefix").where("full = digest").groupBy("host", "path").agg(best.alias("best")))
    return (rows.join(fits, ["host", "path"], "left")
            .select(*[rows[c] for c in rows.columns], F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))
