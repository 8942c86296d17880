"""Summary stage: batching, prompts, the (pluggable) summariser, reply parsing,
attaching summaries back to articles, fallback and batch statistics.

The reference asks a remote chat model for summaries, 20 articles per call.
Here the call is a pluggable, Arrow-batched stage:

* default (deterministic, offline): the *lead* of the article -- its first
  175 words. For a batch it builds the reply a model would send (the leads
  joined by the separator), so the reply parser and its quirks (blank replies
  dropped, later summaries shifting up one slot) are exercised. This is a
  stand-in, not the model's output.
* hook: ``summarize_fn(prompts: pd.Series) -> pd.Series`` of reply texts, run
  with ``mapInPandas`` over one row per batch.

Batches never cross files: batch = floor((position in file - 1) / 20). The
position in file is computed without a window over the whole file
(``dense_position``), so one huge run file is still numbered by many tasks.
"""

from __future__ import annotations

import re
from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from .. import config as C
from ..functions import text as T
from ..functions.udf import series_udf

# --- fixed values: prompt and message formats --------------------------------
TARGET_WORDS = (C.SUMMARY_WORDS + C.SUMMARY_WORDS) // 2

BATCH_HEADER = (
    "Create news summaries for the following {n} articles. Each summary must be EXACTLY {w} words.\n"
    "\n"
    "IMPORTANT INSTRUCTIONS:\n"
    "- Create exactly {w} words for each summary\n"
    "- Separate each summary with '---SUMMARY_SEPARATOR---'\n"
    "- Maintain the same order as the articles below\n"
    "- Be objective and factual\n"
    "- Start directly with content (no introductory phrases)\n"
    "\n"
)
BATCH_BLOCK = "\nARTICLE {i}:\nTitle: {title}\nContent: {content}\n\n"
BATCH_FOOTER = ("\nNow provide exactly {w} words for each of the {n} articles above, "
                "separated by '---SUMMARY_SEPARATOR---':")
_I = " " * 12
SINGLE_PROMPT = (
    "\n"
    f"{_I}Create a news summary that is EXACTLY {{w}} words long. Count your words carefully.\n"
    "\n"
    f"{_I}Title: {{title}}\n"
    "\n"
    f"{_I}Content: {{content}}\n"
    "\n"
    f"{_I}Requirements:\n"
    f"{_I}- EXACTLY {{w}} words (no more, no less)\n"
    f"{_I}- Capture the main points and key information\n"
    f"{_I}- Be objective and factual\n"
    f"{_I}- Use clear, readable language\n"
    f"{_I}- Do not include any introductory phrases like \"This article discusses\" or \"The summary is\"\n"
    f"{_I}- Start directly with the content\n"
    "\n"
    f"{_I}Write your {{w}}-word summary:\n"
    f"{_I}"
)


def _fmt(template: str, **cols) -> F.Column:
    """Fill a ``{name}`` template with columns (``format_string`` on %s)."""
    t = template.replace("%", "%%")
    out, args, i = "", [], 0
    for m in re.finditer(r"\{(\w+)\}", t):
        out += t[i:m.start()] + "%s"
        args.append(cols[m.group(1)])
        i = m.end()
    out += t[i:]
    return F.format_string(out, *args)


def dense_position(df: DataFrame, group: str, pos_col: str, width: int = 4096) -> DataFrame:
    """Add ``_rn``: the 1-based position of each row in ``group`` ordered by
    the integer ``pos_col`` -- without a window over a whole group. Rows with one
    position are ordered by a hash of their values; each keeps a number of its own.

    Positions are cut into ranges of ``width`` values, rows are counted per
    (group, range) with a map-side combined aggregate, the counts are
    prefix-summed per group on that small table, and a ``row_number`` inside each
    (group, range) adds the rest. So a group with a third of all rows is spread
    over many tasks; only rows that share a range of positions meet.
    """
    rows = df.withColumn("_chunk", F.floor(F.col(pos_col) / width).cast("bigint"))
    counts = rows.groupBy(group, "_chunk").agg(F.count(F.lit(1)).alias("_c"))
    wo = Window.partitionBy(group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_c").over(wo), F.lit(0))).drop("_c")
    tie = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, Ty.MapType)])
    wi = Window.partitionBy(group, "_chunk").orderBy(pos_col, tie)
    same = [F.col("l." + c).eqNullSafe(F.col("o." + c)) for c in (group, "_chunk")]
    joined = rows.alias("l").join(offsets.alias("o"), same).select("l.*", "o._off")
    return joined.withColumn("_rn", F.row_number().over(wi) + F.col("_off")).drop("_chunk", "_off")


def summary_batches(articles: DataFrame, file_col: str = "source_file", pos_col: str = "pos",
                    size: int = C.SUMMARY_BATCH) -> DataFrame:
    """Add ``batch_id`` (0-based per file) and ``slot`` (1..size) in file order
    (``pos_col`` is an integer position)."""
    return (dense_position(articles, file_col, pos_col)
            .withColumn("batch_id", F.floor((F.col("_rn") - 1) / size).cast("bigint"))
            .withColumn("slot", (((F.col("_rn") - 1) % size) + 1).cast("int")).drop("_rn"))


def batch_prompt(batched: DataFrame, file_col: str = "source_file", content_cap: int = C.BATCH_CONTENT_CHARS
                 ) -> DataFrame:
    """One prompt per (file, batch): header, numbered ``ARTICLE i`` blocks with
    content capped at 1,500 chars + ``...``, footer; plus the token budget
    ``int(175 * n * 1.5)``. Groups hold at most 20 rows."""
    block = _fmt(BATCH_BLOCK, i=F.col("slot").cast("string"), title=F.coalesce(F.col("title"), F.lit("")),
                 content=T.truncate_ellipsis("coalesce(content, '')", content_cap))
    g = (batched.select(file_col, "batch_id", F.struct("slot", block.alias("block")).alias("b"))
         .groupBy(file_col, "batch_id")
         .agg(F.array_sort(F.collect_list("b")).alias("bs")))
    n = F.size("bs").cast("string")
    w = F.lit(str(TARGET_WORDS))
    prompt = F.concat(_fmt(BATCH_HEADER, n=n, w=w), F.array_join(F.transform("bs", lambda x: x["block"]), ""),
                      _fmt(BATCH_FOOTER, n=n, w=w))
    return g.select(file_col, "batch_id", F.size("bs").cast("int").alias("expected_count"),
                    prompt.alias("prompt"),
                    F.floor(F.lit(TARGET_WORDS) * F.size("bs") * F.lit(1.5)).cast("bigint").alias("max_tokens"))


def single_prompt(articles: DataFrame, content_cap: int = C.SINGLE_CONTENT_CHARS) -> DataFrame:
    """Per-article prompt (content capped at 3,000 + ``...``), budget int(175*1.5)."""
    p = _fmt(SINGLE_PROMPT, w=F.lit(str(TARGET_WORDS)), title=F.coalesce(F.col("title"), F.lit("")),
             content=T.truncate_ellipsis("coalesce(content, '')", content_cap))
    return articles.withColumn("prompt", p).withColumn("max_tokens", F.lit(int(TARGET_WORDS * 1.5)).cast("bigint"))


def default_batch_reply(batched: DataFrame, file_col: str = "source_file") -> DataFrame:
    """The built-in summariser's reply for each batch: leads joined by the
    separator in slot order (``response``), with ``expected_count``."""
    lead = T.lead_words(F.col("content"), TARGET_WORDS)
    g = (batched.select(file_col, "batch_id", F.struct("slot", lead.alias("s")).alias("x"))
         .groupBy(file_col, "batch_id").agg(F.array_sort(F.collect_list("x")).alias("xs")))
    return g.select(file_col, "batch_id", F.size("xs").cast("int").alias("expected_count"),
                    F.array_join(F.transform("xs", lambda x: x["s"]), "\n" + C.SUMMARY_SEPARATOR + "\n")
                    .alias("response"))


def hook_batch_reply(prompts: DataFrame, summarize_fn: Callable[[pd.Series], pd.Series]) -> DataFrame:
    """Replies from a user model: ``mapInPandas`` over one row per batch; a
    raised error is recorded in ``error`` so the fallback path can retry."""
    schema = Ty.StructType(list(prompts.schema.fields) + [Ty.StructField("response", Ty.StringType()),
                                                          Ty.StructField("error", Ty.StringType())])

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            try:                                          # one call for the whole Arrow batch ...
                pdf["response"] = list(summarize_fn(pdf["prompt"].reset_index(drop=True)))
                pdf["error"] = None
            except Exception:                             # noqa: BLE001
                resp, err = [], []                        # ... else one call per summary batch, so a
                for p in pdf["prompt"]:                   # failure only affects its own 20 articles
                    try:
                        resp.append(list(summarize_fn(pd.Series([p])))[0])
                        err.append(None)
                    except Exception as e:                # noqa: BLE001
                        resp.append(None)
                        err.append(str(e) or type(e).__name__)
                pdf["response"], pdf["error"] = resp, err
            yield pdf

    return prompts.mapInPandas(run, schema)


def parse_replies(replies: DataFrame, file_col: str = "source_file") -> DataFrame:
    """Batch replies -> one row per slot: ``(file, batch_id, slot, ai_summary)``."""
    parsed = T.parse_batch_response(F.col("response"), F.col("expected_count"))
    return replies.select(file_col, "batch_id", F.posexplode(parsed).alias("p", "ai_summary")).select(
        file_col, "batch_id", (F.col("p") + 1).cast("int").alias("slot"), "ai_summary")


def attach_summaries(batched: DataFrame, summaries: DataFrame, file_col: str = "source_file") -> DataFrame:
    """Summary j of a batch goes to the article in slot j; a blank summary
    leaves ``ai_summary`` unset (NULL). Equi-join on (file, batch, slot)."""
    s = summaries.withColumn("ai_summary", F.when(F.col("ai_summary") != "", F.col("ai_summary")))
    return batched.join(s, [file_col, "batch_id", "slot"], "left")


def summarize(articles: DataFrame, file_col: str = "source_file", pos_col: str = "pos",
              summarize_fn: Callable[[pd.Series], pd.Series] | None = None,
              single_fn: Callable[[pd.Series], pd.Series] | None = None) -> DataFrame:
    """Fill ``ai_summary`` for every article: by default its lead; with a model, batch
    by batch, then article by article for batches whose call raised (this adds
    ``batch_id`` and ``slot``)."""
    if summarize_fn is None:                     # the lead of each article: a projection
        return articles.withColumn("ai_summary", F.nullif(T.lead_words("content", TARGET_WORDS), F.lit("")))
    from ..session import scratch_path
    batched = summary_batches(articles, file_col, pos_col)
    # written once: the model sees each batch once, whatever reads the replies
    path, replies = scratch_path(articles.sparkSession, "replies"), hook_batch_reply(batch_prompt(batched, file_col), summarize_fn)
    replies.write.parquet(path)
    replies = articles.sparkSession.read.schema(replies.schema).parquet(path)
    ok = parse_replies(replies.filter(F.col("error").isNull()), file_col)
    out = attach_summaries(batched, ok, file_col)
    failed = replies.filter(F.col("error").isNotNull()).select(file_col, "batch_id")
    return summary_fallback(out, failed, single_fn or summarize_fn, file_col)


def summary_fallback(summarized: DataFrame, failed_batches: DataFrame,
                     single_fn: Callable[[pd.Series], pd.Series] | None, file_col: str = "source_file") -> DataFrame:
    """Second pass over the articles of failed batches: per-article prompts
    through ``single_fn`` (default: the lead); results fill ``ai_summary``."""
    redo = summarized.join(failed_batches, [file_col, "batch_id"], "left_semi")
    keep = summarized.join(failed_batches, [file_col, "batch_id"], "left_anti")
    if single_fn is None:
        fixed = redo.withColumn("ai_summary", F.nullif(T.lead_words("content"), F.lit("")))
    else:
        udf = series_udf(single_fn, "string")
        fixed = single_prompt(redo).withColumn("_r0", udf(F.col("prompt"))).withColumn("_r", T.strip("_r0"))
        fixed = fixed.withColumn("ai_summary", F.when(F.col("_r") != "", F.col("_r"))).drop(
            "_r", "_r0", "prompt", "max_tokens")
    return keep.unionByName(fixed)


def summary_stats(parsed: DataFrame, file_col: str = "source_file") -> DataFrame:
    """Per batch: slots, total words of the non-blank summaries, and the
    average over *all* slots (blanks included)."""
    return (parsed.groupBy(file_col, "batch_id")
            .agg(F.count(F.lit(1)).alias("summaries"), F.sum(T.word_count("ai_summary")).alias("total_words"))
            .withColumn("avg_words", F.round(F.col("total_words") / F.col("summaries"), 6)))
