"""Document fingerprints of spot signatures.

A spot signature is an anchor (a very common word) with the chain of content words
that follows it, other anchors skipped. A document's fingerprint is the set of its
signatures, as sorted 32-bit hashes. Two fingerprints are compared by the Jaccard
similarity of their sets, bounded first by the sets' lengths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHAIN = 2                        # content words of a signature

# Common words of English, German, French and Spanish.
ANCHORS = ("the a an of and to in is it that was for on with as at by be this are from or not "
           "der die das und ist ein eine zu den von mit im für auf nicht sich "
           "le la les de des du un une et est en que qui dans pour pas sur "
           "el los las y no se por con su para al lo del").split()


def signatures(text: Column, chain: int = CHAIN):
    """Steps ``(name, expression)`` that lead to a column ``_set``: the sorted distinct signature hashes of ``text``.

    Words are runs of letters and digits, lower-cased. A text without a whole chain has one
    signature, its words (or, without words, itself); only an empty text has none. Steps are
    separate projections, so each is computed once.
    """
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    marked = F.filter(F.transform(F.col("_words"), lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: x["w"].isin(ANCHORS))
    content = F.filter("_words", lambda w: ~w.isin(ANCHORS))
    # the m-th anchor, at word i, stands before content word i - m
    whole = F.filter(F.transform(F.col("_marked"), lambda x, m: F.struct(x["w"].alias("w"), (x["i"] - m).alias("k"))),
                     lambda x: x["k"] + chain <= F.size("_content"))
    spots = F.transform(whole, lambda x: F.concat_ws(" ", F.array(x["w"]), F.slice(F.col("_content"), x["k"] + 1, chain)))
    lone = F.when(F.size("_words") > 0, F.array(F.concat_ws(" ", "_words"))).when(text != "", F.array(text)).otherwise(F.array().cast("array<string>"))
    hashed = F.transform(F.when(F.size("_spots") > 0, F.col("_spots")).otherwise(lone), lambda s: (F.xxhash64(s).bitwiseAND(F.lit(0xFFFFFFFF)) - F.lit(1 << 31)).cast("int"))
    return [("_words", words), ("_marked", marked), ("_content", content), ("_spots", spots), ("_set", F.array_sort(F.array_distinct(hashed)))]


def with_set(df: DataFrame, text: str, name: str, chain: int = CHAIN) -> DataFrame:
    """``df`` with the signature set of a (non-null) text column added as ``name``."""
    keep = df.columns
    for step, expression in signatures(F.col(text), chain):
        df = df.withColumn(step, expression)
    return df.select(*keep, F.col("_set").alias(name))


def as_string(a_set: str) -> Column:
    """Eight hex digits a signature, in order."""
    return F.array_join(F.transform(a_set, lambda x: F.lpad(F.lower(F.hex(x.cast("bigint") + F.lit(1 << 31))), 8, "0")), "")


def likeness(a: str, b: str, least: float = 0.0) -> Column:
    """Jaccard similarity of two sets; 1 if both are empty. Sets whose lengths alone keep it under ``least`` get 0 unseen."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(a, b))
    exact = shared / (F.size(a) + F.size(b) - shared)
    return F.when(large == 0, 1.0).when((small == 0) | (small < least * large), 0.0).otherwise(exact)


def followers(docs: DataFrame, rows_per_bucket: int = 100_000) -> DataFrame:
    """``(doc_id, prev_id, prev_chars)`` for every distinct ``doc_id`` of ``docs(doc_id, n_chars)`` but nulls: ``prev_id`` is
    the document that this one follows in descending order, round the end, ``prev_chars`` its (largest) n_chars. Ids are
    dealt to buckets by approximate quantiles, so no task holds all of them; only one row a bucket (1,000 at most)
    meets in one place."""
    from pyspark.sql import Window
    ids = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("n_chars").alias("n"))
    buckets = max(1, min(1_000, ids.count() // rows_per_bucket))
    cuts = ids.agg(F.percentile_approx("doc_id", [i / buckets for i in range(1, buckets)])).first()[0] if buckets > 1 else []
    bucket = F.size(F.filter(F.array(*map(F.lit, sorted(set(cuts)))), lambda c: c < F.col("doc_id"))) if cuts else F.lit(0)
    ids = ids.withColumn("bucket", bucket)
    after = Window.partitionBy("bucket").orderBy("doc_id")
    inside = ids.withColumn("prev_id", F.lead("doc_id").over(after)).withColumn("prev_n", F.lead("n").over(after))
    ends = ids.groupBy("bucket").agg(F.min(F.struct("doc_id", "n")).alias("lo"), F.max("doc_id").alias("hi"))
    order = Window.orderBy("bucket")
    ends = ends.select(F.col("hi").alias("end_id"), F.coalesce(F.lead("lo").over(order), F.min("lo").over(Window.partitionBy())).alias("next"))
    return (inside.join(F.broadcast(ends), F.col("doc_id") == F.col("end_id"), "left")
            .select("doc_id", F.coalesce("prev_id", "next.doc_id").alias("prev_id"), F.coalesce("prev_n", "next.n").alias("prev_chars")))


def fingerprints(docs: DataFrame, chain: int = CHAIN) -> DataFrame:
    """``docs(doc_id, text, ...)`` as ``(doc_id, text, signatures array<int>)``; null text is empty."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return with_set(rows, "text", "signatures", chain)


def near_pairs(sets: DataFrame, least: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """All documents of ``sets(doc_id, signatures)`` against each other: ``(classes, pairs)``.

    ``classes(doc_id, rep)``: for each document the smallest doc_id with an equal set. ``pairs(a, b,
    similarity)``: every two representatives, a < b, with a Jaccard similarity of ``least`` (over 0,
    under 1) or more; none is lost. Empty sets are a class without pairs, rows without a doc_id are
    left out, and of the sets of one doc_id the smallest is taken. Empty table: no rows.

    Representatives are partitioned by the length of their sets, with bounds that grow by 1/least, so
    that like sets lie in one partition or in neighbours. There, sets meet by their rarest signatures
    only: as many as one may have beyond the other, and one more. Lengths rule out pairs before
    the sets themselves are compared.
    """
    from .common import stored
    from math import log
    rows = sets.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("signatures").alias("signatures"))
    rows = stored(rows.withColumn("digest", F.sha2(as_string("signatures"), 256)), "spotsigs-sets")
    named = rows.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    classes = rows.select("doc_id", "digest").join(named, "digest").select("doc_id", "rep")
    # a hair over 1/least, so that rounding cannot put like sets two partitions apart
    step = log(1 / least) * (1 + 1e-9)
    reps = (rows.join(named.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").where(F.size("signatures") > 0)
            .select("doc_id", "signatures", F.size("signatures").alias("n")))
    said = reps.select("doc_id", "n", F.explode("signatures").alias("s"))
    common = said.groupBy("s").agg(F.count(F.lit(1)).alias("docs"))
    prefix = F.col("n") - F.ceil(F.col("n") * least - 1e-9).cast("int") + 1
    index = (said.join(common, "s").groupBy("doc_id", "n").agg(F.array_sort(F.collect_list(F.struct("docs", "s"))).alias("rare"))
             .select("doc_id", "n", F.floor(F.log("n") / step).alias("part"), F.explode(F.slice("rare", F.lit(1), prefix)["s"]).alias("s")))
    index = stored(index, "spotsigs-index")
    one = index.select("s", "part", F.col("doc_id").alias("x"), F.col("n").alias("nx"))
    two = index.select("s", F.explode(F.array("part", F.col("part") + 1)).alias("part"), F.col("part").alias("own"), F.col("doc_id").alias("y"), F.col("n").alias("ny"))
    met = (one.join(two, ["s", "part"]).where("own < part OR x < y").where(F.least("nx", "ny") >= F.greatest("nx", "ny") * least - 1e-9)
           .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    pairs = (met.join(reps.select(F.col("doc_id").alias("a"), F.col("signatures").alias("sa")), "a")
             .join(reps.select(F.col("doc_id").alias("b"), F.col("signatures").alias("sb")), "b")
             .select("a", "b", likeness("sa", "sb", least).alias("similarity")).where(F.col("similarity") >= least))
    return classes, pairs


def against_edits(docs: DataFrame, chain: int = CHAIN) -> DataFrame:
    """Each document's fingerprint beside that of its edited text and of the next document.

    The edited text has the last floor(n/2) of n code points replaced by the first as many (or
    all) of the next document by descending doc_id (after the last: the first). Of rows with one
    doc_id, the smallest text is that document for its neighbour. A null doc_id has no next: its
    text is edited with nothing, ``near_next`` is null. A lone document follows itself.
    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.
    """
    from pyspark.sql import Window

    from .common import BROADCAST_IDS, stored
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sizes = rows.select("doc_id", F.length("text").cast("bigint").alias("n_chars"))
    follow = stored(followers(sizes), "spotsigs-order")
    once, named = rows.where("doc_id IS NOT NULL"), follow.count()
    if once.count() > named:                  # several rows have one doc_id
        once = once.withColumn("_n", F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))).where("_n = 1").drop("_n")
    # a document goes to the one that it follows: as much of its text as that one takes, and its fingerprint
    sent = once.join(F.broadcast(follow) if named <= BROADCAST_IDS else follow, "doc_id")
    sent = with_set(sent, "text", "_next_set", chain).select(
        F.col("prev_id").alias("doc_id"), F.substring(F.col("text"), F.lit(1), F.floor(F.col("prev_chars") / 2).cast("int")).alias("_next"), "_next_set")
    both = rows.join(sent, "doc_id", "left").withColumn("n_chars", F.length("text").cast("bigint"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - half), F.substring(F.coalesce("_next", F.lit("")), F.lit(1), half))
    both = with_set(both.withColumn("_edited", edited), "text", "signatures", chain)
    both = with_set(both.select("doc_id", "n_chars", "signatures", "_next_set", "_edited", F.sha2("_edited", 256).alias("_hex")), "_edited", "_edited_set", chain)
    return both.select("doc_id", "n_chars", F.col("_hex").alias("edited_sha256"), as_string("signatures").alias("fingerprint"),
                       as_string("_edited_set").alias("edited_fingerprint"), likeness("signatures", "_edited_set").alias("near_edited"),
                       F.when(F.col("_next_set").isNotNull(), likeness("signatures", "_next_set")).alias("near_next"))
