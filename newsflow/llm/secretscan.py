"""Secrets in documents: candidates by pattern, false positives removed by a random forest.

Candidates are long tokens that mix letters and digits, and values assigned to a name.
A forest trained from labelled findings judges each by its length, entropy and character
transitions, the share of it that dictionary words cover, how usual its letter pairs are
in prose, the path (or source) of the document, and the words beside it. The dictionary
and the letter pairs are counted over all documents; the findings that the forest is
trained from are made of a bounded sample.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The form of a candidate, which goes on to the end of its run. (The first look-behind of ASSIGNED only tells soon where none begins.)
ASSIGNED = r"""(?<=[=:>\s"'])(?<=[A-Za-z0-9_]["']?\s?(?:=|:|=>|:=)\s?["']?)[^\s"'<>,;(){}\[\]]{8,}+"""
TOKEN = r"(?<![A-Za-z0-9+/_=.~-])(?=[A-Za-z+/_=.~-]*+[0-9])(?=[0-9+/_=.~-]*+[A-Za-z])[A-Za-z0-9+/_=.~-]{16,}+"
CANDIDATE = f"{ASSIGNED}|{TOKEN}"

CONTEXT = 48                     # characters looked at on each side
SECRET_NAMES = r"(token|secret|passw(or)?d|passwd|pwd|api[ _-]?key|apikey|access[ _-]?key|private[ _-]?key|auth|bearer|credential|signature|client[ _-]?key)"
OTHER_NAMES = r"(commit|sha-?1|sha-?256|md5|checksum|hash|digest|uuid|guid|version|revision|etag|build|example|sample|dummy|placeholder|test|id)"
EXAMPLE_PATH = r"(test|example|sample|mock|fixture|demo|docs?/)"

FIT_DOCS = 600                   # about so many documents make labelled findings (eight each)
WORD_COUNT = 2                   # times that a word stands in the documents to be in the dictionary
BROADCAST_CHARS = 4_000_000      # characters of a dictionary that may be broadcast; a larger one is joined by a shuffle
TREES, DEPTH, SEED = 24, 6, 11
THRESHOLD = 0.5

FEATURES = ["length", "entropy", "digits", "uppers", "transitions", "pair_score", "covered", "named_secret", "named_other", "assigned", "quoted",
            "example_path", "placeholder"]
CODES = "abcdefghijklmnopqrstuvwxyz0123456789"


@dataclass
class Model:
    forest: RandomForestClassificationModel
    dictionary: DataFrame        # word
    pairs: list[float]           # log frequency of each pair of CODES (others: the last code) in prose


def _share(value: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(value, pattern, "")) / F.length(value)


def _entropy(value: Column) -> Column:
    n = F.length(value)
    counts = F.transform(F.array_distinct(F.split(value, "")), lambda c: n - F.length(F.replace(value, c, F.lit(""))))
    return F.aggregate(counts, F.lit(0.0), lambda a, k: a - F.when(k > 0, k / n * F.log2(k / n)).otherwise(0.0))


def _pair_index(one: Column, two: Column) -> Column:
    # instr is 0 for characters without a code: they share one
    return F.instr(F.lit(CODES), one) * (len(CODES) + 1) + F.instr(F.lit(CODES), two) + 1


def _pair_indexes(value: Column) -> Column:
    """The index of each pair of neighbours in ``value``, in time linear in its length."""
    chars = F.split(value, "")
    return F.zip_with(F.slice(chars, 1, F.greatest(F.size(chars) - 1, F.lit(0))), F.slice(chars, 2, F.size(chars)), _pair_index)


def _pair_score(value: Column, pairs: list[float]) -> Column:
    table = F.array(*[F.lit(float(p)) for p in pairs])
    got = F.transform(_pair_indexes(F.lower(value)), lambda p: F.element_at(table, p))
    return F.when(F.length(value) > 1, F.aggregate(got, F.lit(0.0), lambda a, x: a + x) / (F.length(value) - 1)).otherwise(0.0)


def described(findings: DataFrame, dictionary: DataFrame, pairs: list[float]) -> DataFrame:
    """``findings(value, before, after, path, ...)`` with the columns of ``FEATURES`` added.

    What depends on the value alone is worked out once for each distinct value. Null
    ``before``, ``after`` and ``path`` are empty; null or empty values give no row.
    """
    findings = findings.where("length(value) > 0")
    v = F.col("value")
    values = findings.select("value").distinct()
    runs = F.array_distinct(F.regexp_extract_all(F.lower(v), F.lit(r"([\p{L}\p{M}]{3,}+)"), 1))
    few = (dictionary.agg(F.sum(F.length("word"))).first()[0] or 0) <= BROADCAST_CHARS
    known = (values.select("value", F.explode(runs).alias("word")).join(F.broadcast(dictionary) if few else dictionary, "word")
             .groupBy("value").agg(F.collect_set("word").alias("words")))
    # characters of the value that lie in dictionary words
    gone = F.aggregate(F.sort_array("words", asc=False), F.lower(v), lambda a, w: F.replace(a, w, F.lit("")))
    transitions = F.size(F.split(v, "(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Za-z])|(?<=[0-9])(?=[^0-9])|(?<=[^A-Za-z0-9])(?=[A-Za-z0-9])")) - 1
    values = values.join(known, "value", "left").select(
        "value", F.length(v).cast("double").alias("length"), _entropy(v).alias("entropy"), _share(v, "[^0-9]").alias("digits"),
        _share(v, "[^A-Z]").alias("uppers"), (transitions / F.length(v)).alias("transitions"), _pair_score(v, pairs).alias("pair_score"),
        F.coalesce(1 - F.length(gone) / F.length(v), F.lit(0.0)).alias("covered"),
        F.lower(v).rlike(r"(x{4,}|\*{3,}|\.{3,}|your|change|example|sample|dummy|placeholder|1234567|abcdef|\$\{|%\()").cast("double").alias("placeholder"))
    before, after = F.lower(F.coalesce("before", F.lit(""))), F.lower(F.coalesce("after", F.lit("")))
    near = F.regexp_extract(before, r"((?:\S+\s+){0,2}\S*\s*)$", 1)
    return (findings.join(values, "value")
            .withColumn("named_secret", near.rlike(SECRET_NAMES).cast("double"))
            .withColumn("named_other", F.concat_ws(" ", near, F.substring(after, 1, 24)).rlike(rf"\b{OTHER_NAMES}\b").cast("double"))
            .withColumn("assigned", before.rlike(r"[:=]>?\s*[\"']?$").cast("double"))
            .withColumn("quoted", (before.rlike(r"[\"']$") & after.rlike(r"^[\"']")).cast("double"))
            .withColumn("example_path", F.lower(F.coalesce("path", F.lit(""))).rlike(EXAMPLE_PATH).cast("double")))


def candidates(docs: DataFrame, path: str = "source") -> DataFrame:
    """``(doc_id, start, value, before, after, path)``: every candidate of ``docs(doc_id, text, path, ...)``; ``start`` counts code points from 0.

    Texts without one, null and empty texts give no rows."""
    text = F.col("text").cast("string")
    where = F.col(path).cast("string") if path in docs.columns else F.lit("")
    rows = docs.select("doc_id", text.alias("text"), where.alias("path"), F.regexp_extract_all(text, F.lit(f"({CANDIDATE})"), 1).alias("values")).where("size(values) > 0")
    rows = rows.withColumn("gaps", F.split("text", CANDIDATE, -1))
    sizes = F.transform("values", lambda v, i: F.length(F.get("gaps", i)) + F.length(v))
    rows = rows.withColumn("sizes", sizes).select("doc_id", "path", "gaps", "sizes", F.posexplode("values").alias("k", "value"))
    gap, after = F.get("gaps", F.col("k")), F.get("gaps", F.col("k") + 1)
    start = F.aggregate(F.slice("sizes", 1, F.col("k")), F.lit(0), lambda a, x: a + x) + F.length(gap)
    return rows.select("doc_id", start.cast("bigint").alias("start"), "value", F.substring(gap, -CONTEXT, CONTEXT).alias("before"),
                       F.substring(after, 1, CONTEXT).alias("after"), "path")


def labelled_findings(docs: DataFrame, fit_docs: int = FIT_DOCS) -> DataFrame:
    """``(value, before, after, path, label)`` from about ``fit_docs`` documents, drawn by a hash of doc_id: beside words
    of each document stand four drawn secrets in the forms in which keys come (label 1) and four findings of the kinds that
    are taken for secrets: prose, placeholders, hashes of commits and versions or paths (label 0). Fewer than four words: none."""
    sample = _sample(docs, fit_docs).select("doc_id", F.split(F.trim(F.regexp_replace("text", r"[^\p{L}]+", " ")), " ").alias("w")).where("size(w) >= 4")
    def drawn(salt: str) -> Column:
        return F.sha2(F.concat_ws(":", F.lit(salt), F.col("doc_id").cast("string")), 256)
    def word(i: int) -> Column:
        return F.get("w", F.pmod(F.xxhash64(F.lit(i), "doc_id"), F.size("w")).cast("int"))
    def one(value: Column, before: Column, after, label: int, path="src/app") -> Column:
        return F.struct(value.alias("value"), before.alias("before"), F.lit(after).alias("after") if isinstance(after, str) else after.alias("after"),
                        F.lit(path).alias("path"), F.lit(label).alias("label"))
    def pick(*names: str) -> Column:
        return F.get(F.array(*map(F.lit, names)), F.pmod(F.xxhash64(F.lit(len(names)), "doc_id"), F.lit(len(names))).cast("int"))
    names = pick("token", "secret", "password", "api_key", "access_key", "client_secret", "auth_token", "private_key", "passwd", "apiKey")
    mixed = F.replace(F.replace(F.base64(F.unhex(drawn("b"))), F.lit("="), F.lit("")), F.lit("/"), F.lit("x"))
    prose = F.concat(word(1), F.lit(" "), word(2), F.lit(" "))
    tail = F.concat(F.lit(" "), word(3), F.lit(" "), word(4))
    quote = F.concat(F.lit('" '), word(3))
    sizes = F.get(F.array(*map(F.lit, (20, 24, 32, 40, 64))), F.pmod(F.xxhash64(F.lit("n"), "doc_id"), F.lit(5)).cast("int"))
    sep = pick("_", "-", ".")
    joined = F.lower(F.concat(word(5), sep, word(6), sep, word(7), sep, word(8)))
    numbered = F.concat(joined, F.pmod(F.xxhash64(F.lit("v"), "doc_id"), F.lit(1000)).cast("string"))
    made = F.array(
        one(F.substring(drawn("a"), F.lit(1), sizes), F.concat(prose, names, F.lit(' = "')), quote, 1),
        one(F.substring(mixed, F.lit(1), F.least(sizes, F.lit(40))), F.concat(prose, names, pick(": ", "=", ' := "', " => '")), tail, 1),
        one(F.concat(pick("AKIA", "ASIA"), F.upper(F.substring(F.translate(drawn("c"), "0189abc", "GHXYZQW"), 1, 16))), prose, tail, 1),
        one(F.concat(pick("ghp_", "sk-", "xoxb-", "glpat-"), F.substring(mixed, 1, 36)), prose, tail, 1),
        one(numbered, F.concat(prose, pick("name", "title", "key", "token", "page", "file"), pick(" = ", ": ", ' = "')), tail, 0),
        one(pick("your_api_key_here1", "xxxxxxxxxxxxxxxx1234", "changeme-12345678", "example-token-0123456789", "${SECRET_TOKEN_1}", "abcdef1234567890abcdef",
                 "placeholder_password1"), F.concat(prose, names, F.lit(' = "')), quote, 0),
        one(F.substring(drawn("d"), 1, 40), F.concat(prose, pick("commit ", "sha1: ", "revision ", "checksum = ", "md5 ", "digest: ", "etag: ")), tail, 0),
        one(F.concat(pick("v1.2.", "release-2024.", "src/lib/", "build/2024/", "https//"), numbered), prose, tail, 0, "docs/example"))
    return sample.select(F.explode(made).alias("f")).select("f.*")


def _sample(docs: DataFrame, n: int) -> DataFrame:
    total = max(1, docs.count())
    return (docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(min(1, n / total) * 1_000_000) + 1)
            .select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")))


def _words(docs: DataFrame) -> DataFrame:
    """``(word, count)``: the lower-cased words of three or more letters in all documents."""
    parts = F.split(F.lower(F.col("text").cast("string")), r"[^\p{L}\p{M}\p{N}_]+")
    return docs.select(F.explode(parts).alias("word")).groupBy("word").count().where(F.col("word").rlike(r"^[\p{L}\p{M}]{3,}+$"))


def train(labelled: DataFrame, docs: DataFrame, fit_docs: int = FIT_DOCS) -> Model | None:
    """A model from ``labelled(value, before, after, path, label)``; dictionary and letter pairs come from all of ``docs``
    (``fit_docs`` bounds neither). The labelled rows are bounded by their maker; they are put in order in one task, so that
    the same rows make the same forest. None without both labels."""
    from .common import stored
    words = stored(_words(docs), "secret-words")
    dictionary = words.where(F.col("count") >= WORD_COUNT).select("word")
    counts = dict(words.select("count", F.explode(_pair_indexes(F.col("word"))).alias("p")).groupBy("p").agg(F.sum("count")).collect())
    import math
    size, total = (len(CODES) + 1) ** 2, sum(counts.values())
    pairs = [math.log((counts.get(k + 1, 0) + 0.5) / (total + 0.5 * size)) for k in range(size)]
    rows = described(labelled, dictionary, pairs).select(*FEATURES, F.col("label").cast("double").alias("label"))
    rows = stored(rows.repartition(1).sortWithinPartitions(*FEATURES, "label"), "secret-findings")
    if rows.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="features", labelCol="label")
    return Model(forest.fit(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)), dictionary, pairs)


def scan(docs: DataFrame, model: Model | None, path: str = "source", threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, start, n_chars, value, score, is_secret)``: every candidate of every document, judged.

    ``score`` is the forest's probability; without a model (nothing to learn from) it is null and
    every candidate counts as a secret. Repeated rows repeat their findings; an empty table, null
    and empty texts give none.
    """
    found = candidates(docs, path)
    if model is None:
        return found.select("doc_id", "start", F.length("value").cast("bigint").alias("n_chars"), "value", F.lit(None).cast("double").alias("score"),
                            F.lit(True).alias("is_secret"))
    rows = described(found, model.dictionary, model.pairs)
    judged = model.forest.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows))
    score = F.get(vector_to_array("probability"), 1)
    return judged.select("doc_id", "start", F.length("value").cast("bigint").alias("n_chars"), "value", score.alias("score"), (score >= threshold).alias("is_secret"))


def redact(docs: DataFrame, findings: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every value of ``findings(doc_id, value)`` replaced by ``mask`` in its document's text (and n_chars, if there, counted again).

    Documents without findings are unchanged. Findings of a null doc_id are ignored."""
    from .common import with_ids
    values = findings.groupBy("doc_id").agg(F.sort_array(F.collect_set("value"), asc=False).alias("_values"))      # one document's
    touched = with_ids(docs, values.select("doc_id"), "doc_id", "left_semi")
    clean = F.aggregate("_values", F.col("text"), lambda a, v: F.replace(a, v, F.lit(mask)))
    changed = touched.join(values, "doc_id").withColumn("text", clean)
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    rest = docs.where("doc_id IS NULL").unionByName(with_ids(docs.where("doc_id IS NOT NULL"), values.select("doc_id"), "doc_id", "left_anti"))
    return changed.select(*docs.columns).unionByName(rest.select(*docs.columns))
