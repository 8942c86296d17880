"""Language identification, words first.

A word seen in training scores its log frequency in every language. An unseen
word falls back to the character 4-grams of the word (with its ends marked), or,
where none of them is known, to 3-grams, 2-grams and single characters.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import bounded_batches

FIT_DOCS = 8_000                 # about so many labelled documents are learned from
MAX_LANGS, MAX_WORDS, MAX_GRAMS = 200, 150_000, 100_000      # the most frequent ones make the model
ORDERS = (4, 3, 2, 1)
CACHED = 200_000                 # words whose scores a task keeps at hand
WORD = re.compile(r"[^\W\d_]+")
SMOOTH = 0.5


def _grams(word: str, n: int) -> list[str]:
    w = f"<{word}>" if n > 1 else word
    return [w[i:i + n] for i in range(len(w) - n + 1)]


def _counts(batches):
    for b in W.slices(batches, "text", W.SMALL):
        seen: dict[str, Counter] = {}
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True):
            seen.setdefault(lang, Counter()).update(WORD.findall(text.lower()))
        rows = []
        for lang, words in seen.items():
            for n in ORDERS:
                grams = Counter()
                for w, c in words.items():
                    for g in _grams(w, n):
                        grams[g] += c
                rows += [(lang, n, g, c) for g, c in grams.items()]
            rows += [(lang, 0, w, c) for w, c in words.items()]
        cols = list(zip(*rows, strict=True)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.string()),
                                          pa.array(cols[3], pa.int64())], ["lang", "n", "gram", "c"])


def fit(docs: DataFrame, fit_docs: int = FIT_DOCS) -> dict:
    """A model from about ``fit_docs`` rows of ``docs(doc_id, text, lang)``, drawn by a hash of doc_id.

    Every language gets an equal share of the sample, or all its documents if it
    has fewer. The model is bounded by ``MAX_LANGS``, ``MAX_WORDS`` and ``MAX_GRAMS``.
    Null lang or text: not learned from. Nothing to learn from: a model without languages.
    """
    bounded_batches(docs.sparkSession)
    docs = docs.where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = docs.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGS).collect()
    langs = sorted(r["lang"] for r in sizes)
    if not langs:
        return {"langs": [], "tables": {}}
    share = max(1, fit_docs // len(langs))
    keep = F.lit(False)
    for r in sizes:
        keep = keep | ((F.col("lang") == r["lang"]) & (F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * min(1, share / r["count"]) + 1)))
    counts = (docs.where(keep).select("lang", "text").mapInArrow(_counts, "lang string, n int, gram string, c bigint")
              .groupBy("n", "gram").agg(F.sum("c").alias("all"), *[F.sum(F.when(F.col("lang") == v, F.col("c"))).alias(f"c{i}") for i, v in enumerate(langs)]))
    tables = {}
    for n in (0, *ORDERS):
        rows = (counts.where((F.col("n") == n) & (F.col("all") >= 2)).orderBy(F.desc("all"), "gram").limit(MAX_WORDS if n == 0 else MAX_GRAMS).drop("n", "all")
                .toPandas().sort_values("gram"))
        c = rows.iloc[:, 1:].fillna(0).to_numpy(np.float64) + SMOOTH
        tables[n] = (rows["gram"].tolist(), np.log(c / c.sum(axis=0)).astype(np.float32) if len(rows) else c)
    return {"langs": langs, "tables": tables}


class Scorer:
    def __init__(self, model: dict):
        self.langs = model["langs"]
        self.grams = {n: dict(zip(g, m, strict=True)) for n, (g, m) in model["tables"].items() if n}
        self.words, table = model["tables"].get(0, ([], np.zeros((0, 0))))
        self.table = np.vstack([table, np.zeros((CACHED, len(self.langs)), np.float32)]) if self.langs else table
        self.fresh()

    def fresh(self) -> None:
        self.row = {w: i for i, w in enumerate(self.words)}
        self.free = len(self.words)

    def unseen(self, word: str) -> np.ndarray:
        for n in ORDERS:
            known = [g for g in map(self.grams[n].get, _grams(word, n)) if g is not None]
            if known:
                return np.mean(known, axis=0)
        return np.zeros(len(self.langs), np.float32)

    def __call__(self, text: str | None) -> tuple[str, float]:
        words = WORD.findall(text.lower()) if text else []
        if not self.langs or not any(c.isalpha() for w in words for c in w):      # fractions and raised digits are no letters
            return "und", 0.0
        total = np.zeros(len(self.langs))
        for at in range(0, len(words), CACHED // 2):
            part = words[at:at + CACHED // 2]
            if self.free + len(part) > len(self.table):
                self.fresh()
            rows = list(map(self.row.get, part))
            if None in rows:
                for i, r in enumerate(rows):
                    if r is None:
                        w = part[i]
                        r = self.row.get(w)
                        if r is None:
                            r = self.row[w] = self.free
                            self.table[r] = self.unseen(w)
                            self.free += 1
                        rows[i] = r
            total += self.table[rows].sum(axis=0, dtype=np.float64)
        best = int(np.argmax(total))
        return self.langs[best], float(1 / np.exp(total - total[best]).sum())


def predict(docs: DataFrame, model: dict, lang_column: str = "lang_pred", score_column: str = "score") -> DataFrame:
    """``docs(doc_id, text, ...)`` with ``lang_pred string`` and ``score double`` added (columns of these names are replaced).

    ``lang_pred`` is the language with the highest sum of scores, the first by name
    if several have it; ``score`` is its share of the languages' likelihoods (0 to 1).
    Null text or text without a letter: ``und`` with score 0. Nothing but ``text`` is looked at.
    """
    docs = docs.drop(lang_column, score_column)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    text = next(f.name for f in docs.schema.fields if f.name == "text")

    def run(batches):
        scorer = Scorer(sent.value)
        for b in W.slices(batches, text, W.SMALL):
            got = [scorer(t) for t in b.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                                             [*b.schema.names, lang_column, score_column])

    from pyspark.sql.types import DoubleType, StringType, StructType
    schema = StructType([*docs.schema.fields]).add(lang_column, StringType()).add(score_column, DoubleType())
    return docs.mapInArrow(run, schema)
