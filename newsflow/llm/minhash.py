"""Near-duplicate documents by fast similarity sketching.

A document's set (distinct word shingles, as 64-bit hashes) is sketched into
``bands * rows`` bins: in round i every element is thrown into one hashed bin,
bins that stay empty wait for the next round, and from round t on every element
goes to bin i - t, so that after 2t rounds every bin is full. Large sets need
one round. Equal bands make candidates, which are confirmed on the full sets.

Equal sets are folded into one class first. A class then has to be compared
with the smallest class of a shared band only (one pair a class). Where members
of a band still lie in different components, they are compared with a drawn
member of the band, a few times over, and what is then still apart is compared
in pairs across components. Before the full sets are read for that, such a pair
has to pass a bound: each bin that holds an odd number of one set's elements and
an even number of the other's has an element that only one of them has. So a
group of thousands of copies costs a few comparisons each, documents that are
only somewhat like all of them are ruled out by words of bits, and no pair that
could join two components is left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import bounded_batches, stored, with_ids
from .graph import components

TURNS = 3                        # times that members of a band are compared with a drawn one before all are
BITS = 2048                      # bins of the parities that rule out pairs (more elements than bins: they rule out less)
BANDS, ROWS = 40, 6              # a pair of similarity 0.8 shares no band with probability 5e-6
_PARITIES = [f"w{i}" for i in range(BITS // 64)]
_U = np.uint64


def shingle_sets(texts: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, concatenated, and where each text's begin.

    Fewer words than ``shingle``: the whole sequence counts as one. No words: empty.
    """
    h, _, _, off = W.word_spans(texts, W.SPACED)
    acc = np.zeros(max(0, len(h) - shingle + 1), np.uint64)
    for j in range(shingle):
        acc = W.mix(acc + h[j:j + len(acc)] * W.SEEDS[j])
    sets = []
    for a, b in zip(off[:-1], off[1:], strict=True):
        if b - a >= shingle:
            x = np.sort(acc[a:b - shingle + 1])
            keep = np.ones(len(x), bool)
            keep[1:] = x[1:] != x[:-1]
            sets.append(x[keep])
        elif b > a:
            x = np.array([b - a], np.uint64)
            for v in h[a:b, None]:
                x = W.mix(x + v * W.SEEDS[9])
            sets.append(x)
        else:
            sets.append(h[:0])
    starts = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int64)
    return (np.concatenate(sets) if sets else h[:0]), starts


def sketches(h: np.ndarray, starts: np.ndarray, t: int) -> np.ndarray:
    """The t bins of every non-empty set, as a matrix."""
    n = len(starts) - 1
    bins = np.full(n * t, np.iinfo(np.uint64).max, np.uint64)
    full = np.zeros(n * t, bool)
    doc = np.repeat(np.arange(n), np.diff(starts))
    active = np.arange(n)
    for i in range(2 * t):
        v = W.mix(h ^ W.SEEDS[16 + i])
        to = (W.mix(v ^ W.SEEDS[10]) % _U(t)).astype(np.int64) if i < t else i - t
        cell = doc * t + to
        free = ~full[cell]
        cell = cell[free]
        np.minimum.at(bins, cell, v[free])
        full[cell] = True
        active = active[~full.reshape(n, t)[active].all(axis=1)]
        if not len(active):
            break
        left = np.zeros(n, bool)
        left[active] = True
        left = left[doc]
        h, doc = h[left], doc[left]
    return bins.reshape(n, t)


def _signatures(shingle: int, bands: int, rows: int):
    def run(batches):
        for b in W.slices(batches, "text", W.SMALL):
            h, starts = shingle_sets(b.column("text"), shingle)
            size = np.diff(starts)
            some = np.flatnonzero(size)
            one, two = np.zeros(len(size), np.uint64), np.zeros(len(size), np.uint64)
            keys = np.zeros((len(some), bands), np.uint64)
            if len(some):
                at = starts[:-1][some]
                one[some] = np.add.reduceat(W.mix(h ^ W.SEEDS[11]), at)
                two[some] = np.add.reduceat(W.mix(h ^ W.SEEDS[12]), at)
                bins = sketches(h, np.append(at, len(h)), bands * rows).reshape(len(some), bands, rows)
                keys += np.arange(bands, dtype=np.uint64)
                for r in range(rows):
                    keys = W.mix(keys * W.SEEDS[13] + bins[:, :, r])
            lengths = np.where(size > 0, bands, 0)
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(size.astype(np.int64)), pa.array(W.signed(one)), pa.array(W.signed(two)),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(W.signed(keys.reshape(-1))))],
                ["doc_id", "n", "s1", "s2", "bands"])
    return run


def _sets(shingle: int):
    def run(batches):
        for b in W.slices(batches, "text", W.SMALL):
            h, starts = shingle_sets(b.column("text"), shingle)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(W.signed(h)))],
                ["id", "members"])
    return run


def _parities(shingle: int):
    """For every text the parity of its number of elements in each of ``BITS`` hashed bins."""
    def run(batches):
        for b in W.slices(batches, "text", W.SMALL):
            h, starts = shingle_sets(b.column("text"), shingle)
            size = np.diff(starts)
            words = np.zeros((len(size), BITS // 64), np.int64)
            for at in range(0, len(size), 256):
                to = min(at + 256, len(size))
                cell = np.repeat(np.arange(to - at), size[at:to]) * BITS + (W.mix(h[starts[at]:starts[to]] ^ W.SEEDS[14]) % _U(BITS)).astype(np.int64)
                odd = np.bincount(cell, minlength=(to - at) * BITS).astype(np.uint8) & 1
                words[at:to] = np.packbits(odd).view(np.int64).reshape(to - at, -1)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(size.astype(np.int64)), *map(pa.array, words.T.copy())],
                                             ["rep", "n", *_PARITIES])
    return run


def _confirmed(docs: DataFrame, pairs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The ``pairs(a, b)`` whose full sets have 100 * intersection >= percent * union."""
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    sets = stored(with_ids(docs, ids, "doc_id", "left_semi")
                  .mapInArrow(_sets(shingle), "id bigint, members array<bigint>"), "minhash-sets")
    one = sets.select(F.col("id").alias("a"), F.col("members").alias("ma"))
    two = sets.select(F.col("id").alias("b"), F.col("members").alias("mb"))
    shared = F.size(F.array_intersect("ma", "mb"))
    return (pairs.join(one, "a").join(two, "b")
            .where(F.lit(100) * F.least(F.size("ma"), F.size("mb")) >= F.lit(percent) * F.greatest(F.size("ma"), F.size("mb")))
            .select("a", "b", (F.size("ma") + F.size("mb")).alias("both"), shared.alias("shared"))
            .where(F.lit(100) * F.col("shared") >= F.lit(percent) * (F.col("both") - F.col("shared")))
            .select("a", "b").distinct())


def _undecided(members: DataFrame, part: DataFrame) -> DataFrame:
    """The members of bands that lie in several components: ``key, rep, n, component``."""
    placed = (members.select("key", "rep", "n").join(part.withColumnRenamed("id", "rep"), "rep", "left")
              .withColumn("component", F.coalesce("component", "rep")))
    mixed = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
    return placed.join(mixed, "key").select("key", "rep", "n", "component").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row for each row of ``docs(doc_id, text, ...)``.

    Words are runs of anything but ASCII white space, A-Z lower-cased. Documents
    with a Jaccard similarity of at least ``similarity`` are linked;
    ``component_id`` is the smallest doc_id reachable. Null or blank text: an empty
    set, linked with nothing. Rows with one doc_id count as one document. A null
    doc_id joins the class of its equal texts, but links no others; alone its
    component is null and it is kept. Empty table: no rows.
    """
    bounded_batches(docs.sparkSession)
    percent = round(similarity * 100)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sig = stored(docs.mapInArrow(_signatures(shingle, bands, rows), "doc_id bigint, n bigint, s1 bigint, s2 bigint, bands array<bigint>"),
                 "minhash-signatures")
    classes = sig.where("n > 0").groupBy("s1", "s2").agg(F.min("doc_id").alias("rep")).where("rep IS NOT NULL")
    buckets = (sig.where("n > 0").join(classes.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
               .select(F.col("doc_id").alias("rep"), "n", F.explode("bands").alias("key")))
    shared = buckets.groupBy("key").agg(F.min("rep").alias("center"), F.max("rep").alias("last")).where("center < last")
    members = stored(buckets.join(shared.select("key", "center"), "key"), "minhash-buckets")
    first = (members.where("rep <> center").groupBy("rep").agg(F.min("center").alias("center"))
             .select(F.col("center").alias("a"), F.col("rep").alias("b")))
    first = stored(first, "minhash-pairs")
    links = stored(_confirmed(docs, first, shingle, percent), "minhash-links")
    part = components(links)

    tested = first
    for turn in range(TURNS):                 # every member of another component against one drawn member of the band
        rest = stored(_undecided(members, part), "minhash-rest")
        if rest.isEmpty():
            break
        drawn = rest.groupBy("key").agg(F.min(F.struct(F.xxhash64("rep", F.lit(turn)).alias("h"), "rep", "n", "component")).alias("c"))
        other = drawn.select("key", F.col("c.rep").alias("b"), F.col("c.n").alias("nb"), F.col("c.component").alias("cb"))
        pairs = (rest.select("key", F.col("rep").alias("a"), F.col("n").alias("na"), F.col("component").alias("ca")).join(other, "key")
                 .where("ca <> cb")
                 .where(F.lit(100) * F.least("na", "nb") >= F.lit(percent) * F.greatest("na", "nb"))
                 .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        pairs = stored(pairs.join(tested, ["a", "b"], "left_anti"), "minhash-pairs")
        more = stored(_confirmed(docs, pairs, shingle, percent), "minhash-links")
        tested = tested.union(pairs)
        if not more.isEmpty():
            links = links.union(more)
            part = components(links)

    rest = stored(_undecided(members, part), "minhash-rest")
    if not rest.isEmpty():                    # and what is left against all members of other components that the parities don't rule out
        parities = stored(with_ids(docs, rest.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
                          .mapInArrow(_parities(shingle), "rep bigint, n bigint, " + ", ".join(f"{w} bigint" for w in _PARITIES)), "minhash-parities")
        rest = rest.join(parities, ["rep", "n"])
        one, two = (rest.select("key", *[F.coalesce(c, F.lit(0)).alias(f"{c}_{side}") for c in ("rep", "n", "component", *_PARITIES)]) for side in "ab")
        differ = F.expr(" + ".join(f"bit_count({w}_a ^ {w}_b)" for w in _PARITIES))
        both = F.col("n_a") + F.col("n_b")
        pairs = (one.join(two, "key").where("rep_a < rep_b AND component_a <> component_b")
                 .where(F.lit(100) * F.least("n_a", "n_b") >= F.lit(percent) * F.greatest("n_a", "n_b"))
                 .where(F.lit(100 + percent) * (both - differ) >= F.lit(2 * percent) * both)
                 .select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct())
        pairs = stored(pairs.join(tested, ["a", "b"], "left_anti"), "minhash-pairs")
        more = stored(_confirmed(docs, pairs, shingle, percent), "minhash-links")
        if not more.isEmpty():
            part = components(links.union(more))

    named = (classes.join(part.withColumnRenamed("id", "rep"), "rep", "left")
             .select("s1", "s2", F.coalesce("component", "rep").alias("component_id")))
    out = sig.select("doc_id", "n", "s1", "s2").join(named, ["s1", "s2"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))
