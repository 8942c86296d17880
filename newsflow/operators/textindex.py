"""A stored text index with bounded evaluation.

Documents are embedded once (the hashed bag of words of ``embed``) and written as an
inverted index. They are dealt into blocks of documents that are alike in category and
vector length; a posting list is a row for a bucket and a block: the documents' places
in the block, their counts, and the largest weight (count over length) among them. The
lists are partitioned by bucket and sorted by it, so a search reads its own buckets.

A search is exact and scores few blocks:

1. from the largest weights alone, each (query, block) gets a bound that no score in
   the block exceeds; pairs under the threshold are left out;
2. the few best blocks of a query are scored, which gives a lower bound of its n-th score;
3. of the other pairs only those whose bound reaches that score are scored.

Lists are shuffled by block (at most ``BLOCK_DOCS`` documents) for the wanted buckets and
the wanted blocks only; a task scores one block at a time against the queries that want
it. The query vectors travel with the tasks, ``GROUP`` queries at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as Ty
from pyspark.sql.pandas.types import to_arrow_type

from .. import config as C
from ..session import scratch_path
from ..sinks.versions import VersionedTable
from .embed import embed_rows, embed_sparse

BLOCK_DOCS = 64                  # documents of a block
PART_BUCKETS = 32                # buckets of a partition
HEADS = -1                       # the partition (and bucket) of the blocks' ids and lengths
GROUP = 2048                     # queries that are searched together
SEEDS = 4                        # blocks of a query that are scored first
SLACK = 1e-9                     # scores closer than this count as equal


def _postings_schema(id_type: Ty.DataType) -> Ty.StructType:
    ints, doubles = Ty.ArrayType(Ty.IntegerType()), Ty.ArrayType(Ty.DoubleType())
    return Ty.StructType([Ty.StructField(n, t) for n, t in (
        ("part", Ty.IntegerType()), ("batch", Ty.IntegerType()), ("bucket", Ty.IntegerType()), ("block", Ty.LongType()), ("category", Ty.StringType()),
        ("top", Ty.DoubleType()), ("places", ints), ("counts", ints), ("ids", Ty.ArrayType(id_type)), ("norms", doubles))])


def _arrow_schema(schema: Ty.StructType) -> pa.Schema:
    return pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema.fields])


def _blocks(batch: int, schema: Ty.StructType, block_docs: int):
    """Sorted documents in; the posting lists and the head of each block out."""
    def run(batches):
        from pyspark import TaskContext
        out_schema = _arrow_schema(schema)
        number = (batch << 20 | TaskContext.get().partitionId()) << 24
        held: list[pa.RecordBatch] = []

        def close(rows: pa.Table):
            nonlocal number
            n = len(rows)
            norms = rows["norm"].to_numpy()
            sizes = rows["idx"].combine_chunks().value_lengths().to_numpy()
            buckets = rows["idx"].combine_chunks().flatten().to_numpy()
            counts = rows["val"].combine_chunks().flatten().to_numpy().astype(np.int32)
            places = np.repeat(np.arange(n, dtype=np.int32), sizes)
            order = np.argsort(buckets, kind="stable")
            buckets, counts, places = buckets[order], counts[order], places[order]
            first = np.flatnonzero(np.diff(buckets, prepend=-1))
            k, ends = len(first), np.append(first, len(buckets)).astype(np.int32)
            top = np.maximum.reduceat(counts / norms[places], first)
            category = rows["category"][0].as_py()

            def lists(values, kind):              # one list a posting row, none for the head
                return pa.concat_arrays([pa.ListArray.from_arrays(pa.array(ends), pa.array(values, kind)), pa.nulls(1, pa.list_(kind))])
            id_type = out_schema.field("ids").type.value_type
            heads = [pa.concat_arrays([pa.nulls(k, pa.list_(kind)), pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), column)])
                     for kind, column in ((id_type, rows["id"].combine_chunks().cast(id_type)), (pa.float64(), pa.array(norms)))]
            bucket = np.append(buckets[first], HEADS).astype(np.int32)
            columns = [np.where(bucket == HEADS, HEADS, bucket // PART_BUCKETS).astype(np.int32), np.full(k + 1, batch, np.int32), bucket,
                       np.full(k + 1, number, np.int64), pa.array([category] * (k + 1), pa.string()), np.append(top, 0.0),
                       lists(places, pa.int32()), lists(counts, pa.int32()), *heads]
            number += 1
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=out_schema)

        def blocks_of(rows: pa.Table, last: bool):
            """Full blocks of one category each, and what is left over."""
            at, category = 0, np.array(rows["category"].fill_null("").to_pylist(), dtype=object)
            isnull = rows["category"].is_null().to_numpy()
            change = np.flatnonzero((category[1:] != category[:-1]) | (isnull[1:] != isnull[:-1])) + 1
            done = []
            while at < len(rows):
                later = change[change > at]
                to = min(at + block_docs, int(later[0]) if len(later) else len(rows))
                if to == len(rows) and to - at < block_docs and not last:
                    break
                done.append(close(rows.slice(at, to - at)))
                at = to
            return done, rows.slice(at)

        for b in batches:
            held.append(b)
            done, rest = blocks_of(pa.Table.from_batches(held), False)
            held = rest.to_batches()
            yield from done
        if sum(len(b) for b in held):
            yield from blocks_of(pa.Table.from_batches(held), True)[0]
    return run


class TextIndex:
    """The index under ``root``: ``postings`` by (part, batch), ``meta`` by batch. Documents are added in batches."""

    def __init__(self, spark: SparkSession, root: str, dim: int = C.EMBED_DIM, block_docs: int = BLOCK_DOCS):
        self.spark, self.dim, self.block_docs = spark, dim, block_docs
        self.postings = VersionedTable(spark, f"{root}/postings", ("part", "batch"))
        self.meta = VersionedTable(spark, f"{root}/meta", ("batch",))

    def exists(self) -> bool:
        return self.postings.version() > 0

    def add(self, docs: DataFrame, text: str = "text") -> int:
        """Embed and index ``docs(id, <text>, category, <metadata>)``; the version that holds them.

        Ids have to be new. The metadata columns are stored beside the index. Texts without words are stored there
        too, but no search finds them. A crash leaves the index as it was."""
        base = self.postings.version()
        batch = base + 1
        at = scratch_path(self.spark, "index-forward")
        kept = [c for c in docs.columns if c not in ("id", text)]
        forward = embed_rows(docs, text, "id", self.dim, keep=kept)
        forward.write.parquet(at)                             # texts are tokenised here, and never again
        forward = self.spark.read.schema(forward.schema).parquet(at)
        facts = forward.drop("idx", "val", "norm").withColumn("batch", F.lit(batch))
        self.meta.replace(facts, drop=lambda k: k["batch"] >= batch)      # what a lost attempt left
        schema = _postings_schema(forward.schema["id"].dataType)
        dealt = (forward.where("norm > 0").select("id", F.col("category").cast("string").alias("category"), "norm", "idx", "val")
                 .repartitionByRange("category", "norm", "id").sortWithinPartitions("category", "norm", "id"))
        lists = dealt.mapInArrow(_blocks(batch, schema, self.block_docs), schema)
        return self.postings.commit(self.postings.write(lists, order=("bucket", "block")), lambda k: False, schema, base)

    # --- searching ------------------------------------------------------------------

    def search(self, queries: DataFrame, n: int = C.MAX_RESULTS, threshold: float = C.SIMILARITY_THRESHOLD, category: str | None = None,
               text: str = "text", report: dict | None = None) -> DataFrame:
        """``(query_id, id, similarity_score, rank)``: the ``n`` best documents of every row of ``queries(id, <text>)`` with a score of
        ``threshold`` or more (which has to be positive), of one ``category`` if given; ties by id. Query ids have to differ.

        Searches ``GROUP`` queries at a time. ``report`` is filled with numbers of blocks, pairs within the threshold and pairs scored."""
        if n < 1 or threshold <= 0:
            raise ValueError("n must be >= 1 and threshold positive")
        vectors = embed_sparse(queries, text, dim=self.dim).where("size(idx) > 0")
        kind = vectors.schema["id"].dataType
        rows = vectors.limit(GROUP + 1).collect()
        if len(rows) <= GROUP:
            return self._search(rows, kind, n, threshold, category, report)
        at = scratch_path(self.spark, "queries")
        vectors.withColumn("_n", F.monotonically_increasing_id()).write.parquet(at)
        vectors = self.spark.read.schema(vectors.withColumn("_n", F.lit(0).cast("bigint")).schema).parquet(at)
        groups = -(-vectors.count() * 5 // (4 * GROUP))       # a hash deals unevenly
        out = None
        for g in range(groups):
            rows = vectors.where(F.pmod(F.xxhash64("_n"), F.lit(groups)) == g).collect()
            part = self._search(rows, kind, n, threshold, category, report)
            out = part if out is None else out.unionByName(part)
        return out

    def _wanted(self, buckets: list[int], category: str | None) -> DataFrame:
        parts = {b // PART_BUCKETS for b in buckets}
        rows = self.postings.read(lambda k: k["part"] in parts).where(f"bucket IN ({', '.join(map(str, buckets))})")
        return rows if category is None else rows.where(F.col("category") == category)

    def _search(self, rows, query_type, n, threshold, category, report) -> DataFrame:
        schema = Ty.StructType([Ty.StructField("query_id", query_type), Ty.StructField("id", self.postings.read(lambda k: False).schema["ids"].dataType.elementType),
                                Ty.StructField("similarity_score", Ty.DoubleType())])
        if not rows:
            return self._ranked(self.spark.createDataFrame([], schema), n)
        q = _Queries(rows)
        wanted = self._wanted(q.buckets.tolist(), category)
        lists = wanted.select("block", "bucket", "top").repartition("block").sortWithinPartitions("block")
        pairs = lists.mapInArrow(_bounds(q, threshold), "block bigint, q int, bound double")
        at = scratch_path(self.spark, "index-pairs")
        pairs.write.parquet(at)
        pairs = self.spark.read.schema(pairs.schema).parquet(at)
        best = Window.partitionBy("q").orderBy(F.desc("bound"), "block")
        first_at = scratch_path(self.spark, "index-first")
        pairs.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= SEEDS).select("block", "q").write.parquet(first_at)
        first = self.spark.read.schema("block bigint, q int").parquet(first_at)       # SEEDS * GROUP rows at most
        hits_at = scratch_path(self.spark, "index-hits")
        self._scored(wanted, first, q, n, threshold, schema).write.parquet(hits_at)
        hits = self.spark.read.schema(schema).parquet(hits_at)
        kth = self._ranked(hits, n).where(F.col("rank") == n).select("query_id", "similarity_score").collect()
        floors = np.full(len(q.ids), threshold)
        number = {i: k for k, i in enumerate(q.ids)}
        for r in kth:
            floors[number[r["query_id"]]] = max(threshold, r["similarity_score"])
        floor = self.spark.createDataFrame([*enumerate(floors.tolist())], "q int, floor double")
        rest = (pairs.join(F.broadcast(floor), "q").where(F.col("bound") >= F.col("floor") - SLACK).select("block", "q")
                .join(F.broadcast(first), ["block", "q"], "left_anti"))
        if report is not None:
            for name, count in (("blocks", self._wanted(q.buckets.tolist(), category).select("block").distinct().count()),
                                ("queries", len(q.ids)), ("pairs", pairs.count()), ("scored", first.count() + rest.count())):
                report[name] = report.get(name, 0) + count
        return self._ranked(hits.unionByName(self._scored(wanted, rest, q, n, threshold, schema)), n)

    def _scored(self, wanted: DataFrame, pairs: DataFrame, q: _Queries, n: int, threshold: float, schema: Ty.StructType) -> DataFrame:
        """The ``n`` best of each (query, block) of ``pairs``."""
        heads = self.postings.read(lambda k: k["part"] == HEADS).select("block", "ids", "norms")
        asked = pairs.groupBy("block").agg(F.collect_list("q").alias("qs")).join(heads, "block")
        lists = wanted.select("block", "bucket", "places", "counts").join(pairs.select("block").distinct(), "block", "left_semi")
        return asked.groupBy("block").cogroup(lists.groupBy("block")).applyInArrow(_score(q, n, threshold, _arrow_schema(schema)), schema)

    @staticmethod
    def _ranked(hits: DataFrame, n: int) -> DataFrame:
        w = Window.partitionBy("query_id").orderBy(F.round("similarity_score", 9).desc(), F.asc("id"))
        return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)

    def with_meta(self, hits: DataFrame) -> DataFrame:
        """``hits`` with the stored metadata of their documents."""
        meta = self.meta.read().drop("batch")
        return meta.join(hits, "id").select(*hits.columns, *[c for c in meta.columns if c not in hits.columns])


class _Queries:
    """The vectors of a group of queries over the buckets that any of them has."""

    def __init__(self, rows):
        self.ids = [r["id"] for r in rows]
        self.buckets = np.unique(np.concatenate([np.array(r["idx"]) for r in rows]))
        self.weights = np.zeros((len(rows), len(self.buckets)))
        for k, r in enumerate(rows):
            self.weights[k, np.searchsorted(self.buckets, r["idx"])] = r["val"]
        self.norms = np.array([sum(v * v for v in r["val"]) for r in rows]) ** 0.5


def _bounds(q: _Queries, threshold: float):
    """Rows (block, bucket, largest weight), sorted by block; the pairs whose bound reaches the threshold out."""
    def run(batches):
        held = None

        def bounds(block, bucket, top):
            blocks, row = np.unique(block, return_inverse=True)
            for a in range(0, len(blocks), 256):
                here = (row >= a) & (row < a + 256)
                tops = np.zeros((min(256, len(blocks) - a), len(q.buckets)))
                tops[row[here] - a, np.searchsorted(q.buckets, bucket[here])] = top[here]
                bound = tops @ (q.weights / q.norms[:, None]).T
                b, k = np.nonzero(bound >= threshold - SLACK)
                yield pa.RecordBatch.from_arrays([pa.array(blocks[a + b]), pa.array(k.astype(np.int32)), pa.array(bound[b, k])], names=["block", "q", "bound"])
        for b in batches:
            new = [b.column(i).to_numpy() for i in range(3)]
            held = new if held is None else [np.concatenate(p) for p in zip(held, new, strict=True)]
            if len(held[0]) and held[0][0] != held[0][-1]:
                cut = int(np.searchsorted(held[0], held[0][-1]))      # the last block may go on
                yield from bounds(*(x[:cut] for x in held))
                held = [x[cut:] for x in held]
        if held is not None and len(held[0]):
            yield from bounds(*held)
    return run


def _score(q: _Queries, n: int, threshold: float, schema: pa.Schema):
    """One block: its documents' scores for the queries that want it, the ``n`` best of each."""
    def run(asked: pa.Table, lists: pa.Table) -> pa.Table:
        if not len(asked) or not len(lists):
            return schema.empty_table()
        qs = np.array(asked["qs"][0].as_py())
        ids, norms = asked["ids"].combine_chunks().flatten(), np.array(asked["norms"][0].as_py())
        places = lists["places"].combine_chunks()
        columns = np.repeat(np.searchsorted(q.buckets, lists["bucket"].to_numpy()), np.diff(places.offsets.to_numpy()))
        docs = np.zeros((len(norms), len(q.buckets)))
        docs[places.flatten().to_numpy(), columns] = lists["counts"].combine_chunks().flatten().to_numpy()
        score = (docs @ q.weights[qs].T) / (q.norms[qs] * norms[:, None])
        key = np.round(score, 9)
        out_q, out_d = [], []
        by_id = np.argsort(np.array(ids.to_pylist(), dtype=object), kind="stable")
        for k in range(len(qs)):
            order = by_id[np.argsort(-key[by_id, k], kind="stable")][:n]
            order = order[score[order, k] >= threshold]
            out_q += [qs[k]] * len(order)
            out_d.append(order)
        d = np.concatenate(out_d)
        column = {x: i for i, x in enumerate(qs.tolist())}
        return pa.Table.from_arrays([pa.array([q.ids[x] for x in out_q], schema.field(0).type), ids.take(pa.array(d)).cast(schema.field(1).type),
                                     pa.array(score[d, [column[x] for x in out_q]] if len(d) else np.zeros(0))], schema=schema)
    return run
