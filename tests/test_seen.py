"""The bucketed seen set and its filters."""

import hashlib

from newsflow.sinks.seen import SeenTable


def digests(spark, values):
    return spark.createDataFrame([(hashlib.md5(str(v).encode()).hexdigest(),) for v in values], "article_hash string")


def found(table, spark, values, **kw):
    return {r.article_hash for r in table.seen(digests(spark, values), **kw).collect()}


def test_only_buckets_that_may_hold_a_key_are_read(spark, tmp_path):
    t = SeenTable(spark, str(tmp_path / "s"), digits=1)
    assert found(t, spark, range(5)) == set() and t.read().count() == 0
    t.add(digests(spark, [*range(3000), 1, 2]), "s-1")
    t.add(digests(spark, range(2500, 4000)), "s-2")
    report = {}
    assert found(t, spark, range(10_000, 10_040), report=report) == set()      # new keys: the filters rule nearly all out
    assert report["partitions"] == 32 and report["read"] <= 3
    known = [7, 2600, 3999]
    want = {hashlib.md5(str(v).encode()).hexdigest() for v in known}
    assert found(t, spark, [*known, *range(20_000, 20_020)], report=report) == want
    assert 3 <= report["read"] <= 8 and report["rows"] < 4500 / 3
    assert found(t, spark, [7, 2600, 3999], but="s-2") == want - {hashlib.md5(b"3999").hexdigest()}
    assert t.read().count() == 4000 and t.has("s-2") and t.has("s-1") and not t.has("s-3") and not t.has("other-0")
    t.add(digests(spark, [1, 50_000]), "s-2")                  # the batch again, with other rows
    assert t.read().count() == 3001 and found(t, spark, [3999, 50_000]) == {hashlib.md5(b"50000").hexdigest()}


def test_joined_batches(spark, tmp_path):
    t = SeenTable(spark, str(tmp_path / "s"), digits=1)
    for b in range(4):
        t.add(digests(spark, range(b * 100, b * 100 + 150)), f"s-{b}")
    before = {r.article_hash for r in t.read().collect()}
    assert t.compact(5) == 0 and t.compact(4) == 16
    assert {r.article_hash for r in t.read().collect()} == before and len(t.hashes.partitions()) == 16 == len(t.filters.partitions())
    assert len(found(t, spark, [0, 449, 450])) == 2 and t.has("s-3")
    assert len(t.read().collect()) == t.read().distinct().count() == 450


def test_full_filters_let_pass_but_never_miss(spark, tmp_path):
    t = SeenTable(spark, str(tmp_path / "s"), digits=1, bitmaps=1)
    t.add(digests(spark, range(60_000)), "s-0")
    assert len(found(t, spark, range(59_000, 61_000))) == 1000
