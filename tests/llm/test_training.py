"""Tokens, fill-in-the-middle and whitening, each against a plain version."""

import hashlib
import random
import re

import numpy as np

import public_tokenizers
import pytest

from newsflow.llm import bpe, fim, queries, whiten
from pyspark.sql import functions as F

from .test_documents import DOCS, frame, prose

ODD = [None, "", " ", "a", "It's  the\n\n\tend 'sam 12½ 日本語 é \x85　x", "<|endoftext|>", "x<|endoftext|><|endoftext|> y <|endoftext|", "a" * 5000, "ab" * 4000, " " * 300,
       "é" * 3000, "=-" * 777, "࢏౜a ꟎1", "a\x00b", "<P>x", "one <M> two", "don't we'll I'D"]


def sha(data):
    return hashlib.sha256(data).hexdigest()


@pytest.fixture(scope="module")
def byte_tokenizer():
    return str(public_tokenizers.path(queries.BYTE_TOKENIZER))


@pytest.fixture(scope="module")
def table_dir(spark, tmp_path_factory):
    """Documents and embeddings with odd rows, as a table folder."""
    folder = str(tmp_path_factory.mktemp("tables"))
    r = random.Random(8)
    letters = ["a", "B", " ", "\n", "'s", "é", "日", "<", "P", ">", "12", "zebra", "\U0001f600"]
    texts = ODD + [prose(i, 200) for i in range(30)] + ["".join(r.choice(letters) for _ in range(r.randrange(300))) for _ in range(60)] + [prose(77, 40_000)]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)] + [(3, "a", "en", "s", 0), (3, "other", "en", "s", 0), (None, "null id", None, None, None)]
    spark.createDataFrame(rows, DOCS).withColumn("ids", F.lit(1)).withColumn("place", F.lit("clash")).withColumn("row", F.lit(2)).write.parquet(f"{folder}/documents.parquet")
    g = np.random.default_rng(3)
    base = (g.standard_normal((400, 12)) * np.array([3, 2, 2, 1.5, *[1] * 8]) / 4).astype("f4").tolist()
    odd = [None, [], [1.0] * 11, [float("nan")] + [0.0] * 11, [float("inf")] + [0.0] * 11, [None] + [0.0] * 11, [-0.0] * 12]
    vectors = [*enumerate([*base, *odd]), *((1000 + i, base[0]) for i in range(300)), (None, base[1]), (1, base[2])]
    spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>").withColumn("component", F.lit("clash")).write.parquet(f"{folder}/embeddings.parquet")
    return folder, rows, vectors


def test_bpe_is_the_librarys(spark, table_dir, byte_tokenizer):
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(byte_tokenizer)
    folder, rows, _ = table_dir
    want = []
    for i, t, *_ in rows:
        ids = own.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(own.decode(ids, skip_special_tokens=False).encode())))
    got = [tuple(r) for r in queries.op11_byte_bpe(spark, folder).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    encoded = bpe.encode(docs, byte_tokenizer)
    back = bpe.decode(encoded.withColumn("text", F.lit("clash")), byte_tokenizer).collect()
    assert sorted((r.doc_id or -1, r.text) for r in back) == sorted((i or -1, t or "") for i, t, *_ in rows)
    assert bpe.round_trip(docs.where("false"), byte_tokenizer).count() == 0
    lost = spark.createDataFrame([(1, None), (2, bytearray(b"\xff\xff\xff\x7f" + (0).to_bytes(4, "little")))], "doc_id bigint, ids binary")
    assert {r.doc_id: r.text for r in bpe.decode(lost, byte_tokenizer).collect()} == {1: "", 2: "!"}


def test_bpe_of_random_merges():
    """Vocabularies with tokens that their own bytes never give, against merging one place at a time."""
    for seed in range(30):
        r = random.Random(seed)
        known, merges = [b"a", b"b", b"c"], []
        while len(merges) < 40:
            pair = r.choice(known), r.choice(known)
            if b"".join(pair) not in known and len(pair[0] + pair[1]) < 9:
                merges.append(pair)
                known.append(pair[0] + pair[1])
        v = bpe.Vocabulary(merges)
        rank = {p: i for i, p in enumerate(merges)}

        def plain(word):
            parts = [bytes([b]) for b in word]
            while pairs := [(rank[p], i) for i, p in enumerate(zip(parts[:-1], parts[1:], strict=True)) if p in rank]:
                _, i = min(pairs)
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
            return parts
        words = ["".join(r.choice("abc") for _ in range(r.randrange(1, 40))).encode() for _ in range(200)] + [b"a" * 300, b"abc" * 100]
        want = [plain(w) for w in words]
        assert [[v.bytes[t] for t in got] for got in v.encode(words)] == want
        assert [[v.bytes[t] for t in got] for got in v.merge(words)] == want
    assert v.merge([]) == []


def test_bpe_wants_a_byte_level_file():
    with pytest.raises(ValueError):
        bpe.Coder(str(public_tokenizers.path(queries.TOKENIZER)))


def plain_fim(doc_id, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    h = [int(hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()[i:i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle(spark, table_dir, monkeypatch):
    folder, rows, _ = table_dir
    want = [(i, *plain_fim(i, t)) for i, t, *_ in rows]
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    got = queries.op12_fill_in_middle(spark, folder)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(((*w[:5], sha(w[5].encode()), sha((t or "").encode())) for w, (_, t, *_) in zip(want, rows, strict=True)), key=str)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = fim.transform(docs)
    assert sorted(map(tuple, texts.collect()), key=str) == sorted(want, key=str)
    back = fim.restore(texts.withColumn("text", F.lit("clash"))).select("doc_id", "text").collect()
    assert sorted((r.doc_id or -1, r.text) for r in back) == sorted((i or -1, t or "") for i, t, *_ in rows)
    assert fim.digests(docs.where("false")).count() == 0


def test_fill_in_middle_in_small_pieces(monkeypatch):
    monkeypatch.setattr(fim, "PIECE", 5)
    monkeypatch.setattr(fim, "BLOCK", 3)
    r = random.Random(5)
    for i in range(400):
        text = "".join(r.choice(["ab", "c", " ", "é", "<", "P", ">", "<P", "S>", "日本", "longerword", "<S"]) for _ in range(r.randrange(30)))
        data, off = np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())])
        pieces = list(fim.document_pieces(i, text.encode(), fim.unit_starts(data, off)))
        assert [p[0] for p in pieces] == list(range(len(pieces)))
        output = b"".join(p[-1] for p in pieces)
        n, form, a, m, want = plain_fim(i, text)
        assert (*pieces[0][2:6], output.decode()) == (n, form, a, m, want)
        assert all(len(p[-1]) <= 5 + 9 for p in pieces)
        parse, parts = fim.Parser(form), []
        for p in pieces:
            parts += parse(p[-1])
        parts += parse(b"", last=True)
        assert b"".join(p for _, p in sorted(parts)).decode() == text == fim.restore_text(want, form)


def test_fill_in_middle_against_sql(spark, duck):
    got = {tuple(r) for r in queries.op12_fill_in_middle(spark, "/root/testdata/sf0.001").collect()}
    cols = "doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256"
    assert got == set(duck.execute(f"SELECT {cols} FROM ({queries.FIM_SQL})").fetchall())


def plain_whitening(vectors):
    good = [(i, np.floor(256 * np.array(v, float)).astype(np.int64)) for i, v in vectors if v and len(v) == 12 and None not in v and np.isfinite(v).all()]
    fitted = np.unique(np.array([x for _, x in good]), axis=0)
    n, s = len(fitted), fitted.sum(0)
    centred = fitted - s / n
    e, q = np.linalg.eigh(centred.T @ centred / n)
    e, q = e[::-1][:4], q[:, ::-1][:, :4]
    return n, e / np.trace(centred.T @ centred / n), [(i, int(((n * x - s) ** 2).sum()), ((x - s / n) @ q) / np.sqrt(e)) for i, x in good]


def test_whitening_against_numpy(spark, table_dir):
    folder, _, vectors = table_dir
    got = queries.op13_whitening(spark, folder)
    assert got.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = got.collect()
    n, explained, want = plain_whitening(vectors)
    assert len(rows) == 4 * len(want) == 4 * 703
    by = {}
    for r in rows:
        by.setdefault(r.component, []).append(r)
    for c in range(4):
        mine = sorted(by[c + 1], key=lambda r: (-1 if r.vec_id is None else r.vec_id, r.deviation))
        theirs = sorted(want, key=lambda w: (-1 if w[0] is None else w[0], w[1]))
        assert [(r.vec_id, r.deviation) for r in mine] == [(w[0], w[1]) for w in theirs]
        a, b = np.array([r.whitened for r in mine]), np.array([w[2][c] for w in theirs])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-9
        assert {r.n for r in mine} == {n} and mine[0].explained == pytest.approx(explained[c], rel=1e-9) and mine[0].identity_error < 1e-9


def test_whitening_of_odd_tables(spark):
    def run(vectors):
        rows = spark.createDataFrame([*enumerate(vectors)], "vec_id bigint, embedding array<double>")
        return whiten.apply(rows, whiten.fit(rows)).collect()
    assert run([]) == [] and run([None, []]) == [] and run([[1.0, 2.0]] * 5) == []
    line = run([[1.0, 0.0], [3.0, 0.0], [5.0, 0.0]])            # one component of any variance
    assert sorted((r.vec_id, r.component) for r in line) == [(0, 1), (1, 1), (2, 1)]
    assert sorted(r.deviation for r in line) == [0, 9 * 512**2, 9 * 512**2]
    assert sorted(abs(r.whitened) for r in line) == pytest.approx([0, 1.5**0.5, 1.5**0.5]) and line[0].explained == pytest.approx(1)
    huge = run([[1e12, 0.0], [-1e12, 1.0], [3e12, 5.0], [0.0, 0.0]])
    assert {r.deviation for r in huge} == {None} and len(huge) >= 4


@pytest.mark.parametrize("d,ratio", [(3, 1.0), (40, 1.0), (120, 0.97), (200, 0.5)])
def test_eigenpairs_are_certified(d, ratio):
    g = np.random.default_rng(d)
    q, _ = np.linalg.qr(g.standard_normal((d, d)))
    e = np.sort(5 * ratio ** np.arange(d) * (1 + 0.01 * g.random(d)))[::-1]
    v = (q * e) @ q.T
    got, u, history = whiten.eigenpairs(lambda x: v @ x, d, 4)
    want, w = np.linalg.eigh(v)
    k = min(4, d)
    assert got == pytest.approx(want[::-1][:k], rel=1e-12) and len(history) < 40
    gaps = np.abs(np.diff(want[::-1][:k + 1])).min() if d > k else 1
    assert np.abs(np.abs((u * w[:, ::-1][:, :k]).sum(0)) - 1).max() < 1e-10 / gaps**2
