"""Near-duplicates, decontamination, language, packing, fingerprints, licences and secrets on small tables."""

import hashlib
import itertools
import random
import re
import zlib

import pyarrow as pa
import public_tokenizers
import pytest

from newsflow.llm import decontam, langid, licenses, minhash, packing, secretscan, spotsigs
from newsflow.llm import words as W
from newsflow.llm.graph import components
from pyspark.sql import functions as F

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def frame(spark, texts, lang="en"):
    """Documents 0.. with these texts."""
    return spark.createDataFrame([(i, t, lang, "src0", len(t or "")) for i, t in enumerate(texts)], DOCS)


def prose(seed, n, vocab=None):
    r = random.Random(seed)
    vocab = vocab or [a + b for a in ("ba", "ke", "lo", "mi", "nu", "pra", "ste") for b in ("n", "rt", "ss", "la", "mo", "vi")]
    return " ".join(r.choice(vocab) for _ in range(n))


def links(texts, shingle, percent):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i:i + shingle]) for i in range(len(w) - shingle + 1)} if len(w) >= shingle else {tuple(w)} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in itertools.combinations(range(len(texts)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return [(i, len(sets[i]), find(i), find(i) == i) for i in range(len(texts))]


def test_words_are_cut_at_any_piece_size(monkeypatch):
    texts = ["Ab cd\tAB", "", None, "x" * 5000 + " é ü", " \n ", "a"]
    want = W.word_spans(pa.array(texts), W.SPACED)
    monkeypatch.setattr(W, "PIECE", 7)
    got = W.word_spans(pa.array(texts), W.SPACED)
    assert all((a == b).all() for a, b in zip(want, got, strict=True))
    assert want[3].tolist() == [0, 3, 3, 3, 6, 6, 7]
    assert want[0][0] == want[0][2] and len(set(want[0].tolist())) == 6      # "Ab" is "AB"


@pytest.mark.parametrize("shingle", [2, 5])
def test_near_duplicates_against_all_pairs(spark, shingle):
    r = random.Random(5)
    texts = [None, "", " \t", "one", "One", "one two", "ONE TWO", "é"]
    for i in range(12):
        base = prose(i, 60).split()
        texts += [" ".join(base)] * 2
        for edits in (1, 2, 3, 6, 12):
            w = list(base)
            for _ in range(edits):
                w[r.randrange(len(w))] = f"edit{r.random()}"
            texts.append(" ".join(w))
    texts.append(prose(99, 30_000))
    got = minhash.near_duplicates(frame(spark, texts).withColumn("rep", F.lit("clash")).withColumn("n", F.lit(1)), shingle=shingle)
    assert sorted(map(tuple, got.collect())) == links(texts, shingle, 80)


def test_near_duplicates_of_odd_tables(spark):
    assert minhash.near_duplicates(frame(spark, ["a"]).where("false")).count() == 0
    rows = [(3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (None, "z"), (7, "a b c d e f")]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in got) == [(-1, -1, True), (-1, 3, False), (3, 3, True), (3, 3, True), (7, 3, False)]


def test_sketch_fills_every_bin_and_estimates():
    import numpy as np
    r = np.random.default_rng(1)
    a = np.unique(r.integers(1, 2**63, 1000, dtype=np.uint64))
    b = np.concatenate([a[:900], r.integers(1, 2**63, 100, dtype=np.uint64)])
    for n in (1, 3, 50, 1000):
        s = minhash.sketches(np.sort(a[:n]), np.array([0, n]), 240)
        assert (s != np.iinfo(np.uint64).max).all()
    x, y = (minhash.sketches(np.sort(v), np.array([0, len(v)]), 240)[0] for v in (a, b))
    assert abs((x == y).mean() - 900 / 1100) < 0.12


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (102, 101), (5, 5)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100, 102: 100}


def edited(words, edits, r):
    w = list(words)
    for _ in range(edits):
        at, kind = r.randrange(len(w)), r.choice("sid")
        if kind == "s":
            w[at] = f"new{r.randrange(10**6)}"
        elif kind == "i":
            w.insert(at, f"new{r.randrange(10**6)}")
        else:
            del w[at]
    return w


def distance(item, text):
    """Least word edits from item to any part of text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        old, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(old[j] + 1, row[j - 1] + 1, old[j - 1] + (a != b)))
    return min(row)


def test_edit_match_is_exact():
    r = random.Random(2)
    for _ in range(300):
        item = [r.randrange(6) for _ in range(r.randrange(1, 12))]
        text = [r.randrange(6) for _ in range(r.randrange(0, 25))]
        got = decontam.edit_match(item, text, len(item))
        assert got[0] == distance(item, text)
        assert distance(item, text[got[1]:got[2]]) == got[0]


def test_leaks_recall_and_precision(spark):
    r = random.Random(3)
    items = [prose(1000 + i, r.randrange(12, 50)) for i in range(30)]
    bench = spark.createDataFrame([*enumerate(items), (98, None), (99, "too few words"), (97, "")], "item_id bigint, text string")
    texts, want = [None, "", "...", prose(7, 20_000)], set()
    for i, item in enumerate(items):
        w = item.split()
        for edits in (0, len(w) // 10, len(w) // 5):
            want.add((len(texts), i))
            texts.append(prose(50 + i, 40) + "\n" + " ".join(edited(w, edits, r)).upper() + ". " + prose(60 + i, 40))
        texts.append(prose(500 + i, 200))
    got = decontam.leaks(frame(spark, texts).withColumn("item_id", F.lit("clash")), bench).collect()
    found = {(x.doc_id, x.item_id) for x in got}
    assert len(found & want) >= 0.97 * len(want)
    for x in got:
        words = re.findall(r"[^\W_]+", texts[x.doc_id].lower())[x.first_word:x.first_word + x.n_words]
        item = items[x.item_id].split()
        assert x.distance == distance(item, words) <= len(item) // 5
    exact = [x for x in got if x.distance == 0]
    assert len(exact) >= 30
    assert decontam.leaks(frame(spark, texts), bench.where("false")).count() == 0
    assert decontam.leaks(frame(spark, texts).where("false"), bench).count() == 0
    blocks = decontam.leaks(frame(spark, texts), bench, block_chars=500).collect()
    assert {(x.doc_id, x.item_id) for x in blocks if x.distance == 0} == {(x.doc_id, x.item_id) for x in exact}


@pytest.mark.parametrize("n", [100, 300, 1200])
def test_leaks_of_long_items(spark, n):
    r = random.Random(n)
    vocab = [f"w{i}" for i in range(3000)]
    items = [prose(2000 * n + i, n, vocab) for i in range(8)]
    texts, want = [], {}
    for i, item in enumerate(items):
        for edits in (0, n // 10, n // 5):
            want[len(texts), i] = edits
            texts.append(prose(i, 90, vocab) + " " + " ".join(edited(item.split(), edits, r)) + " " + prose(n + i, 70, vocab))
        texts.append(prose(n * 7 + i, n, vocab))
    got = {(x.doc_id, x.item_id): x for x in decontam.leaks(frame(spark, texts), spark.createDataFrame([*enumerate(items)], "item_id bigint, text string")).collect()}
    assert set(got) == set(want)
    for k, x in got.items():
        words = texts[k[0]].split()[x.first_word:x.first_word + x.n_words]
        assert x.distance <= want[k] and (n > 300 or x.distance == distance(items[k[1]].split(), words))


def test_leaks_of_short_items_and_unspaced_scripts(spark):
    items = ["Blue whale.", "yes", "一只敏捷的棕色狐狸跳过了那只懒惰的狗。", "สวัสดีครับผมชื่อสมชาย", "東京は日本の首都です", "forty two", "", "?!", "the Łódź “free” état", "blue whale"]
    texts = ["a BLUE\nwhale swims; blue whale", "whale blue, yesterday", "他说：“一只敏捷的红色狐狸跳过了那只懒惰的狗”，然后走了。", "x สวัสดีครับผมชื่อสมชาย y", "いま東京は、日本の首都です！", None,
             "no. Yes", "forty", "two", "see THE łódź—free état", "一只狗"]
    got = decontam.leaks(frame(spark, texts), spark.createDataFrame([*enumerate(items)], "item_id bigint, text string")).collect()
    assert sorted(tuple(x)[:5] for x in got) == [(0, 0, 1, 2, 0), (0, 9, 1, 2, 0), (2, 2, 2, 18, 1), (3, 3, 1, 21, 0), (4, 4, 2, 10, 0), (6, 1, 1, 1, 0), (9, 8, 1, 4, 0)]


def test_language_of_held_out_texts(spark):
    vocab = {"aa": ["the", "ship", "sails", "north", "wind"], "bb": ["das", "schiff", "segelt", "nordwind", "weht"], "cc": ["le", "navire", "vogue", "vent", "nord"]}
    rows = [(i, prose(i, 30, v), lang, "s", 0) for k, (lang, v) in enumerate(vocab.items()) for i in range(k * 100, k * 100 + 40)]
    model = langid.fit(spark.createDataFrame([*rows, (999, None, "aa", "s", 0), (998, "x", None, "s", 0)], DOCS))
    assert model["langs"] == ["aa", "bb", "cc"]
    asked = ["the ship", "Schiffe segelten", "navires", None, "", "123 %%", "中文", "das das the", "the " * 400_000]
    odd = langid.predict(frame(spark, ["½ ²", "① 3", "½ the ship"]), model).orderBy("doc_id").collect()
    assert [r.lang_pred for r in odd] == ["und", "und", "aa"]
    got = [tuple(r)[-2:] for r in langid.predict(frame(spark, asked).withColumn("score", F.lit("clash")), model).orderBy("doc_id").collect()]
    assert [g[0] for g in got] == ["aa", "bb", "cc", "und", "und", "und", got[6][0], "bb", "aa"]
    assert got[6][0] in model["langs"] and all(0 <= g[1] <= 1 for g in got)
    none = langid.fit(frame(spark, ["x"]).where("false"))
    assert langid.predict(frame(spark, ["the"]), none).first()["lang_pred"] == "und"


@pytest.fixture(scope="module")
def tokenizer():
    return str(public_tokenizers.path("word_bpe_49k.json"))


def test_packing_keeps_every_id_once(spark, tokenizer):
    from tokenizers import Tokenizer
    texts = [None, "", "Hello WORLD's end.", "ß É ½x ﬁ İstanbul a\x1cb", "<|endoftext|> it's", prose(1, 9000), "x" * 3000, "中文 字", "a\u0301 e\xa0f", "- -- 12,5"]
    texts += [prose(i, 20 + 13 * i) for i in range(40)]
    rows = packing.pack(frame(spark, texts).repartition(3), tokenizer).collect()
    own = Tokenizer.from_file(tokenizer)
    for i, t in enumerate(texts):
        pieces = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        want = own.encode(t or "", add_special_tokens=False).ids + [2]
        assert [x for p in pieces for x in p.ids] == want
        assert all(p.doc_tokens == len(want) and p.length == len(p.ids) for p in pieces)
        assert all(p.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in p.ids)) for p in pieces)
    for _, group in itertools.groupby(sorted(rows, key=lambda r: (r.sequence_id, r.offset)), key=lambda r: r.sequence_id):
        at = 0
        for p in group:
            assert p.offset == at
            at += p.length
        assert at <= 4096 and p.padding == (0 if at & (at - 1) == 0 else 4096 - at)
    assert packing.pack(frame(spark, ["a"]).where("false"), tokenizer).count() == 0


def test_packer_minimises_the_sum_of_squares():
    import numpy as np
    r = random.Random(4)
    packer = packing.Packer(window=16, max_open=10**6)
    for i in range(300):
        size, n = r.randrange(1, 16), packer.count.copy()
        def cost(level):
            m = n.copy()
            if level:
                m[level] -= 1
            if level + size < 16:
                m[level + size] += 1
            return int((m[:16] ** 2).sum())
        best = min(cost(h) for h in range(17 - size) if h == 0 or n[h])
        list(packer.add(i, np.zeros(size, "<u4")))
        assert int((packer.count[:16] ** 2).sum()) == best
    sizes = [sum(len(p[2]) for p in s) for s in packer.close()]
    assert all(s == 16 or s & (s - 1) == 0 for s in sizes)


def test_fingerprints_beside_edits(spark):
    texts = ["The cat of the house sat on a mat in the big garden", "the house and the red garden by the lake", None, "", "zzz", "%%", "é" * 7, prose(3, 20_000)]
    texts += [prose(i, 50) + " the end of a long day" for i in range(20)]
    got = {r.doc_id: r for r in spotsigs.against_edits(frame(spark, texts).withColumn("signatures", F.lit("clash"))).collect()}
    order = sorted(range(len(texts)), reverse=True)
    for k, i in enumerate(order):
        t, nxt = texts[i] or "", texts[order[(k + 1) % len(order)]] or ""
        half = len(t) // 2
        edited_text = t[:len(t) - half] + nxt[:half]
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256(edited_text.encode()).hexdigest()
        other = got[order[(k + 1) % len(order)]]
        for a, b, near in ((got[i].fingerprint, got[i].edited_fingerprint, got[i].near_edited), (got[i].fingerprint, other.fingerprint, got[i].near_next)):
            x, y = ({s[j:j + 8] for j in range(0, len(s), 8)} for s in (a, b))
            assert near == pytest.approx(len(x & y) / len(x | y) if x | y else 1.0)
    many = spark.createDataFrame([(i * 3 - 50, f"t{i}") for i in range(100)] + [(4, "same"), (4, "other"), (None, "lost")], "doc_id bigint, text string")
    follow = {r.doc_id: r.prev_id for r in spotsigs.followers(many.select("doc_id", F.length("text").alias("n_chars")), rows_per_bucket=7).collect()}
    ids = sorted({r.doc_id for r in many.collect()} - {None})
    assert follow == {a: b for a, b in zip(ids, ids[1:] + ids[:1], strict=True)}
    rows = spotsigs.against_edits(many).collect()
    assert len(rows) == 103 and [r.near_next for r in rows if r.doc_id is None] == [None]
    lone = spotsigs.against_edits(many.where("doc_id = 1")).first()
    assert lone.near_next == 1.0
    assert spotsigs.against_edits(many.where("false")).count() == 0


@pytest.mark.parametrize("least", [0.5, 0.8])
def test_near_fingerprints_against_all_pairs(spark, least):
    r = random.Random(11)
    sets = []
    for group in range(12):
        base = r.sample(range(group * 60, group * 60 + 90), r.randrange(1, 60))
        for _ in range(12):
            keep = [x for x in base if r.random() > r.choice([0, 0.02, 0.1, 0.3])]
            sets.append(sorted({*keep, *r.sample(range(5_000, 5_030), r.randrange(0, 3))}))
    sets += [[], [], [1], list(range(4)), list(range(5)), list(range(28)), list(range(35)), sets[0]]
    table = spark.createDataFrame([*enumerate(sets), (None, [1])], "doc_id bigint, signatures array<int>").withColumn("rep", F.lit("clash"))
    classes, pairs = spotsigs.near_pairs(table, least)
    reps = {i: min(j for j, t in enumerate(sets) if t == s) for i, s in enumerate(sets)}
    assert {c.doc_id: c.rep for c in classes.collect()} == reps
    want = {(a, b): len({*sets[a]} & {*sets[b]}) / len({*sets[a]} | {*sets[b]})
            for a, b in itertools.combinations(sorted(set(reps.values())), 2) if sets[a] and sets[b]}
    want = {k: v for k, v in want.items() if v >= least}
    got = pairs.collect()
    assert len(got) == len(want) > 20 and {(p.a, p.b): p.similarity for p in got} == pytest.approx(want)
    assert [x.count() for x in spotsigs.near_pairs(table.where("false"), least)] == [0, 0]


def test_signatures_are_chains_after_anchors(spark):
    row = spotsigs.with_set(spark.createDataFrame([("The Cat and the big dog, of course",)], "t string"), "t", "s").first()
    chains = ["the cat big", "and big dog", "the big dog"]      # "of course" has no second word
    want = [r.h for r in spark.createDataFrame([(c,) for c in chains], "c string").selectExpr("cast((xxhash64(c) & 4294967295) - 2147483648 as int) h").collect()]
    assert row.s == sorted(want)


def test_licenses_in_order(spark):
    texts = [None, "", "No statement here.", "Released under the MIT\nLicense.", "x y\nLicensed under CC BY-NC 4.0. All rights reserved.",
             "This work is licensed under the GNU General Public License, version 3.",
             "Permission is hereby granted, free of charge, to any person obtaining a copy of this. The above copyright notice and this permission notice shall be "
             "included in all copies. The software is provided \"as is\", without warranty of any kind.",
             "Licensed under the Apache License, Version 2.0! Copyright (c) 2020 Me. All rights reserved.", "Licensed under the Foo License.", "under the sea " * 9000]
    got = {r.doc_id: (r.n_sentences, r.licenses, r.unmatched) for r in licenses.scan(frame(spark, texts).withColumn("licenses", F.lit("clash"))).collect()}
    assert got == {3: (1, "MIT", ""), 4: (2, "CC-BY-NC-4.0 All-Rights-Reserved", ""), 5: (1, "GPL-3.0", ""), 6: (3, "MIT", ""),
                   7: (3, "Apache-2.0 All-Rights-Reserved", ""), 8: (1, "", "Unknown")}
    import duckdb
    con = duckdb.connect()
    con.register("documents", frame(spark, texts).toPandas())
    assert {r[0]: (r[1], r[3], r[4]) for r in con.execute(licenses.oracle()).fetchall()} == got
    assert licenses.scan(frame(spark, texts).where("false")).count() == 0


@pytest.mark.parametrize("gap", ["\n", "  ", "\t", " \r\n * "])
def test_licenses_across_line_breaks(spark, gap):
    want = {"All rights reserved.": "Reserved", "Released into the public domain.": "PublicDomain", "Distributed under CC BY 4.0.": "CC-BY-4.0",
            "Under the terms of it": "Unknown", "Given to the creative commons zero": "CC0",
            "Neither the name of X may be used to endorse or promote products": "BSDname"}
    texts = [t.replace(" ", gap) for t in want]
    got = {r.doc_id: r.sentence_ids for r in licenses.scan(frame(spark, texts)).collect()}
    assert got == dict(enumerate(want.values()))


def test_secrets_are_told_from_lookalikes(spark):
    key = hashlib.sha1(b"k").hexdigest()
    real = [f'the token = "{key}" was here', f"export API_KEY={hashlib.sha256(b'q').hexdigest()[:32]} now"]
    other = [f"commit {key} fixed it", "see mail7.example.com today", 'password = "your_password_here1"', "plain words only and 2669109448945250", None, ""]
    docs = frame(spark, [prose(i, 200) for i in range(200)])
    model = secretscan.train(secretscan.labelled_findings(docs, 200), docs, 200)
    texts = real + other + [prose(1, 5000) + ' secret: "' + "0f" * 12 + 'a9" ']
    asked = frame(spark, texts).withColumn("value", F.lit("clash"))
    got = secretscan.scan(asked, model).collect()
    assert {r.doc_id for r in got if r.is_secret} == {0, 1, 8}
    assert all(texts[r.doc_id][r.start:r.start + r.n_chars] == r.value for r in got)
    found = secretscan.scan(asked, model).where("is_secret")
    clean = {r.doc_id: r for r in secretscan.redact(frame(spark, texts), found).collect()}
    assert len(clean) == len(texts) and clean[0].text == 'the token = "[SECRET]" was here' and clean[0].n_chars == len(clean[0].text)
    assert all(clean[i + 2].text == t for i, t in enumerate(other))
    assert secretscan.train(secretscan.labelled_findings(docs, 200).where("false"), docs, 200) is None
    assert secretscan.scan(asked.where("false"), model).count() == 0
    assert secretscan.scan(asked, None).where("is_secret").count() == len(got)


def test_long_secrets_are_masked_to_their_end(spark):
    key = "".join(hashlib.sha256(bytes([i])).hexdigest() for i in range(32))[:2000]
    late = "abcdefghijklmnopqrstuvwxyz" * 4 + "7" * 3
    huge = key * 150
    texts = [f'token = "{key}" end', f"see {key}. end", f"see {late} end", f"see {late[::-1]} end", f"key: {key}%end", f"see {huge} end"]
    docs = frame(spark, texts)
    values = {r.doc_id: r.value for r in secretscan.candidates(docs).collect()}
    assert values == {0: key, 1: key + ".", 2: late, 3: late[::-1], 4: key + "%end", 5: huge}
    clean = {r.doc_id: r.text for r in secretscan.redact(docs, secretscan.scan(docs, None)).collect()}
    assert clean == {0: 'token = "[SECRET]" end', 1: "see [SECRET] end", 2: "see [SECRET] end", 3: "see [SECRET] end", 4: "key: [SECRET]", 5: "see [SECRET] end"}
    prose_docs = frame(spark, [prose(i, 100) for i in range(100)])
    model = secretscan.train(secretscan.labelled_findings(prose_docs, 100), prose_docs, 100)
    judged = {r.doc_id: r for r in secretscan.scan(docs, model).collect()}
    assert judged[0].is_secret and {i: r.n_chars for i, r in judged.items()} == {i: len(v) for i, v in values.items()}


def test_dictionary_of_all_documents(spark, monkeypatch):
    rare = ["déjàvécu", "incomprehensibilities", "zyxwvu"]
    texts = [prose(i, 30) for i in range(300)] + [f"The {w} and the {w.upper()}, x{w}9 once{i}x" for i, w in enumerate(rare)]
    docs = frame(spark, texts)
    model = secretscan.train(secretscan.labelled_findings(docs, 20), docs, 20)
    words = {r.word for r in model.dictionary.collect()}
    assert words == {w for t in texts[:300] for w in t.split()} | {"the", "and", *rare}
    counted = sum(len(w) - 1 for t in texts for w in re.split(r"[^\w]+", t) if len(w) > 2 and w.isalpha())
    size = (len(secretscan.CODES) + 1) ** 2
    import math
    assert sum(math.exp(p) for p in model.pairs) == pytest.approx(1) and min(model.pairs) == pytest.approx(math.log(0.5 / (counted + 0.5 * size)))
    asked = spark.createDataFrame([(w + "/" + w, "", "", "") for w in rare], "value string, before string, after string, path string")
    for most in (secretscan.BROADCAST_CHARS, 0):      # broadcast, shuffled
        monkeypatch.setattr(secretscan, "BROADCAST_CHARS", most)
        got = {r.value: r.covered for r in secretscan.described(asked, model.dictionary, model.pairs).collect()}
        assert got == {w + "/" + w: pytest.approx(1 - 1 / (2 * len(w) + 1)) for w in rare}
