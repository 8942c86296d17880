"""The registered queries that SQL does not express, over the smallest tables, against plain versions of their contracts."""

import base64
import hashlib
import zlib

import numpy as np
import pytest

from newsflow.llm import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_language_query(spark, documents):
    got = {r.doc_id: r for r in Q.op3_language_id(spark, SF).collect()}
    assert set(got) == set(documents)
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1
    asked = [i for i, r in got.items() if r.held_out and documents[i].lang and r.lang_pred != "und"]
    assert np.mean([got[i].lang_pred == documents[i].lang for i in asked]) > 0.9 and len(asked) > 20


def test_fingerprint_query(spark, documents):
    got = {r.doc_id: r for r in Q.op4_fingerprints(spark, SF).collect()}
    order = sorted(documents, reverse=True)
    for k, i in enumerate(order):
        text, following = (documents[j].text or "" for j in (i, order[(k + 1) % len(order)]))
        half = len(text) // 2
        assert got[i].n_chars == len(text) and got[i].edited_sha256 == hashlib.sha256((text[:len(text) - half] + following[:half]).encode()).hexdigest()
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1


def test_html_query(spark):
    rows = Q.op7_html_text(spark, SF).collect()
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert {r.page_id: r.url for r in rows} == pages and all(r.n_chars == len(r.text) and r.text == " ".join(r.text.split()) for r in rows)


def test_warc_query(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    first: dict[bytes, int] = {}
    for p in sorted(pages, key=lambda p: p.page_id):
        first.setdefault((p.html or "").encode(), p.page_id)
    want = []
    for p in pages:
        payload = (p.html or "").encode()
        own = first[payload] == p.page_id
        want.append((p.page_id, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), "response" if own else "revisit", None if own else first[payload]))
    assert sorted(map(tuple, Q.op8_warc(spark, SF).collect())) == sorted(want)


def test_packing_query(spark, documents):
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(Q.tokenizer_file(Q.TOKENIZER))
    rows = Q.op9_packing(spark, SF).collect()
    pieces: dict[int, list] = {}
    sequences: dict[int, list] = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert set(pieces) == set(documents)
    for i, parts in pieces.items():
        ids = own.encode(documents[i].text or "", add_special_tokens=False).ids + [2]
        at = 0
        for p in sorted(parts, key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids)) and p.ids_crc32 == zlib.crc32(np.array(ids[at:at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 4096
    padded = sum(0 if n & (n - 1) == 0 else 4096 - n for n in (sum(p.length for p in s) for s in sequences.values()))
    assert padded < 0.02 * sum(r.length for r in rows)


def test_secret_query(spark, documents):
    rows = Q.op10_secret_scan(spark, SF).collect()
    assert rows
    for r in rows:
        value = documents[r.doc_id].text[r.start:r.start + r.n_chars]
        assert hashlib.sha256(value.encode()).hexdigest() == r.value_sha256 and len(value) == r.n_chars


def test_decontamination_query(spark, documents):
    items = {r.item_id: r.text.lower().split() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    found = {(r.doc_id, r.item_id) for r in Q.op1_decontaminate(spark, SF).collect()}
    plain = {i: " " + " ".join((r.text or "").lower().split()) + " " for i, r in documents.items()}
    exact = {(d, i) for d, t in plain.items() for i, w in items.items() if f" {' '.join(w)} " in t}
    assert exact and exact <= found
