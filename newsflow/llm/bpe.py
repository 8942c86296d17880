"""Byte-level BPE by speculation and verification, and back.

A text is cut into words as the tokenizer's pattern does it. New words are encoded
together, on arrays:

1. speculate: at every byte the longest token that starts there is looked up in a
   trie, and each word is read off greedily;
2. verify: an encoding is the merges' own result if and only if each token is what
   the merges make of its bytes and no merge would cross the border of two neighbours.
   All distinct neighbours are checked at once. Merges apply in the order of their
   numbers, so the pieces at a border at any time are known from the way both tokens
   are made: undoing the younger piece's merge again and again, one meets every pair
   that ever stood at the border, and the border is crossed if such a pair has a merge
   older than the one that was undone last;
3. only words that fail are merged exactly, by the rules.

Tokens are numbered inside by age: the bytes first, then the merges in their order.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import byte_batches

CACHED = 800_000                 # words whose ids a Python worker keeps (about 160 MB)
CACHED_CHARS = 64                # longer words are not kept
TOGETHER = 1 << 18               # bytes of new words that are encoded together
NONE = np.iinfo(np.int64).max    # no merge

# The pattern of the byte-level tokenizers, and the bytes that stand for themselves in their files.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]

ENCODED = "doc_id bigint, n_tokens bigint, ids binary"
DECODED = "doc_id bigint, text string"
_PAIR = np.int64(1) << 32


def byte_of_char() -> dict[str, int]:
    """The file's character of every byte: itself, or the next free one from 256 on."""
    hidden = [b for b in range(256) if b not in SHOWN]
    return {**{chr(b): b for b in SHOWN}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


class Vocabulary:
    """Tokens by age: their bytes, the two that each is made of, and the merges as a sorted table of pairs."""

    def __init__(self, merges: list[tuple[bytes, bytes]]):
        self.bytes = [bytes([b]) for b in range(256)]
        place = {t: i for i, t in enumerate(self.bytes)}
        left, right = [-1] * 256, [-1] * 256
        for a, b in merges:
            if a + b in place:
                raise ValueError("two merges make the same token")
            left.append(place[a])
            right.append(place[b])
            place[a + b] = len(self.bytes)
            self.bytes.append(a + b)
        self.left, self.right = np.array(left, np.int64), np.array(right, np.int64)
        key = self.left[256:] * _PAIR + self.right[256:]
        order = np.argsort(key)
        self.pairs, self.made = np.append(key[order], np.iinfo(np.int64).max), np.append(order + 256, -1)
        # a token that its own bytes don't give is never speculated on
        every = np.arange(256, len(left))
        sound = np.append(np.ones(256, bool), ~self.crossed(self.left[256:], self.right[256:], every))
        for t in every.tolist():                              # ages ascend: both halves are known
            sound[t] &= sound[left[t]] and sound[right[t]]
        self._grow([t for t in range(len(left)) if sound[t]])

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The token that each pair merges to, -1 for none."""
        key = a * _PAIR + b
        at = np.searchsorted(self.pairs, key)
        return np.where(self.pairs[at] == key, self.made[at], -1)

    def crossed(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Whether a merge (older than ``before``, if given) crosses the border of the neighbours ``a`` and ``b``."""
        out = np.zeros(len(a), bool)
        at, u, v = np.arange(len(a)), a.copy(), b.copy()
        limit = np.full(len(a), np.iinfo(np.int64).max) if before is None else before.copy()
        while len(at):
            m = self.merged(u, v)
            bad = (m >= 0) & (m < limit)
            out[at[bad]] = True
            go = ~bad & ((u >= 256) | (v >= 256))
            at, u, v = at[go], u[go], v[go]
            later = u > v                                     # the left piece is younger; of equal ones the right piece is made last
            limit = np.where(later, u, v + 1)                 # the right piece is made after a merge of its own number at its left
            u, v = np.where(later, self.right[u], u), np.where(later, v, self.left[v])
        return out

    def _grow(self, tokens: list[int]) -> None:
        """The trie of the tokens: edges (node, byte) as a sorted table, and the token at each node."""
        level = {b"": 0}
        edges, self.token_at = [], [-1]
        for t in sorted(tokens, key=lambda t: len(self.bytes[t])):
            word, node = self.bytes[t], 0
            for i in range(1, len(word) + 1):
                following = level.get(word[:i])
                if following is None:
                    following = level[word[:i]] = len(self.token_at)
                    edges.append((node << 8 | word[i - 1], following))
                    self.token_at.append(-1)
                node = following
            self.token_at[node] = t
        edges.sort()
        self.edges = np.array([*(k for k, _ in edges), np.iinfo(np.int64).max], np.int64)
        self.nodes = np.array([*(n for _, n in edges), -1], np.int64)
        self.token_at = np.array(self.token_at, np.int64)
        self.first = np.zeros(256, np.int64)                  # nodes of single bytes
        self.first[self.edges[:256] & 255] = self.nodes[:256]

    def longest(self, data: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The longest token at every byte, not reaching over ``end``, and its bytes."""
        node = self.first[data]
        token, size = self.token_at[node], np.ones(len(data), np.int64)
        at, depth = np.arange(len(data)), 1
        while True:
            more = at + depth < end[at]
            at, node = at[more], node[more]
            if not len(at):
                return token, size
            key = node << 8 | data[at + depth]
            edge = np.searchsorted(self.edges, key)
            known = self.edges[edge] == key
            at, node, depth = at[known], self.nodes[edge[known]], depth + 1
            t = self.token_at[node]
            token[at[t >= 0]], size[at[t >= 0]] = t[t >= 0], depth

    def merge(self, words: list[bytes]) -> list[list[int]]:
        """The merges' result for each word, by the rules: the oldest merge that fits, leftmost first, until none fits.

        All words take a step together. A step applies the oldest merge of each word at all its places: what a merge
        makes only takes part in younger ones, so none of these places would have been lost."""
        out: list[list[int]] = [[] for _ in words]
        ids = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        which = np.arange(len(words))
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        made = self._neighbours(ids, np.repeat(which, sizes), np.arange(len(ids)))
        while len(which):
            starts = np.cumsum(sizes) - sizes
            best = np.minimum.reduceat(made, starts)
            done = best == NONE
            if done.any():
                for w, a, n in zip(which[done].tolist(), starts[done].tolist(), sizes[done].tolist(), strict=True):
                    out[w] = ids[a:a + n].tolist()
                left = np.repeat(~done, sizes)
                ids, made, which, sizes, best = ids[left], made[left], which[~done], sizes[~done], best[~done]
                if not len(which):
                    break
            row = np.repeat(np.arange(len(which)), sizes)
            at = np.flatnonzero(made == best[row])
            run = np.cumsum(np.diff(at, prepend=-2) > 1)      # overlapping places: each second one of a run
            at = at[(np.arange(len(at)) - np.searchsorted(run, run)) % 2 == 0]
            ids[at] = made[at]
            left = np.ones(len(ids), bool)
            left[at + 1] = False
            sizes = sizes - np.bincount(row[at], minlength=len(sizes))
            ids, made, row = ids[left], made[left], row[left]
            at = at - np.arange(len(at))
            at = np.concatenate([at, at[at > 0] - 1])
            made[at] = self._neighbours(ids, row, at)
        return out

    def _neighbours(self, ids: np.ndarray, row: np.ndarray, at: np.ndarray) -> np.ndarray:
        """What the tokens at ``at`` and after them merge to, ``NONE`` at the end of a word."""
        after = np.minimum(at + 1, len(ids) - 1)
        m = self.merged(ids[at], ids[after])
        m[(m < 0) | (row[at] != row[after]) | (at == after)] = NONE
        return m

    def encode(self, new: list[bytes]) -> list[list[int]]:
        """The tokens of all words, by speculation, verification and, where that fails, by the merges."""
        data = np.frombuffer(b"".join(new), np.uint8)
        sizes = np.fromiter(map(len, new), np.int64, len(new))
        ends = np.cumsum(sizes)
        token, size = (x.tolist() for x in self.longest(data, np.repeat(ends, sizes)))
        flat, starts, at = [], [], 0
        for end in ends.tolist():
            starts.append(len(flat))
            while at < end:
                flat.append(token[at])
                at += size[at]
        starts.append(len(flat))
        ids, word = np.array(flat, np.int64), np.repeat(np.arange(len(new)), np.diff(starts))
        inner = np.flatnonzero(word[1:] == word[:-1])
        pairs, where = np.unique(ids[inner] * _PAIR + ids[inner + 1], return_inverse=True)
        bad = self.crossed(pairs // _PAIR, pairs % _PAIR)[where]
        out = [flat[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)]
        failed = np.unique(word[inner[bad]]).tolist()
        for i, tokens in zip(failed, self.merge([new[i] for i in failed]), strict=True):
            out[i] = tokens
        return out


class Coder:
    """Texts to ids and back by a tokenizer file of the byte-level BPE kind; other kinds raise a ValueError."""

    def __init__(self, path: str):
        import os

        import regex
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cut = spec["model"], spec["pre_tokenizer"] or {}
        plain = {"type": "BPE", "dropout": None, "continuing_subword_prefix": None, "end_of_word_suffix": None, "byte_fallback": False}
        if (any(model.get(k, v) not in (v, "") for k, v in plain.items()) or model.get("ignore_merges") or spec["normalizer"] is not None
                or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True) or spec["decoder"]["type"] != "ByteLevel"
                or any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"])):
            raise ValueError(f"{path}: not a plain byte-level BPE tokenizer")
        code = byte_of_char()

        def raw(token: str) -> bytes:
            return bytes(code[c] for c in token)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.vocabulary = Vocabulary([(raw(a), raw(b)) for a, b in pairs])
        number = {raw(t): i for t, i in model["vocab"].items()}
        self.ids = [number[t].to_bytes(4, "little") for t in self.vocabulary.bytes]
        self.special = {t["content"]: t["id"].to_bytes(4, "little") for t in spec["added_tokens"]}
        pieces = {i: t for t, i in number.items()} | {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        self.pieces = [pieces.get(i, b"") for i in range(max(pieces) + 1)]
        self.parts = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.cut = regex.compile(PATTERN)
        self.library = Tokenizer.from_str(json.dumps(spec | {"truncation": None, "padding": None})).pre_tokenizer
        self.known, self.odd = set(map(chr, range(128))), set()
        self.cache: dict[str, bytes] = {}

    def words(self, text: str) -> list[str]:
        """The text cut as the tokenizer cuts it. Characters of which this pattern's library thinks otherwise are left to the tokenizer's own."""
        new = set(text) - self.known
        for c in new:
            probe = f"a{c}a1{c}1.{c}.\n"
            if self.cut.findall(probe) != self._library_words(probe):
                self.odd.add(c)
        self.known |= new
        return self.cut.findall(text) if not self.odd or self.odd.isdisjoint(text) else self._library_words(text)

    def _library_words(self, text: str) -> list[str]:
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.cache) > CACHED:
            self.cache.clear()
        cut = []
        for text in texts:
            text = text or ""
            parts = self.parts.split(text) if self.special and any(s in text for s in self.special) else [text]
            cut.append([(p, None) if i % 2 else (None, self.words(p)) for i, p in enumerate(parts)])
        cache = self.cache
        new = list({w for parts in cut for _, ws in parts if ws for w in ws if w not in cache})
        found = self._new(new)
        for parts in cut:
            yield b"".join([self.special[s] if ws is None else b"".join([cache.get(w) or found[w] for w in ws]) for s, ws in parts])

    def _new(self, new: list[str]) -> dict[str, bytes]:
        """The ids of words that are not in the cache; long ones are returned only, not kept."""
        found, at = {}, 0
        while at < len(new):
            group, size = [], 0
            while at < len(new) and size < TOGETHER:
                group.append(new[at].encode())
                size += len(group[-1])
                at += 1
            for w, tokens in zip(new[at - len(group):at], self.vocabulary.encode(group), strict=True):
                (self.cache if len(w) <= CACHED_CHARS else found)[w] = b"".join([self.ids[t] for t in tokens])
        return found

    def decode(self, ids: bytes) -> str:
        """The text of ids, special tokens as they are written; bytes that are no UTF-8 become U+FFFD, unknown ids nothing."""
        known = np.frombuffer(ids, "<u4")
        if len(known) and known.max() >= len(self.pieces):
            known = known[known < len(self.pieces)]
        return b"".join(map(self.pieces.__getitem__, known.tolist())).decode("utf-8", "replace")


_coders: dict[str, Coder] = {}


def _coder(path: str) -> Coder:
    return _coders.get(path) or _coders.setdefault(path, Coder(path))


def _encoded(tokenizer: str, columns):
    """Batches of ids, their counts and the ``columns(coder, ids)`` by name."""
    def run(batches):
        coder = _coder(tokenizer)
        for b in W.slices(batches, "text", W.SMALL):
            ids = list(coder.encode(b.column("text").to_pylist()))
            more = columns(coder, ids)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([len(i) // 4 for i in ids], pa.int64()), *more.values()], names=["doc_id", "n_tokens", *more])
    return run


def _texts(docs: DataFrame) -> DataFrame:
    byte_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``ENCODED``: the ids of each row of ``docs(doc_id, text, ...)`` by the file ``tokenizer``, as little-endian unsigned 32-bit integers.

    As the tokenizers library does it without truncation, padding and added special tokens; the strings of special
    tokens in a text become their ids. Null text: empty, no ids. Repeated rows each for itself. Empty table: no rows."""
    return _texts(docs).mapInArrow(_encoded(tokenizer, lambda coder, ids: {"ids": pa.array(ids, pa.binary())}), ENCODED)


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """``DECODED``: the texts of ``encoded(doc_id, ids, ...)``, special tokens included. Null ids: empty."""
    def run(batches):
        coder = _coder(tokenizer)
        for b in W.slices(batches, "ids", W.SMALL):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([coder.decode(i or b"") for i in b.column("ids").to_pylist()], pa.string())], names=["doc_id", "text"])
    byte_batches(encoded.sparkSession)
    return encoded.select(F.col("doc_id").cast("bigint").alias("doc_id"), "ids").mapInArrow(run, DECODED)


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: digests of ``encode`` and ``decode`` of each row, in one pass."""
    def digests(coder, ids):
        return {"ids_sha256": pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                "decoded_sha256": pa.array([hashlib.sha256(coder.decode(i).encode()).hexdigest() for i in ids], pa.string())}
    return _texts(docs).mapInArrow(_encoded(tokenizer, digests), "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
