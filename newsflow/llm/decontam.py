"""Benchmark passages in documents, also with small edits.

Words are the alphabet: lower-cased runs of letters, marks and digits, and each
character of a script that is written without spaces. The random walk
of Chakraborty, Goldenberg and Koucky copies a word sequence, at every step
staying on the current word or moving on by a random bit of (step, word), so a
small edit distance becomes a small Hamming distance. A locality-sensitive key
is a sample of a few steps of such a walk; ``repeats`` independent walks, half of
them forward from a window's first word and half backward from its last, give the
keys of each item-sized window, looked up among the keys of the items.
Candidates are confirmed by their exact edit distance to the item.

A walk over many words seldom survives their edits, so items of more than ``WHOLE``
words are looked up by parts of at most ``PART`` words: edits over all parts are at most
the item's share of edits, so some part has at most its own share. A part's candidate
is confirmed on the whole item. Items of fewer than ``MIN_WORDS`` words have no
room for an edit; their word sequences are looked up as they are.

Windows that cannot be confirmed are not walked: an edit destroys two word pairs
at most, so a window within distance d of an item has all but 2d of the item's
word pairs (the q-gram lemma). This loses nothing.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import bounded_batches

MIN_WORDS = 5                    # shorter items are searched for exactly
SIMILARITY = 0.8                 # 1 - edit distance / words of the item
REPEATS, SAMPLED = 40, 3         # walks, and steps of a walk in one key
WHOLE, PART = 60, 50             # longest item that is looked up as a whole, and words of a part of a longer one
BLOCK_CHARS = 8_000_000          # characters of items searched for in one pass over the documents
RATIO = 1.25                     # longest to shortest item of one window size
WALKED = 2048                    # windows that are walked together
_U = np.uint64

SCHEMA = "doc_id bigint, item_id bigint, first_word bigint, n_words bigint, distance bigint, similarity double"


# What parts words beside ASCII, and the scripts without spaces between words.
PARTING = r"[^\x00-\x7f\p{L}\p{M}\p{N}]"
UNSPACED = r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Bopomofo}\p{Yi}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\p{Tai_Le}\p{New_Tai_Lue}\p{Tai_Tham}\p{Tai_Viet}])"
_LEADS = np.zeros(256, bool)     # first bytes of the characters of UNSPACED
_LEADS[[0xE0, 0xE1, 0xE2, *range(0xE3, 0xEB), 0xEF, 0xF0]] = True


def _lower(texts: pa.Array) -> pa.Array:
    """The texts lower-cased, with spaces for all but letters, marks and digits outside ASCII and around characters of unspaced scripts."""
    low = pc.utf8_lower(texts)
    raw, _ = W.text_bytes(low)
    if len(raw) and raw.max() >= 0x80:
        low = pc.replace_substring_regex(low, PARTING, " ")
        if _LEADS[W.text_bytes(low)[0]].any():
            low = pc.replace_substring_regex(low, UNSPACED, r" \1 ")
    return low


class Items:
    """The items of one block: word ids, word pairs, and walk keys by window size."""

    def __init__(self, rows: list[tuple[int, str]], similarity: float, repeats: int, sampled: int):
        hashes, _, _, off = W.word_spans(_lower(pa.array([t for _, t in rows], pa.string())), W.ALNUM)
        self.words = np.unique(hashes)
        self.repeats, self.sampled = repeats, sampled
        self.items = []                        # (item, word ids, most edits)
        self.short: dict[int, dict[tuple, list]] = defaultdict(lambda: defaultdict(list))      # words: [word ids: items]
        for (item, _), a, b in zip(rows, off[:-1], off[1:], strict=True):
            if b - a >= MIN_WORDS:
                self.items.append((item, self.ids(hashes[a:b]), int((1 - similarity) * (b - a) + 1e-9)))
            elif b > a:
                self.short[int(b - a)][tuple(self.ids(hashes[a:b]).tolist())].append(item)
        self.short_keys = {n: np.unique(_runs(np.array([*table], np.int64).ravel(), n)[::n]) for n, table in self.short.items()}
        self.units = [(k, at, part, int((1 - similarity) * len(part) + 1e-9)) for k, (_, w, _) in enumerate(self.items) for at, part in _parts(w)]
        self.masks = [_masks(w.tolist()) for _, w, _ in self.items]
        self.pairs = np.unique(np.concatenate([_pairs(w) for _, w, _ in self.items])) if self.items else np.zeros(0, np.uint64)
        self.classes = []                      # window words, most edits, walk keys and their units, which pairs its units have
        most = {len(w): d for _, _, w, d in self.units}
        for size in sorted(most):
            if not self.classes or size > RATIO * self.classes[-1].size:
                self.classes.append(Class(size, len(self.pairs) + 1))
            self.classes[-1].edits = most[size]      # sizes ascend, and so do the edits
        self.own_pairs = [frozenset(self.pair_ids(w).tolist()) for _, w, _ in self.items]
        by_class: dict[int, list[int]] = defaultdict(list)
        for u, (_, _, w, _) in enumerate(self.units):
            own = next(i for i in range(len(self.classes) - 1, -1, -1) if self.classes[i].size <= len(w))
            self.classes[own].has_pair[self.pair_ids(w)] = True
            by_class[own].append(u)
        for i, c in enumerate(self.classes):
            keys, units = [], []
            for at in range(0, len(by_class[i]), WALKED):
                some = by_class[i][at:at + WALKED]
                lengths = np.array([len(self.units[u][2]) for u in some])
                hi = np.cumsum(lengths)
                keys.append(self.keys(np.concatenate([self.units[u][2] for u in some]), hi - lengths, hi, hi - lengths, hi, c.size))
                units.append(np.broadcast_to(np.array(some), keys[-1].shape))
            keys, units = (np.concatenate([x.ravel() for x in xs]) for xs in (keys, units))
            order = np.argsort(keys, kind="stable")
            c.keys, c.units = keys[order], units[order].astype(np.int32)

    def pair_ids(self, ids: np.ndarray) -> np.ndarray:
        """1.. for word pairs of the items, 0 for all others."""
        return _find(self.pairs, _pairs(ids))

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """1.. for words of the items, 0 for all others."""
        return _find(self.words, hashes)

    def keys(self, ids: np.ndarray, first: np.ndarray, end: np.ndarray, lo, hi, size: int) -> np.ndarray:
        """The keys of all walks (a row each) for windows ``[first, end)`` of texts ``[lo, hi)`` of ``ids``; each second walk goes backward from the end.

        All walks take a step together. They are ordered by their last sampled step, so those that have ended are left out."""
        steps = [np.sort(np.random.default_rng((size, r)).choice(2 * size, self.sampled, replace=False)) for r in range(self.repeats)]
        walks = sorted(range(self.repeats), key=lambda r: -steps[r][-1])
        back = np.array([r % 2 == 1 for r in walks])[:, None]
        move = np.where(back, -1, 1).astype(np.int64)
        salts = W.mix(np.arange(2 * size * self.repeats, dtype=np.uint64).reshape(2 * size, -1) * W.SEEDS[23] + _U(size))
        at = np.where(back, end - 1, first)
        key = np.broadcast_to(W.mix((np.array(walks, np.uint64) + _U(1)) * W.SEEDS[20])[:, None], at.shape).copy()
        mixed = W.mix((ids + 1).astype(np.uint64) * W.SEEDS[22])      # a word's random bits come from its mixed id
        nothing = W.mix(np.array([0], np.uint64))[0]
        last, n = len(ids) - 1, len(walks)
        for step in range(int(steps[walks[0]][-1]) + 1):
            while steps[walks[n - 1]][-1] < step:
                n -= 1
            here = at[:n]
            word = np.where((here >= lo) & (here < hi), mixed[np.clip(here, 0, last)], nothing)
            for i in range(n):
                if step in steps[walks[i]]:
                    key[i] = W.mix(key[i] * W.SEEDS[21] + word[i])
            salt = salts[step, walks[:n]][:, None]
            bit = ((word ^ salt) * (salt | _U(1))) >> _U(63)
            here += move[:n] * bit.astype(np.int64)
        out = np.empty_like(key)
        out[walks] = key
        return out


class Class:
    def __init__(self, size: int, pairs: int):
        self.size, self.edits = size, 0
        self.keys, self.units = np.zeros(0, np.uint64), np.zeros(0, np.int32)      # sorted by key; a key may have several units
        self.has_pair = np.zeros(pairs, bool)


def _find(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """1 + the place of each value in a sorted table, 0 if it isn't there."""
    if not len(table):
        return np.zeros(len(values), np.int64)
    at = np.searchsorted(table, values)
    at[at == len(table)] = 0
    return np.where(table[at] == values, at + 1, 0)


def _runs(ids: np.ndarray, n: int) -> np.ndarray:
    """A key for each run of ``n`` words."""
    w = ids.astype(np.uint64)
    count = max(0, len(w) - n + 1)
    key = np.full(count, n, np.uint64) * W.SEEDS[25]
    for i in range(n):
        key = W.mix(key * W.SEEDS[26] + w[i:i + count])
    return key


def _parts(ids: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """The first word and the words of each part by which an item is looked up."""
    n = 1 if len(ids) <= WHOLE else -(-len(ids) // PART)
    cuts = [len(ids) * i // n for i in range(n + 1)]
    return [(a, ids[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _pairs(ids: np.ndarray) -> np.ndarray:
    w = ids.astype(np.uint64)
    return W.mix(w[:-1] * W.SEEDS[24] + w[1:])


def _masks(words: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << i
    return out


def edit_match(words: list[int], text: list[int], most: int, masks: dict[int, int] | None = None) -> tuple[int, int, int] | None:
    """``(distance, first, end)`` of the part of ``text`` nearest to ``words``, or None if that is over ``most`` word edits.

    Ties go to the earliest end, then to the shortest part."""
    m = len(words)
    best, end = _scan(masks or _masks(words), m, text)
    if best > most:
        return None
    _, length = _scan(_masks(words[::-1]), m, text[:end][::-1], target=best)
    return best, end - length, end


def _scan(masks: dict[int, int], m: int, text: list[int], target: int | None = None) -> tuple[int, int]:
    """Myers' bit-parallel scan: the least distance of the item to a part of the text that ends
    (with ``target``: starts at the front and has that distance), and that end."""
    ones, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = ones, 0, m
    best, end = m, 0
    if target == m:
        return m, 0
    for j, w in enumerate(text):
        eq = masks.get(w, 0)
        x = eq | down
        h = ((((x & up) + up) ^ up) | x)
        hp, hn = down | ~(h | up) & ones, up & h
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        hp = hp << 1 | (1 if target is not None else 0)
        hn <<= 1
        up, down = (hn | ~(x | hp)) & ones, hp & x & ones
        if score < best:
            best, end = score, j + 1
            if target is not None and best == target:
                break
    return best, end


def _search(items: Items):
    def run(batches):
        for b in W.slices(batches, "text", W.SMALL):
            hashes, _, _, off = W.word_spans(_lower(b.column("text")), W.ALNUM)
            ids = items.ids(hashes)
            pairs = items.pair_ids(ids)
            ends = np.repeat(off[1:], np.diff(off))      # of the text of each word
            found: dict[tuple[int, int], tuple[int, int, int]] = {}
            tried: set[tuple[int, int, int]] = set()
            for c in items.classes:
                windows = _windows(ids, pairs, ends, c)
                doc = np.searchsorted(off, windows, "right") - 1
                lo, hi = off[doc], off[doc + 1]
                for at in range(0, len(windows), WALKED):
                    part = slice(at, at + WALKED)
                    first, its = windows[part], doc[part]
                    keys = items.keys(ids, first, np.minimum(first + c.size, hi[part]), lo[part], hi[part], c.size)
                    a = np.searchsorted(c.keys, keys)
                    walk, i = np.nonzero((a < len(c.keys)) & (c.keys[np.minimum(a, len(c.keys) - 1)] == keys))
                    z = np.searchsorted(c.keys, keys[walk, i], "right")
                    near = {(int(x), int(u)) for x, p, q in zip(i, a[walk, i], z, strict=True) for u in c.units[p:q]}
                    for x, u in sorted(near):
                        _confirm(items, u, ids, pairs, int(lo[at + x]), int(hi[at + x]), int(first[x]), int(its[x]), found, tried)
            hits = sorted((d, k, *part) for (d, k), part in found.items())
            hits = [(d, items.items[k][0], len(items.items[k][1]), *part) for d, k, *part in hits] + _exact(items, ids, ends, off)
            doc_ids = b.column("doc_id").to_pylist() if hits else []
            yield pa.RecordBatch.from_pylist(
                [{"doc_id": doc_ids[d], "item_id": item, "first_word": first, "n_words": end - first, "distance": dist,
                  "similarity": 1 - dist / n} for d, item, n, dist, first, end in hits],
                schema=pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("first_word", pa.int64()), ("n_words", pa.int64()),
                                  ("distance", pa.int64()), ("similarity", pa.float64())]))
    return run


def _exact(items: Items, ids: np.ndarray, ends: np.ndarray, off: np.ndarray) -> list[tuple[int, int, int, int, int, int]]:
    """``(doc, item, words, 0, first, end)``: the first place of every short item in each text that has it."""
    out = []
    for n, table in items.short.items():
        keys = _runs(ids, n)
        at = np.flatnonzero(_find(items.short_keys[n], keys))
        at = at[at + n <= ends[at]]
        doc = np.searchsorted(off, at, "right") - 1
        _, one = np.unique(np.stack([doc, keys[at].view(np.int64)]), axis=1, return_index=True)      # the first of equal ones
        for i in one.tolist():
            a, d = int(at[i]), int(doc[i])
            first = a - int(off[d])
            out += [(d, item, n, 0, first, first + n) for item in table.get(tuple(ids[a:a + n].tolist()), ())]
    return out


def _windows(ids, pairs, ends, c: Class) -> np.ndarray:
    """Window starts that have enough of the class's word pairs (see the q-gram lemma above)."""
    if len(ids) < 2:
        return np.zeros(0, np.int64)
    known = np.concatenate([[0], np.cumsum(c.has_pair[pairs], dtype=np.int32)])      # pairs that begin before a word
    end = np.minimum(np.arange(c.size - 1, len(ids) + c.size - 1), ends - 1)
    return np.flatnonzero(known[end] - known >= max(1, c.size - 1 - 2 * c.edits))


def _confirm(items: Items, u: int, ids, pairs, lo: int, hi: int, window: int, doc: int, found: dict, tried: set) -> None:
    """Keep the best part of the text near ``window`` for the item of unit ``u``, if near enough; each place is tried once."""
    k, at, part, edits = items.units[u]
    item, words, most = items.items[k]
    best = found.get((doc, k))
    if best is not None and best[0] == 0:
        return
    if len(part) == len(words):
        first, last = window, window
    else:
        # where the item would begin, give or take the part's edits, its class and the item's edits: one try for each stretch of such places
        size = most + len(part)
        first = (window - at) // size * size
        last = first + size
        first -= edits + len(part)
        last += edits + len(part)
    if (doc, k, first) in tried:
        return
    tried.add((doc, k, first))
    a, z = max(lo, first - most), min(hi, last + len(words) + most)
    own = items.own_pairs[k]
    if sum(p in own for p in pairs[a:z - 1].tolist()) < len(words) - 1 - 2 * most:      # the q-gram lemma again, for this item alone
        return
    match = edit_match(words.tolist(), ids[a:z].tolist(), most, items.masks[k])
    if match is not None:
        nearest = (match[0], match[1] + a - lo, match[2] + a - lo)
        if best is None or nearest < best:
            found[doc, k] = nearest


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, repeats: int = REPEATS, sampled: int = SAMPLED,
          block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``SCHEMA``: the best matching part of every document for every benchmark item it contains.

    ``docs(doc_id, text, ...)`` are read once for each block of items; a block holds
    about ``block_chars`` characters of items and travels with the tasks. ``first_word``
    counts from 0. Ties go to the earliest part. Null or empty texts contain nothing;
    items of fewer than ``MIN_WORDS`` words are found where all their words stand in
    order, and items without a word nowhere; repeated rows repeat their results. Empty
    tables: no rows.
    """
    bounded_batches(docs.sparkSession)
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_chars))
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).distinct().collect()
        part = docs.mapInArrow(_search(Items(sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0, r[1])), similarity, repeats, sampled)), SCHEMA)
        out = part if out is None else out.union(part)
    return out
