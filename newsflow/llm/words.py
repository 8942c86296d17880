"""Word hashes of whole Arrow text columns, computed on the raw UTF-8 bytes.

Every byte gets a random 64-bit value (0 for separators); a word's hash is its
polynomial over these values modulo 2**64, read off one running sum, and then
mixed. All work is on numpy arrays; a batch is cut into pieces at separators,
so memory follows the piece and the number of words, not the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20                  # bytes hashed at a time
SLICE = 8 << 20                  # bytes of text handled at a time, if not told otherwise
SMALL = 2 << 20                  # where work does not get cheaper in larger slices
BASE = 0x9E3779B97F4A7C15 | 1
_U = np.uint64
_random = np.random.default_rng(20240101)
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
SEEDS = _random.integers(1, 2**63, 4096, dtype=np.uint64)

ASCII_SPACE = b" \t\n\x0b\x0c\r"


def _table(is_word, lower: bool) -> np.ndarray:
    t = np.zeros(256, np.uint64)
    for b in range(256):
        if is_word(b):
            t[b] = _BYTE[b + 32 if lower and 65 <= b <= 90 else b]
    return t


#: words are runs of anything but ASCII white space; A-Z are lower-cased
SPACED = _table(lambda b: b not in ASCII_SPACE, lower=True)
#: words are runs of ASCII letters and digits and of all non-ASCII characters
ALNUM = _table(lambda b: b >= 128 or chr(b).isalnum(), lower=True)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, PIECE)
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 2**64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"], _powers["down"]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array and its offsets (nulls are empty)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def word_spans(texts: pa.Array, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(hash, first byte, end byte, words before each text)`` of all words of a text column."""
    data, offsets = text_bytes(texts)
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    found, at = [], 0
    while at < n:
        stop = min(n, at + PIECE)
        if stop < n and not edge[stop]:
            stop = _cut(data, edge, symbols, at, stop)
        sym = symbols[data[at:stop]]
        inside, m = sym != 0, stop - at
        first, last = inside.copy(), inside.copy()
        breaks = ~inside[:-1] | edge[at + 1:stop]
        first[1:] &= breaks
        last[:-1] &= ~inside[1:] | edge[at + 1:stop]
        s, e = np.flatnonzero(first), np.flatnonzero(last)
        up, down = _power(m)
        run = np.cumsum(sym * up[:m])
        h = run[e] - np.where(s > 0, run[s - 1], _U(0))
        found.append((mix(h * down[s]), s + at, e + at + 1))
        at = stop
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    h, s, e = (np.concatenate(x) for x in zip(*found, strict=True))
    return h, s, e, np.searchsorted(s, offsets)


def _cut(data, edge, symbols, at: int, stop: int) -> int:
    """The last place in ``(at, stop]`` where no word is cut, or else the first one after ``stop``."""
    free = np.flatnonzero(edge[at + 1:stop + 1] | (symbols[data[at + 1:stop + 1]] == 0))
    if len(free):
        return at + 1 + int(free[-1])
    while stop < len(data):
        end = min(len(data), stop + PIECE)
        free = np.flatnonzero(edge[stop:end] | (symbols[data[stop:end]] == 0))
        if len(free):
            return stop + int(free[0])
        stop = end
    return len(data)


def give_back() -> None:
    """Return what a Python worker has freed to the system: workers live on between tasks, and several share an executor's memory."""
    import ctypes
    import gc
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
    if trim is not None:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about ``size`` bytes of ``column``, one row at least.

    What earlier tasks of the worker left is given back first, what this one used last."""
    give_back()
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1
            to = min(batch.num_rows, max(at + 1, to))
            yield batch.slice(at, to - at)
            at = to
    give_back()


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
