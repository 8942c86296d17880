"""Sum-of-squares packing of tokenised documents into training sequences.

Every task packs its own rows as they come. Full windows are cut off the front of
a document; the rest goes, as one piece, to the open window of the fill level that
makes the sum of squared counts of open windows by level smallest (an empty window
counts as level 0). The counts are kept in an array by level. What is open at the
end of a task, or when more than ``MAX_OPEN`` windows are open, is cut and joined to
full windows, and the last remainder is cut to lengths that are powers of two, which
need no padding.
"""

from __future__ import annotations

import re
import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import bounded_batches

WINDOW = 4096
END_ID = 2
END = END_ID.to_bytes(4, "little")
MAX_OPEN = 2048                  # open windows a task keeps; their ids are all that is in memory
CACHED = 500_000                 # chunks, and words, whose ids a Python worker keeps (about 150 MB)
CHUNK_CHARS = 256                # longer chunks are not kept

SCHEMA = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
          "`offset` bigint, padding bigint")


class Encoder(dict):
    """Token ids of whole texts. The vocabulary drops white space and never joins across it, so the ids of a
    text are those of its white-space separated chunks; this dictionary keeps the ids of the common ones.

    A chunk of Latin-1 characters is cut into words as the tokenizer does it, and new words go to its merge
    model alone, which is several times faster than the whole tokenizer. All other chunks go to the tokenizer.
    """

    #: white space for str.split(), but not for the tokenizer
    ODD = "\x1c\x1d\x1e\x1f"
    PLAIN = re.compile(r"[!-~¡-ÿ]+")
    # The tokenizer's words, for lower-case Latin-1, and its characters for bytes.
    WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]|[^a-zªµºß-öø-ÿ0-9²³¹¼-¾]+")
    SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]

    def __init__(self, path: str):
        super().__init__()
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        hidden = [b for b in range(256) if b not in self.SHOWN]
        self.shown = {b: chr(256 + hidden.index(b)) if b in hidden else chr(b) for b in range(256)}
        self.bytes = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.words: dict[str, bytes] = {}

    def raw(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, chunk: str) -> bytes:
        if not self.PLAIN.fullmatch(chunk) or "<|" in chunk:
            ids = self.raw(chunk)
        else:
            words = self.words
            ids = b"".join([words.get(w) or self.word(w) for w in self.WORDS.findall(chunk.lower())])
        if len(chunk) <= CHUNK_CHARS:
            self[chunk] = ids
        return ids

    def word(self, word: str) -> bytes:
        shown = word if word.isascii() else word.encode().decode("latin-1").translate(self.shown)
        ids = b"".join([self.bytes[t.id] for t in self.model.tokenize(shown)])
        if len(word) <= CHUNK_CHARS:
            self.words[word] = ids
        return ids

    def __call__(self, text: str | None) -> np.ndarray:
        """The ids of a text, followed by the end id."""
        if len(self) > CACHED:
            self.clear()
        if len(self.words) > CACHED:
            self.words.clear()
        text = text or ""
        ids = self.raw(text) if any(c in text for c in self.ODD) else b"".join([self[x] for x in text.split()])
        return np.frombuffer(ids + END, "<u4")


class Packer:
    """Pieces ``(doc_id, start, ids, doc_tokens)`` in; finished sequences, as lists of such pieces, out."""

    def __init__(self, window: int = WINDOW, max_open: int = MAX_OPEN):
        self.window, self.max_open = window, max_open
        self.count = np.zeros(window + 1, np.int64)       # open windows by fill level
        self.open: list[deque] = [deque() for _ in range(window + 1)]

    def add(self, doc_id, ids: np.ndarray):
        total, at = len(ids), 0
        while total - at >= self.window:
            yield [(doc_id, at, ids[at:at + self.window], total)]
            at += self.window
        if at == total:
            return
        size, n = total - at, self.count
        # change of the sum of squares, less a constant, if a window of level h takes the piece
        change = -2 * n[:self.window - size + 1]
        change[:self.window - size] += 2 * n[size:self.window] + 1
        change[0] = 2 * n[size]                           # a new window
        change[1:][n[1:self.window - size + 1] == 0] = np.iinfo(np.int64).max
        level = len(change) - 1 - int(np.argmin(change[::-1]))      # ties: the fullest window
        pieces = self.open[level].popleft() if level else []
        self.count[level] -= level > 0
        pieces.append((doc_id, at, ids[at:], total))
        if level + size == self.window:
            yield pieces
        else:
            self.open[level + size].append(pieces)
            self.count[level + size] += 1
            if self.count.sum() > self.max_open:
                yield from self.close(keep=1)

    def close(self, keep: int = 0):
        """Cut and join all open windows to full ones; the remainder to powers of two, or (``keep``) to an open window."""
        rest: list[tuple] = []
        size = 0
        for level in range(self.window, 0, -1):
            while self.open[level]:
                for doc_id, start, ids, total in self.open[level].popleft():
                    while size + len(ids) >= self.window:
                        cut = self.window - size
                        yield [*rest, (doc_id, start, ids[:cut], total)]
                        start, ids, rest, size = start + cut, ids[cut:], [], 0
                    if len(ids):
                        rest.append((doc_id, start, ids, total))
                        size += len(ids)
        self.count[:] = 0
        if keep and size:
            self.open[size].append(rest)
            self.count[size] = 1
            return
        while size:
            want = 1 << (size.bit_length() - 1)
            size -= want
            part = []
            while want:
                doc_id, start, ids, total = rest.pop(0)
                part.append((doc_id, start, ids[:want], total))
                if len(ids) > want:
                    rest.insert(0, (doc_id, start + want, ids[want:], total))
                want -= min(want, len(ids))
            yield part


_encoders: dict[str, Encoder] = {}


def _pack(tokenizer: str, window: int, with_ids: bool):
    def run(batches):
        from pyspark import TaskContext
        encode = _encoders.get(tokenizer) or _encoders.setdefault(tokenizer, Encoder(tokenizer))
        packer, number = Packer(window), TaskContext.get().partitionId() << 36
        rows: list[tuple] = []

        def take(sequence):
            nonlocal number
            at, size = 0, sum(len(p[2]) for p in sequence)
            padding = 0 if size & (size - 1) == 0 else window - size
            for doc_id, start, ids, total in sequence:
                rows.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), total, number, at, padding, ids))
                at += len(ids)
            number += 1

        def flush():
            cols = list(zip(*rows, strict=True)) or [[]] * 9
            rows.clear()
            arrays = [pa.array(c, pa.int64()) for c in cols[:8]]
            if with_ids:
                offsets = np.concatenate([[0], np.cumsum([len(i) for i in cols[8]])]).astype(np.int32)
                values = np.concatenate(cols[8]).astype(np.int32) if cols[8] else np.zeros(0, np.int32)
                arrays.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)))
            return pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padding",
                                                       *["ids"] * with_ids])

        for b in W.slices(batches, "text", W.SMALL):
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                for sequence in packer.add(doc_id, encode(text)):
                    take(sequence)
            yield flush()
        for sequence in packer.close():
            take(sequence)
            if len(rows) > 5000:
                yield flush()
        yield flush()
    return run


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, with_ids: bool = True) -> DataFrame:
    """``SCHEMA`` (and ``ids array<int>``): one row for each piece of each row of ``docs(doc_id, text, ...)``.

    A document is its token ids by the file ``tokenizer``, then ``END_ID``; null or empty
    text: the end id alone. Every id lies in exactly one piece. Sequences hold ``window``
    ids at most; ``padding`` is what the piece's sequence lacks to ``window`` (0 at powers of
    two). Sequence ids are unique over the tasks. Repeated rows are packed each for itself.
    Empty table: no rows.
    """
    bounded_batches(docs.sparkSession)
    schema = SCHEMA + (", ids array<int>" if with_ids else "")
    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(_pack(tokenizer, window, with_ids), schema))
