"""Fill-in-the-middle by a secondary sort.

A document is cut into units (a run of ASCII letters, or any other character) and,
by a hash of its id, into prefix, middle and suffix. Every part leaves its task as
pieces of at most ``PIECE`` bytes, cut between units and keyed by the row and the
place in the output. A repartition by row, sorted by (row, place) within partitions (as
``repartitionAndSortWithinPartitions`` does it, in its DataFrame form), brings the
pieces of an output together in order: they stream through an incremental
digest or, for the texts, are joined. Beyond the cut, no task needs more than a piece and
a hash state of a document (the texts: one document).

For the way back the same stream is parsed: the form says which sentinel is next,
the bytes say where it stands. What lies between the sentinels gets its place in the
original, and a second sort of the partitions, without a shuffle, brings the parts
into their old order for the second digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import byte_batches

PIECE = 64 << 10                 # bytes of a piece at most
FLUSH = 4 << 20                  # bytes of pieces that are handed on at a time
BLOCK = 64 << 10                 # bytes whose units are counted together
PLAIN_FROM, SPM_BELOW = 90, 20   # of 100: plain from here on; of the others, spm below this
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
ORDER = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE), "plain": ()}
PLACE = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}            # of a part in the original
LAST = 1 << 62                   # place of the row that ends a document

_HEAD = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint"
PIECES = f"row bigint, place bigint, {_HEAD}, piece binary"
_SORTED = f"row bigint, place bigint, {_HEAD}, output_sha256 string, piece binary"
SCHEMA = f"{_HEAD}, output_sha256 string, restored_sha256 string"
TEXTS = f"{_HEAD}, output string"

_LETTER = np.array([chr(b).isalpha() and b < 128 for b in range(256)])
_INNER = np.array([0x80 <= b < 0xC0 for b in range(256)])       # bytes inside a character


def unit_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which bytes of a text column begin a unit."""
    letter = _LETTER[data]
    start = ~_INNER[data]
    start[1:] &= ~(letter[1:] & letter[:-1])
    start[offsets[:-1][np.diff(offsets) > 0]] = True
    return start


class Units:
    """The unit starts of one text, found by their number without a list of all of them."""

    def __init__(self, start: np.ndarray):
        self.start = start
        self.before = np.concatenate([[0], np.cumsum([np.count_nonzero(start[a:a + BLOCK]) for a in range(0, len(start), BLOCK)])]).astype(np.int64)
        self.n = int(self.before[-1])

    def byte(self, k: int) -> int:
        """The first byte of unit ``k``, or the end of the text after the last one."""
        if k >= self.n:
            return len(self.start)
        block = int(np.searchsorted(self.before, k, "right")) - 1
        a = block * BLOCK
        return a + int(np.flatnonzero(self.start[a:a + BLOCK])[k - int(self.before[block])])

    def chunks(self, a: int, b: int) -> Iterator[tuple[int, int]]:
        """``[a, b)`` in pieces of at most ``PIECE`` bytes, cut between units where one ends in time."""
        while b - a > PIECE:
            known = np.flatnonzero(self.start[a + 1:a + PIECE + 1])
            cut = a + 1 + int(known[-1]) if len(known) else a + PIECE
            yield a, cut
            a = cut
        if b > a:
            yield a, b


def draws(doc_id: int | None) -> list[int]:
    """h1 to h4 of a document; a null id counts as an empty one."""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(h[i:i + 8], 16) for i in range(0, 32, 8)]


def form_of(h: list[int], text: bytes) -> str:
    if not text or h[2] % 100 >= PLAIN_FROM or any(s in text for s in PLACE):
        return "plain"
    return "spm" if h[3] % 100 < SPM_BELOW else "psm"


def document_pieces(doc_id, text: bytes, start: np.ndarray) -> Iterator[tuple]:
    """``(place, doc_id, n, form, prefix_chars, middle_chars, piece)``; the head stands at place 0 only."""
    units, h = Units(start), draws(doc_id)
    form = form_of(h, text)
    if form == "plain":
        head, parts = (doc_id, units.n, form, None, None), [(b"", 0, len(text))]
    else:
        a, b = sorted(units.byte(x % (units.n + 1)) for x in h[:2])
        inner = _INNER[np.frombuffer(text, np.uint8)[:b]]
        head = (doc_id, units.n, form, a - int(np.count_nonzero(inner[:a])), b - a - int(np.count_nonzero(inner[a:])))
        span = {PREFIX: (0, a), MIDDLE: (a, b), SUFFIX: (b, len(text))}
        parts = [(s, *span[s]) for s in ORDER[form]]
    place, before = 0, b""
    for sentinel, x, y in parts:
        before += sentinel
        for c, d in units.chunks(x, y):
            yield (place, *(head if not place else (None,) * 5), before + text[c:d])
            place, before = place + 1, b""
    if before or not place:
        yield (place, *(head if not place else (None,) * 5), before)


class Parser:
    """Output pieces in; ``(place in the original, bytes)`` out. A sentinel may lie across pieces."""

    def __init__(self, form: str):
        self.next, self.part, self.count, self.held = list(ORDER[form]), 0, 0, b""

    def __call__(self, piece: bytes, last: bool = False) -> Iterator[tuple[int, bytes]]:
        data, self.held = self.held + piece, b""
        while self.next:
            at = data.find(self.next[0])
            if at < 0:
                if not last:                             # its first bytes may be here
                    cut = max(0, len(data) - len(self.next[0]) + 1)
                    data, self.held = data[:cut], data[cut:]
                break
            yield from self._out(data[:at])
            data = data[at + 3:]
            self.part, self.count = PLACE[self.next.pop(0)], 0
        yield from self._out(data)

    def _out(self, data: bytes):
        if data:
            yield self.part << 40 | self.count, data
            self.count += 1


def _rows(batches) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def _batches(rows, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows, the last column bytes or text, as batches of about ``FLUSH`` bytes."""
    kept, size = [], 0
    for r in rows:
        kept.append(r)
        size += 64 + len(r[-1] or b"")
        if size >= FLUSH:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*kept, strict=True), schema, strict=True)], schema=schema)
            kept, size = [], 0
    if kept:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*kept, strict=True), schema, strict=True)], schema=schema)
    pa.default_memory_pool().release_unused()


def _schema(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(n, kinds[t]) for n, t in (c.split() for c in ddl.split(", "))])


def _cut(batches):
    from pyspark import TaskContext
    row = TaskContext.get().partitionId() << 36

    def rows():
        nonlocal row
        for b in W.slices(batches, "text", W.SMALL):
            data, off = W.text_bytes(b.column("text"))
            start = unit_starts(data, off)
            for doc_id, a, z in zip(b.column("doc_id").to_pylist(), off[:-1].tolist(), off[1:].tolist(), strict=True):
                for piece in document_pieces(doc_id, data[a:z].tobytes(), start[a:z]):
                    yield row, *piece
                row += 1
    yield from _batches(rows(), _schema(PIECES))


def pieces(docs: DataFrame) -> DataFrame:
    """``PIECES`` of every row of ``docs(doc_id, text, ...)``, in no order.

    ``row`` numbers the rows by task, so that equal ids and equal rows stay apart; a
    task that is repeated has to meet its rows in the same order, as scans of files do.
    Null text: empty. Empty text: one empty piece."""
    byte_batches(docs.sparkSession)
    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(_cut, PIECES))


def _in_order(cut: DataFrame) -> DataFrame:
    """Repartitioned by row and sorted within partitions: the pieces of an output, one after the other."""
    return cut.repartition("row").sortWithinPartitions("row", "place")


def _digest(batches):
    """The digest of every output, and its parts with their places in the original."""
    def rows():
        row, head, sha, parse = None, None, None, None

        def end():
            for place, data in parse(b"", last=True):
                yield row, place, *(None,) * 6, data
            yield row, LAST, *head, sha.hexdigest(), None
        for r, place, *new, piece in _rows(batches):
            if r != row:
                if row is not None:
                    yield from end()
                row, head, sha, parse = r, new, hashlib.sha256(), Parser(new[2])
            sha.update(piece)
            for at, data in parse(piece):
                yield row, at, *(None,) * 6, data
        if row is not None:
            yield from end()
    yield from _batches(rows(), _schema(_SORTED))


def _restored(batches):
    def rows():
        sha = hashlib.sha256()
        for _, place, *head, piece in _rows(batches):
            if place == LAST:
                yield *head, sha.hexdigest()
                sha = hashlib.sha256()
            else:
                sha.update(piece)
    yield from _batches(rows(), _schema(SCHEMA))


def digests(docs: DataFrame) -> DataFrame:
    """``SCHEMA``, a row for each row of ``docs(doc_id, text, ...)``: its units, form and cuts, and the SHA-256 of the
    output and of the text rebuilt from it.

    Plain (empty text, a sentinel in the text, or by the hash): ``prefix_chars`` and ``middle_chars`` are null.
    Null text: empty; null id: hashed as an empty one. Rows with equal ids are cut alike, each for itself. Empty table: no rows."""
    out = _in_order(pieces(docs)).mapInArrow(_digest, _SORTED)
    return out.sortWithinPartitions("row", "place").mapInArrow(_restored, SCHEMA)


def _joined(batches):
    def rows():
        row, head, parts = None, None, []
        for r, _, *new, piece in _rows(batches):
            if r != row:
                if row is not None:
                    yield *head, b"".join(parts).decode()
                row, head, parts = r, new, []
            parts.append(piece)
        if row is not None:
            yield *head, b"".join(parts).decode()
    yield from _batches(rows(), _schema(TEXTS))


def transform(docs: DataFrame) -> DataFrame:
    """``TEXTS``: the output text of each row of ``docs(doc_id, text, ...)``; otherwise as ``digests``."""
    return _in_order(pieces(docs)).mapInArrow(_joined, TEXTS)


def restore_text(output: str | None, form: str | None) -> str:
    """The text that ``output`` was made of. A null form counts as plain."""
    parse, data = Parser(form or "plain"), (output or "").encode()
    return b"".join(p for _, p in sorted(parse(data, last=True))).decode()


def restore(outputs: DataFrame, column: str = "text") -> DataFrame:
    """``outputs(output, form, ...)`` with the original texts in ``column``, which takes the place of one of that name."""
    def run(batches):
        for b in batches:
            texts = [restore_text(o, f) for o, f in zip(b.column("output").to_pylist(), b.column("form").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*b.schema.names, column])
    byte_batches(outputs.sparkSession)
    kept = outputs.drop(column)
    return kept.mapInArrow(run, kept.withColumn(column, F.lit("")).schema)
