"""Fill-in-middle transformation by piece tables.

A document is a table of descriptors (buffer, start, length) over two immutable
buffers: the UTF-8 bytes of its text and the sentinels.  Cutting splits a
descriptor in two, an arrangement permutes descriptors, the inverse permutation
restores the document, and hashes stream over the descriptors; text is only
copied where the output itself is asked for.

The draws of a document come from the SHA-256 of ``<seed>:<decimal id>``: two cut
points, whether it is transformed at all, and the order of its parts.  Texts that
contain a sentinel stay plain, so an output always splits in one way.

Defined results: a null text counts as empty; an empty text is plain.  A null id
draws as ``<seed>:``.  Rows that repeat an id draw alike and each is returned.  An
empty table gives an empty result.  Cut points count code points, also of
combining marks and emoji.  Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from techmine.llm.common import prepare

# Fixed values of the formats: sentinels and the order of the parts.
PREFIX_MARK, SUFFIX_MARK, MIDDLE_MARK = b"<P>", b"<S>", b"<M>"
MARKS = PREFIX_MARK + SUFFIX_MARK + MIDDLE_MARK
TRANSFORMED_PCT = 90   # documents that are cut, per hundred
SPM_PCT = 20           # of these, suffix first

TEXT, MARK = 0, 1      # buffers
# Places of the cut table: prefix, middle, suffix, then the three sentinels.
P, M, S, P_MARK, S_MARK, M_MARK = range(6)
ARRANGEMENTS = {"psm": (P_MARK, P, S_MARK, S, M_MARK, M), "spm": (S_MARK, S, P_MARK, P, M_MARK, M)}

# Bytes looked at together when a code point is located.
BLOCK = 1 << 20


@dataclass(frozen=True)
class PieceTable:
    """Descriptors (buffer, start, length), in bytes, over immutable buffers."""

    buffers: tuple
    pieces: tuple

    @classmethod
    def of(cls, text, marks: bytes = MARKS) -> "PieceTable":
        view = memoryview(text)
        return cls((view, memoryview(marks)), ((TEXT, 0, len(view)),))

    def split(self, k: int, at: int) -> "PieceTable":
        """Piece ``k`` cut into two, the first one ``at`` bytes long."""
        buffer, start, length = self.pieces[k]
        halves = ((buffer, start, at), (buffer, start + at, length - at))
        return PieceTable(self.buffers, self.pieces[:k] + halves + self.pieces[k + 1:])

    def with_marks(self) -> "PieceTable":
        width = len(PREFIX_MARK)
        return PieceTable(self.buffers, self.pieces + tuple((MARK, width * k, width) for k in range(3)))

    def permuted(self, order) -> "PieceTable":
        return PieceTable(self.buffers, tuple(self.pieces[k] for k in order))

    def restored(self, order) -> "PieceTable":
        """The cut document again: the inverse of ``order``, without sentinels."""
        place = {k: at for at, k in enumerate(order)}
        return self.permuted([place[P], place[M], place[S]])

    def chunks(self) -> Iterator[memoryview]:
        for buffer, start, length in self.pieces:
            yield self.buffers[buffer][start:start + length]

    def digest(self) -> str:
        h = hashlib.sha256()
        for c in self.chunks():
            h.update(c)
        return h.hexdigest()

    def to_bytes(self) -> bytes:
        return b"".join(self.chunks())


def _starts(block: np.ndarray) -> np.ndarray:
    """Which bytes begin a code point."""
    return (block & 0xC0) != 0x80


def code_points(text: bytes) -> int:
    raw = np.frombuffer(text, np.uint8)
    return int(sum(np.count_nonzero(_starts(raw[k:k + BLOCK])) for k in range(0, len(raw), BLOCK)))


def byte_offset(text: bytes, n: int) -> int:
    """Bytes of the first ``n`` code points."""
    raw = np.frombuffer(text, np.uint8)
    for k in range(0, len(raw), BLOCK):
        first = _starts(raw[k:k + BLOCK])
        here = int(np.count_nonzero(first))
        if n < here:
            return k + int(np.flatnonzero(first)[n])
        n -= here
    return len(raw)


def draws(seed: str, doc_id: int | None) -> tuple[int, int, int, int]:
    key = f"{seed}:{'' if doc_id is None else doc_id}"
    digest = hashlib.sha256(key.encode()).digest()
    return tuple(int.from_bytes(digest[4 * k:4 * k + 4], "big") for k in range(4))


@dataclass(frozen=True)
class Cut:
    """One document: its form, cut points in code points, and its output."""

    n: int
    form: str
    prefix: int | None
    middle: int | None
    output: PieceTable


def cut(text: bytes, doc_id: int | None, seed: str, transformed_pct: int, spm_pct: int) -> Cut:
    n = code_points(text)
    h1, h2, h3, h4 = draws(seed, doc_id)
    table = PieceTable.of(text)
    if not n or h3 % 100 >= transformed_pct or any(m in text for m in (PREFIX_MARK, SUFFIX_MARK, MIDDLE_MARK)):
        return Cut(n, "plain", None, None, table)
    form = "spm" if h4 % 100 < spm_pct else "psm"
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    at, end = (low, high) if n == len(text) else (byte_offset(text, low), byte_offset(text, high))
    table = table.split(0, at).split(1, end - at).with_marks()
    return Cut(n, form, low, high - low, table.permuted(ARRANGEMENTS[form]))


def parsed(output: bytes, form: str) -> PieceTable:
    """The piece table of an output, over the output itself: its parts lie between
    the sentinels, which occur once each."""
    table = PieceTable.of(output, b"")
    if form == "plain":
        return table
    second, third = (SUFFIX_MARK, MIDDLE_MARK) if form == "psm" else (PREFIX_MARK, MIDDLE_MARK)
    width = len(second)
    a = output.index(second, width)
    b = output.index(third, a + width)
    for k, length in enumerate((width, a - width, width, b - a - width, width)):
        table = table.split(k, length)
    return table


def rebuilt(output: bytes, form: str) -> PieceTable:
    """The exact text from an output and its form."""
    table = parsed(output, form)
    return table if form == "plain" else table.restored(ARRANGEMENTS[form])


CUTS = ("id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, "
        "restored_sha256 string, pieces array<struct<buffer: int, start: long, length: long>>, output string")
NAMES = ["id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256", "pieces", "output"]
_PIECE = pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("length", pa.int64())])


def _transform(seed: str, transformed_pct: int, spm_pct: int, with_output: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                c = cut(raw, doc_id, seed, transformed_pct, spm_pct)
                output = c.output.to_bytes()
                pieces = [dict(zip(("buffer", "start", "length"), p)) for p in c.output.pieces]
                rows.append((doc_id, c.n, c.form, c.prefix, c.middle, c.output.digest(),
                             rebuilt(output, c.form).digest(), pieces, output.decode() if with_output else None))
            cols = list(zip(*rows)) if rows else [()] * 9
            types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(),
                     pa.list_(_PIECE), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], NAMES)
    return run


def _restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [None if o is None else rebuilt(o.encode(), f).to_bytes().decode()
                 for o, f in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["id", "text"])


def transformed(docs: DataFrame, seed: str = "1", transformed_pct: int = TRANSFORMED_PCT, spm_pct: int = SPM_PCT,
                with_output: bool = True, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its code points, form, cuts, the descriptors of its
    output (buffer 0 the text, 1 the sentinels; bytes), the output (if asked for),
    its hash, and the hash of the text rebuilt from output and form alone.

    Row by row: nothing is shuffled, and a lost task is simply run again.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    out = rows.mapInArrow(_transform(seed, transformed_pct, spm_pct, with_output), CUTS)
    return out.withColumnRenamed("id", id_col)


def restored(outputs: DataFrame, id_col: str = "doc_id", output: str = "output", form: str = "form") -> DataFrame:
    """(id, text): the exact texts, from outputs and forms."""
    prepare(outputs.sparkSession)
    rows = outputs.select(F.col(id_col).cast("long").alias("id"), output, form)
    return rows.mapInArrow(_restore, "id long, text string").withColumnRenamed("id", id_col)
