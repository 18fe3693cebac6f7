"""SentencePiece models on the tokenizers library: encode, decode, parity.

The model file's protobuf is read field by field; from it a ``Tokenizer`` is
built with the model's normaliser, the metaspace marker, unigram scores or
merges in the order of the scores, and byte fallback.  Batches are encoded by
the library's own threads.  Where the vocabulary has no piece with the marker
behind another character and white space is kept as it is, runs of spaces with
the word after them are independent: their ids, and the text of their ids, are
remembered, and every new run is held against the reference library, which
proves parity for each text made of them.  Other models are compared text by
text.

Defined results: a null text is empty and has no ids; ``round_trip`` is whether
decoding gives the text back (a text with the marker itself, or one that the
normaliser changes, does not).  Repeated rows give equal results.  An empty
table gives an empty result.  Only the id and text columns are read.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from techmine.llm.common import prepare

MARK = "▁"
CACHE_RUNS = 500_000
THREADS = 2
JOINED = 512  # new runs that one text of a batch holds

# Piece types and model types of the format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _varint(b: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = b[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return value, at
        shift += 7


def fields(b: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message; floats as four bytes."""
    at = 0
    while at < len(b):
        key, at = _varint(b, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(b, at)
        else:
            if kind == 2:
                size, at = _varint(b, at)
            else:
                size = 8 if kind == 1 else 4
            value, at = b[at:at + size], at + size
        yield key >> 3, value


@dataclass
class Model:
    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    types: list[int] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    unk_id: int = 0
    charsmap: bytes = b""
    dummy_prefix: bool = True
    collapse_spaces: bool = True
    escape_spaces: bool = True
    suffix_spaces: bool = False


def parse_model(data: bytes) -> Model:
    m = Model()
    for number, value in fields(data):
        if number == 1:
            piece = dict(fields(value))
            m.pieces.append(piece[1].decode())
            m.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
            m.types.append(piece.get(3, NORMAL))
        elif number == 2:
            spec = dict(fields(value))
            m.kind, m.byte_fallback = spec.get(3, UNIGRAM), bool(spec.get(35, 0))
            m.unk_id, m.suffix_spaces = spec.get(40, 0), bool(spec.get(24, 0))
        elif number == 3:
            spec = dict(fields(value))
            m.charsmap = spec.get(2, b"")
            m.dummy_prefix, m.collapse_spaces = bool(spec.get(3, 1)), bool(spec.get(4, 1))
            m.escape_spaces = bool(spec.get(5, 1))
    return m


def merges_of(m: Model) -> list[tuple[str, str]]:
    """Both halves of every normal piece, best score first: the order in which
    the trainer's merges apply."""
    usable = {p for p, t in zip(m.pieces, m.types, strict=True) if t in (NORMAL, USER_DEFINED)}
    ranked = sorted((i for i, t in enumerate(m.types) if t in (NORMAL, USER_DEFINED) and len(m.pieces[i]) > 1),
                    key=lambda i: (-m.scores[i], len(m.pieces[i])))
    return [(p[:k], p[k:]) for i in ranked for p in [m.pieces[i]] for k in range(1, len(p))
            if p[:k] in usable and p[k:] in usable]


def build_tokenizer(m: Model):
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers
    unk = m.pieces[m.unk_id]
    if m.kind == BPE:
        vocab = {p: i for i, p in enumerate(m.pieces)}
        model = models.BPE(vocab, merges_of(m), unk_token=unk, fuse_unk=True, byte_fallback=m.byte_fallback)
    elif m.kind == UNIGRAM:
        model = models.Unigram(list(zip(m.pieces, m.scores, strict=True)), m.unk_id, m.byte_fallback)
    else:
        raise ValueError(f"model type {m.kind} is neither unigram nor BPE")
    steps = [normalizers.Precompiled(m.charsmap)] if m.charsmap else []
    if m.collapse_spaces:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()]
    if m.dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    if m.escape_spaces:
        steps.append(normalizers.Replace(" ", MARK))
    tok = Tokenizer(model)
    tok.normalizer = normalizers.Sequence(steps)
    tok.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(),
                                     *[decoders.Strip(" ", 1, 0)] * m.dummy_prefix])
    return tok


RUN = re.compile(" *[^ ]*")


class Codec:
    """Encoder and decoder of one model file; ids as little-endian 32 bits."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
        import sentencepiece
        with open(path, "rb") as f:
            self.model = m = parse_model(f.read())
        self.tokenizer = build_tokenizer(m)
        self.reference = sentencepiece.SentencePieceProcessor(model_file=path)
        inner = any(MARK in p.lstrip(MARK) for p, t in zip(m.pieces, m.types, strict=True) if t == NORMAL)
        self.by_runs = (m.dummy_prefix and m.escape_spaces and not m.collapse_spaces and not m.charsmap
                        and not m.suffix_spaces and not inner and USER_DEFINED not in m.types and MARK in m.pieces)
        self.starts = np.array([p.startswith(MARK) for p in m.pieces])
        self.double = np.array([p.startswith(MARK * 2) for p in m.pieces])
        if self.by_runs:  # cuts a joined text into its runs before any merge
            from tokenizers import pre_tokenizers
            self.cutting = build_tokenizer(m)
            self.cutting.pre_tokenizer = pre_tokenizers.Split(MARK, "merged_with_next")
        self._reset()

    def _reset(self) -> None:
        self.runs: dict[str, bytes] = {}
        self.unlike: set[str] = set()  # runs for which the libraries differ
        self.texts: dict[bytes, str] = {}
        if self.by_runs:  # a single space without a word
            self.runs[""] = self.model.pieces.index(MARK).to_bytes(4, "little")

    def _encode(self, texts: list[str]) -> tuple[list[bytes], list[bool]]:
        ids = [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        alike = [a == b for a, b in zip(ids, self.reference.encode(texts, num_threads=THREADS), strict=True)]
        return [np.array(i, "<u4").tobytes() for i in ids], alike

    def _learn(self, new: list[str]) -> None:
        """Ids of new runs.  Words without space or marker are joined, many to a
        text, for both libraries; their ids part again at the marked pieces."""
        words = [r for r in new if r and " " not in r and MARK not in r]
        rest = [r for r in new if " " in r or MARK in r]
        groups = [words[i:i + JOINED] for i in range(0, len(words), JOINED)]
        texts = [" ".join(g) for g in groups]
        found = self.cutting.encode_batch_fast(texts, add_special_tokens=False) if texts else []
        wanted = self.reference.encode(texts, num_threads=THREADS) if texts else []
        for group, e, want in zip(groups, found, wanted, strict=True):
            ids = np.array(e.ids, "<u4")
            at = np.flatnonzero(self.starts[ids])
            if len(at) != len(group) or e.ids != want:
                rest += group  # run by run
                continue
            raw = ids.tobytes()
            for run, i, j in zip(group, (4 * at).tolist(), [*(4 * at[1:]).tolist(), len(raw)], strict=True):
                self.runs[run] = raw[i:j]
        if rest:
            for run, ids, alike in zip(rest, *self._encode(rest), strict=True):
                self.runs[run] = ids
                if not alike:
                    self.unlike.add(run)

    def _read(self, new: list[bytes]) -> None:
        """Texts of new runs of ids, joined in the same way."""
        firsts = np.frombuffer(b"".join(r[:4] for r in new), "<u4")
        plain = self.starts[firsts] & ~self.double[firsts]
        words = [r for r, p in zip(new, plain.tolist(), strict=True) if p]
        rest = [r for r, p in zip(new, plain.tolist(), strict=True) if not p]
        groups = [words[i:i + JOINED] for i in range(0, len(words), JOINED)]
        texts = self.tokenizer.decode_batch([np.frombuffer(b"".join(g), "<u4").tolist() for g in groups])
        for group, text in zip(groups, texts, strict=True):
            parts = text.split(" ")
            if len(parts) == len(group):
                self.texts.update(zip(group, [" " + p for p in parts], strict=True))
            else:
                rest += group
        # The decoder drops one leading space, which every run but the first keeps.
        found = self.tokenizer.decode_batch([np.frombuffer(r, "<u4").tolist() for r in rest])
        for run, text in zip(rest, found, strict=True):
            first = int(np.frombuffer(run, "<u4", 1)[0])
            self.texts[run] = (" " if self.starts[first] else "") + text

    @staticmethod
    def _split(text: str) -> list[str]:
        """Runs of spaces with the word behind, less the one space that the
        prefix of each stands for."""
        if "  " not in text and text[0] != " ":
            return text.split(" ")
        return [r[1:] for r in RUN.findall(" " + text) if r]

    def encode(self, texts: list[str | None]) -> tuple[list[bytes], list[bool]]:
        """Ids of each whole text, and whether the reference library agrees."""
        texts = [t or "" for t in texts]
        if not self.by_runs:
            return self._encode(texts)
        if len(self.runs) + len(self.texts) > CACHE_RUNS:
            self._reset()
        parts = [self._split(t) if t else [] for t in texts]
        new = list(set().union(*parts).difference(self.runs))
        if new:
            self._learn(new)
        get = self.runs.__getitem__
        alike = [not self.unlike or self.unlike.isdisjoint(p) for p in parts]
        return [b"".join(map(get, p)) for p in parts], alike

    def decode(self, ids: list[bytes]) -> list[str]:
        """Texts of id sequences."""
        arrays = [np.frombuffer(i, "<u4") for i in ids]
        if not self.by_runs:
            return self.tokenizer.decode_batch([a.tolist() for a in arrays], skip_special_tokens=True)
        cut = []
        for raw, a in zip(ids, arrays, strict=True):
            at = [0, *(4 * (np.flatnonzero(self.starts[a[1:]]) + 1)).tolist(), len(raw)]
            cut.append([raw[i:j] for i, j in zip(at, at[1:], strict=False) if j > i])
        new = list(set().union(*cut).difference(self.texts))
        if new:
            self._read(new)
        get = self.texts.__getitem__
        return [("".join(map(get, c))).removeprefix(" ") for c in cut]


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """The codec of a model file, built once per worker."""
    return Codec(path)


def encoded(docs: DataFrame, model_path: str, id_col: str = "doc_id", text: str = "text",
            with_ids: bool = True) -> DataFrame:
    """One row per document: id, n_tokens, ids_crc32, round_trip, parity, and
    the ids if asked for."""
    prepare(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            ids, alike = c.encode(texts)
            same = [x == y for x, y in zip(c.decode(ids), texts, strict=True)]
            cols = [b.column(0), pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array([zlib.crc32(i) for i in ids], pa.int64()), pa.array(same, pa.bool_()),
                    pa.array(alike, pa.bool_())]
            names = ["id", "n_tokens", "ids_crc32", "round_trip", "parity"]
            if with_ids:
                cols.append(pa.array([np.frombuffer(i, "<i4") for i in ids], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    schema = f"id {kind}, n_tokens long, ids_crc32 long, round_trip boolean, parity boolean"
    out = docs.select(id_col, text).mapInArrow(run, schema + ", ids array<int>" * with_ids)
    return out.withColumnRenamed("id", id_col)


def decoded(rows: DataFrame, model_path: str, id_col: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(id, text) of rows with an array of ids; null ids give the empty text."""
    prepare(rows.sparkSession)
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        for b in batches:
            raw = [np.array(i or [], "<u4").tobytes() for i in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(c.decode(raw), pa.string())], ["id", "text"])

    return rows.select(id_col, ids).mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_col)
