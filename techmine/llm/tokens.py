"""Token ids of whole texts by a public tokenizer file, inside Arrow tasks.

``Encoder`` gives exactly the ids of ``Tokenizer.encode(text,
add_special_tokens=False)``.  If the file's normaliser and pre-tokenizer treat
every run between white space by itself and ignore case (``word_bpe``), the ids
of a run are remembered, and the library only sees runs it has not met.  Arrow
numbers the distinct runs of a few MB of texts, so each is looked up once there.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

END_ID = 1
# Runs remembered by one worker (about 200 bytes each); then it starts anew.
CACHE_RUNS = 800_000
# Texts that are taken apart at once; a longer one is taken alone.
CHUNK_CHARS = 4_000_000

# The normaliser and splitting pattern that make runs independent.
WORD_NORMALISERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
                    {"type": "Lowercase"}]
WORD_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"

# That pattern for ASCII runs in lower case.
PIECE = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")

# A run of letters followed by these is two pieces for that pattern.
TAIL = b".,;:!?*%$#&()\"|-"


def _by_runs(spec: dict) -> bool:
    normal = (spec.get("normalizer") or {}).get("normalizers")
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    split = steps[0]
    return (normal == WORD_NORMALISERS and len(steps) == 2 and split.get("type") == "Split"
            and split.get("pattern") == {"Regex": WORD_PATTERN} and split.get("behavior") == "Removed"
            and split.get("invert") is True and steps[1].get("type") == "ByteLevel"
            and not steps[1].get("add_prefix_space") and spec["model"].get("end_of_word_suffix") == "</w>"
            and spec.get("post_processor") is None)


def _letters(word: str) -> bool:
    """Only letters, also once normalised and lower-cased."""
    return word.isalpha() and unicodedata.normalize("NFC", word).lower().isalpha()


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct runs between ASCII white space (where bytes.split cuts), the place of
    each run of all texts among them, and where each text's runs end."""
    raw = pa.array([t.encode("utf-8", "replace") for t in texts], pa.large_binary()).view(pa.large_string())
    split = pc.ascii_split_whitespace(raw)
    words = split.flatten()
    some = pc.not_equal(pc.binary_length(words), 0)  # at the edges of a text
    kept = np.concatenate([[0], np.cumsum(some.to_numpy(zero_copy_only=False))])
    coded = words.filter(some).dictionary_encode()
    return (coded.dictionary.view(pa.large_binary()).to_numpy(zero_copy_only=False), coded.indices.to_numpy(),
            kept[split.offsets.to_numpy()[1:]])


def _chunks(texts: list[str]) -> Iterator[list[str]]:
    """Texts in order, in lists of up to CHUNK_CHARS or of one text."""
    chunk, size = [], 0
    for t in texts:
        if chunk and size + len(t) > CHUNK_CHARS:
            yield chunk
            chunk, size = [], 0
        chunk.append(t)
        size += len(t)
    if chunk:
        yield chunk


def _without(texts: list[str], places: list[int]) -> list[str]:
    out = list(texts)
    for k in places:
        out[k] = ""
    return out


class Encoder:
    """Ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.vocab_size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.runs: dict[bytes, bytes] | None = {} if _by_runs(spec) else None
        specials = [t["content"] for t in spec.get("added_tokens") or []]
        self.special = re.compile("|".join(map(re.escape, specials))) if specials else None
        if self.runs is not None:
            self.ends = np.zeros(self.vocab_size, bool)  # the last token of a piece
            self.ends[[i for t, i in self.tokenizer.get_vocab(with_added_tokens=True).items()
                       if t.endswith("</w>")]] = True

    def _plain(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _learn_joined(self, words: list[bytes], pieces: list[int]) -> bool:
        """Remember the ids of runs of so many pieces each, encoded as one text; false if
        its pieces are not as many."""
        ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(words).decode()],
                                                        add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.ends[ids]) + 1
        last = np.cumsum(pieces)
        if len(ends) != last[-1] or not min(pieces):
            return False
        raw, at = ids.tobytes(), 0
        for word, to in zip(words, (ends[last - 1] * 4).tolist(), strict=True):
            self.runs[word] = raw[at:to]
            at = to
        return True

    def _learn(self, new: set[bytes]) -> None:
        """Remember the ids of runs: letters and their punctuation apart."""
        runs = self.runs
        cut = {}
        cores, others = set(), set()
        for w in new:
            core = w.rstrip(TAIL)
            if core and (core.isalpha() or _letters(core.decode())):
                cut[w] = core
                cores.add(core)
                if len(core) < len(w):
                    others.add(w[len(core):])
            else:
                others.add(w)
        cores = list(cores.difference(runs))
        if cores and not self._learn_joined(cores, [1] * len(cores)):
            others.update(cores)
        others = others.difference(runs)
        ascii_ = [w for w in others if w.isascii()]
        if ascii_ and self._learn_joined(ascii_, [len(PIECE.findall(w)) for w in ascii_]):
            others.difference_update(ascii_)
        others = list(others)
        if others:
            for w, ids in zip(others, self._plain([w.decode() for w in others]), strict=True):
                runs[w] = ids
        for w, core in cut.items():
            if len(core) < len(w):
                runs[w] = runs[core] + runs[w[len(core):]]

    def _by_words(self, texts: list[str]) -> list[bytes]:
        """Every distinct run is looked up once, then all are put in place."""
        runs = self.runs
        if len(runs) > CACHE_RUNS:
            runs.clear()
        # Special tokens are matched with their case and across white space, and
        # lower-casing must not make one.
        plain = [k for k, t in enumerate(texts)
                 if "<|" in t or (self.special is not None and self.special.search(t))]
        words, places, ends = _words(_without(texts, plain))
        # ASCII runs are lower-cased; others stay, as NFC composes some letters in one case only.
        words = [w.lower() if w.isascii() else w for w in words]
        found = list(map(runs.get, words))
        if None in found:
            self._learn({w for w, ids in zip(words, found, strict=True) if ids is None})
            found = list(map(runs.__getitem__, words))
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        pool = np.frombuffer(b"".join(found), "<u4")
        starts = np.cumsum(sizes) - sizes
        counts = sizes[places]
        to = np.cumsum(counts)
        at = np.repeat(starts[places] - (to - counts), counts)
        at += np.arange(len(at))
        raw = pool[at].tobytes()
        cuts = (np.concatenate([[0], to])[ends] * 4).tolist()
        out = [raw[low:high] for low, high in zip([0, *cuts], cuts, strict=False)]
        for k, ids in zip(plain, self._plain([texts[k] for k in plain]), strict=True):
            out[k] = ids
        return out

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        texts = [t or "" for t in texts]
        if self.runs is None:
            return self._plain(texts)
        return [ids for chunk in _chunks(texts) for ids in self._by_words(chunk)]


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """The encoder of a tokenizer file, loaded once per worker."""
    return Encoder(path)


def encode(path: str, texts: list[str | None], end_id: int = END_ID) -> list[bytes]:
    """Ids of each whole text (null: empty) with the end id, as little-endian
    unsigned 32-bit integers."""
    end = int(end_id).to_bytes(4, "little")
    return [ids + end for ids in encoder(path)(texts)]


def gathered(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Batches joined until ``column`` has CHUNK_CHARS bytes: a run that is frequent in
    them is looked up once."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.column(column).nbytes
        if size >= CHUNK_CHARS:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def crc32_of(ids: bytes) -> int:
    """Unsigned CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids)
