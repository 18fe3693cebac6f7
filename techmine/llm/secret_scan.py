"""Secret scan: keyword automaton, anchored expressions near hits, checksums.

One Aho-Corasick pass finds the keywords of all kinds in the whole text; an
expression is tried only where its keyword was hit, anchored at the hit.  Kinds
whose format embeds a checksum (CRC-32 in base 62, base58check, bech32) count
only if it validates.  Runs of hex digits have no keyword; a plain run search
finds them.

Defined results: a null text is empty and has no secrets; equal rows give equal
results; offsets are code points, end exclusive.  An empty table gives an empty
result.  ``scan`` reads only the id and text columns; ``redacted`` changes the
text column alone and passes every other column through.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from techmine.llm.common import prepare

# The expressions of the base kinds (group 2 is the value).
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+", re.ASCII)
HEX_RUN = re.compile(r"[0-9a-f]{16,}", re.ASCII)
MIN_ASSIGN, MIN_ACCESS = 12, 18

# Alphabets of the checksummed formats.
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
BECH32 = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"
BECH32_GENERATOR = (0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)

GITHUB = re.compile(r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])", re.ASCII)
NPM = re.compile(r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])", re.ASCII)
XPRV = re.compile(r"xprv[1-9A-HJ-NP-Za-km-z]{107}(?![A-Za-z0-9])", re.ASCII)
AGE = re.compile(r"AGE-SECRET-KEY-1[QPZRY9X8GF2TVDW0S3JN54KHCE6MUA7L]{58}(?![A-Za-z0-9])", re.ASCII)
NSEC = re.compile(r"nsec1[qpzry9x8gf2tvdw0s3jn54khce6mua7l]{58}(?![A-Za-z0-9])", re.ASCII)


def crc_base62_ok(token: str) -> bool:
    """The last six characters are the CRC-32 of the 30 before them in base 62."""
    body, check = token[4:-6], token[-6:]
    n = zlib.crc32(body.encode())
    digits = ""
    for _ in range(6):
        n, d = divmod(n, 62)
        digits = BASE62[d] + digits
    return digits == check


def base58check_ok(token: str) -> bool:
    n = 0
    for ch in token:
        n = n * 58 + BASE58.index(ch)
    raw = n.to_bytes((n.bit_length() + 7) // 8, "big")
    return hashlib.sha256(hashlib.sha256(raw[:-4]).digest()).digest()[:4] == raw[-4:]


def bech32_ok(token: str) -> bool:
    token = token.lower()
    prefix, _, data = token.rpartition("1")
    values = [ord(c) >> 5 for c in prefix] + [0] + [ord(c) & 31 for c in prefix] + [BECH32.index(c) for c in data]
    check = 1
    for v in values:
        top = check >> 25
        check = (check & 0x1FFFFFF) << 5 ^ v
        for i, g in enumerate(BECH32_GENERATOR):
            check ^= g if (top >> i) & 1 else 0
    return check == 1


# kind -> keywords (lower case), expression, test of a match; in the order of the kinds.
KEYED = {
    "assign": (("password", "passwd", "secret", "token", "apikey", "api_key"), ASSIGN,
               lambda m: len(m[2]) >= MIN_ASSIGN),
    "access": (("akia",), ACCESS, lambda m: len(m[0]) >= MIN_ACCESS),
    "github": (("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), GITHUB, lambda m: crc_base62_ok(m[0])),
    "npm": (("npm_",), NPM, lambda m: crc_base62_ok(m[0])),
    "xprv": (("xprv",), XPRV, lambda m: base58check_ok(m[0])),
    "age": (("age-secret-key-1",), AGE, lambda m: bech32_ok(m[0])),
    "nsec": (("nsec1",), NSEC, lambda m: bech32_ok(m[0])),
}
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "github", "npm", "xprv", "age", "nsec")

UPPER_TO_LOWER = {c: c + 32 for c in range(65, 91)}
SPANS_TYPE = "array<struct<kind:string,start:int,end:int>>"
_SPANS_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


@lru_cache(maxsize=1)
def _automaton():
    found = ahocorasick.Automaton()
    for kind, (keywords, _, _) in KEYED.items():
        for k in keywords:
            found.add_word(k, (kind, len(k)))
    found.make_automaton()
    return found


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every secret, by start and then by kind."""
    low = text.lower()
    if len(low) != len(text):  # some letters grow; only A-Z matter here
        low = text.translate(UPPER_TO_LOWER)
    hits: dict[str, list[int]] = {}
    for last, (kind, size) in _automaton().iter(low):
        hits.setdefault(kind, []).append(last + 1 - size)
    spans = [("hex", *m.span()) for m in HEX_RUN.finditer(text)]
    for kind, starts in hits.items():
        _, expression, holds = KEYED[kind]
        done = 0
        for at in sorted(starts):
            m = expression.match(text, at) if at >= done else None
            if m:
                done = m.end()  # a match that fails its test still uses up its text
                if holds(m):
                    spans.append((kind, *m.span()))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        spans = [[{"kind": k, "start": s, "end": e} for k, s, e in find_spans(t or "")]
                 for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, _SPANS_ARROW)], ["id", "spans"])


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the id and ``spans``, all secrets found."""
    prepare(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(id_col, text).mapInArrow(_scan, f"id {kind}, spans {SPANS_TYPE}")
    return out.withColumnRenamed("id", id_col)


def span_text(spans, kinds: tuple[str, ...] = KINDS):
    """``kind:start:end`` of the spans of these kinds, comma-joined (native)."""
    chosen = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: str, mark: str) -> str:
    """``text`` with every run of overlapping or touching spans replaced by ``mark``."""
    runs: list[list[int]] = []
    for _, start, end in find_spans(text):
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([start, end])
    out, at = [], 0
    for start, end in runs:
        out += [text[at:start], mark]
        at = end
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced; nulls stay null."""
    prepare(docs.sparkSession)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = pa.array([None if t is None else redact(t, mark) for t in b.column(at).to_pylist()], pa.string())
            yield b.set_column(at, b.schema.field(at), new)

    return docs.mapInArrow(run, docs.schema)
