import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

from techmine.llm import residual_packing as rp
from techmine.llm import sentencepiece_codec as sc
from techmine.llm import token_store as ts
from techmine.llm import tokens
from tests.conftest import SF001

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")

ODD = ["", " ", "Don't  <|endoftext|> <|ENDOFTEXT|> İstanbul. ΑΣ! ες ﬁne Ḱ.", "a\x1c.b \x85.  x", "naïvé ..İ. क़. Å. 123abc,,.",
       "<|startoftext|>", "́a é. क़,", "tabs\tand\nlines\x0b\x0c", "a" * 5000, "…“quoted”—dash", "ÀÉÎ ñandú ß"]


def ids_of(path, text):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_encoder_equals_the_library(spark, path):
    texts = ODD + [r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").limit(60).collect()]
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    want = [tok.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]
    for _ in range(2):  # new and remembered runs
        assert [np.frombuffer(i, "<u4").tolist() for i in tokens.encode(path, texts)] == want
    assert (tokens.encoder(path).runs is not None) == (path == WORD)


def test_runs_are_learned_together_and_looked_up_once(monkeypatch):
    texts = ["It's 12 o'clock: mail a.b@c.de, a1b2--c3 </w> x\x1cy don't", "  12 a.b@c.de,\t\x0b12 ", "", None,
             "Ünïcode \u1e96H\u0331 <|EndOfText|> <|endoftext|>", "\u3000 12\x85 12"]
    e = tokens.Encoder(WORD)
    plain, alone = e._plain, []
    monkeypatch.setattr(e, "_plain", lambda ts: alone.extend(ts) or plain(ts))
    assert e(texts) == plain([t or "" for t in texts])
    assert not any(t.isascii() for t in alone)  # they were encoded one by one
    words, places, ends = tokens._words(["b a  b", "", " a\n"])
    assert ([words[k] for k in places], list(words), ends.tolist()) == ([b"b", b"a", b"b", b"a"], [b"b", b"a"], [3, 3, 4])
    monkeypatch.setattr(tokens, "CHUNK_CHARS", 5)
    assert e(texts) == plain([t or "" for t in texts])
    assert list(tokens._chunks(["ab", "cde", "f", "ghijklm", ""])) == [["ab", "cde"], ["f"], ["ghijklm"], [""]]


def test_small_batches_are_encoded_together(monkeypatch):
    monkeypatch.setattr(tokens, "CHUNK_CHARS", 100)
    batches = [pa.RecordBatch.from_pydict({"id": [k], "text": ["x" * 30]}) for k in range(10)]
    got = list(tokens.gathered(iter(batches), 1))
    assert len(got) < 5
    assert [i for b in got for i in b.column(0).to_pylist()] == list(range(10))
    assert list(tokens.gathered(iter([]), 1)) == []


def test_capitals_that_compose_in_lower_case_only():
    texts = ["J\u030cx", "H\u0331amza T\u0308a, W\u030a Y\u030a. j\u030cx h\u0331amza", "ABC J\u030cX abc", "É É <|Endoftext|>"]
    want = [ids_of(WORD, t) + [1] for t in texts]
    for _ in range(2):
        assert [np.frombuffer(i, "<u4").tolist() for i in tokens.encode(WORD, texts)] == want


# ---------------------------------------------------------------- token store


def test_perfect_hash_is_minimal_and_knows_absent_keys():
    r = np.random.default_rng(2)
    for n in (0, 1, 7, 5000):
        ids = r.choice(1 << 40, n, replace=False).astype(np.int64) - (1 << 39)
        occ, nul = np.zeros(n, np.int64), np.zeros(n, bool)
        h = ts.PerfectHash.build(ids, occ, nul)
        assert sorted(h.slots(ids, occ, nul).tolist()) == list(range(n))
    slots = np.zeros(n, ts.SLOT)
    slots["fingerprint"] = ts._hash(ids, occ, nul, ts.FINGERPRINT_SEED).astype(np.uint32)
    slots["offset"] = np.arange(n)
    back, table = ts._read_index(ts._index_bytes(ids, occ, nul, slots))
    assert (table["offset"][back.slots(ids, occ, nul)] == np.arange(n)).all()
    absent = ids + (1 << 41)
    at = back.slots(absent, occ, nul)
    hit = (at >= 0) & (table["fingerprint"][at] == ts._hash(absent, occ, nul, ts.FINGERPRINT_SEED).astype(np.uint32))
    assert not hit.any()


def test_store_round_trip(spark, edge, empty):
    from tests.llm.conftest import EDGE
    store = ts.write_store(edge, WORD)
    got = ts.read_payload(store, ts.look_up(store, ts.keys_of(edge)), with_ids=True).collect()
    texts = {}
    for i, t, _ in EDGE:
        texts.setdefault(i, []).append(ids_of(WORD, t) + [1])
    start = 0
    order = sorted(got, key=lambda r: r["start"])
    assert [(r["id"] is not None, r["id"] or 0) for r in order] == sorted((i is not None, i or 0) for i, *_ in EDGE)
    for r in order:
        ids = list(r["ids"])
        texts[r["id"]].remove(ids)
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert not any(texts.values())
    absent = spark.createDataFrame([(12345, 0), (4, 7)], "id long, occurrence long")
    assert ts.look_up(store, absent).count() == 0
    none = ts.write_store(empty, WORD)
    assert ts.read_payload(none, ts.look_up(none, ts.keys_of(empty))).count() == 0


def test_store_query(spark):
    from techmine.llm.queries import QUERIES
    docs = spark.read.parquet(f"{SF001}/documents.parquet").orderBy("doc_id").collect()
    got = {r["doc_id"]: r for r in QUERIES["op3_token_store"](spark, SF001).collect()}
    start = 0
    for d in docs:
        ids = ids_of(WORD, d["text"]) + [1] if False else None
        r = got.pop(d["doc_id"])
        assert r["start"] == start
        start += r["n_tokens"]
        if d["doc_id"] % 20 == 0:
            ids = ids_of(WORD, d["text"]) + [1]
            assert (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) == (r["n_tokens"], r["ids_crc32"])
    assert not got


# -------------------------------------------------------------------- packing


def check_packing(rows, texts, capacity):
    want = []
    for i, t in texts:
        ids = ids_of(WORD, t) + [1]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            want.append((i, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), sum(w[3] for w in want)


def test_packing_places_every_piece_once(spark, edge, empty):
    from tests.llm.conftest import EDGE
    rows = rp.pack_documents(edge, WORD, capacity=256).collect()
    n, total = check_packing(rows, [(i, t) for i, t, _ in EDGE], 256)
    assert n <= -(-total // 256) + 2
    assert rp.pack_documents(empty, WORD).count() == 0


def test_rounds_reach_few_sequences(spark):
    r = np.random.default_rng(4)
    sizes = np.concatenate([r.integers(1, 1200, 4000), np.full(900, 2500), r.integers(3000, 4096, 300)])
    items = spark.createDataFrame([(k, 0, 0, int(s), 0) for k, s in enumerate(sizes)], rp.PIECES).repartition(23)
    from techmine.llm.common import stored
    rows = rp.pack(stored(items, "t")).collect()
    assert sorted((x["id"], x["length"]) for x in rows) == [(k, int(s)) for k, s in enumerate(sizes)]
    fills = {}
    for x in rows:
        fills[x["sequence_id"]] = fills.get(x["sequence_id"], 0) + x["length"]
    assert max(fills.values()) <= 4096
    assert len(fills) <= 1.01 * sizes.sum() / 4096 + 1
    alike = spark.createDataFrame([(k, 0, 0, 2500, 0) for k in range(3000)], rp.PIECES).repartition(9)
    assert rp.pack(stored(alike, "t")).select("sequence_id").distinct().count() == 3000


def test_best_fit_takes_the_fullest_bin():
    bins, fills = rp.best_fit(np.array([50, 70, 20, 30, 30]), 100)
    assert bins.tolist() == [1, 0, 1, 0, 1] and fills.tolist() == [100, 100]


def test_sequences_hold_the_ids(spark, documents):
    docs = documents(spark, [(k, "word " * (k * 7 % 40), "s") for k in range(50)])
    placed = rp.pack_documents(docs, WORD, capacity=64)
    from techmine.llm.common import stored
    placed = stored(placed, "t")
    rows = placed.collect()
    seqs = {r["sequence_id"]: list(r["ids"]) for r in rp.sequences(docs, placed, WORD, capacity=64).collect()}
    for r in rows:
        ids = (ids_of(WORD, "word " * (r["doc_id"] * 7 % 40)) + [1])[r["start"]:r["start"] + r["length"]]
        assert seqs[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]] == ids


# -------------------------------------------------------------- sentencepiece

SP_ODD = ["", " ", "a ", " a", "a  b   c ", "é\n\t日本語🙂 x", "<s> <0x0A> ▁x", "   ", "x" * 300 + " " * 40 + "y", "\x00\x01",
          "a b", "ſ İ ﬁ"]


def test_codec_parity_with_the_reference_library(spark):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    texts = SP_ODD + [r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").limit(80).collect()]
    c = sc.codec(PIECE)
    ids, alike = c.encode(texts)
    want = sp.encode([t or "" for t in texts])
    assert [np.frombuffer(i, "<u4").tolist() for i in ids] == want and all(alike)
    assert c.decode(ids) == sp.decode(want)
    assert [t or "" for t in texts if "▁" not in (t or "")] == [d for d, t in zip(c.decode(ids), texts) if "▁" not in (t or "")]


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def message(pieces, kind, fallback=0, collapse=1):
    import struct
    part = lambda n, b: varint(n << 3 | 2) + varint(len(b)) + b
    out = b""
    for p, s, t in pieces:
        out += part(1, part(1, p.encode()) + varint(2 << 3 | 5) + struct.pack("<f", s) + varint(3 << 3) + varint(t))
    out += part(2, varint(3 << 3) + varint(kind) + varint(35 << 3) + varint(fallback) + varint(40 << 3) + varint(0))
    return out + part(3, part(1, b"identity") + varint(3 << 3) + varint(1) + varint(4 << 3) + varint(collapse)
                      + varint(5 << 3) + varint(1))


def test_unigram_model_with_byte_fallback(tmp_path):
    import sentencepiece
    pieces = [("<unk>", 0.0, 2)] + [(f"<0x{k:02X}>", 0.0, 6) for k in range(256)]
    pieces += [(p, s, 1) for p, s in (("▁", -3.0), ("▁a", -2.0), ("b", -3.5), ("ab", -2.5), ("c", -4.0), ("a", -3.2),
                                      ("bc", -3.1), ("▁abc", -5.2))]
    path = tmp_path / "u.model"
    path.write_bytes(message(pieces, sc.UNIGRAM, 1))
    m = sc.parse_model(path.read_bytes())
    assert (m.kind, m.byte_fallback, m.collapse_spaces, len(m.pieces)) == (sc.UNIGRAM, True, True, 265)
    c = sc.Codec(str(path))
    assert not c.by_runs
    sp = sentencepiece.SentencePieceProcessor(model_file=str(path))
    texts = ["abc", "a  abc é", "", "cab bca", "日 a"]
    ids, alike = c.encode(texts)
    assert [np.frombuffer(i, "<u4").tolist() for i in ids] == sp.encode(texts) and all(alike)
    assert c.decode(ids) == sp.decode(sp.encode(texts))


def test_codec_tables(spark, edge, empty):
    from tests.llm.conftest import EDGE
    rows = sc.encoded(edge, PIECE).collect()
    assert len(rows) == len(EDGE) and all(r["parity"] and r["round_trip"] for r in rows)
    assert {r["doc_id"]: r["n_tokens"] for r in rows}[1] == 0
    back = {r["doc_id"]: r["text"] for r in sc.decoded(sc.encoded(edge, PIECE), PIECE).collect()}
    assert back == {i: t or "" for i, t, _ in EDGE}
    assert sc.encoded(empty, PIECE).count() == 0


def test_texts_are_encoded_where_they_are_read(spark, edge, monkeypatch):
    """No task sorts texts while its worker encodes: what is sorted are ids."""
    plans, stored = {}, ts.stored
    monkeypatch.setattr(ts, "stored", lambda df, name: (
        plans.update({name: df._jdf.queryExecution().toString()}), stored(df, name))[1])
    ts.write_store(edge, WORD)
    exchanged = plans["manifest"].split("Exchange")
    assert len(exchanged) > 1 and "MapInArrow" in exchanged[-1] and "encoded" not in plans
