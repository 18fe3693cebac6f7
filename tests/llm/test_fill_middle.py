import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from techmine.llm import fill_middle as fm


def expected(doc_id, text, seed="1"):
    """Brute force on str."""
    t = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    n = len(t)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, t
    pre, mid, suf = t[:a], t[a:b], t[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", a, b - a, f"<P>{pre}<S>{suf}<M>{mid}"


sha = lambda t: hashlib.sha256(t.encode()).hexdigest()


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10 ** 9), st.text(st.sampled_from("ab<>PSM é日🙂\n"), max_size=30))
def test_cut_and_rebuild(doc_id, text):
    c = fm.cut(text.encode(), doc_id, "1", 90, 20)
    n, form, a, m, out = expected(doc_id, text)
    assert (c.n, c.form, c.prefix, c.middle) == (n, form, a, m)
    assert c.output.to_bytes() == out.encode() and c.output.digest() == sha(out)
    assert fm.rebuilt(out.encode(), form).to_bytes() == text.encode()
    # The inverse permutation restores from the descriptors alone, too.
    if form != "plain":
        assert c.output.restored(fm.ARRANGEMENTS[form]).to_bytes() == text.encode()


def test_offsets_across_blocks(monkeypatch):
    monkeypatch.setattr(fm, "BLOCK", 7)
    text = "aé日🙂" * 9 + "z"
    raw = text.encode()
    assert fm.code_points(raw) == len(text)
    for k in range(len(text) + 1):
        assert fm.byte_offset(raw, k) == len(text[:k].encode())


def test_tables(spark, edge, empty, documents):
    from tests.llm.conftest import EDGE
    more = [(100 + k, f"text {k} <{'PSMX'[k % 4]}> end é🙂" * (k % 3), "s") for k in range(60)]
    for df, rows in ((edge, EDGE), (empty, []), (documents(spark, more), more)):
        out = fm.transformed(df)
        got = sorted((tuple(r)[:7] + (r.output,) for r in out.collect()), key=repr)
        want = []
        for i, t, *_ in rows:
            n, form, a, m, o = expected(i, t)
            want.append((i, n, form, a, m, sha(o), sha(t or ""), o))
        assert got == sorted(want, key=repr)
        back = sorted((tuple(r) for r in fm.restored(out).collect()), key=repr)
        assert back == sorted(((i, t or "") for i, t, *_ in rows), key=repr)


def test_descriptors_stay_within_their_buffers(spark, edge):
    for r in fm.transformed(edge).collect():
        assert sum(p.length for p in r.pieces) == len(r.output.encode())
        assert len(r.pieces) == (1 if r.form == "plain" else 6)
        assert all(p.start + p.length <= len(fm.MARKS) for p in r.pieces if p.buffer == fm.MARK)


def test_parameters(spark, edge):
    forms = {r.form for r in fm.transformed(edge, seed="x", transformed_pct=0).collect()}
    assert forms == {"plain"}
    forms = {r.form for r in fm.transformed(edge, transformed_pct=100, spm_pct=100).collect()}
    assert forms == {"plain", "spm"}
