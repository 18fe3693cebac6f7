import re

from techmine.llm import pii_surrogates as ps
from tests.conftest import SF001

KEY = "test key"
ROWS = [
    (1, "write to Anna.Lee@mail.example.com or anna.lee@mail.example.com, not bob@mail.example.com.", "s"),
    (2, "call +1 (663) 555-6869 or +1 663 555 6869 or +1-663-555-6870 now", "s"),
    (3, "hosts 192.168.3.4 and 8.8.8.8, again 8.8.8.8; not 1.2.3 nor 1.2.3.4.5 nor 999.1.1.1", "s"),
    (4, "card 4465 7583 8288 9437 and 4465758382889437 but 4465758382889438 is none", "s"),
    (5, "ssn 123-45-6789. Mr. John Smith met Mrs Smith, and Frau Änne Müller; г-н Иван Петров? Г-н Иван Петров", "s"),
    (6, "nothing here", "s"), (7, None, "s"), (8, "", "s"), (1, "bob@mail.example.com", "s"), (None, "8.8.8.8", "s"),
]


def texts(spark, documents):
    rows = ps.surrogated(documents(spark, ROWS), KEY).collect()
    return {r["doc_id"]: r for r in rows if not (r["doc_id"] == 1 and r["text"].startswith(("b", "c")) and len(r["text"]) < 30)}, rows


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(int(c) * 2, 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def test_types_shapes_and_coreference(spark, documents):
    df = documents(spark, ROWS)
    out = ps.surrogated(df, KEY)
    assert out.columns == [*df.columns, "__llm_types"]
    rows = out.collect()
    assert len(rows) == len(ROWS)
    by = {r["doc_id"]: r["text"] for r in rows if r["doc_id"] != 1}
    first = next(r["text"] for r in rows if r["doc_id"] == 1 and r["text"].startswith("write"))
    mails = re.findall(r"[\w.]+@[\w.]+\w", first)
    assert mails[0].lower() == mails[1].lower() and mails[0][0].isupper() and mails[2] != mails[1]
    assert {m.split("@")[1] for m in mails} == {mails[0].split("@")[1]} and mails[0].endswith(".com")
    assert mails[2] in {r["text"] for r in rows}  # the same person in another document
    a, b, c = re.findall(r"\+1[ \-(\d)]{11,14}\d", by[2])
    digits = lambda s: re.sub(r"\D", "", s)
    assert digits(a) == digits(b) != digits(c) and re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", a)
    ips = re.findall(r"\d+\.\d+\.\d+\.\d+", by[3].split("; not")[0])
    assert ips[0].startswith("10.") and ips[1] == ips[2] == by[None] != "8.8.8.8"
    assert by[3].endswith("; not 1.2.3 nor 1.2.3.4.5 nor 999.1.1.1")
    spaced, plain = re.fullmatch(r"card (\d{4} \d{4} \d{4} \d{4}) and (\d{16}) but 4465758382889438 is none", by[4]).groups()
    assert digits(spaced) == plain != "4465758382889437" and luhn(plain) and plain[0] == "4"
    m = re.fullmatch(r"ssn (\d{3}-\d{2}-\d{4})\. Mr\. (\w+) (\w+) met Mrs (\w+), and Frau (\w+) (\w+); (\S+) (\w+) (\w+)\? Г-н (\w+) (\w+)", by[5])
    ssn, john, smith, smith2, anne, _, _, _, _, ivan, petrov = m.groups()
    assert ssn != "123-45-6789" and smith == smith2 != "Smith" and john.endswith("n") and anne.endswith("a")
    assert re.fullmatch(r"[А-Яа-я]+", ivan + petrov) and ivan != "Иван" and len(ivan) == 4
    assert (by[6], by[7], by[8]) == ("nothing here", None, "")


def test_surrogates_are_distinct_and_new(spark):
    # One letter and one digit leave few shapes: draws collide and are repeated.
    ents = [("email", f"{a}{d}@x.org", "") for a in "bcdfghjk" for d in range(10)]
    ents += [("ssn", f"{k:09d}", "") for k in range(300)]
    df = spark.createDataFrame(ents, "type string, norm string, gender string")
    got = ps.surrogates(df, KEY).collect()
    assert len(got) == len(ents)
    new = {(r["type"], r["surrogate"]) for r in got}
    assert len(new) == len(ents) and not new & {(t, n) for t, n, _ in ents}
    again = {tuple(r) for r in ps.surrogates(df.repartition(7), KEY).collect()}
    assert again == {tuple(r) for r in got}
    other = {tuple(r) for r in ps.surrogates(df, "other key").collect()}
    assert len(other & again) < len(ents) / 4


def test_no_entity_survives_in_documents(spark):
    from techmine.llm.queries import QUERIES
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    found = 0
    for r in QUERIES["op2_pii_surrogates"](spark, SF001).collect():
        old = docs[r["doc_id"]]
        hits = re.findall(r"[\w.+-]+@[\w.-]+\w|\+\d \(\d{3}\) \d{3}-\d{4}|(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d.])", old)
        found += len(hits)
        assert not any(h in r["text"] for h in hits)
        assert r["n_entities"] >= len(hits)
        if not r["n_entities"]:
            assert r["text"] == old
    assert found


def test_empty(spark, empty):
    assert ps.surrogated(empty, KEY).count() == 0


def test_numbers_beside_each_other(spark, documents):
    lines = [("call 555-123-4567 555-987-6543", "phone phone"), ("tel 555-123-4567 100 Main", "phone"),
             ("100 555-123-4567 x", "phone"), ("card 4111 1111 1111 1111 123", "card"),
             ("12 4111 1111 1111 1111", "card"), ("4111 1111 1111 1111-555-123-4567", "card phone"),
             ("123-45-6789 987-65-4321", "ssn ssn"), ("+86 138 0013 8000 and +55 11 91234 5678", "phone phone"),
             ("+1 555 123 4567 555-987-6543", "phone phone"), ("+49 30 123456 4111 1111 1111 1111", "phone card"),
             ("1234500000000 192.168.3.4", "ip"), ("1234500000000 42a@b.example.com", "email"),
             ("4111 1111 1111 1111 555.123.4567 4111111111111111", "card phone card"),
             ("4465758382889438 4465 7583 8288 9438", "")]
    out = ps.surrogated(documents(spark, [(k, t, "s") for k, (t, _) in enumerate(lines)]), KEY)
    rows = {r["doc_id"]: r for r in out.collect()}
    cards = set()
    for k, (old, types) in enumerate(lines):
        new = rows[k]["text"]
        assert rows[k]["__llm_types"] == types.split(), old
        assert re.sub(r"\w", "", new) == re.sub(r"\w", "", old) and (len(new) == len(old) or types == "ip")
        for real in ("4567", "987-6543", "1111 1111", "6789", "65-4321", "0013", "91234", "168.3.4", "42a@"):
            assert real not in new, (old, new)
        cards.update(re.sub(r"\D", "", c) for c in re.findall(r"4\d{3} \d{4} \d{4} \d{4}|4\d{15}", new) if "446" not in old)
    assert rows[1]["text"].endswith(" 100 Main") and rows[3]["text"].endswith(" 123")
    assert len(cards) == 1 and luhn(cards.pop())


def test_one_phone_number_in_several_formats(spark, documents):
    forms = ["+15551234567", "+1 555 123 4567", "+1 (555) 123-4567", "+1-555-123-4567", "(555) 123-4567", "555-123-4567", "555.123.4567"]
    other = ["+442079460958", "+44 20 7946 0958", "+44 (0)20 7946 0958", "+44 (20) 7946-0958", "+351 912 345 678", "+351912345678"]
    rows = [(k, f"call {t} now", "s") for k, t in enumerate([*forms, *other])]
    new = {r["doc_id"]: r["text"][5:-4] for r in ps.surrogated(documents(spark, rows), KEY).collect()}
    for k, t in enumerate([*forms, *other]):
        assert re.sub(r"\d", "", new[k]) == re.sub(r"\d", "", t) and new[k] != t
    digits = [re.sub(r"\D", "", new[k].replace("(0)", "")) for k in range(len(rows))]
    assert len({d[-10:] for d in digits[:7]}) == 1 and all(d.startswith("1") for d in digits[:4])
    assert [len(d) for d in digits[:7]] == [11, 11, 11, 11, 10, 10, 10]
    assert len(set(digits[7:11])) == 1 and digits[7].startswith("44") and "(0)" in new[9]
    assert digits[11] == digits[12] and digits[11].startswith("351")


def test_cheap_test_loses_nothing():
    import regex

    texts = ["a@b.co", "+1 (555) 123-4567", "+44 (0)20 7946 0958", "1.2.3.4", "123-45-6789", "555.123.4567",
             "4111 1111 1111 1111", "+1.(555).123.4567", "+999 (1234) 1-2-3-4-5-6", "Frau Erika", "Sr. Juan de la Vega",
             "Г-н Иванов", "Κυρία Ελένη", "3782 822463 10005", "(555) 123-4567", "10.20.30.140"]
    java = lambda p: regex.compile(re.sub(r"\\p\{Is(\w+)\}", r"\\p{\1}", p))
    maybe, full = java(ps.MAYBE), java(ps.ANY)
    for t in texts:
        for around in ("{}", "so {}.", "x\n{} y"):
            assert full.search(around.format(t)) and maybe.search(around.format(t)), t


def test_every_letter_is_drawn_and_long_names_are_whole(spark, documents):
    text = "write to xj.q@jqx.com or łódź@ßđø.pl; Mr. Juan Carlos de la Vega and Herr Otto von der Heide Müller left"
    out = ps.surrogated(documents(spark, [(k, text, "s") for k in range(3)]), "k").collect()
    assert len({r.text for r in out}) == 1
    for word in ("xj.q", "jqx", "łódź", "ßđø", "Juan", "Carlos", "Vega", "Otto", "Heide", "Müller"):
        assert word not in out[0].text
    assert out[0].text.startswith("write to ") and out[0].text.endswith(" left") and "Mr. " in out[0].text
