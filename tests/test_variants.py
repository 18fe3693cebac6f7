import random
import re

from techmine.operators import variants as VA


def table(spark, names):
    return spark.createDataFrame([(n,) for n in names], "name string")


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def form(n):
    return re.sub(r"[\s._\-]+", " ", n.lower()).strip()


def expected(names):
    """All pairs."""
    allowed = lambda w: 2 if len(w) >= 9 else 1 if len(w) >= 5 else 0
    out = set()
    for a in names:
        for b in names:
            x, y = form(a).replace(" ", ""), form(b).replace(" ", "")
            if a < b and x and y and distance(x, y) <= min(allowed(x), allowed(y)):
                out.add((a, b, distance(x, y)))
    return out


NAMES = ["JavaScript", "Java Script", "Javascript", "java-script", "C++", "C ++", "C", "C#", "Java", "Java-K", "Featherweight Java",
         "Featherweigth Java", "Lisp", "LISP", "Common Lisp", "Python", "Pyhton", "Pythons", "Haskell", "Haskel", "R", "Go",
         "TypeScript", "Typscript", "", "  ", "-", "Scratch Jr.", "Scratch Jr", "F⋆", "Objective-C", "ObjectiveC", "Objective C++"]


def test_variants_equal_all_pairs(spark):
    got = {(r.left, r.right, r.edits) for r in VA.spelling_variants(table(spark, [*NAMES, None, "Java"])).collect()}
    assert got == expected(NAMES)
    assert {("Java Script", "JavaScript", 0), ("C ++", "C++", 0)} <= got
    assert VA.spelling_variants(table(spark, [])).count() == 0


def test_random_names_equal_all_pairs(spark):
    r = random.Random(5)
    names = {"".join(r.choice("abc ") for _ in range(r.randrange(1, 14))) for _ in range(250)}
    for n in list(names)[:80]:
        k = r.randrange(len(n))
        names.add(n[:k] + r.choice(["", "a", "z", "bc"]) + n[k + r.randrange(2):])
    got = [(q.left, q.right, q.edits) for q in VA.spelling_variants(table(spark, names)).collect()]
    assert len(got) == len(set(got)) and set(got) == expected(names)


def test_derived_names(spark):
    got = {(r.derived, r.base) for r in VA.derived_names(table(spark, [*NAMES, None, "Lisp"])).collect()}
    forms = {}
    for n in NAMES:
        if form(n):
            forms[form(n)] = min(forms.get(form(n), n), n)
    want = set()
    for n in NAMES:
        held = [f for f in forms if f != form(n) and f" {f} " in f" {form(n)} "]
        if held and form(n):
            best = min(held, key=lambda f: (-len(f.split()), -len(f), f))
            want.add((n, forms[best]))
    assert got == want
    assert {("Featherweight Java", "Java"), ("Java-K", "Java"), ("Common Lisp", "LISP"), ("Objective-C", "C")} <= got
    assert VA.derived_names(table(spark, [])).count() == 0


def test_derived_ids(spark):
    t = spark.createDataFrame([(5, "Java"), (3, "Java"), (7, "Featherweight Java"), (9, "Featherweight Java"), (1, "Go")],
                              "id long, name string")
    assert sorted(map(tuple, VA.derived_ids(t).collect())) == [(7, 3), (9, 3)]
