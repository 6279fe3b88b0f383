"""Forms: equal for what looks the same, different for the rest."""

import pytest

from leafmill.llm import lookalike as L

SAME = [
    ("paura", "р​аura"), ("file", "ﬁle"), ("ABC", "ＡＢＣ"), ("ABC", "ΑΒС"), ("á", "á"), ("a b", "a b"), ("a b", "a　b"), ("a-b", "a‑b"), ("a-b", "a‐b"),
    ("co", "cօ"), ("𝚌𝚘𝚍𝚎", "code"), ("soft", "so­ft"), ("ガ", "ｶﾞ"), ("ё", "ё"), ("ВЕСЬ", "BECЬ"), ("µ", "μ"), ("x\n", "x\r\n"), ("ɡo", "go"), ("ï", "ї"),
]
DIFFERENT = [("a", "A"), ("e", "é"), ("o", "0"), ("l", "1"), ("a  b", "a b"), ("a\nb", "a b"), ("a.b", "a,b"), ("a–b", "a-b"), ("2", "²"), ("½", "1/2"), ("т", "t"), ("👨‍👩", "👨👩"), ("И", "N"), ("a\tb", "a b"), ("…", "...")]


@pytest.mark.parametrize(("a", "b"), SAME)
def test_same(a, b):
    f = L.Forms()
    assert f.form(a) == f.form(b)
    assert f.form(f.form(a)) == f.form(a)


@pytest.mark.parametrize(("a", "b"), DIFFERENT)
def test_different(a, b):
    assert L.Forms().form(a) != L.Forms().form(b)


def test_scripts():
    f = L.Forms()
    assert f.form("Рост c нами") == "Рост с нами"  # the Latin letter alone takes the script of its neighbours
    assert f.form("сор стоит") == "сор стоит"
    assert f.form("сор") == "cop"
    assert f.kinds("сaт рост сор Ελλη") == (1, 1)


def test_pairs_and_forms(spark):
    rows = [(1, "code"), (2, "cоde"), (3, "code"), (4, None), (5, ""), (6, " "), (7, " "), (8, "​"), (9, "other"), (10, "ｃｏｄｅ"), (10, "ｃｏｄｅ")]
    df = spark.createDataFrame([(*r, b"x") for r in rows], "doc_id long, text string, look binary")
    got = sorted(map(tuple, L.lookalike_pairs(df, "doc_id", "text").collect()))
    assert got == [(1, 2), (1, 10), (2, 3), (2, 10), (3, 10)]
    assert L.lookalike_pairs(df.where("false"), "doc_id", "text").count() == 0
    forms = {r["doc_id"]: (r["form"], r["n_mixed"]) for r in L.forms(df, "doc_id", "text").collect()}
    assert forms[2] == ("code", 1) and forms[4] == (None, 0) and forms[5] == ("", 0)
