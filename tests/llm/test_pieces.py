"""Pieces: whole, within the limit, cut at boundaries, with the overlap asked for."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from leafmill.llm import pieces as P


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab. \n\r\té́‍🙂。"), max_size=400), st.integers(8, 60), st.integers(0, 6))
def test_pieces_are_the_text(text, limit, overlap):
    got = P.split(text, limit, overlap)
    assert "".join(text[c:e] for _, c, e in got) == text
    assert all(e - s <= limit and s <= c for s, c, e in got)
    for (_, _, end), (start, cut, _) in zip(got, got[1:]):
        assert cut == end and cut - overlap <= start <= cut
    assert len(got) == 1 or len(text) > limit


def test_strong_boundaries_win():
    text = ("word " * 30 + "\n\n") * 6
    for _, cut, _ in P.split(text.strip(), 250, 20)[1:]:
        assert text[:cut].endswith("\n\n")
    text = "Some words stand here. " * 40
    for _, cut, _ in P.split(text, 250, 20)[1:]:
        assert text[:cut].endswith(". ")


@pytest.mark.parametrize("text", ["x" * 100_000, "é" * 9000, "\r\n" * 4500, "́" * 9000, "a‍" * 5000])
def test_texts_without_boundaries(text):
    got = P.split(text, 4000, 200)
    assert "".join(text[c:e] for _, c, e in got) == text
    assert max(e - s for s, _, e in got) <= 4000


def test_bad_parameters():
    with pytest.raises(ValueError):
        P.split("x", 10, 10)


def test_column(spark):
    df = spark.createDataFrame([(1, "short", "p"), (2, None, "p"), (3, "", "p"), (4, "ab " * 2000, "p"), (4, "ab " * 2000, "p")], "page_id long, body string, piece string")
    got = P.pieces(df, "page_id", "body", 4000, 200).collect()
    assert [(r["page_id"], r["piece"]) for r in got if r["page_id"] in (1, 3)] == [(1, "short"), (3, "")]
    assert not [r for r in got if r["page_id"] == 2]
    four = [r for r in got if r["page_id"] == 4]
    assert len(four) == 4 and all(len(r["piece"]) <= 4000 for r in four)
    assert {r["n_repeated"] > 0 for r in four if r["piece_no"]} == {True}
