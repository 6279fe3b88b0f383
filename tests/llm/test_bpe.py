"""The transducer against the library's own encoder, and decoding as a round trip."""

import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from leafmill.llm import bpe
from leafmill.session import tokenizer_folder

pytestmark = pytest.mark.skipif(not os.path.isdir(tokenizer_folder()), reason="no vocabularies")


@pytest.fixture(scope="module")
def library():
    import tiktoken

    own = bpe.encoder()
    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=own.transducer.ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("thein gs'\n\t  ²½<|>")), max_size=60))
def test_any_text(library, text):
    ids = bpe.encoder().encode(text)
    assert ids == library.encode_ordinary(text)
    assert bpe.encoder().decode(ids) == text
    assert bpe.encoder().count(text) == len(ids)


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 700, "漢" * 900, "<|endoftext|>", "it's WE'LL don't", " \n \t  x ", "\x1c a\x1f1", "🙂👍🏽" * 50, "Ångström" * 99])
def test_hard_texts(library, text):
    assert bpe.encoder().encode(text) == library.encode_ordinary(text)


def test_decoding_is_incremental():
    rng = random.Random(4)
    for _ in range(300):
        data = bytes(rng.choice([rng.randrange(256), rng.randrange(0x80, 0xC0), 0xE2, 0x82, 0xAC, 65]) for _ in range(rng.randrange(30)))
        cut = [data[i : i + 1] for i in range(len(data))]
        assert "".join(bpe.decode_stream(cut)) == "".join(bpe.decode_stream([data])) == data.decode("utf-8", "replace")


def test_column(spark):
    df = spark.createDataFrame([(1, "the cat", "x"), (2, "", "x"), (3, None, "x"), (4, "the cat", "x")], "doc_id long, text string, ids string")
    got = {r["doc_id"]: list(r["ids"]) for r in bpe.encode_column(df, "doc_id", "text").collect()}
    assert got == {1: [1169, 3797], 2: [], 3: [], 4: [1169, 3797]}
    assert {r["doc_id"]: r["n_tokens"] for r in bpe.count_column(df, "doc_id", "text").collect()} == {1: 2, 2: 0, 3: 0, 4: 2}
    assert bpe.encode_column(df.where("false"), "doc_id", "text").count() == 0
