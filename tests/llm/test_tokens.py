import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortloom.llm.tokens import PART_CHARS, decode, decoded_texts, encode, encoding, parts_of, token_counts, token_ids


@pytest.fixture(scope="module")
def enc():
    return encoding()


@given(st.text(max_size=300))
@settings(max_examples=200, deadline=None)
def test_round_trip(text):
    enc = encoding()
    assert decode(encode(text, enc), enc).decode() == text
    assert encode(text, enc) == enc.encode_ordinary(text)


def test_long_texts_are_cut_where_nothing_crosses(enc):
    rng = random.Random(1)
    words = ["don't", "12,5", "染色体", "\n\n", "   ", "it'S", "<|endoftext|>", "a", "GSE1", "é", "👩‍🔬", "\t", "..."]
    for joiner in (" ", "", "\n"):
        text = joiner.join(rng.choice(words) for _ in range(20_000))
        assert "".join(parts_of(text)) == text
        assert encode(text, enc) == enc.encode_ordinary(text)
    assert len(list(parts_of("a b" * PART_CHARS))) > 2


def test_special_strings_are_text(enc):
    assert 50256 not in encode("<|endoftext|>", enc)


def test_frames(spark, enc):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "a b", "x"), (3, "a b", "x"), (4, " \n", "x")], "doc_id long, text string, ids string")
    got = sorted((r.doc_id, list(r.ids)) for r in token_ids(df).collect())
    assert got == [(1, []), (2, []), (3, encode("a b", enc)), (3, encode("a b", enc)), (4, encode(" \n", enc))]
    assert sorted((r.doc_id, r.n_tokens) for r in token_counts(df).collect()) == [(i, len(x)) for i, x in got]
    assert sorted((r.doc_id, r.text) for r in decoded_texts(token_ids(df)).collect()) == [(1, ""), (2, ""), (3, "a b"), (3, "a b"), (4, " \n")]
    assert token_ids(df.limit(0)).collect() == []
