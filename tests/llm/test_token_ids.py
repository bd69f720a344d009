import functools

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cloudmarts.llm import token_ids as t


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(t.default_vocabulary())
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoder():
    return t.Encoder()


one_encoder = functools.cache(t.Encoder)


def ids(encoder, text):
    return np.frombuffer(encoder.encode([text])[0], "<u4").tolist()


def test_documents(spark, whole, encoder):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for _ in range(2):  # the second time from memory
        assert [np.frombuffer(e, "<u4").tolist() for e in encoder.encode(texts)] == [whole(x) for x in texts]


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("a'sB1 .,\n\t\r\x0b\x1c\x85\u00a0\u2003\u200b\u3000漢é\U0001f600<|>"), max_size=40))
def test_any_mix_of_blanks_and_signs(text):
    e = one_encoder()
    assert ids(e, text) == e._tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["", " ", "  a", "a  b ", "x <|endoftext|> y<|endoftext|>", "<|endoftext|>" * 3,
                                  " " * 1_000_000, "\n" * 1_000_000, "x" * 200_000, "aĠb Ġ c",
                                  "it's we'll. they'd, x) y)) (z) a.b. wORD! Word? I'm: 's' don't.", "a <b> c<|d \u00aa\u00b5. \u0391."])
def test_edges(text, whole, encoder):
    assert ids(encoder, text) == whole(text)


def test_words_of_all_latin_letters(whole, encoder):
    letters = "".join(chr(c) for c in range(0x250) if chr(c).isalpha())
    text = " ".join([letters, *(f"x{c}y {c}. {c}" for c in letters), "\u0250 a\u0251b."])
    assert ids(encoder, text) == whole(text)


def test_full_memory_changes_nothing(monkeypatch, whole):
    monkeypatch.setattr(t, "_KNOWN", 3)
    e = t.Encoder()
    for text in ("one two three four five", "six seven one two", "one two three four five"):
        assert ids(e, text) == whole(text)
    assert len(e._known) <= 3


def test_long_stretches_are_not_remembered(whole):
    e = t.Encoder()
    text = "one two " + "y" * 500 + " three"
    assert ids(e, text) == ids(e, text) == whole(text) and set(e._known) == {"two", "three"}


def test_lines_and_signs_are_told_apart(whole, encoder):
    for text in ("one.\nTwo three,%%%\nFour\n\nfive ''' six.' seven's\neight", "a\n b \nc\td\n<|endoftext|>\ne", "x$$$\ny. z–.\nw",
                 "été,\nÉté. 漢.\n漢 12,\n12;", "a\x1c\nb\nc　\nd", "Haus’.\nHaus", "one\n"):
        assert ids(encoder, text) == whole(text)
    many = ["one two.\nThree", "one  two", "", " ", "two.\nThree one"]  # cut in both ways, in one call
    assert [np.frombuffer(e, "<u4").tolist() for e in encoder.encode(many)] == [whole(x) for x in many]


def test_signs_and_lines_need_no_word_of_their_own(whole):
    e = t.Encoder()
    text = " ".join(["a", *(f"word{s}" for s in (".", ",", "!!", "$$$", ".\nWord", "!\nWord", "\nWord."))])
    assert ids(e, text) == whole(text)
    assert set(e._known) == {"word"} and set(e._bare) == {"a", "Word"}
