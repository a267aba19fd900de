import re
import sys

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quakelake.llm import tokens
from quakelake.llm.tokens import Encoder, tokenizer_path

TOKENIZERS = ("byte_bpe_50k.json", "word_bpe_49k.json")
CHARACTERS = "aZéß×÷ÀÿĀ.,!?;:'s\"#<|>0 \n\t\xa0́*-_—İΣñ😀"


@pytest.fixture(scope="module", params=TOKENIZERS)
def encoder(request):
    return Encoder(tokenizer_path(request.param))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | st.text(CHARACTERS, max_size=30), max_size=8), st.integers(0, 3))
def test_texts_encoded_together_give_the_ids_of_each(encoder, texts, skipped):
    for kind in (pa.string(), pa.large_string()):
        found = list(encoder.encode_all(pa.array(texts, kind).slice(skipped)))
        assert found == [encoder.whole(text or "") for text in texts[skipped:]]


def test_texts_are_cut_by_bytes(encoder, monkeypatch):
    monkeypatch.setattr(tokens, "CUT_BYTES", 40)
    texts = ["a few words, again.", None, "", "more " * 50 + "words", "It's\nthe end!", "two  blanks", "x" * 100, ""]
    cut = []
    monkeypatch.setattr(encoder, "_encode_some", lambda some, real=encoder._encode_some: cut.append(some) or real(some))
    found = list(encoder.encode_all(pa.array(texts)))
    assert found == [encoder.whole(text or "") for text in texts]
    assert len(cut) > 2 and all(len(some) == 1 or pc.sum(pc.binary_length(some)).as_py() <= 40 for some in cut)


def test_other_white_space_is_all_that_python_names():
    every = [chr(i) for i in range(sys.maxunicode + 1) if not 0xD800 <= i < 0xE000]
    found = pc.match_substring_regex(pa.array(every), tokens._OTHER_SPACE).to_pylist()
    assert [c for c, hit in zip(every, found) if hit] == [c for c in every if re.match(r"[^\S \n]", c)]


def test_a_tokenizer_without_special_tokens(encoder, monkeypatch):
    text = "Some words; and others, none of them met before: zyx wvu!"
    alone = Encoder(tokenizer_path(TOKENIZERS[0]))
    monkeypatch.setattr(alone, "_border", None)
    assert alone.encode(text) == alone.whole(text)


def test_words_and_the_stops_behind_them_are_kept_apart(encoder):
    encoder.encode("one.\ntwo, one three? é! one; ... don't.")
    kept = {*encoder._spaced._young}
    assert {" one", ".", ",", "?", "!", ";"} <= kept and not {"one.", " one;", " two,"} & kept
