import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from docsink.llm.token_counts import TokenCounter, default_vocabulary, read_vocabulary, token_counts, whole_tokens

PATH = default_vocabulary()
LIBRARY = Tokenizer.from_file(PATH)
COUNTER = TokenCounter(PATH, whole_tokens(PATH))

ODD = [
    "",
    " ",
    "  a  \n\n b\t\tc  ",
    "<|endoftext|>x<|endoftext|> y<|endoftext",
    "don't we'LL 'S 's it 's",
    "a" * 5000,
    "é ï　  x\x1cy\x85z",
    "1234567 ½² ٣",
    "日本語 テキスト 😀👍🏽",
    "Ġ Ċ raw letters of the vocabulary",
]


def test_whole_tokens_are_proved():
    whole = whole_tokens(PATH)
    assert 45_000 < len(whole) <= 50_256 and " the" in whole
    assert LIBRARY.encode_special_tokens is False


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    assert COUNTER.count(text) == len(LIBRARY.encode(text, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'sdlv.,aZ0é<|endoftext|>"), st.characters(exclude_categories=["Cs"]))))
def test_any_text(text):
    assert COUNTER.count(text) == len(LIBRARY.encode(text, add_special_tokens=False).ids)


def test_documents(documents):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(50, None), (50, "x"), (None, "two words"), (60, "word " * 1024), (61, "word " * 1023)]
    got = token_counts(documents(rows, n_tokens="x", n_bytes="y")).collect()
    want = []
    for i, text in rows:
        n = len(LIBRARY.encode(text or "", add_special_tokens=False).ids)
        want.append((i, len((text or "").encode()), n, n > 1024))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert token_counts(documents([])).collect() == []


def test_other_vocabularies_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError, match="plain byte-level"):
        read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))
