"""The encoder with a memory gives the library's own ids."""

import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm.text import bytes_list
from llm.tokens import Encoder

FILES = [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)]
ALPHABET = list("abAB 09.,!'\n\t\r") + ["  ", "'s", "'ll", "é", "É", "ß", "×", "½", " ", " ", "é", "　", "中", "😀", "\x1c", "\x00", "\x0b", "<|endoftext|>"]
TEXTS = [None, "", " ", "\n\n", " a", "a ", "a  b", "a\n b", "a \n\nb  ", "don't  stop", "x's'll", "THE!! END.  b", "  b", "é" * 500, "a" * 5000]




def by_encoder(enc, texts):
    ids, bounds = enc.encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]


@pytest.fixture(scope="module", params=FILES)
def pair(request):
    path = public_tokenizers.path(request.param[0])
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    return tok, Encoder(path, request.param[1])


def test_listed_texts(pair):
    tok, enc = pair
    want = [tok.encode(t or "", add_special_tokens=False).ids for t in TEXTS]
    for _ in range(2):
        assert by_encoder(enc, TEXTS) == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ALPHABET), max_size=14).map("".join), max_size=4))
def test_any_text(pair, texts):
    tok, enc = pair
    assert by_encoder(enc, texts) == [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_values_are_cut_from_the_buffer():
    values = pa.array([b"", b"a", "é中".encode(), b"\x00b", b""], pa.large_binary())
    assert bytes_list(values) == values.to_pylist()
    assert bytes_list(values.slice(1, 3)) == values.to_pylist()[1:4]
    assert bytes_list(values.slice(5)) == bytes_list(pa.array([], pa.large_binary())) == []
    assert bytes_list(pa.array([b""], pa.large_binary())) == [b""]


def test_pieces_are_not_made_into_scalars(monkeypatch):
    """Arrow's own way takes longer than all the rest of the encoding."""
    seen = []
    monkeypatch.setattr("llm.tokens.bytes_list", lambda values: seen.append(len(values)) or bytes_list(values))
    enc = Encoder(public_tokenizers.path(FILES[1][0]), False)
    assert len(enc.encode(pa.array(["one two one", None, " two 中 one"]))[1]) == 4
    assert seen == [3]


def test_words_of_the_language_model_are_not_made_into_scalars(monkeypatch):
    import numpy as np

    from llm import lm

    seen = []
    monkeypatch.setattr(lm, "bytes_list", lambda values: seen.append(len(values)) or bytes_list(values), raising=False)
    one = np.ones(2, np.int64)
    vocab = lm.Vocabulary({b"two": 0}, np.array([7, 0]), np.array([3, -1]), np.array([1, 2]), 10.0 * one, 0, one, 9, 2)
    found, n, cls, norm = vocab.codes(pa.array(["One two", None, "two"]))
    assert seen == [2]
    assert found.distinct.to_pylist() == [b"one", b"two"]
    assert n.tolist() == [0, 7] and cls.tolist() == [1 + lm.ending(b"one", 2), 3] and norm.tolist() == [1.0, 0.0]
