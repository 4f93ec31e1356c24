import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def ids(text):
    return np.frombuffer(bpe.codec(PATH).encode(text), "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    assert ids(text) == library(text)
    assert bpe.codec(PATH).decode(bpe.codec(PATH).encode(text)) == text


@pytest.mark.parametrize("alphabet", ["ab", "aeiount 's", " \n\t\r", "0123 .", "éèaß ", "<|endoftext|> "])
def test_repetitive_text(alphabet):
    rng = random.Random(alphabet)
    for _ in range(200):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 60)))
        assert ids(text) == library(text)


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 3000, " " * 4000, "<|endoftext|>" * 3, "aaab" * 2000])
def test_long_pieces(text):
    assert ids(text) == library(text)


def test_memory_may_be_emptied(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    own = bpe.Codec(PATH)
    text = "many different words stand here, more than are remembered"
    assert np.frombuffer(own.encode(text), "<u4").tolist() == library(text)
    assert len(own.pieces.known) <= 3


def test_operator(documents, edge_rows):
    data = documents(edge_rows)
    got = bpe.digests(bpe.decode(bpe.encode(data, PATH), PATH)).collect()
    assert len(got) == len(edge_rows)
    expected = set()
    for key, text in edge_rows:
        packed = np.array(library(text or ""), "<u4")
        sha = hashlib.sha256(packed.tobytes()).hexdigest()
        expected.add((key, len(packed), sha, hashlib.sha256((text or "").encode()).hexdigest()))
    assert {tuple(r) for r in got} == expected
    assert bpe.encode(data.limit(0), PATH).count() == 0
