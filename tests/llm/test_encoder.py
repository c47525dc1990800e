"""Words encoded one by one and together against whole texts."""

from __future__ import annotations

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from wattledger.llm import stages, tokens

LETTERS = list("abAB  \n\té😀İΣς .,'!1中\x1c\x85\xa0ǅ") + ["the ", "'s ", "<|endoftext|>", "ΑΣ ", "é "]


def texts():
    chance = random.Random(2)
    made = ["".join(chance.choices(LETTERS, k=chance.randrange(1, 50))) for _ in range(3000)]
    return ["", "a. b, c! d's 3.14 foo). bar..! Straße ẞ ﬁ ª aİ. Σ.", *made]


@pytest.mark.parametrize("name, by_word", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_ids_are_those_of_whole_texts(monkeypatch, name, by_word):
    """Also for a tokenizer that keeps white space, and while the cache turns over."""
    monkeypatch.setattr(tokens, "REMEMBERED", 50)
    monkeypatch.setattr(tokens, "TOGETHER", 500)
    path = stages.tokenizer_path(name)
    encoder = tokens.WordEncoder(path, "<u2")
    assert encoder.by_word == by_word
    want = Tokenizer.from_file(path).encode_batch(texts(), add_special_tokens=False)
    assert encoder.encode([t.encode() for t in texts()]) == [np.array(e.ids, "<u2").tobytes() for e in want]


def test_words_met_since_the_last_turn_stay(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 10)
    encoder = tokens.WordEncoder(stages.tokenizer_path(), "<u2")
    learned = []
    plain = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda missing: (learned.extend(missing), plain(missing)))
    for i in range(50):
        encoder.encode([b"often " + " ".join(f"rare{i}x{j}" for j in range(6)).encode()])
    assert learned.count(b"often") == 1
    assert len(encoder._new) + len(encoder._old) < 40


def test_long_texts_are_cut_at_white_space(monkeypatch):
    monkeypatch.setattr(tokens, "CHUNK", 100)
    encoder = tokens.WordEncoder(stages.tokenizer_path(), "<u2")
    text = " ".join(f"word{i}" for i in range(500)) + " " + "y" * 400
    want = Tokenizer.from_file(stages.tokenizer_path()).encode(text, add_special_tokens=False).ids
    assert encoder.encode([text.encode()]) == [np.array(want, "<u2").tobytes()]


@pytest.mark.parametrize("text", [b"", b"  ", b"plain words", b"...", b"a. b"])
def test_texts_of_one_kind_of_words(text):
    encoder = tokens.WordEncoder(stages.tokenizer_path(), "<u2")
    want = Tokenizer.from_file(stages.tokenizer_path()).encode(text.decode(), add_special_tokens=False).ids
    assert encoder.encode([text]) == [np.array(want, "<u2").tobytes()]
    assert encoder.encode([]) == []
