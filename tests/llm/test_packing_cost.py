"""What tokenizing spends: words are merged once, in one form."""

from __future__ import annotations

import random

import numpy as np

from creditmart.llm import token_units

PARTS = ["Ab", "c'ST", "don't", "it's,", ".", "',", "É", "ß", "²", "³½", "ª", "µ", "×", "÷", "¡¿", "1,234.5", "a.b", "\t", "\n", " ", "\xad", "<|endoftext|>", "ÿ", "İ", "œ", "\0", "\x7f", "x,y.z", "..", ",", ". ,", "’"]


def test_ids_stay_those_of_the_library():
    path, pick = token_units.public_path("word_bpe_49k.json"), random.Random(5)
    library, encoded = token_units.load(path), token_units.document_encoder(path, 1_000)
    for _ in range(5_000):
        text = "".join(pick.choice(PARTS) + pick.choice(["", " "]) for _ in range(pick.randint(1, 7)))
        assert np.frombuffer(encoded(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_words_with_signs_and_capitals_are_one_form():
    assert set(token_units.apart("Late, late. LATE\nÉté, été.").split()) == {"late", ",", ".", "été"}
    assert token_units.apart("no.. way") is None and token_units.apart("it',s") is None and token_units.apart("\x7f") is None and token_units.apart("œ") is None
