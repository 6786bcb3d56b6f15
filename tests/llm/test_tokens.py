"""Ids by pieces against encoding whole texts."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from seatcast.llm.tokens import PieceEncoder

BITS = [" ", "  ", "\n", "\n\n", " \n", "\t", "\x1c", "\x85", "　", "́", "e", "É", "ß",
        "'s", "'ll", "12", "٣", "!", "<|endoftext|>", "don't", "the", "ab", "Σ", "🙂"]


@pytest.mark.parametrize("name, cut", [("byte_bpe_50k.json", "space"),
                                       ("word_bpe_49k.json", "drop")])
def test_pieces_give_the_ids_of_whole_texts(name, cut):
    rnd = random.Random(4)
    texts = ["".join(rnd.choices(BITS, k=rnd.randint(0, 14))) for _ in range(3000)]
    whole = Tokenizer.from_file(public_tokenizers.path(name))
    whole.encode_special_tokens = True
    got = PieceEncoder(public_tokenizers.path(name), cut).encode(texts)
    for text, ids in zip(texts, got):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(
            text, add_special_tokens=False).ids, repr(text)


def test_case_and_marks_after_a_word_cost_no_further_piece():
    path = public_tokenizers.path("word_bpe_49k.json")
    enc, whole = PieceEncoder(path, "drop"), Tokenizer.from_file(path)
    words = ["thanentre", "éouxreé", "straßeon"]
    texts = [f"{w}{m} {w.capitalize()}{m}\n{w.upper()}{m}" for w in words
             for m in (".", ",", "!!", "&&&", "$$$")]
    got = enc.encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [
        whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(enc.known.young) <= 1 + 3 + 3 + 5  # one ASCII word, two others, five marks


@pytest.mark.parametrize("end", ["", ".", "'s,", ".'s", "&&&a", "≠", "̱.", "</w>", "\x85."])
def test_letters_that_change_case_or_join_marks(end):
    path = public_tokenizers.path("word_bpe_49k.json")
    enc, whole = PieceEncoder(path, "drop"), Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    texts = [a + b + end for a in ("", "x", "H", "É") for b in
             ("İ", "İ", "H̱", "É", "ẞ", "Σ", "K", "Ⅷ", "ª", "ÿ", "×", "Ǆ", "﻿")]
    for text, ids in zip(texts, enc.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(
            text, add_special_tokens=False).ids, repr(text)
