"""Texts that hold the text of a special token, against a tokenizer as it comes."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from layerhouse.llm.packing import Words, pack

PATH = public_tokenizers.path("word_bpe_49k.json")
PARTS = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof", "text|>", "hand", "The", "it's", "42", "\u00e9", "\x01", ".", "  ", "\n"]


def ids(words, text):
    return words.encode(pa.array([text]))[0].tolist()


@pytest.mark.parametrize("apart", ["", " "])
def test_special_tokens_are_read_as_the_library_does(apart):
    rng, library = random.Random(1), Tokenizer.from_file(PATH)
    for mark in (True, False):
        words = Words(PATH)
        if not mark:
            words.mark = None
        for _ in range(400):
            text = apart.join(rng.choice(PARTS) for _ in range(rng.randint(1, 12)))
            assert ids(words, text) == library.encode(text, add_special_tokens=False).ids
    assert ids(Words(PATH), "one<|endoftext|>two")[1:-1] == [49407] and ids(Words(PATH), "<|startoftext|>") == [49406]


def test_packed_ids_hold_special_tokens(spark):
    library, text = Tokenizer.from_file(PATH), "the end <|endoftext|>the<|startoftext|> start"
    row = pack(spark.createDataFrame([(1, text)], "doc_id long, text string"), PATH, with_ids=True).first()
    assert np.frombuffer(row["ids"], "<u4").tolist() == [*library.encode(text, add_special_tokens=False).ids, 0]
