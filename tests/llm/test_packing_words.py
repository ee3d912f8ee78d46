import random

import public_tokenizers
import pyarrow as pa

from layerhouse.llm.packing import Words

PARTS = ["a", "B", "H̱", "İ", "É", ".", ",", ",", "!", "'s", "'T", "Σ", " ", "\n", " ", "1", "日", "?", "x", "é", "\x01"]


def test_words_have_the_ids_of_the_library():
    words = Words(public_tokenizers.path("word_bpe_49k.json"))
    draw = random.Random(3)
    for turn in range(200):
        pool = [*PARTS, "<|endoftext|>", "<|ENDOFTEXT|>"] if turn % 4 == 0 else PARTS
        batch = [None if draw.random() < .1 else "".join(draw.choice(pool) for _ in range(draw.randint(0, 25))) for _ in range(draw.randint(0, 9))]
        given = pa.array([None, "zz", *batch], pa.string()).slice(draw.choice([0, 1, 2]))
        ids, counts = words.encode(given)
        expected = [words.library.encode(t or "", add_special_tokens=False).ids for t in given.to_pylist()]
        assert counts.tolist() == [len(e) for e in expected]
        assert ids.tolist() == [i for e in expected for i in e]
    words.forget()
    assert len(words.known) == 1
