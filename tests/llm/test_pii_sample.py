"""The windows the tagger is trained on."""

import random

import numpy as np

from layerhouse.llm import pii, tagger


def test_copies_of_a_window_do_not_fill_the_sample(spark, monkeypatch):
    """A group of copies owns most windows; the sample has each different one once."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice(["an", "the", "or", "ing", "ly"]) for _ in range(rng.randint(1, 3)))
    own = lambda: " ".join([*(word() for _ in range(8)), str(rng.randint(1, 9999)), *(word() for _ in range(8))])
    docs = [own() for _ in range(30)]
    docs += [docs[k] for k in range(30) for _ in range(60)]
    rng.shuffle(docs)
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(5)
    taken = []
    monkeypatch.setattr(tagger, "train", lambda chars, tags, number: taken.append((chars, tags)))
    for most in (20, 3000):
        pii.learn(frame, windows=most)
    few, every = (np.unique(chars, axis=0) for chars, _ in taken)
    assert len(taken[0][0]) == len(few) == 20
    assert len(taken[1][0]) == len(every) > 20  # equal windows count once
    assert {x.tobytes() for x in few} <= {x.tobytes() for x in every}
