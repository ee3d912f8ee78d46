"""Which insults are learned: by their own evidence, at any number of patterns."""

import random

from layerhouse.llm import toxicity

STEMS = "grobix vrulta knaffe ploster drimzel".split()


def prose(rng, n=12):
    return [f"w{rng.randrange(4000)}x" for _ in range(n)]


def test_a_proven_insult_is_taken_though_others_cover_its_texts(spark):
    rng = random.Random(4)
    docs = [(i, 0, " ".join(prose(rng))) for i in range(300)]
    for i in range(60):  # every text with the last stem holds two others of the common ones as well
        own = rng.sample(STEMS[:-1], 2) + ([STEMS[-1]] if i % 4 == 0 else [])
        docs.append((1000 + i, 1, " ".join(prose(rng) + own)))
    lexicon = toxicity.learn_lexicon(spark.createDataFrame(docs, "doc_id long, toxic int, text string"))
    assert all(lexicon.is_insult(stem) for stem in STEMS)
    assert not any(lexicon.is_insult(f"w{n}x") for n in range(4000))
    found = toxicity.Scorer(lexicon).matches(f"nothing else but {STEMS[-1]} here")
    assert found.sum() == 1


def test_no_number_of_patterns_is_a_limit():
    """4,500 patterns, each in two texts that nothing else explains."""
    docs = {f"word{n}.": {2 * n, 2 * n + 1} for n in range(4500)}
    assert toxicity.chosen_patterns(docs, set()) == set(docs)


def test_samples_are_compared_by_rates(spark):
    rng = random.Random(7)
    docs = [(i, 1, " ".join([*prose(rng), "grobix"])) for i in range(30)]
    # five others of 3,000 texts hold the word: a rate of 0.0017, against 1 of the toxic texts
    docs += [(100 + i, 0, " ".join(prose(rng, 4) + ["grobix"] * (i < 5))) for i in range(3000)]
    lexicon = toxicity.learn_lexicon(spark.createDataFrame(docs, "doc_id long, toxic int, text string"))
    assert lexicon.is_insult("grobix")
    assert round(toxicity.chance(3, 0, 0.5), 9) == 0.125 and round(toxicity.chance(1, 1, 0.5), 9) == 0.75
