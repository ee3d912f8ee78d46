"""The composed machine and its second walk, against the rule word by word."""

import random

import numpy as np

from layerhouse.llm import toxicity

WORDS = {"insult": "grobix", "threat": "kill", "target": "you", "negation": "not", "report": "said", "other": "hand"}


def brute(symbols):
    """Marks of every hit: reported after a verb of saying, negated or at a target within three words."""
    found = {}
    for i, own in enumerate(symbols):
        if own in toxicity.HITS:
            marks = ["reported"] * ("report" in symbols[:i]) + ["negated"] * ("negation" in symbols[max(0, i - 3):i])
            kind = " ".join([*marks, own]) + " at" * ("target" in symbols[max(0, i - 3):i + 4])
            found[kind] = found.get(kind, 0) + 1
    return found


def test_the_walks_mark_what_the_rule_says():
    rng, scorer = random.Random(2), toxicity.Scorer(toxicity.Lexicon(frozenset(["grobix."])))
    for _ in range(2000):
        symbols = rng.choices(list(WORDS), k=rng.randint(1, 12))
        found = scorer.matches(" ".join(WORDS[s] for s in symbols) + ".")
        assert {toxicity.KINDS[k]: int(found[k]) for k in np.flatnonzero(found)} == brute(symbols)


def test_the_target_is_a_part_of_the_machine():
    machine = toxicity.grammar()
    state, out = machine.start, []
    for symbol in ("target", "other", "insult", "report", "insult"):
        state, own = machine.step[state, symbol]
        out.append(own)
    assert out == ["target", "other", "at insult", "report", "reported insult"]
