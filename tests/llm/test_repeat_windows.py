"""Words in repeated three-word windows against a direct count, also where places or hashes need the slow way."""

import random

from pyspark.sql import functions as F

from layerhouse.llm import quality_rules as rules


def counted(text):
    words = text.split()
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    return len({i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)})


def test_both_ways_count_alike(spark, monkeypatch):
    draw = random.Random(8)
    texts = [" ".join(draw.choice("abcd") for _ in range(draw.randint(0, 60))) for _ in range(200)]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")

    def ours():
        words = rules.split_words(rules.spaced(F.col("t")))
        return [r["n"] for r in df.select("k", rules.let(words, rules._repeat_words).alias("n")).orderBy("k").collect()]

    expected = [counted(t) for t in texts]
    assert ours() == expected
    monkeypatch.setattr(rules, "PLACE_BITS", 5)  # texts of 32 words and more take the slow way
    assert ours() == expected
    monkeypatch.setattr(rules, "PLACE_BITS", 61)  # three bits of hash: different windows share one
    assert ours() == expected
