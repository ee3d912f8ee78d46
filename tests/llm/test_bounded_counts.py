import random

import numpy as np
import pytest

from layerhouse.llm import language_id, pii


def test_counts_do_not_depend_on_the_runs():
    draw = random.Random(4)
    for _ in range(200):
        batch = [None if draw.random() < .1 else "".join(draw.choice("abcÉß日. 1\n-") for _ in range(draw.randint(0, 60)))
                 for _ in range(draw.randint(0, 8))]
        whole = language_id.gram_counts(batch)
        for most in (3, 7, 40):
            assert all(np.array_equal(a, b) for a, b in zip(whole, language_id.gram_counts(batch, most), strict=True))


def test_a_run_of_letters_longer_than_a_piece():
    whole = language_id.gram_counts(["x" * 5000 + " y"])
    assert all(np.array_equal(a, b) for a, b in zip(whole, language_id.gram_counts(["x" * 5000 + " y"], 100), strict=True))


@pytest.mark.parametrize("batch", [[""], ["plain prose"], ["plain", "", None], ["plain", "call 12"], []])
def test_slices_without_a_digit_or_a_sign(spark, batch):
    net = pii.learn(spark.createDataFrame([("mail a.b@c.example.org or +1 (619) 555-1368",)] * 3, "text string"))
    assert [base for base, _ in pii.all_spans(net, batch)] == [[] for _ in batch]


def test_partitions_without_a_digit(spark):
    df = spark.createDataFrame([(k, "plain prose" if k else "mail a.b@c.org now") for k in range(8)], "doc_id long, text string").repartition(8)
    found = {r["doc_id"]: r["spans"] for r in pii.find(df, pii.learn(df)).collect()}
    assert len(found) == 8 and not any(found[k] for k in range(1, 8))
