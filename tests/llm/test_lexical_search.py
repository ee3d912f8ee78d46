"""Ranked search against a direct computation of every score."""

import re
from collections import Counter
from math import floor, log

import numpy as np
import pyarrow as pa
import pytest

from layerhouse.llm import bitsliced, registry

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def terms(text):
    return Counter(TERM.findall((text or "").translate(SMALL)))


def brute(documents, items, k=50):
    docs = [(d, t, sum(t.values())) for d, t in ((d, terms(text)) for d, text in documents) if t]
    count, total = len(docs), sum(n for _, _, n in docs)
    holding = Counter(t for _, own, _ in docs for t in own)
    out = []
    for item, text in items:
        scores = []
        for d, own, n in docs:
            damp = 50 + (50 * n * count) // total
            score = sum(floor(1000 * log((2 * count + 2) / (2 * holding[t] + 1))) * ((10**9 * own[t]) // (1000 * own[t] + 20 * damp))
                        for t in terms(text) if t in own)
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def found(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=str)


def test_the_registered_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    assert found(registry.QUERIES["op11_bitsliced_search"](spark, folder)) == brute(docs, items)


@pytest.mark.parametrize("pass_terms", [1, 10_000])
def test_edges(spark, edge, monkeypatch, pass_terms):
    monkeypatch.setattr(bitsliced, "PIECE_BYTES", 1000)
    items = [(1, "The CAT and the dog"), (1, "The CAT and the dog"), (2, None), (3, " ,. "), (4, "été 日本語 wort"), (None, "one two"), (5, "nowhere")]
    docs = [(r["doc_id"], r["text"]) for r in edge.collect()]
    asked = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, score string")
    table = bitsliced.stored(bitsliced.index(edge))
    for k in (2, 50):
        assert found(bitsliced.search(table, asked, k, pass_terms=pass_terms)) == brute(docs, items, k)
    assert bitsliced.ranked_search(edge.limit(0), asked).collect() == []
    assert bitsliced.ranked_search(edge, asked.limit(0)).collect() == []


def test_long_texts_are_counted_in_pieces(monkeypatch):
    monkeypatch.setattr(bitsliced, "PIECE_BYTES", 50)
    text = "Abc dé f12 " * 40 + "z" * 200 + " last"
    plain = bitsliced.lowered(pa.array([text]))
    words, _, word, times = bitsliced.counted_long(plain[0].as_py().encode())
    assert dict(zip(words.take(pa.array(word)).to_pylist(), times.tolist(), strict=True)) == dict(terms(text))


def test_bounds_hold_and_shut_out(monkeypatch):
    draw = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in draw.zipf(1.3, draw.integers(1, 80)) if x < 5000) for _ in range(400)]
    words, row, word, times = bitsliced.counted(bitsliced.lowered(pa.array(texts)))
    width = 2048
    entry = bitsliced.block(list(range(400)), words, row, word, times, width)
    entry = bitsliced.unpacked({k: pa.scalar(v[0]) for k, v in entry.items()})
    items = bitsliced.Items([set(texts[n].split()) for n in range(0, 400, 40)])
    ranking = bitsliced.Ranking(items, np.full(len(items.terms), 700), 400, int(times.sum()), 3)
    bounds, scores = [], []
    kept = bitsliced.Ranking._summed

    def summed(self, term, doc, value, size):
        out = kept(self, term, doc, value, size)
        (scores if bounds else bounds).append(out)
        return out

    monkeypatch.setattr(bitsliced.Ranking, "_summed", summed)
    ranking.meet(entry)
    assert (bounds[0] >= scores[0]).all()
    assert (bounds[0] <= 1.3 * scores[0]).mean() > 0.9  # levels and signatures are nearly exact
    least = np.sort(scores[0], axis=1)[:, -3]
    assert (bounds[0] >= least[:, None]).mean() < 0.05  # and shut out nearly all that is not among the best
    assert [[-s for s, _, _ in best] for best in ranking.best] == np.sort(scores[0], axis=1)[:, :-4:-1].tolist()
