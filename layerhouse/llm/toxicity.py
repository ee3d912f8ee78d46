"""Toxicity by a weighted finite-state grammar over clauses.

A clause is a run of words between stops.  Its words become symbols (insult, threat, target, negation,
report, other) by look-up: insults in the learned lexicon, the others in word lists.  Three transducers
rewrite the symbols in turn: reported speech marks what follows a verb of saying, negation marks an
insult or threat shortly after a negating word, and the target machine marks one that stands shortly
after the person it is aimed at.  They are composed into one machine and a clause is one walk through
it; a second walk of the target machine, from the clause's end, marks what stands shortly before the
person.  The matches that come out are weighted together.  Insults
are learned from labelled texts as words or beginnings of words; the weights of the kinds of match are
fitted on the same texts from the grammar's own weights as prior.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from math import exp, lgamma, log
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from layerhouse.llm.inputs import slices
from layerhouse.llm.pu_quality import chosen

#: Most labelled rows of either label that the lexicon and the weights are learned from.
TOXIC_ROWS, OTHER_ROWS = 8_000, 12_000

#: A pattern is telling if its rate in other texts is at most this share of its rate in toxic ones.
STRAY = 0.02

#: A pattern merely accompanies another one that is in this share of its toxic texts.
BESIDE = 0.9

#: Beginnings of words may have so many letters; whole words are kept apart by a stop.
SHORTEST, LONGEST = 4, 7

#: Words on either side of a match that negate it (before) or are its target (before or after).
NEAR = 3

# Word lists of the grammar (fixed values): English, French, German, Spanish.
THREATS = frozenset((
    "kill murder stab shoot strangle hang burn beat "
    "tuer tuerai frapper poignarder brûler "
    "töten umbringen erschießen erstechen verprügeln "
    "matar mataré golpear apuñalar quemar"
).split())
TARGETS = frozenset((
    "you your you're they them he him she her people everyone "
    "tu toi vous ton votre ils eux lui elle gens "
    "du dich dir dein ihr euch sie ihn leute "
    "tú vosotros usted ustedes ellos él ella gente"
).split())
NEGATIONS = frozenset((
    "not never no isn't aren't don't won't cannot "
    "pas jamais aucun non "
    "nicht nie niemals kein keine "
    "nunca jamás ningún ninguna"
).split())
REPORTS = frozenset((
    "said says say wrote claimed called quoted reported "
    "dit disait écrit déclaré "
    "sagte sagt schrieb behauptete "
    "dijo dice escribió declaró"
).split())

WORD = re.compile(r"[\w']+|[.!?;:\n]")
STOPS = frozenset(".!?;:\n")

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = "other", "insult", "threat", "target", "negation", "report"
HITS = (INSULT, THREAT)

#: Kinds of match in the order of the weights: marks are added by the machines.
MARKS = ("", "reported", "negated", "reported negated")
KINDS = [f"{m} {hit}{at}".strip() for hit in HITS for m in MARKS for at in ("", " at")]


def _prior(kind: str) -> float:
    """The grammar's own weight of a kind of match."""
    weight = 4.0 if INSULT in kind else 0.5
    weight += 1.5 if kind.endswith(" at") else 0.0
    return weight - 2.0 * ("negated" in kind) - 1.5 * ("reported" in kind)


class Transducer(NamedTuple):
    """Deterministic: ``step`` maps (state, symbol) to (state, symbol out)."""

    start: object
    step: dict[tuple[object, str], tuple[object, str]]
    symbols: tuple[str, ...]


def scope(opener: str, mark: str, reach: int | None, symbols: tuple[str, ...]) -> Transducer:
    """Marks the hits up to ``reach`` words after an opener, or to the clause's end."""
    endless = -1
    states = [0, *(range(1, reach + 1) if reach else [endless])]
    step = {}
    for state in states:
        for symbol in symbols:
            base = symbol.split()[-1]
            after = state if state == endless else max(state - 1, 0)
            out = f"{mark} {symbol}" if state and base in HITS else symbol
            step[state, symbol] = ((reach or endless) if base == opener else after, out)
    return Transducer(0, step, symbols)


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The machine that feeds what ``first`` writes to ``second``."""
    start = (first.start, second.start)
    step, todo, seen = {}, [start], {start}
    while todo:
        a, b = state = todo.pop()
        for symbol in first.symbols:
            a2, middle = first.step[a, symbol]
            b2, out = second.step[b, middle]
            step[state, symbol] = ((a2, b2), out)
            if (a2, b2) not in seen:
                seen.add((a2, b2))
                todo.append((a2, b2))
    return Transducer(start, step, first.symbols)


PLAIN = (OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT)


def target() -> Transducer:
    """Marks the hits, however marked, shortly after a target; walked in both directions."""
    hits = [f"{m} {h}".strip() for m in MARKS for h in HITS]
    return scope(TARGET, "at", NEAR, (*(s for s in PLAIN if s not in HITS), *hits, *(f"at {h}" for h in hits)))


def grammar() -> Transducer:
    reported = scope(REPORT, "reported", None, PLAIN)
    negated = scope(NEGATION, "negated", NEAR, (*PLAIN, *(f"reported {h}" for h in HITS)))
    # marks come in one order: "reported negated insult"
    renamed = {key: (state, re.sub(r"^negated reported", "reported negated", out)) for key, (state, out) in negated.step.items()}
    return compose(compose(reported, negated._replace(step=renamed)), target())


#: What the walks write on a hit, with the place of its kind: a target before, after, or on both sides.
PLACES = {f"{at}{kind}": KINDS.index(kind + (" at" if at else ""))
          for kind in KINDS if not kind.endswith(" at") for at in ("", "at ", "at at ")}


class Lexicon(NamedTuple):
    """Insults as whole words (ending in a stop) and beginnings of words."""

    patterns: frozenset[str]

    def is_insult(self, word: str) -> bool:
        return f"{word}." in self.patterns or any(word[:n] in self.patterns for n in range(SHORTEST, min(len(word), LONGEST) + 1))


class Scorer:
    """Walks texts through the grammar; words met are remembered with their symbol."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.machine, self.back = lexicon, grammar(), target()
        self.symbol: dict[str, str] = {}

    def classify(self, word: str) -> str:
        # a learned insult outranks the lists; lists of the roles do not meet
        for kind, words in ((THREAT, THREATS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (TARGET, TARGETS)):
            if word in words:
                return kind
        return INSULT if self.lexicon.is_insult(word) else OTHER

    def matches(self, text: str) -> np.ndarray:
        """How often each kind of match occurs in the clauses of a text."""
        found = np.zeros(len(KINDS))
        words, symbol = WORD.findall(text.lower()), self.symbol
        if len(symbol) > 500_000:
            symbol.clear()
        for word in set(words):
            if word not in symbol:
                symbol[word] = OTHER if word in STOPS else self.classify(word)
        symbols = [symbol[w] for w in words]
        if INSULT not in symbols and THREAT not in symbols:
            return found
        step, state = self.machine.step, self.machine.start
        clause: list[str] = []
        for word, own in zip([*words, "."], [*symbols, OTHER], strict=True):
            if word not in STOPS:
                state, out = step[state, own]
                clause.append(out)
                continue
            state = self.back.start
            for out in reversed(clause):
                state, out = self.back.step[state, out]
                if out in PLACES:
                    found[PLACES[out]] += 1
            clause, state = [], self.machine.start
        return found


class Model(NamedTuple):
    lexicon: Lexicon
    weights: np.ndarray
    bias: float

    def score(self, found: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(np.log1p(found) @ self.weights + self.bias, -30, 30)))


def patterns_of(text: str | None) -> set[str]:
    """The distinct words of a text (with a stop) and their beginnings."""
    out = set()
    for word in set(WORD.findall((text or "").lower())):
        if len(word) >= 3 and word not in STOPS:
            out.add(f"{word}.")
            out.update(word[:n] for n in range(SHORTEST, min(len(word), LONGEST) + 1))
    return out


def chance(t: int, n: int, share: float) -> float:
    """Probability that of ``t + n`` texts at least ``t`` are toxic, if ``share`` of all texts are."""
    if share >= 1:
        return 1.0
    if share <= 0:
        return 0.0
    both = t + n
    return min(1.0, sum(exp(lgamma(both + 1) - lgamma(k + 1) - lgamma(both - k + 1) + k * log(share) + (both - k) * log(1 - share))
                        for k in range(t, both + 1)))


def chosen_patterns(docs: dict[str, set[int]], proven: set[str]) -> set[str]:
    """The patterns to take, of those (with their toxic texts) that are telling.

    A proven one is taken unless it merely accompanies one already taken; the others are taken by a
    greedy cover of the texts that no taken pattern explains, each for at least two of them.
    """
    # of equal patterns the longest one: a beginning must earn its generality by more texts
    rank = lambda p, d: (-len(d), -len(p), p)
    taken: set[str] = set()
    holders: dict[int, list[str]] = {}
    for p in sorted(proven, key=lambda p: rank(p, docs[p])):
        beside = Counter(q for d in docs[p] for q in holders.get(d, ()))
        if beside and max(beside.values()) >= BESIDE * len(docs[p]):
            continue
        taken.add(p)
        for d in docs[p]:
            holders.setdefault(d, []).append(p)
    covered = set(holders)
    heap = [(rank(p, left), p) for p in docs if p not in proven and len(left := docs[p] - covered) >= 2]
    heapq.heapify(heap)
    while heap:
        old, p = heapq.heappop(heap)
        left = docs[p] - covered
        if len(left) < 2:
            continue
        if (now := rank(p, left)) != old:
            heapq.heappush(heap, (now, p))
            continue
        taken.add(p)
        covered |= left
    return taken


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """The patterns that toxic texts have and other texts (almost) never have.

    ``sample`` (``doc_id, toxic, text``) is bounded.  Spark counts every pattern; all that are telling by
    their rates come to the driver with the toxic texts they occur in, so the sample bounds them.  A
    pattern is proven if fewer than one of all patterns would be as telling by chance.  Proven patterns
    are taken by their own evidence, except those that only stand beside another one (as words do in
    copies of one text); the rest are taken where they explain texts that nothing else explains.
    """
    schema = T.StructType([T.StructField("pattern", T.StringType()), T.StructField("doc", T.LongType()),
                           T.StructField("toxic", T.IntegerType())])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, batch in slices(batches):
            rows = [(p, d, t) for p, d, t in zip(map(patterns_of, batch), part.column(0).to_pylist(), part.column(1).to_pylist(),
                                                 strict=True)]
            yield pa.RecordBatch.from_arrays([
                pa.array([p for ps, _, _ in rows for p in ps], pa.string()),
                pa.array([d for ps, d, _ in rows for _ in ps], pa.int64()),
                pa.array([t for ps, _, t in rows for _ in ps], pa.int32()),
            ], names=schema.names)

    texts_of = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    toxic, other = texts_of.get(1, 0), texts_of.get(0, 0)
    if not toxic:
        return Lexicon(frozenset())
    spreads = sample.select(F.xxhash64("doc_id").alias("doc"), F.col("toxic").cast("int"), "text").mapInArrow(spread, schema)
    counted = spreads.groupBy("pattern").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("n")).persist()
    met = counted.count()
    # rates, not counts: the two samples are not drawn alike
    telling = counted.where((F.col("t") >= 2) & (F.col("n") * toxic <= F.lit(STRAY) * F.col("t") * other))
    odds = lru_cache(maxsize=None)(lambda t, n: chance(t, n, toxic / (toxic + other)))
    proven = {r["pattern"] for r in telling.collect() if met * odds(r["t"], r["n"]) < 1}
    hits = spreads.where("toxic = 1").join(telling.select("pattern"), "pattern")
    docs: dict[str, set[int]] = {}
    for r in hits.select("pattern", "doc").toLocalIterator():
        docs.setdefault(r["pattern"], set()).add(r["doc"])
    counted.unpersist()
    return Lexicon(frozenset(chosen_patterns(docs, proven)))


def fit(found: np.ndarray, toxic: np.ndarray, steps: int = 300) -> tuple[np.ndarray, float]:
    """Logistic weights, drawn to the grammar's own and never below zero; bias learned freely."""
    prior = np.array([max(_prior(k), 0.0) for k in KINDS])
    weights, bias = prior.copy(), -2.0
    if not len(toxic) or toxic.min() == toxic.max():
        return weights, bias
    x = np.log1p(found)
    balance = np.where(toxic == 1, 0.5 / max(toxic.sum(), 1), 0.5 / max((1 - toxic).sum(), 1))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights + bias, -30, 30)))
        d = (p - toxic) * balance
        weights = np.maximum(weights - 2.0 * (x.T @ d + 0.002 * (weights - prior)), 0.0)
        bias -= 2.0 * d.sum()
    return weights, float(bias)


def found_in(df: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``doc_id`` and ``found``, the number of matches of each kind."""
    schema = T.StructType([df.schema["doc_id"], T.StructField("found", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(lexicon)
        for part, batch in slices(batches):
            rows = [scorer.matches(t or "").tolist() for t in batch]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, pa.list_(pa.float64()))], names=schema.names)

    return df.select("doc_id", "text").mapInArrow(run, schema)


def learn(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", toxic_rows: int = TOXIC_ROWS, other_rows: int = OTHER_ROWS) -> Model:
    """Learn lexicon and weights from at most ``toxic_rows`` and ``other_rows`` labelled rows.

    The rows are chosen by a hash of their identifier; null labels and identifiers are left out.
    Without labelled rows the lexicon is empty and the grammar's own weights hold.
    """
    told = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    picks = [chosen(told.where(F.col(label_col) == v).select(F.col(id_col).alias("doc_id")), most, 3).withColumn("toxic", F.lit(v))
             for v, most in ((1, toxic_rows), (0, other_rows))]
    # at most ``toxic_rows + other_rows`` identifiers
    sample = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).join(
        F.broadcast(picks[0].unionByName(picks[1])), "doc_id").repartition(F.col("doc_id")).persist()
    lexicon = learn_lexicon(sample)
    rows = found_in(sample, lexicon).join(sample.select("doc_id", "toxic"), "doc_id").groupBy("found", "toxic").count().collect()
    sample.unpersist()
    many = np.array([r["count"] for r in rows], "i8")
    found = np.repeat(np.array([r["found"] for r in rows], "f8").reshape(-1, len(KINDS)), many, axis=0)
    order = np.lexsort(found.T)
    toxic = np.repeat(np.array([r["toxic"] for r in rows], "f8"), many)
    return Model(lexicon, *fit(found[order], toxic[order]))


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, predicted`` and ``matches`` (how often each kind of match occurs) for every row.

    Null and empty texts match nothing and get the lowest score.  Repeated rows repeat their result, an
    empty table gives an empty one, other columns are not read.
    """
    df = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([df.schema["doc_id"], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()),
                           T.StructField("matches", T.MapType(T.StringType(), T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.lexicon)
        for part, batch in slices(batches):
            found = np.array([scorer.matches(t or "") for t in batch]).reshape(-1, len(KINDS))
            s = model.score(found)
            named = [[(KINDS[k], int(row[k])) for k in np.flatnonzero(row)] for row in found]
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array(s), pa.array((s >= 0.5).astype("i4")), pa.array(named, pa.map_(pa.string(), pa.int64())),
            ], names=schema.names)

    return df.mapInArrow(run, schema)
