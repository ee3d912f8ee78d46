"""Quality classifier by positive-unlabelled learning.

Trusted positives (texts labelled good) and unlabelled web text train a small network on text
measures.  The risk is the non-negative unbiased one: ``prior * R_p(+)`` plus
``max(0, R_u(-) - prior * R_p(-))``, where the unlabelled risk corrected by the positives stands in for
the risk on texts that are not good.  Where the corrected part turns negative on a batch, the step
goes up its gradient instead, which keeps the network from memorising the positives.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from layerhouse.llm.quality_rules import measures

#: Most rows the network is fitted on, of either kind; they are chosen by a hash of the identifier.
POSITIVES, UNLABELLED = 10_000, 10_000

#: Measures of a text, each a number of ``quality_rules.measures`` over another.
RATIOS = {
    "word_length": ("word_chars", "n_words"), "symbols": ("n_symbols", "word_chars"),
    "repeated_lines": ("n_dup_lines", "n_lines"), "repeated_windows": ("n_repeat_words", "n_words"),
    "exclamations": ("n_exclamations", "n_words"), "letters": ("n_letters", "word_chars"),
    "capitals": ("n_upper", "n_letters"), "stop_words": ("n_stop_words", "n_words"),
    "equal_neighbours": ("n_equal_neighbours", "n_words"), "open_lines": ("n_ellipsis_lines", "n_lines"),
    "bullets": ("n_bullet_lines", "n_lines"), "words_per_line": ("n_words", "n_lines"),
}


class Network(NamedTuple):
    """A hidden layer of tanh units on standardised measures, and a logistic output."""

    centre: np.ndarray
    scale: np.ndarray
    hidden: np.ndarray
    shift: np.ndarray
    out: np.ndarray
    bias: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(self.standard(x) @ self.hidden + self.shift) @ self.out + self.bias

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.centre) / self.scale, -8, 8)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def features(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``x``, the measures of a text as an array of doubles; a null text is an empty one."""
    taken = df.select(F.col(id_col).alias("doc_id"), F.inline(F.array(measures(F.col(text_col).cast("string")))))
    shares = [F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0)) for a, b in RATIOS.values()]
    sizes = [F.log1p(F.col(c).cast("double")) for c in ("n_words", "n_lines", "n_symbols", "n_exclamations")]
    return taken.select("doc_id", F.array(*shares, *sizes).alias("x"))


def chosen(ids: DataFrame, most: int, salt: int) -> DataFrame:
    """At most ``most`` rows of one column of identifiers, by a hash; each task sends its first only."""
    (name,) = ids.columns
    return ids.orderBy(F.xxhash64(name, F.lit(salt)), name).limit(most)


def prior_of(labels: DataFrame, label_col: str) -> float:
    """The share of good texts among the labelled ones, an estimate for the unlabelled."""
    row = labels.agg(F.avg(F.col(label_col).cast("double")).alias("share")).first()
    return min(max(row["share"] or 0.5, 0.05), 0.95)


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, units: int = 16, steps: int = 1500,
        batch: int = 256, rate: float = 0.01, decay: float = 1e-4, seed: int = 7) -> Network:
    """Minimise the non-negative risk by Adam; the same rows give the same network.

    Without positives or unlabelled rows every text scores the prior.
    """
    width = positive.shape[1] if len(positive) else unlabelled.shape[1] if len(unlabelled) else 0
    rng = np.random.default_rng(seed)
    if not len(positive) or not len(unlabelled):
        return Network(np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros(1), np.log(prior / (1 - prior)))
    centre = np.median(unlabelled, axis=0)
    net = Network(centre, np.std(unlabelled, axis=0) + 1e-3, rng.normal(0, 1 / np.sqrt(width), (width, units)),
                  np.zeros(units), rng.normal(0, 1 / np.sqrt(units), units), 0.0)
    p, u = net.standard(positive), net.standard(unlabelled)
    weights = [net.hidden.copy(), net.shift.copy(), net.out.copy(), np.zeros(1)]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]

    def gradient(x: np.ndarray, sign: int) -> tuple[float, list[np.ndarray]]:
        """Logistic loss of the label ``sign`` and its gradient."""
        act = np.tanh(x @ weights[0] + weights[1])
        margin = act @ weights[2] + weights[3][0]
        loss = np.logaddexp(0, -sign * margin).mean()
        d = -sign / (1 + np.exp(np.clip(sign * margin, -30, 30))) / len(x)
        back = np.outer(d, weights[2]) * (1 - act**2)
        return loss, [x.T @ back, back.sum(axis=0), act.T @ d, np.array([d.sum()])]

    for step in range(1, steps + 1):
        xp, xu = p[rng.integers(len(p), size=batch)], u[rng.integers(len(u), size=batch)]
        _, g_plus = gradient(xp, 1)
        r_minus, g_minus = gradient(xp, -1)
        r_unlabelled, g_unlabelled = gradient(xu, -1)
        corrected = r_unlabelled - prior * r_minus
        g = [b - prior * a for a, b in zip(g_minus, g_unlabelled, strict=True)]
        g = [prior * a + b for a, b in zip(g_plus, g, strict=True)] if corrected >= 0 else [-b for b in g]
        for i, w in enumerate(weights):
            d = g[i] + decay * w
            first[i] = 0.9 * first[i] + 0.1 * d
            second[i] = 0.999 * second[i] + 0.001 * d * d
            w -= rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return Network(net.centre, net.scale, weights[0], weights[1], weights[2], float(weights[3][0]))


def learn(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Network:
    """Fit on at most ``positives`` rows labelled 1 and ``unlabelled`` rows of ``df``, whatever their label.

    ``labels`` has ``id_col`` and ``label_col``; null labels are left out.  The rows' measures, not their
    texts, come to the driver.
    """
    told = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    good = chosen(told.where(F.col(label_col) == 1).select(F.col(id_col).alias("doc_id")), positives, 1)
    web = chosen(df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id")), unlabelled, 2)
    both = good.withColumn("good", F.lit(True)).unionByName(web.withColumn("good", F.lit(False)))
    both = both.groupBy("doc_id").agg(F.max("good").alias("good"), F.min("good").alias("only_good"))
    some = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(
        F.broadcast(both), "doc_id")  # at most ``positives + unlabelled`` identifiers
    rows = some.select(F.struct("doc_id", "good", "only_good").alias("doc_id"), "text")
    # in the order of the identifier, so that a run is repeated exactly
    got = sorted(((r["doc_id"], r["x"]) for r in features(rows).collect()), key=lambda r: r[0]["doc_id"])
    width = len(RATIOS) + 4
    positive = np.array([x for key, x in got if key["good"]], "f8").reshape(-1, width)
    general = np.array([x for key, x in got if not key["only_good"]], "f8").reshape(-1, width)
    return fit(positive, general, prior_of(told, label_col))


def score(df: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, predicted`` for every row, from its whole text.

    Null and empty texts are scored by their measures, all zero.  Repeated rows repeat their result, an
    empty table gives an empty one, other columns are not read.
    """
    measured = features(df, id_col, text_col)
    schema = T.StructType([measured.schema["doc_id"], T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            x = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
            s = net.score(x) if part.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(s), pa.array((s >= 0.5).astype("i4"))],
                                             names=schema.names)

    return measured.mapInArrow(run, schema)
