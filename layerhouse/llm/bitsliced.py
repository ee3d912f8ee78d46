"""Ranked lexical search over bit-sliced Bloom signatures.

The index has blocks of documents of like size.  Every document has a Bloom signature of its terms, one key per
term and level of frequency (1, 2, 3, 5, 9 and more times), as wide as the block's class asks for; the block keeps
the signatures sliced, a bitmap over its documents for each bit.  A query term's bitmap is the AND of three slices
and holds every document with the term, so adding up what the terms can weigh at most, by the levels they show,
bounds each document's score from above.  Documents whose bound falls short of the k-th best score found so far are
provably out; the others are scored exactly from the block's own term counts.

Scores are integers, computed as the contract of the search says (see ``search``).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import floor, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T, Window

from layerhouse.llm.inputs import slices, texts
from layerhouse.llm.near_dedup import mix
from layerhouse.session import scratch

#: Bytes that make up terms, as their lower case, and a space for all others (fixed: ASCII letters and digits, all beyond ASCII).
LOWER = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

#: Least frequency of each level, bits that a key sets, and least bits per key.
LEVELS, HASHES, BITS = (1, 2, 3, 5, 9), 3, 8

#: Bytes of text that become blocks together, and bytes of one text that are counted at a time.
BLOCK_BYTES, PIECE_BYTES = 1_000_000, 1_000_000

#: Query terms, with repeats over the items, that one pass over the index looks for.
PASS_TERMS = 100_000

#: (term, document, item) triples that are added up at a time.
TRIPLES = 4_000_000

#: Numbers of a block are packed as little-endian integers, its words joined by a space.
INDEX = T.StructType([
    T.StructField("width", T.LongType()), T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("lengths", T.BinaryType()),
    T.StructField("documents", T.LongType()), T.StructField("terms", T.LongType()), T.StructField("slices", T.BinaryType()),
    T.StructField("words", T.StringType()), T.StructField("holding", T.BinaryType()), T.StructField("counts", T.BinaryType()),
    T.StructField("word", T.BinaryType()), T.StructField("times", T.BinaryType()),
])

#: Bytes of a row group of the stored index, which is what a reader holds at once.
GROUP_BYTES = 16_000_000


def lowered(batch: pa.Array) -> pa.Array:
    """The texts with term characters in lower case and spaces between; null is empty."""
    batch = pc.fill_null(batch.cast(pa.string()), "")
    _, offsets, data = batch.buffers()
    if not len(batch) or data is None:
        return pa.array([""] * len(batch), pa.string())
    offsets = np.frombuffer(offsets, "i4")[batch.offset:batch.offset + len(batch) + 1]
    text = data[int(offsets[0]):int(offsets[-1])].to_pybytes().translate(LOWER)
    return pa.Array.from_buffers(pa.string(), len(batch), [None, pa.py_buffer((offsets - offsets[0]).tobytes()), pa.py_buffer(text)])


def counted(batch: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Different words, and row, word and frequency of each pair, ordered by row, of texts in ``lowered`` form."""
    lists = pc.ascii_split_whitespace(batch)
    flat = lists.flatten().dictionary_encode()
    words, index = flat.dictionary, flat.indices.to_numpy()
    row = np.repeat(np.arange(len(batch)), lists.value_lengths().to_numpy())
    if len(index):
        filled = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)[index]
        index, row = index[filled], row[filled]
    key, times = np.unique(row.astype("i8") * max(1, len(words)) + index, return_counts=True)
    return words, key // max(1, len(words)), key % max(1, len(words)), times


def counted_long(text: str | bytes) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """As ``counted`` for one long text, a piece at a time: memory grows with its different words only."""
    total: dict[str, int] = {}
    at = 0
    while at < len(text):
        until = min(len(text), at + PIECE_BYTES)
        cut = text.find(b" ", until) if until < len(text) else len(text)
        until = cut if cut >= 0 else len(text)
        words, _, word, times = counted(pa.array([text[at:until].decode()], pa.string()))
        for name, n in zip(words.take(pa.array(word)).to_pylist(), times.tolist(), strict=True):
            total[name] = total.get(name, 0) + n
        at = until
    times = np.array(list(total.values()), "i8")
    return pa.array(list(total), pa.string()), np.zeros(len(times), "i8"), np.arange(len(times)), times


def hashes(words: pa.Array) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(w) for w in words.cast(pa.binary()).to_pylist()], "u8")


def places(term: np.ndarray, level: int, width: int) -> np.ndarray:
    """The bits, by column, that each term's key of a level sets."""
    return np.stack([(mix(term, 1 + HASHES * level + h) & np.uint64(width - 1)).astype("i8") for h in range(HASHES)], axis=-1)


def block(ids: list, words: pa.Array, row: np.ndarray, word: np.ndarray, times: np.ndarray, width: int) -> dict[str, list]:
    """One row of the index: the documents, their slices and their term counts."""
    size = len(ids)
    used, word = np.unique(word, return_inverse=True)
    words = words.take(pa.array(used))
    term = hashes(words)
    bits = np.zeros((width, -(-size // 8) * 8), bool)
    for level, least in enumerate(LEVELS):
        holds = times >= least
        if not holds.any():
            break
        at = places(term[word[holds]], level, width)
        for h in range(HASHES):
            bits[at[:, h], row[holds]] = True
    lengths = np.bincount(row, weights=times, minlength=size).astype("i8")
    return {
        "width": [width], "ids": [ids], "lengths": [lengths.astype("<i8").tobytes()], "documents": [int((lengths > 0).sum())],
        "terms": [int(lengths.sum())], "slices": [np.packbits(bits, axis=1).tobytes()], "words": [" ".join(words.to_pylist())],
        **{name: [x.astype("<i4").tobytes()] for name, x in (
            ("holding", np.bincount(word, minlength=len(words))), ("counts", np.bincount(row, minlength=size)), ("word", word), ("times", times))},
    }


def index(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The signature index of a table: blocks of documents that have terms.

    Null texts and texts without a term have no place in it.  Repeated rows and null identifiers are documents of
    their own; an empty table gives an empty index; other columns are not read.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(INDEX)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _ in slices(batches, most=BLOCK_BYTES, read=False):
            plain = lowered(part.column(1))
            if part.num_rows == 1 and plain.nbytes > BLOCK_BYTES:
                words, row, word, times = counted_long(plain.buffers()[2].to_pybytes())
            else:
                words, row, word, times = counted(plain)
            names = part.column(0).to_pylist()
            keys = sum(np.bincount(row[times >= least], minlength=len(names)) for least in LEVELS)
            wide = np.where(keys > 0, 1 << np.ceil(np.log2(np.maximum(keys * BITS, 64))).astype("i8"), 0)
            for width in np.unique(wide[wide > 0]).tolist():
                members = np.flatnonzero(wide == width)
                own = wide[row] == width
                yield pa.RecordBatch.from_pydict(
                    block([names[m] for m in members], words, np.searchsorted(members, row[own]), word[own], times[own], width), arrow)

    return texts(df, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(run, INDEX)


def words_of(joined: pa.Scalar) -> pa.Array:
    return pc.ascii_split_whitespace(pa.array([joined.as_py()], pa.string())).values


def unpacked(row: dict[str, pa.Scalar]) -> dict:
    """A row of the index as numbers and arrays."""
    kinds = {"lengths": "<i8", "counts": "<i4", "word": "<i4", "times": "<i4"}
    return {"width": row["width"].as_py(), "ids": row["ids"].as_py(), "slices": row["slices"].as_py(), "words": words_of(row["words"]),
            **{name: np.frombuffer(row[name].as_py(), kind) for name, kind in kinds.items()}}


class Items:
    """Query items: their different terms, and for each term the items that ask for it."""

    def __init__(self, asked: list[set[str]]):
        number: dict[str, int] = {}
        pairs = sorted({(number.setdefault(t, len(number)), n) for n, terms in enumerate(asked) for t in sorted(terms)})
        self.size = len(asked)
        self.terms = pa.array(list(number), pa.string())
        self.hashes = hashes(self.terms)
        self.items = np.array([n for _, n in pairs], "i8")
        self.many = np.bincount(np.array([t for t, _ in pairs], "i8"), minlength=len(number))
        self.first = np.cumsum(self.many) - self.many

    def holding(self, table: DataFrame) -> np.ndarray:
        """In how many documents each term stands: one row per term and task reaches the sum, one per term the driver."""
        terms = self.terms

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(terms), "i8")
            for batch in batches:
                for k in range(batch.num_rows):
                    at = pc.fill_null(pc.index_in(terms, value_set=words_of(batch.column(0)[k])), -1).to_numpy()
                    total[at >= 0] += np.frombuffer(batch.column(1)[k].as_py(), "<i4")[at[at >= 0]]
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "n"])

        out = np.zeros(len(terms), "i8")
        for r in table.select("words", "holding").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
            out[r["term"]] = r["n"]
        return out


class Ranking:
    """The best documents of each item that a task has met."""

    def __init__(self, items: Items, weights: np.ndarray, documents: int, terms: int, k: int):
        self.items, self.weights, self.documents, self.terms, self.k = items, weights, documents, terms, k
        self.best: list[list[tuple]] = [[] for _ in range(items.size)]
        self.least = np.ones(items.size, "i8")  # a score must be above 0

    def _summed(self, term: np.ndarray, doc: np.ndarray, value: np.ndarray, size: int) -> np.ndarray:
        """Value added up per (item, document) over the items of each term; sums are exact in doubles."""
        items, out = self.items, np.zeros(self.items.size * size)
        for part in np.array_split(np.arange(len(term)), 1 + int(items.many[term].sum()) // TRIPLES):
            many = items.many[term[part]]
            at = np.repeat(items.first[term[part]] - np.cumsum(many) + many, many) + np.arange(many.sum())
            out += np.bincount(items.items[at] * size + np.repeat(doc[part], many), weights=np.repeat(value[part], many), minlength=len(out))
        return out.astype("i8").reshape(items.size, size)

    def _worth(self, term: np.ndarray, times: np.ndarray, damp: np.ndarray) -> np.ndarray:
        return self.weights[term] * ((1_000_000_000 * times) // (1000 * times + 20 * damp))

    def meet(self, row: dict) -> None:
        """Bound all documents of a block, and score those that the bounds leave."""
        lengths, width = row["lengths"], row["width"]
        size = len(lengths)
        table = np.frombuffer(row["slices"], "u1").reshape(width, -1)
        damp = 50 + (50 * lengths * self.documents) // self.terms
        at = places(self.items.hashes, 0, width)
        maybe = reduce(np.bitwise_and, (table[at[:, h]] for h in range(HASHES)))
        some = np.flatnonzero(maybe.any(axis=1))
        term, doc = np.nonzero(np.unpackbits(maybe[some], axis=1)[:, :size])
        term = some[term]
        most = np.full(len(term), LEVELS[1] - 1, "i8")
        above = np.arange(len(term))
        for level in range(1, len(LEVELS)):
            bit = places(self.items.hashes[term[above]], level, width)
            shown = np.ones(len(above), bool)
            for h in range(HASHES):
                shown &= (table[bit[:, h], doc[above] >> 3] >> (7 - (doc[above] & 7))) & 1 == 1
            above = above[shown]
            most[above] = LEVELS[level + 1] - 1 if level + 1 < len(LEVELS) else lengths[doc[above]]
        bound = self._summed(term, doc, self._worth(term, np.minimum(most, lengths[doc]), damp[doc]), size)
        item, doc = np.nonzero(bound >= self.least[:, None])
        if len(item):
            self._rescore(row, item, doc, damp)

    def _rescore(self, row: dict, item: np.ndarray, doc: np.ndarray, damp: np.ndarray) -> None:
        counts = row["counts"]
        wanted = np.zeros(len(counts), bool)
        wanted[doc] = True
        holder = np.repeat(np.arange(len(counts)), counts)
        own = pc.fill_null(pc.index_in(row["words"], value_set=self.items.terms), -1).to_numpy().astype("i8")
        term = own[row["word"]]
        used = wanted[holder] & (term >= 0)
        term, holder, times = term[used], holder[used], row["times"][used].astype("i8")
        score = self._summed(term, holder, self._worth(term, times, damp[holder]), len(counts))[item, doc]
        good = score >= self.least[item]
        item, doc, score = item[good], doc[good], score[good]
        for n in np.unique(item).tolist():
            mine = item == n
            rows = self.best[n] + [(-s, row["ids"][d] is None, row["ids"][d]) for s, d in zip(score[mine].tolist(), doc[mine].tolist(), strict=True)]
            rows.sort(key=lambda r: (r[0], r[1], r[2] or 0))
            self.best[n] = rows[:self.k]
            if len(rows) >= self.k:
                self.least[n] = max(1, -rows[self.k - 1][0])


def _terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _ in slices(batches, most=PIECE_BYTES, read=False):
            words, row, word, _ = counted(lowered(part.column(1)))
            lists = [[] for _ in range(part.num_rows)]
            for r, w in zip(row.tolist(), words.take(pa.array(word)).to_pylist(), strict=True):
                lists[r].append(w)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lists, pa.list_(pa.string()))], names=["item_id", "terms"])

    return texts(items, id_col, text_col).withColumnRenamed("doc_id", "item_id").select(
        F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(run, "item_id long, terms array<string>")


def search(table: DataFrame, items: DataFrame, k: int = 50, id_col: str = "item_id", text_col: str = "text",
           pass_terms: int = PASS_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of an ``index`` for each item.

    N documents have a term, L is the number of their terms.  A term in df documents weighs
    ``w = floor(1000 ln((2N + 2) / (2df + 1)))``; in a document of n terms that holds it tf times it adds
    ``w * (10**9 tf div (1000 tf + 20 m))`` with ``m = 50 + 50 n N div L``; an item's terms count once each.  Only
    scores above 0 are returned; equal ones go by the smaller identifier, null last.  A null item text, or one without
    a term, finds nothing; repeated items repeat their result; an empty index gives an empty result.

    Items go to the tasks in passes of at most ``pass_terms`` terms (or one item).
    """
    spark = table.sparkSession
    result = T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", T.LongType()), T.StructField("salt", T.LongType()),
                           T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
    documents, terms = table.agg(F.coalesce(F.sum("documents"), F.lit(0)), F.coalesce(F.sum("terms"), F.lit(0))).first()

    def one_pass(first: int, names: list, asked: list[set[str]]) -> DataFrame:
        items_ = Items(asked)
        weights = np.array([floor(1000 * log((2 * documents + 2) / (2 * df + 1))) for df in items_.holding(table).tolist()], "i8")
        carried = spark.sparkContext.broadcast((items_, weights))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items, weights = carried.value
            ranking = Ranking(items, weights, documents, terms, k)
            for batch in batches:
                for n in range(batch.num_rows):
                    ranking.meet(unpacked({name: batch.column(name)[n] for name in batch.schema.names}))
            salt = TaskContext.get().partitionId() % 64
            rows = [(first + n, names[n], salt, doc, -score) for n, best in enumerate(ranking.best) for score, _, doc in best]
            for start in range(0, len(rows), 100_000):
                columns = zip(*rows[start:start + 100_000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=result.names)

        return table.mapInArrow(run, result)

    parts, names, asked, held, number = [], [], [], 0, 0
    for r in _terms(items, id_col, text_col).toLocalIterator():
        if not r["terms"] or not documents:
            continue
        if asked and held + len(r["terms"]) > pass_terms:
            parts.append(one_pass(number, names, asked))
            number, names, asked, held = number + len(names), [], [], 0
        names.append(r["item_id"])
        asked.append(set(r["terms"]))
        held += len(r["terms"])
    if asked:
        parts.append(one_pass(number, names, asked))
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    found = reduce(DataFrame.unionByName, parts)
    best = [F.desc("score"), F.asc_nulls_last("doc_id")]
    for keys in (["item", "salt"], ["item"]):  # each task hands on k rows of an item; salted groups cut them first
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*best))).where(F.col("rank") <= k)
    return found.select("item_id", "rank", "doc_id", "score")


def stored(table: DataFrame) -> DataFrame:
    """An index in the shared folder, in row groups that are small enough to be read by any task."""
    path = scratch(table.sparkSession, "index")
    table.write.option("parquet.block.size", GROUP_BYTES).parquet(path)
    return table.sparkSession.read.schema(INDEX).parquet(path)


def ranked_search(df: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """Index the documents, durably, and search the items in it."""
    return search(stored(index(df)), items, k)
