"""Best-fit packing of token sequences, planned on the histogram of lengths.

Only how many pieces have each length matters to a best-fit plan, so the plan is made over counts:
its size depends on the capacity (the number of different lengths), not on the number of documents.
Pieces then take the planned places by their rank among the pieces of their length.
"""

from __future__ import annotations

import functools
import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T, Window

from layerhouse.llm.inputs import slices, texts
from layerhouse.session import written

CAPACITY = 2048

#: Encoded words a worker remembers: entries, and bytes of text they may hold together.
REMEMBERED, REMEMBERED_BYTES = 500_000, 16_000_000

#: Bytes of text that are split into words at a time.
SLICE_BYTES = 2_000_000

#: Parts the words that are encoded in one call; a control character with a token of its own.
MARK = "\x01"

#: The characters that stand for bytes: printable ones for themselves, the others from U+0100 on in order; a space parts words.
BYTE_CHARACTERS = {b: 256 + n for n, b in enumerate([*range(33), *range(127, 161), 173]) if b != 32}

#: What special tokens begin with.
SPECIAL = b"<|"

#: Bytes: 1 capital and 2 small letters, 3 punctuation that closes, 4 white space, 0 others.
CLASS = np.zeros(256, "u1")
CLASS[65:91], CLASS[97:123], CLASS[list(b".,;:!?")], CLASS[list(b" \t\n\x0b\x0c\r")] = 1, 2, 3, 4


def plainer(batch: pa.Array) -> pa.Array:
    """The texts with fewer different words and the same ids: small letters, closing punctuation apart.

    The vocabulary lower-cases its words and ends a piece where a letter meets punctuation.  A letter before
    a character beyond ASCII stays (they may compose to one character first), and so do texts that may hold
    a special token.
    """
    _, offsets, data = batch.buffers()
    offsets = np.frombuffer(offsets, "i4")[batch.offset:batch.offset + len(batch) + 1] if len(batch) else np.zeros(1, "i4")
    text = np.frombuffer(data or b"", "u1")[offsets[0]:offsets[-1]]
    if not len(text) or SPECIAL in text.tobytes():
        return batch
    after = np.append(text[1:], 32)
    after[offsets[1:-1][(offsets[1:-1] > offsets[0]) & (offsets[1:-1] < offsets[-1])] - offsets[0] - 1] = 32  # a text ends there
    kind, kind_after = CLASS[text], CLASS[after]
    text = np.where((kind == 1) & (after < 128), text + 32, text).astype("u1")
    closing = (kind == 3) & (kind_after == 4)
    cut = np.flatnonzero(closing[1:] & ((kind[:-1] == 1) | (kind[:-1] == 2)) & (kind_after[:-1] == 3)) + 1
    moved = offsets - offsets[0] + np.searchsorted(cut, offsets - offsets[0])
    return pa.Array.from_buffers(pa.string(), len(batch), [None, pa.py_buffer(moved.astype("i4").tobytes()),
                                                           pa.py_buffer(np.insert(text, cut, 32).tobytes())])


class Words:
    """Ids of white-space separated words by the library; a worker remembers the frequent ones.

    The vocabulary drops white space before its merges, so a text's ids are those of its words in order.
    A special token's text inside a word is that token, as the library reads it by default.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        one = self._ids([MARK])[0]
        self.mark = one[0] if len(one) == 1 and self._ids([f"a {MARK}\n{MARK} b"])[0].tolist().count(one[0]) == 2 else None
        whole = self._ids(["One, two.\tThree's\n 4 5"])[0]
        apart = np.concatenate(self._ids(["One,", "two.", "Three's", "4 5"]))
        if not np.array_equal(whole, apart):
            raise ValueError("this vocabulary does not drop white space; its texts cannot be encoded by words")
        # words of letters alone need no normalising and no splitting, only the merges
        self.merges = Tokenizer.from_file(path)
        self.merges.normalizer, self.merges.pre_tokenizer = normalizers.Sequence([]), pre_tokenizers.WhitespaceSplit()
        probe = ["straße", "qué", "façade", "the", "über", "ñandú"] * 3
        self.direct = True
        self.direct = [x.tolist() for x in self._many(probe, easy=True)[0]] == [
            [i for i in x.tolist() if i != self.mark] for x in self._ids([f" {MARK} ".join(probe)])]
        self.forget()

    def _ids(self, batch: list[str], easy: bool = False) -> list[np.ndarray]:
        library = self.merges if easy else self.library
        return [np.array(x.ids, "<u4") for x in library.encode_batch_fast(batch, add_special_tokens=False)]

    def _many(self, words: list[str], easy: bool = False) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of the words, one after the other, and how many each has, in parts.

        Words are joined by ``MARK``, which cuts the ids apart again; calls cost more than words.  ``easy`` words
        go to the merges as they are, in the vocabulary's characters for bytes.
        """
        if self.mark is None:
            own = self._ids(words)
            return own, [np.array([len(x) for x in own], "i8")]
        groups = [words[i:i + 500] for i in range(0, len(words), 500)]
        joined = [f" {MARK} ".join(g) for g in groups]
        if easy:
            joined = [t.lower().encode().decode("latin-1").translate(BYTE_CHARACTERS) for t in joined]
        ids, lengths = [], []
        for found, group in zip(self._ids(joined, easy), groups, strict=True):
            marks = found == self.mark
            cuts = np.flatnonzero(marks)
            if len(cuts) == len(group) - 1:
                ids.append(found[~marks])
                lengths.append(np.diff(np.concatenate([[-1], cuts, [len(found)]])) - 1)
            else:
                own = self._ids(group)
                ids += own
                lengths.append(np.array([len(x) for x in own], "i8"))
        return ids, lengths

    def _learn(self, words: list[bytes]) -> None:
        """Adds the ids of words that are not known yet, one after the other, to ``ids``."""
        easy, plain, odd = [], [], []
        for raw in words:
            word = raw.decode()
            if self.direct and self.mark is not None and word.isalpha() and max(word) < "\u0250" and "\u0130" not in word:
                easy.append(word)
            else:
                (odd if MARK in word else plain).append(word)
        ids, parts = self._many(easy, easy=True)
        more, rest = self._many(plain)
        own = self._ids(odd)
        lengths = np.concatenate([*parts, *rest, np.array([len(x) for x in own], "i8")])
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, *ids, *more, *own])
        ordered = (w.encode() for w in (*easy, *plain, *odd))
        self.known.update(zip(ordered, range(len(self.known), len(self.lengths)), strict=True))
        self.held += sum(map(len, words))

    def encode(self, batch: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each text has; null counts as empty.

        The words of the batch are dictionary-encoded: each different one is looked up once, and the ids are
        gathered by their places.
        """
        lists = pc.ascii_split_whitespace(plainer(pc.fill_null(batch, "")))
        flat = lists.flatten().dictionary_encode()
        different = flat.dictionary.cast(pa.binary()).to_pylist()
        if len(self.known) > REMEMBERED or self.held > REMEMBERED_BYTES:
            self.forget()
        if new := [w for w in different if w not in self.known]:
            self._learn(new)
        place = np.fromiter(map(self.known.__getitem__, different), "i8", len(different))[flat.indices.to_numpy()]
        size = self.lengths[place]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.repeat(self.starts[place] - ends + size, size) + np.arange(total)]
        until = np.concatenate([[0], ends])[np.cumsum(lists.value_lengths().to_numpy())] if len(batch) else ends
        return ids, np.diff(until, prepend=0)

    def forget(self) -> None:
        """Drops the remembered words; the library stays."""
        self.known: dict[bytes, int] = {b"": 0}
        self.starts, self.lengths, self.ids = np.zeros(1, "i8"), np.zeros(1, "i8"), np.zeros(0, "<u4")
        self.held = 0


@functools.lru_cache(maxsize=2)
def words(path: str) -> Words:
    return Words(path)


def tokenized(df: DataFrame, tokenizer: str, capacity: int, with_ids: bool) -> DataFrame:
    """Pieces of at most ``capacity`` ids, each with the task that made it and its rank there."""
    kind = df.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("doc_id", kind), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
        T.StructField("task", T.IntegerType()), T.StructField("own_rank", T.LongType()),
        *([T.StructField("ids", T.BinaryType())] if with_ids else []),
    ])
    end = np.zeros(1, "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, task = words(tokenizer), TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        try:
            for part, _ in slices(batches, most=SLICE_BYTES, read=False):
                ids, counts = known.encode(part.column(1))
                rows, at = [], 0
                for name, count in zip(part.column(0).to_pylist(), counts.tolist(), strict=True):
                    whole = ids[at:at + count].tobytes() + end
                    at += count
                    for piece, start in enumerate(range(0, len(whole), 4 * capacity)):
                        own = whole[start:start + 4 * capacity]
                        length = len(own) // 4
                        rows.append((name, piece, start // 4, length, zlib.crc32(own), task, seen[length], own))
                        seen[length] += 1
                columns = list(zip(*rows, strict=True))[:len(schema)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)
        finally:
            known.forget()  # the worker may serve another stage next

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return df.mapInArrow(run, schema)


class Place(NamedTuple):
    """Pieces of ``length`` with ranks from ``first`` go into ``sequences`` sequences, ``each`` into one."""

    length: int
    first: int
    each: int
    sequences: int
    sequence: int
    offset: int


def plan(histogram: Mapping[int, int], capacity: int = CAPACITY) -> list[Place]:
    """Best fit by decreasing length, over counts.

    Sequences that are filled alike are one entry (first sequence, number) under their free space.
    The pieces of a length go to the entries with the least free space that holds them, each sequence
    taking as many as fit before the next is touched, and then into new sequences.
    """
    free: dict[int, list[tuple[int, int]]] = {}
    sizes: list[int] = []  # the free spaces that have entries, in order
    places: list[Place] = []
    sequences = 0

    def add(space: int, first: int, number: int) -> None:
        if number and space:
            if space not in free:
                free[space] = []
                insort(sizes, space)
            free[space].append((first, number))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0

        def fill(space: int, first: int, number: int, length: int = length) -> None:
            """Put pieces into ``number`` sequences that have ``space`` each."""
            nonlocal left, rank
            each = space // length
            for count, many in ((min(number, left // each), each), (1, left % each)):
                if count and many and number and left >= many:
                    places.append(Place(length, rank, many, count, first, capacity - space))
                    add(space - many * length, first, count)
                    first, number, left, rank = first + count, number - count, left - count * many, rank + count * many
            add(space, first, number)

        while left:
            at = bisect_left(sizes, length)
            if at == len(sizes):
                need = -(-left // (capacity // length))
                fill(capacity, sequences, need)
                sequences += need
            else:
                space = sizes[at]
                first, number = free[space].pop()
                if not free[space]:
                    del free[space], sizes[at]
                fill(space, first, number)
    return places


def pack(df: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for every piece of every row.

    A text's ids end with id 0, so a null or empty text is one piece of length 1.  Only texts of more
    than ``capacity`` ids are cut.  ``with_ids`` adds the ids as little-endian 32-bit integers.  Rows
    that repeat an identifier are packed as documents of their own; an empty table gives an empty
    result; other columns are not read.
    """
    spark = df.sparkSession
    pieces = written(tokenized(texts(df, id_col, text_col), tokenizer, capacity, with_ids))
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = spark.createDataFrame(
        [(p.length, p.first, p.first + p.each * p.sequences, p.each, p.sequence, p.offset) for p in plan(histogram, capacity)],
        "p_length long, p_first long, p_until long, p_each long, p_sequence long, p_offset long")
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = pieces.join(starts, ["length", "task"]).withColumn("rank", F.col("first") + F.col("own_rank"))
    # the plan's rows are bounded by the capacity, whatever the number of documents
    placed = ranked.join(F.broadcast(places), (F.col("length") == F.col("p_length"))
                         & (F.col("rank") >= F.col("p_first")) & (F.col("rank") < F.col("p_until")))
    nth = F.col("rank") - F.col("p_first")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("p_sequence") + F.floor(nth / F.col("p_each"))).cast("long").alias("sequence_id"),
        (F.col("p_offset") + F.pmod(nth, F.col("p_each")) * F.col("length")).alias("offset"),
        *(["ids"] if with_ids else []),
    )
