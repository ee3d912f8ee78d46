"""SentencePiece encoding with merge-type vocabularies, and decoding."""

from __future__ import annotations

import functools
import heapq
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, types as T

from layerhouse.llm.inputs import slices, texts

SPACE = "▁"

#: Encoded words a worker remembers: entries, and characters they may hold together.
REMEMBERED, REMEMBERED_CHARS = 400_000, 8_000_000

#: Symbols up to which a scan finds the best pair, and the score of a pair that is no piece.
FEW, NEVER = 32, float("-inf")

#: Bytes of text that are encoded and decoded at a time.
SLICE_BYTES = 1_000_000


class Merges:
    """A vocabulary's merges, applied by an agenda of adjacent symbol pairs in the order of score.

    The agenda holds every adjacent pair whose concatenation is a piece; the pair with the highest
    score (of equal scores the leftmost) is merged, which makes two new pairs with its neighbours.
    Symbols that are no piece in the end become byte pieces, or the unknown piece where the vocabulary
    has no bytes.
    """

    def __init__(self, model: str):
        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=model)
        ids = range(sp.get_piece_size())
        special = lambda i: sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)
        if any(sp.is_unused(i) for i in ids):
            raise ValueError("vocabularies with unused pieces are not supported")
        self.ids = {sp.id_to_piece(i): i for i in ids if not special(i)}
        self.scores = {piece: sp.get_score(i) for piece, i in self.ids.items()}
        self.bytes = {int(sp.id_to_piece(i)[3:5], 16): i for i in ids if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        # characters that are neighbours in no piece are never merged: texts can be cut between them
        self.neighbours = {pair for piece in self.ids for pair in zip(piece, piece[1:], strict=False)}
        self.by_word = not any(right == SPACE != left for left, right in self.neighbours)
        self.known: dict[str, str] = {}  # ids as decimals joined by a space
        self.parts: dict[str, list[int]] = {}
        self.held = 0

    def merge(self, text: str) -> list[int]:
        """The ids of a text whose spaces are already ``SPACE``."""
        symbols = self.merge_few(text) if len(text) <= FEW else self.merge_many(text)
        out: list[int] = []
        for symbol in symbols:
            found = self.ids.get(symbol)
            if found is not None:
                out.append(found)
            elif self.bytes:
                out.extend(self.bytes[byte] for byte in symbol.encode())
            else:
                out.append(self.unknown)
        return out

    def merge_few(self, text: str) -> list[str]:
        """The agenda as a list in the order of the text: finding its best pair beats keeping a heap."""
        symbols, score = list(text), self.scores.get
        agenda = [score(a + b, NEVER) for a, b in zip(symbols, symbols[1:], strict=False)]
        while agenda and (best := max(agenda)) > NEVER:
            at = agenda.index(best)  # the leftmost of equal scores
            symbols[at] += symbols.pop(at + 1)
            del agenda[at]
            if at:
                agenda[at - 1] = score(symbols[at - 1] + symbols[at], NEVER)
            if at < len(agenda):
                agenda[at] = score(symbols[at] + symbols[at + 1], NEVER)
        return symbols

    def merge_many(self, text: str) -> list[str]:
        """The agenda as a heap; a pair whose symbols have changed since is skipped when it comes up."""
        symbols, scores = list(text), self.scores
        before, after = list(range(-1, len(symbols) - 1)), [*range(1, len(symbols)), -1]
        agenda = []
        for left in range(len(symbols) - 1):
            if (score := scores.get(symbols[left] + symbols[left + 1])) is not None:
                agenda.append((-score, left, left + 1, 2))
        heapq.heapify(agenda)
        while agenda:
            _, left, right, size = heapq.heappop(agenda)
            a, b = symbols[left], symbols[right]
            if not a or not b or len(a) + len(b) != size:
                continue
            symbols[left], symbols[right] = a + b, ""
            follower, leader = after[right], before[left]
            after[left] = follower
            if follower >= 0:
                before[follower] = left
                pair = a + b + symbols[follower]
                if (score := scores.get(pair)) is not None:
                    heapq.heappush(agenda, (-score, left, follower, len(pair)))
            if leader >= 0:
                pair = symbols[leader] + a + b
                if (score := scores.get(pair)) is not None:
                    heapq.heappush(agenda, (-score, leader, left, len(pair)))
        return [symbol for symbol in symbols if symbol]

    def cut(self, text: str) -> list[str]:
        """Parts of a text that no merge joins."""
        neighbours, parts, start = self.neighbours, [], 0
        for at, pair in enumerate(zip(text, text[1:], strict=False), 1):
            if pair not in neighbours:
                parts.append(text[start:at])
                start = at
        parts.append(text[start:])
        return parts

    def words(self, text: str) -> list[str]:
        """Independent parts of a text: each begins with a ``SPACE`` that is left out here."""
        if not text:
            return []
        if not self.by_word:
            return [text.replace(" ", SPACE)]
        if SPACE not in text and "" not in (parts := text.split(" ")):
            return parts
        whole = SPACE + text.replace(" ", SPACE)
        return [part[1:] for part in re.findall(f"{SPACE}+[^{SPACE}]*", whole)]

    def learn(self, words: Iterable[str], check: bool) -> None:
        """Encode the words not known yet; with ``check`` compare each with the library."""
        new, encoded, parts = [w for w in words if w not in self.known], [], self.parts
        for word in new:
            ids: list[int] = []
            for part in self.cut(SPACE + word):
                if (own := parts.get(part)) is None:
                    own = parts[part] = self.merge(part)
                ids += own
            encoded.append(ids)
        if check:
            for word, ours, theirs in zip(new, encoded, self.library.encode(new, num_threads=1), strict=True):
                if word and ours != theirs:  # the library gives an empty text no prefix
                    raise ValueError(f"the agenda and the library disagree on {word[:80]!r}: {ours[:20]} {theirs[:20]}")
        for word, ids in zip(new, encoded, strict=True):
            self.known[word] = " ".join(map(str, ids))
            self.held += len(word)

    def encode(self, batch: list[str | None], check: bool) -> list[str]:
        """Ids of each text as decimals joined by one space."""
        parts = [self.words(t or "") for t in batch]
        met = set().union(*parts)
        self.learn(met, check)
        encoded = [" ".join(map(self.known.__getitem__, words)) for words in parts]
        if len(self.known) > REMEMBERED or self.held > REMEMBERED_CHARS:
            self.known = {w: self.known[w] for w in met if len(w) <= 64}  # what is frequent comes again
            self.held = sum(map(len, self.known))
        if 2 * len(self.parts) > REMEMBERED or sum(map(len, self.parts)) > REMEMBERED_CHARS:
            self.parts.clear()
        return encoded


@functools.lru_cache(maxsize=2)
def merges(model: str) -> Merges:
    return Merges(model)


def encode(df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text",
           end: bool = True, check: bool = True, as_text: bool = False) -> DataFrame:
    """``doc_id, n_ids, ids, decoded`` for every row: the ids of the whole text and the text they decode to.

    ``ids`` is an array of integers, or with ``as_text`` their decimals joined by one space.  A null text
    is an empty one: its ids are the end id alone (none without ``end``), decoded to an empty text.  Rows
    are independent: repeated rows repeat their result, an empty table gives an empty one, other columns
    are not read.  ``check`` compares, in every Arrow batch, each word that the worker does not remember
    with the library and fails on a difference.
    """
    df = texts(df, id_col, text_col)
    schema = T.StructType([
        df.schema["doc_id"], T.StructField("n_ids", T.LongType()),
        T.StructField("ids", T.StringType() if as_text else T.ArrayType(T.IntegerType())),
        T.StructField("decoded", T.StringType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        agenda = merges(model)
        last = [agenda.library.eos_id()] if end else []
        for part, batch in slices(batches, most=SLICE_BYTES):
            flat, lists = [], []
            for decimals in agenda.encode(batch, check):
                own = [*np.fromstring(decimals, "i4", sep=" ").tolist(), *last]
                lists.append(own)
                flat.append(" ".join([decimals, *map(str, last)] if decimals else map(str, last)) if as_text else own)
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array([len(x) for x in lists], pa.int64()),
                pa.array(flat, pa.string() if as_text else pa.list_(pa.int32())),
                pa.array(agenda.library.decode(lists, num_threads=1), pa.string()),
            ], names=schema.names)

    return df.mapInArrow(run, schema)
