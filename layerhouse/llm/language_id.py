"""Language identification by rank-order profiles of letter n-grams.

A profile ranks the most frequent n-grams (one to three characters, words framed by spaces) of a
language's documents.  A text's own most frequent n-grams are ranked alike, and a language's distance
is the sum of the places by which each n-gram is out of place in its profile; an n-gram the profile
lacks counts as the whole profile's length.  The nearest language wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T, Window

from layerhouse.llm.inputs import remainder, slices
from layerhouse.llm.near_dedup import mix

#: N-grams in a profile, of a language and of a text.
PLACES = 400

#: Bits of an n-gram's hash beside the row number in one sortable number.
GRAM_BITS = 44

UNKNOWN = "und"

#: Characters whose n-grams are counted at a time, and different (language, n-gram) pairs a task holds.
RUN_CHARS, HELD = 250_000, 500_000


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _runs(batch: list[str | None], most: int = RUN_CHARS) -> Iterator[list[tuple[int, str]]]:
    """Pieces of texts (row, piece) in runs of about ``most`` characters; a text's last piece ends with a line break.

    A long text is cut before a character that is no letter, if a piece of that size has one.
    """
    run, held = [], 0
    for row, text in enumerate(batch):
        text, at = text or "", 0
        while True:
            until = at + most
            if until < len(text):
                cut = until
                while cut > at + 1 and text[cut].isalpha():
                    cut -= 1
                until = cut if cut > at + 1 else until
            piece = text[at:until].lower()
            run.append((row, piece if until < len(text) else piece + "\n"))
            held += len(piece)
            at = until
            if held >= most:
                yield run
                run, held = [], 0
            if at >= len(text):
                break
    if run:
        yield run


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, with their summed counts."""
    if len(keys) == 1:
        return keys[0], counts[0]
    every, back = np.unique(np.concatenate(keys), return_inverse=True)
    return every, np.bincount(back, weights=np.concatenate(counts), minlength=len(every)).astype("i8")


def gram_counts(batch: list[str | None], most: int = RUN_CHARS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, n-gram and count, ordered by row and n-gram, of texts in lower case.

    Everything but letters is a space and spaces are one; an n-gram has no space inside.  The texts are one
    stream that is read in runs of ``most`` characters, and a run begins with the last two characters of the one
    before it, so the counts are those of the whole texts and memory is bounded by the run, not by a text.
    """
    # one separator stands before the first text
    tail, tail_row, tail_letter, before = np.array([32], "u8"), np.zeros(1, "i8"), np.zeros(1, bool), False
    keys, counts, held = [np.zeros(0, "u8")], [np.zeros(0, "i8")], 0
    for run in _runs(batch, most):
        points = np.frombuffer("".join(p for _, p in run).encode("utf-32-le"), "<u4")
        if not len(points):
            continue
        row = np.repeat(np.array([r for r, _ in run]), [len(p) for _, p in run])
        letter = _letters()[points]
        stays = letter.copy()
        stays[1:] |= letter[:-1]
        stays[0] |= before
        before = bool(letter[-1])
        points = np.concatenate([tail, np.where(letter, points, 32)[stays].astype("u8")])
        row, letter = np.concatenate([tail_row, row[stays]]), np.concatenate([tail_letter, letter[stays]])
        known, found = len(tail), []
        for n, ok in ((1, letter), (2, letter[:-1] | letter[1:]), (3, letter[1:-1])):
            size = len(points) - n + 1
            if size <= 0:
                continue
            ok = ok.copy()
            ok[:max(0, known - n + 1)] = False  # n-grams that end in the run before
            code = np.zeros(size, "u8")
            for k in range(n):
                code = code << np.uint64(21) | points[k:size + k]
            own = row[min(n - 1, 1):][:size]  # the second character is in the text, the one before it may be the separator
            gram = mix(code[ok], 7) >> np.uint64(64 - GRAM_BITS)
            found.append(own[ok].astype("u8") << np.uint64(GRAM_BITS) | gram)
        new = np.sort(np.concatenate(found)) if found else np.zeros(0, "u8")
        first = np.flatnonzero(np.concatenate([[True], new[1:] != new[:-1]])) if len(new) else np.zeros(0, "i8")
        keys.append(new[first])
        counts.append(np.diff(np.append(first, len(new))))
        held += len(first)
        if held > 4 * most:
            whole = _summed(keys, counts)
            keys, counts, held = [whole[0]], [whole[1]], 0
        tail, tail_row, tail_letter = points[-2:], row[-2:], letter[-2:]
    every, count = _summed(keys, counts)
    return (every >> np.uint64(GRAM_BITS)).astype("i8"), every & np.uint64((1 << GRAM_BITS) - 1), count


def ranked(row: np.ndarray, gram: np.ndarray, count: np.ndarray, places: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, n-gram and rank of each row's most frequent n-grams; equally frequent ones share their mean rank."""
    order = np.argsort((row.astype("u8") << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - count.astype("u8")), kind="stable")
    row, gram, count = row[order], gram[order], count[order]
    starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else np.zeros(0, "i8")
    sizes = np.diff(np.append(starts, len(row)))
    place = np.arange(len(row)) - np.repeat(starts, sizes)
    tie = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (count[1:] != count[:-1])])) if len(row) else starts
    width = np.diff(np.append(tie, len(row)))
    mean = np.repeat(place[tie] + (width - 1) / 2, width)
    top = place < places
    return row[top], gram[top], np.minimum(mean[top], places)


def learn_profiles(df: DataFrame, lang_col: str = "lang", text_col: str = "text",
                   places: int = PLACES) -> dict[str, np.ndarray]:
    """Per language the n-grams in the order of frequency, counted over all rows with a language and a text.

    Rows without either are not learned from.  What reaches the driver is ``places`` numbers per language.
    """
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("gram", T.LongType()),
                           T.StructField("n", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[str, int] = {}
        keys, counts = [], []

        def told() -> pa.RecordBatch:
            every, sums = _summed(keys, counts)
            names = np.array(list(number), object)[(every >> np.uint64(GRAM_BITS)).astype("i8")]
            keys.clear()
            counts.clear()
            return pa.RecordBatch.from_arrays([
                pa.array(names.tolist(), pa.string()), pa.array((every & np.uint64((1 << GRAM_BITS) - 1)).astype("i8")),
                pa.array(sums)], names=schema.names)

        for part, batch in slices(batches, "text", RUN_CHARS):
            own = np.array([number.setdefault(name, len(number)) for name in part.column(0).to_pylist()])
            row, gram, n = gram_counts(batch)
            every, back = np.unique(own[row].astype("u8") << np.uint64(GRAM_BITS) | gram, return_inverse=True)
            keys.append(every)
            counts.append(np.bincount(back, weights=n, minlength=len(every)).astype("i8") if len(every) else np.zeros(0, "i8"))
            if sum(map(len, keys)) > HELD:
                yield told()
        if keys:
            yield told()

    told = df.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    sums = told.where("lang IS NOT NULL AND text IS NOT NULL").mapInArrow(count, schema).groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    best = sums.withColumn("place", place).where(F.col("place") <= places).collect()
    profiles: dict[str, list] = {}
    for r in sorted(best, key=lambda r: (r["lang"], r["place"])):
        profiles.setdefault(r["lang"], []).append(r["gram"])
    return {lang: np.array(grams, "u8") for lang, grams in profiles.items()}


def identify(df: DataFrame, profiles: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text",
             places: int = PLACES) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row, from its whole text.

    ``score`` compares the nearest two languages, 0.5 if they are as near as each other.  A text that
    is null or has no letter, or any text where no language was learned, is ``und`` with score 0.  Of
    equally near languages the first by name wins.  Repeated rows repeat their result, an empty table
    gives an empty one, other columns are not read.  Memory does not grow with a text.
    """
    df = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([df.schema["doc_id"], T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = Nearest(profiles, places)
        for part, batch in slices(batches, "text", RUN_CHARS):
            lang, score = nearest(batch)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lang, pa.string()), pa.array(score)],
                                             names=schema.names)

    return df.mapInArrow(run, schema)


def drop_unknown(df: DataFrame, profiles: dict[str, np.ndarray], lang_col: str = "lang", text_col: str = "text",
                 places: int = PLACES) -> DataFrame:
    """The rows of ``df`` whose text has a letter, with all their columns; a null ``lang_col`` is filled.

    A text without a letter has no language, whatever was learned.  Without any profile all texts with a
    letter stay, and a null ``lang_col`` stays null.
    """
    place, schema = df.columns.index(lang_col), df.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = Nearest(profiles, places)
        for part, batch in slices(batches, text_col, RUN_CHARS):
            if profiles:
                lang, _ = nearest(batch)
                stays = [x != UNKNOWN for x in lang]
                filled = pc.coalesce(part.column(place), pa.array(lang, part.column(place).type))
                part = part.set_column(place, part.schema.field(place), filled)
            else:
                stays = [any(map(str.isalpha, t or "")) for t in batch]
            yield part.filter(pa.array(stays, pa.bool_()))

    return df.mapInArrow(run, schema)


class Nearest:
    """Language and score of texts."""

    def __init__(self, profiles: dict[str, np.ndarray], places: int):
        self.names, self.places, self.tables = sorted(profiles), places, []
        for name in self.names:
            order = np.argsort(profiles[name])
            self.tables.append((profiles[name][order], order.astype("f8")))

    def __call__(self, batch: list[str | None]) -> tuple[list[str], np.ndarray]:
        names, places = self.names, self.places
        row, gram, rank = ranked(*gram_counts(batch), places)
        total = np.bincount(row, minlength=len(batch))
        far = np.ones((len(names) + 1, len(batch)))
        for k, (grams, place) in enumerate(self.tables):
            at = np.minimum(np.searchsorted(grams, gram), len(grams) - 1)
            off = np.where(grams[at] == gram, np.abs(place[at] - rank), places)
            far[k] = np.bincount(row, weights=off, minlength=len(batch)) / (places * np.maximum(total, 1))
        known = (total > 0) & bool(names)
        best = far[:-1].argmin(axis=0) if names else np.zeros(len(batch), int)
        two = np.sort(far, axis=0)[:2]  # the last row stands for a language with none of the n-grams
        score = np.where(known, two[-1] / np.maximum(two[0] + two[-1], 1e-12), 0.0)
        return [names[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], score


def learnable(id_col: str, parts: int, held: int) -> Column:
    """Rows to learn from: not of the held-out split; a null identifier is never learned from."""
    return F.coalesce(remainder(id_col, parts) != held, F.lit(False))
