"""Nearest neighbours by a block matrix join with int8 tiles and error bounds.

Vectors are packed in blocks, each with its unit vectors rounded to int8 under a scale of their own and the
length of what the rounding left.  Query tiles of bounded size go to the tasks that hold the candidates.  A tile
product of int8 values gives every cosine up to a proven error: ``|<x, y> - <x', y'>| <= |x - x'| |y| + |x'| |y - y'|``.
The k-th largest lower bound of a block and the k-th best found so far both are thresholds; pairs whose upper
bound falls short of one are excluded, the others are computed from the original doubles and merged by heaps,
first in the task, then over the tasks.  Nothing is capped, so the result is exact.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T, Window

from layerhouse.llm.whitening import one_width, usable
from layerhouse.session import written

#: Rows and bytes of doubles of a block, and bytes of the query tiles of one round, which one broadcast carries.
BLOCK_ROWS, BLOCK_BYTES, ROUND_BYTES = 4096, 4_000_000, 64_000_000

#: Queries that meet a block in one product, and dimensions whose int8 products a float sums exactly.
QUERIES, EXACT_DIMENSIONS = 256, 1024

#: Covers the rounding of the bounds themselves.
SLACK = 1e-9


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 values, their scale, and the length of the difference, of each row."""
    scale = np.abs(unit).max(axis=1) / 127
    values = np.rint(unit / scale[:, None]).astype("i1")
    return values, scale, np.sqrt(((unit - values * scale[:, None]) ** 2).sum(axis=1))


def units(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors, and each row's own length; extreme entries neither overflow nor vanish."""
    most = np.abs(vectors).max(axis=1, keepdims=True)
    small = vectors / most
    length = np.sqrt((small * small).sum(axis=1, keepdims=True))
    return small / length, (length * most)[:, 0]


def cosines(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Row by row, in doubles, summed in the order of the dimensions; scaled by powers of two, which round nothing."""
    dot, a_square, b_square = np.zeros((3, len(one)))
    a_power, b_power = (np.frexp(np.abs(x).max(axis=1))[1] for x in (one, other))
    for d in range(one.shape[1]):
        a, b = np.ldexp(one[:, d], -a_power), np.ldexp(other[:, d], -b_power)
        dot += a * b
        a_square += a * a
        b_square += b * b
    return dot / (np.sqrt(a_square) * np.sqrt(b_square))


def _first_copies(vectors: np.ndarray, ids: list, most: int) -> np.ndarray:
    """Whether a row is among the ``most`` first, by identifier, of the block's rows with the same vector."""
    order = np.lexsort((np.arange(len(ids)), [0 if i is None else i for i in ids], [i is None for i in ids]))
    _, group = np.unique((vectors[order] + 0.0).view(f"V{8 * vectors.shape[1]}").ravel(), return_inverse=True)
    place = np.argsort(group, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], np.diff(group[place]) > 0]))
    nth = np.arange(len(ids)) - np.repeat(starts, np.diff(np.append(starts, len(ids))))
    out = np.empty(len(ids), bool)
    out[order[place]] = nth < most
    return out


BLOCK = "block long, ids array<long>, query array<boolean>, candidate array<boolean>, vectors binary"


def blocks(df: DataFrame, is_query: Column, id_col: str, vec_col: str, k: int) -> DataFrame:
    """Rows packed task by task; ``candidate`` keeps ``k + 1`` of the equal vectors of a block, which no result can exceed."""
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.coalesce(is_query, F.lit(False)).alias("query"),
                     F.col(vec_col).cast("array<double>").alias("v"))
    rows = rows.where(usable(F.col("v"))).where(F.exists("v", lambda c: c != 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, asked, held, number = [], [], [], TaskContext.get().partitionId() << 32

        def told() -> pa.RecordBatch:
            nonlocal number
            vectors = np.concatenate(held)
            columns = [[number], [list(ids)], [list(asked)], [_first_copies(vectors, ids, k + 1).tolist()], [vectors.tobytes()]]
            number += 1
            for x in (ids, asked, held):
                x.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (
                pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.bool_()), pa.binary()), strict=True)],
                names=["block", "ids", "query", "candidate", "vectors"])

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                width = len(batch.column(2)[at])
                room = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * width))) - len(ids)
                part = batch.slice(at, room)
                ids += part.column(0).to_pylist()
                asked += part.column(1).to_pylist()
                held.append(part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1).copy())
                at += part.num_rows
                if part.num_rows == room:
                    yield told()
        if ids:
            yield told()

    # checked in the JVM, because a block is one array
    one_width(rows, "v")
    return rows.mapInArrow(run, BLOCK)


def _queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The queries of each block as a tile of their own."""
    for batch in batches:
        for block, ids, asked, vectors in zip(*(batch.column(n).to_pylist() for n in ("block", "ids", "query", "vectors")), strict=True):
            places = np.flatnonzero(asked)
            if len(places):
                table = np.frombuffer(vectors).reshape(len(ids), -1)[places]
                yield pa.RecordBatch.from_arrays([
                    pa.array([block]), pa.array([places.tolist()], pa.list_(pa.int64())),
                    pa.array([[ids[p] for p in places]], pa.list_(pa.int64())), pa.array([table.tobytes()], pa.binary()),
                    pa.array([table.nbytes])], names=["block", "places", "ids", "vectors", "size"])


class Tile:
    """Queries with their heaps."""

    def __init__(self, rows: list, k: int):
        self.k = k
        self.block = np.concatenate([np.full(len(r["ids"]), r["block"]) for r in rows])
        self.place = np.concatenate([np.array(r["places"]) for r in rows])
        self.ids = [i for r in rows for i in r["ids"]]
        self.vectors = np.concatenate([np.frombuffer(r["vectors"]).reshape(len(r["ids"]), -1) for r in rows])
        values, self.scale, self.rest = quantised(units(self.vectors)[0])
        self.values = values.astype("f4")
        self.heaps: list[list] = [[] for _ in self.ids]
        self.least = np.full(len(self.ids), -np.inf)

    def meet(self, block: int, ids: list, candidate: np.ndarray, vectors: np.ndarray) -> None:
        """Join with the candidates of a block."""
        places = np.flatnonzero(candidate)
        own = vectors[places]
        values, scale, rest = quantised(units(own)[0])
        columns = values.astype("f4").T.copy()
        for first in range(0, len(self.ids), QUERIES):
            part = slice(first, min(len(self.ids), first + QUERIES))
            product = np.zeros((part.stop - first, len(places)))
            for d in range(0, len(columns), EXACT_DIMENSIONS):
                product += self.values[part, d:d + EXACT_DIMENSIONS] @ columns[d:d + EXACT_DIMENSIONS]
            product *= self.scale[part, None] * scale
            margin = self.rest[part, None] + (1 + self.rest[part, None]) * rest + SLACK
            itself = np.flatnonzero(self.block[part] == block)
            mine = np.searchsorted(places, self.place[part][itself])
            mine_ok = (mine < len(places)) & (places[np.minimum(mine, len(places) - 1)] == self.place[part][itself])
            product[itself[mine_ok], mine[mine_ok]] = -np.inf
            least = self.least[part]
            if len(places) > self.k:
                lower = product - margin
                least = np.maximum(least, np.partition(lower, len(places) - self.k, axis=1)[:, len(places) - self.k])
            q, c = np.nonzero((product + margin >= least[:, None]) & (product > -np.inf))
            for start in range(0, len(q), 65_536):
                a, b = q[start:start + 65_536] + first, c[start:start + 65_536]
                self._merge(a, cosines(self.vectors[a], own[b]), block, places[b], ids)

    def _merge(self, query: np.ndarray, score: np.ndarray, block: int, places: np.ndarray, ids: list) -> None:
        near = score >= self.least[query]
        for q, s, p in zip(query[near].tolist(), score[near].tolist(), places[near].tolist(), strict=True):
            name, heap = ids[p], self.heaps[q]
            item = (s, float("-inf") if name is None else -name, -block, -p, name)
            if len(heap) < self.k:
                heapq.heappush(heap, item)
            else:
                heapq.heappushpop(heap, item)
            if len(heap) == self.k:
                self.least[q] = heap[0][0]

    def found(self) -> Iterator[tuple]:
        for q, heap in enumerate(self.heaps):
            for score, _, block, place, name in heap:
                yield int(self.block[q]), int(self.place[q]), self.ids[q], name, score, -block, -place


FOUND = "q_block long, q_place long, query_id long, vec_id long, score double, c_block long, c_place long"


def nearest(df: DataFrame, is_query: Column | None = None, k: int = 5, id_col: str = "vec_id",
            vec_col: str = "embedding", round_bytes: int = ROUND_BYTES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows with the largest cosine to each query row, without itself.

    Queries are the rows where ``is_query`` holds (by default, identifiers divisible by 50).  Fewer candidates
    give fewer rows; equal cosines go by the smaller identifier, null last.  Vectors that are null, empty, zero or
    hold null or non-finite entries take no part; vectors of different lengths are an error.  Repeated
    identifiers are rows of their own: each is a query, and each may be found.  An empty table gives an empty
    result, other columns are not read.  Queries go to the tasks in rounds of at most ``round_bytes`` (or one block).
    """
    spark = df.sparkSession
    asked = F.col(id_col) % 50 == 0 if is_query is None else is_query
    table = written(blocks(df, asked, id_col, vec_col, k))
    tiles = written(table.select("block", "ids", "query", "vectors").mapInArrow(
        _queries, "block long, places array<long>, ids array<long>, vectors binary, size long"))
    rounds: list[list[int]] = []  # first and last block, bytes; a few bytes per block pass the driver, one after the other
    for r in tiles.select("block", "size").orderBy("block").toLocalIterator():
        if rounds and rounds[-1][2] + r["size"] <= round_bytes:
            rounds[-1][1:] = r["block"], rounds[-1][2] + r["size"]
        else:
            rounds.append([r["block"], r["block"], r["size"]])

    def searched(least: int, most: int) -> DataFrame:
        carried = spark.sparkContext.broadcast([
            r.asDict() for r in tiles.where(F.col("block").between(least, most)).orderBy("block").collect()])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tile = None
            for batch in batches:
                for block, ids, candidate, vectors in zip(*(batch.column(n).to_pylist() for n in ("block", "ids", "candidate", "vectors")), strict=True):
                    tile = tile or Tile(carried.value, k)
                    tile.meet(block, ids, np.array(candidate), np.frombuffer(vectors).reshape(len(ids), -1))
            rows = list(tile.found()) if tile else []
            if rows:
                kinds = (pa.int64(),) * 4 + (pa.float64(),) + (pa.int64(),) * 2
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                                                 names=[part.split()[0] for part in FOUND.split(", ")])

        return table.select("block", "ids", "candidate", "vectors").mapInArrow(run, FOUND)

    parts = [searched(least, most) for least, most, _ in rounds]
    found = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], FOUND)
    order = Window.partitionBy("q_block", "q_place").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "c_block", "c_place")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
