"""What the operators share: the columns they read, and text handled in bounded slices."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Characters that part words, as one string (fixed values): space, tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"

#: Characters of text that one slice of an Arrow batch may hold; a longer text is a slice by itself.
SLICE_CHARS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only identifier and text, as ``doc_id`` and ``text``: other columns cannot clash."""
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def without_blanks(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def remainder(id_col: str, parts: int) -> Column:
    """The split of the contracts: crc32 of the identifier as text, modulo ``parts``."""
    return F.crc32(F.col(id_col).cast("string")) % parts


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           most: int = SLICE_CHARS, read: bool = True) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Runs of rows with their texts (unless not ``read``), at most ``most`` bytes of text each (or one row)."""
    for batch in batches:
        place = batch.schema.get_field_index(column)
        lengths = pc.fill_null(pc.binary_length(batch.column(place)), 0).to_pylist()
        start = held = 0
        for row, size in enumerate(lengths):
            if row > start and held + size > most:
                part = batch.slice(start, row - start)
                yield part, part.column(place).to_pylist() if read else []
                start, held = row, 0
            held += size
        if batch.num_rows > start:
            part = batch.slice(start)
            yield part, part.column(place).to_pylist() if read else []


def record(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for f in schema if (c := columns[f.name]) is not None],
        schema=schema,
    )
