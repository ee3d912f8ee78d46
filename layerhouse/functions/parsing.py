"""Expensive expressions, evaluated once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def fields_of(df: DataFrame, record: Column, *keep: str) -> DataFrame:
    """The fields of a struct expression (a parse, a decryption) as columns beside ``keep``.

    A generator holds the expression in place: a filter on its fields is not pushed below it, and
    each field does not repeat the whole parse, as projections of the struct would.
    """
    return df.select(*keep, F.inline(F.array(record)))


def parse_json(df: DataFrame, column: str, schema: str, *keep: str) -> DataFrame:
    """Fields of a JSON text column; unreadable text gives nulls."""
    return fields_of(df, F.from_json(column, schema), *keep)
