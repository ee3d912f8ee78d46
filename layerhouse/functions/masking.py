"""Masking and validation of personal data; invalid values become null, never pass through."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The phone and e-mail patterns that decide which values are valid.
PHONE = r"^(13[0-9]|14[01456879]|15[0-35-9]|16[2567]|17[0-8]|18[0-9]|19[0-35-9])\d{8}$"
EMAIL = r"^[a-zA-Z0-9_-]+@[a-zA-Z0-9_-]+(\.[a-zA-Z0-9_-]+)+$"


def valid_phone(value: Column) -> Column:
    return F.when(value.rlike(PHONE), value)


def valid_email(value: Column) -> Column:
    return F.when(value.rlike(EMAIL), value)


def mask_name(value: Column) -> Column:
    """First character and a star."""
    return F.concat(F.substring(value, 1, 1), F.lit("*"))


def mask_phone(value: Column) -> Column:
    return F.concat(F.substring(valid_phone(value), 1, 3), F.lit("*"))


def mask_email(value: Column) -> Column:
    return F.concat(F.lit("*@"), F.get(F.split(valid_email(value), "@"), F.lit(1)))


def hashed_phone(value: Column) -> Column:
    return F.md5(valid_phone(value))


def hashed_email(value: Column) -> Column:
    return F.md5(valid_email(value))
