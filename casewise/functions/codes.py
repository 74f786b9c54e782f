"""Coded values."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def decode(code: Column, table: dict[str, str]) -> Column:
    """Label of a code; null for a null or unknown code, never a wrong label."""
    return F.create_map(*map(F.lit, chain.from_iterable(table.items())))[code]


def code_flag(code: Column) -> Column:
    """Three-valued flag: true for code 1, false for any other, null for null."""
    return code == "1"
