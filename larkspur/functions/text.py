"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Titles in the order they are searched for (Mrs contains Mr).
TITLES = ("Mrs", "Mr", "Miss", "Master")


def title(col: Column) -> Column:
    """First title found anywhere in the text, ``Other`` when there is none."""
    out = F.lit("Other")
    for name in reversed(TITLES):
        out = F.when(F.contains(col, F.lit(name)), F.lit(name)).otherwise(out)
    return F.when(col.isNotNull(), out)


def first_token(col: Column) -> Column:
    """Text before the first blank run; null for blank text."""
    return F.nullif(F.element_at(F.split(F.trim(col), r"\s+"), 1), F.lit(""))


def first_letter(col: Column) -> Column:
    return F.substring(col, 1, 1)


def slug(col: Column) -> Column:
    """Runs of non-word characters become one underscore."""
    return F.regexp_replace(F.trim(col), r"\W+", "_")


def blank_out(col: Column, sentinel: str) -> Column:
    return F.nullif(col, F.lit(sentinel))
