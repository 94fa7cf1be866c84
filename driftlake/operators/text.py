"""Cleaning and converting of text columns: what can't be converted is null, never an error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the pattern of a whole e-mail address.
EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"


def email_valid(c: Column) -> Column:
    """Whether the whole text is one address; null for null."""
    return c.rlike(EMAIL)


def clean(c: Column) -> Column:
    """Trimmed, with single spaces, null if nothing is left."""
    return F.nullif(F.trim(F.regexp_replace(c, r"\s+", " ")), F.lit(""))


def part(c: Column, sep: str, n: int) -> Column:
    """The n-th part between separators, from the end for a negative n; '' beyond."""
    return F.split_part(c, F.lit(sep), F.lit(n))


def to_time(c: Column, formats: Sequence[str]) -> Column:
    """The time that the text is by the first format that fits."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats]).cast("timestamp_ntz")


def to_number(c: Column, precision: int = 18, scale: int = 2) -> Column:
    """The number that the text is, also with thousands' commas, a currency sign, or in brackets for below zero."""
    bare = F.regexp_replace(F.trim(c), r"[$,]", "")
    number = lambda x: x.try_cast(f"decimal({precision},{scale})")
    return F.when(bare.rlike(r"^\(.*\)$"), -number(F.regexp_replace(bare, r"[()]", ""))).otherwise(number(bare))
