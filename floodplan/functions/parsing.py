"""Text to number without failing on malformed text (ANSI mode stays on)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# An optionally signed whole number, or the whole part of a decimal one.
WHOLE_PART = r"^([+-]?[0-9]+)([.][0-9]*)?$"


def parse_population(text: Column) -> Column:
    """Head count: the whole part of a number, NULL for anything else."""
    return F.regexp_extract(F.trim(text), WHOLE_PART, 1).try_cast("int")


def parse_size(text: Column) -> Column:
    """Population as a double, NULL if it is no number."""
    return text.try_cast("double")


def parse_id(text: Column) -> Column:
    """A whole number, NULL for anything else."""
    return text.try_cast("bigint")
