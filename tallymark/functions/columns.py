"""Scalar expressions of the pipelines."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of the product tiers.
EVOLUTION = "t0 (Evolution)"
LEDGER = "Ledger"
CORE = "T+n (Core)"


def product_tier(migrated: Column, flagged: Column) -> Column:
    """Tier of a merchant: migrated first, then flagged, else core. NULL counts as false."""
    return F.when(migrated, EVOLUTION).when(flagged, LEDGER).otherwise(CORE)


def null_default(column: Column, default: str = "") -> Column:
    """Text of a value, or ``default`` where it is NULL."""
    return F.coalesce(column.cast("string"), F.lit(default))


# How a day may be spelled in a statement: with or without leading zeros, by hyphens, by slashes, or without either.
DAY_PATTERNS = ("yyyy-M-d", "yyyy/M/d", "yyyyMMdd")


def text_date(column: Column, patterns: Sequence[str] = DAY_PATTERNS) -> Column:
    """Day in the first ten characters of a text, up to a blank; NULL, not an error, where they are no date."""
    day = F.substring_index(F.substring(column, 1, 10), " ", 1)
    return F.coalesce(*(F.try_to_date(day, pattern) for pattern in patterns))


def missing(column: Column) -> Column:
    """NULL or empty."""
    return column.isNull() | (column == "")


def format_line(columns: Iterable[Column], separator: str = ",") -> Column:
    """One text line: every value in double quotes, none escaped. A NULL value makes the line NULL."""
    quoted = [F.concat(F.lit('"'), c.cast("string"), F.lit('"')) for c in columns]
    parts = [quoted[0]]
    for c in quoted[1:]:
        parts += [F.lit(separator), c]
    return F.concat(*parts)
