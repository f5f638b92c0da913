"""What a statement asks of the ledger: its codes with their numbers of lines, and its days."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.functions.columns import text_date
from tallymark.operators.prepare import nonempty, statement_of
from tallymark.sources.layouts import Layout
from tallymark.sources.scratch import write_packed

ROW_BYTES = 32
MAX_DAY_RANGES = 32


@dataclass(frozen=True)
class Profile:
    """The narrow part of a statement, a written table: whatever is asked about its codes, days and counts is read here, and
    the lines themselves are read once.

    Layouts matched by code: ``_key`` and its number of ``_lines``. The day-matched layout: a row for each line, with its number
    ``_line``, ``_key``, ``_day``, acquirer id ``_id``, and 1 in ``_lines``; there, keys hardly repeat. Rows of several statements
    together also say which one they are of.
    """

    rows: DataFrame
    lines: int
    codes: int  # no fewer than there are different codes (and days)
    code_bytes: int
    days: tuple[tuple[str, str], ...] | None = None  # first and last of each range of days

    @property
    def keyed(self) -> DataFrame:
        """The rows that can match."""
        return self.rows.filter(nonempty("_key"))

    @property
    def by(self) -> list[str]:
        """Columns that lines are matched by."""
        return ["_key"] if self.days is None else ["_key", "_day"]

    @property
    def keys(self) -> DataFrame:
        """What lines are matched by; the empty code is one, NULL is none. ``code_bytes`` is the size of it as it is, with what repeats."""
        return self.rows.select(*self.by).dropna()


def profile(lines: DataFrame, layout: Layout) -> Profile:
    """Read the key columns of a statement once. A hot code is one row for each map task before it is shuffled."""
    key, of = F.col(layout.key).alias("_key"), statement_of(lines)
    if layout.day:
        narrow = [F.col(layout.line_id).alias("_line"), key, text_date(F.col(layout.day)).alias("_day"), F.col(layout.duplicate).alias("_id")]
        rows = lines.select(*of, *narrow, F.lit(1).cast("long").alias("_lines"))
    else:
        rows = lines.groupBy(*of, key).agg(F.count(F.lit(1)).alias("_lines"))
    rows = write_packed(rows, "profile")
    size = F.sum(F.octet_length("_key") + ROW_BYTES)
    total = rows.agg(F.sum("_lines").alias("lines"), F.count("_key").alias("codes"), size.alias("bytes")).first()
    days = day_ranges(rows.filter(nonempty("_key"))) if layout.day else None
    return Profile(rows, total["lines"] or 0, total["codes"], total["bytes"] or 0, days)


def day_ranges(rows: DataFrame, most: int = MAX_DAY_RANGES) -> tuple[tuple[str, str], ...]:
    """The days of a statement as at most ``most`` ranges: all days, cut at the widest gaps between them.

    Days that are few are so each a range of their own, and a single wrong date far away opens no more than itself. Different
    days are as few as the calendar has, so one task can look at them in order.
    """
    days = rows.select("_day").where("_day is not null").distinct()
    ordered = Window.orderBy("_day")
    # The row behind the last day, without a day of its own, tells where the last range ends.
    places = days.select("_day", F.lag("_day").over(ordered).alias("_before"), F.lead("_day").over(ordered).alias("_next"))
    gap = F.coalesce(F.datediff("_day", "_before"), F.lit(1 << 30)).alias("_gap")
    ends = places.select("_day", "_before", gap).where("_gap > 1").orderBy(F.desc("_gap"), "_day").limit(most)
    last = places.where("_next is null").select(F.lit(None).cast("date").alias("_day"), F.col("_day").alias("_before"), F.lit(0).alias("_gap"))
    text = [F.col(c).cast("string").alias(c) for c in ("_day", "_before")]
    cuts = sorted(ends.unionByName(last).select(*text).collect(), key=lambda r: (r["_day"] is None, r["_day"]))
    return tuple((cut["_day"], end["_before"]) for cut, end in zip(cuts, cuts[1:]))


def within_days(made: Column, days: tuple[tuple[str, str], ...]) -> Column:
    """Condition on a stored time, as ranges that a scan can skip files by."""
    condition = F.lit(False)
    for first, last in days:
        condition = condition | ((made >= F.lit(first).cast("date")) & (made < F.date_add(F.lit(last).cast("date"), 1)))
    return condition
