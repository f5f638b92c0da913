"""Web-shop statements matched by the acquirer's code and the day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.functions.columns import null_default
from tallymark.operators import code_filter, match
from tallymark.operators.lookup import eligible_authorizations, with_signatures
from tallymark.operators.prepare import own_number, statement_of
from tallymark.operators.reduce import LINE_BYTES, Reduced
from tallymark.plans.common import file_columns, ledger_texts, metric_rows
from tallymark.sources.layouts import MERCHANT_ID_V4, TRANSACCIONES
from tallymark.sources.ledger import Ledger
from tallymark.sources.scratch import write_packed

LINE_ID = TRANSACCIONES.line_id
SHOWN_BYTES = 512


def reduced(lines: DataFrame, ledger: Ledger, *, shared: bool = False) -> Reduced:
    """What the ledger holds for these lines. ``shared``: for several outputs, which all read one written table of it."""
    return Reduced(lines, ledger, TRANSACCIONES, eligible=eligible_authorizations, extra=with_signatures, write_shown=shared)


def joined_lines(lines: DataFrame, found: Reduced, *, keep_duplicates: bool = False) -> DataFrame:
    """Lines that match, of each code and acquirer id the first, with what the ledger shows for them; and lines that do not match, with NULLs.

    Which lines stay is settled on narrow rows, and wide lines are fetched last. If the narrow rows of a statement and what is
    shown fit a broadcast, lines are read once and not shuffled at all. Else they are filtered by number, with the numbers
    broadcast, or a bit for each, or shuffled by it if both are too large, and only those that match and stay go on to the join
    with the ledger. The ledger side has one row per code and day, so it cannot multiply lines.
    """
    of = statement_of(lines)
    matched = found.matched.select(*of, "_line", "_key", "_day", "_id")
    shown = found.shown.withColumnRenamed("id", "_authorization_id")
    if found.few_lines and found.shown.count() * SHOWN_BYTES <= match.MAX_BROADCAST_BYTES:
        first = F.min("_line").over(Window.partitionBy(*of, "_key", "_id"))
        settled = matched.select("_line", F.col("_key").alias("_code"), F.col("_day").alias("_on"), (F.lit(keep_duplicates) | (F.col("_line") == first)).alias("_stays"))
        told = lines.join(F.broadcast(settled), F.col(LINE_ID) == F.col("_line"), "left").filter("_stays is null or _stays")
        return told.join(F.broadcast(shown), (F.col("_code") == F.col("codigo_unico_adq")) & (F.col("_on") == F.col("auth_day")), "left")
    if found.few_lines or not found.write_shown:
        matched = write_packed(matched, "matched-lines")
    few = matched.count() * LINE_BYTES <= match.MAX_BROADCAST_BYTES

    def numbered(rows: DataFrame, how: str) -> DataFrame:
        numbers = rows.select("_line")
        return lines.join(F.broadcast(numbers) if few else numbers, F.col(LINE_ID) == F.col("_line"), how)

    # A hot code and id is one row per map task before it is shuffled.
    stay = matched if keep_duplicates else matched.groupBy(*of, "_key", "_id").agg(F.min("_line").alias("_line"))
    if not few:
        sets = [write_packed(code_filter.number_set(rows.select("_line")), "line-set") for rows in (matched, stay)]
        if sum(numbers.count() for numbers in sets) * code_filter.BLOCK_BYTES <= match.MAX_BROADCAST_BYTES:
            told = code_filter.with_membership(lines, F.col(LINE_ID), sets[0], "_matches")
            told = code_filter.with_membership(told, F.col(LINE_ID), sets[1], "_stays")
            winners = told.filter("_stays").join(shown, match.same_code_and_day(TRANSACCIONES))
            return winners.unionByName(told.filter("not _matches"), allowMissingColumns=True)
    winners = numbered(stay, "left_semi").join(shown, match.same_code_and_day(TRANSACCIONES))
    return winners.unionByName(numbered(matched, "left_anti"), allowMissingColumns=True)


def _export(lines: DataFrame, ledger: Ledger, found: Reduced | None, keep_duplicates: bool, *more: Column) -> DataFrame:
    # Lines are settled by the codes and days of what is shown, so that is written even for one output.
    rows = joined_lines(lines, found or reduced(lines, ledger, shared=True), keep_duplicates=keep_duplicates)
    # Here a line without a match has no tier either: its ledger columns are all NULL.
    number = own_number(lines, LINE_ID).alias(LINE_ID)
    return rows.select(*statement_of(lines), *file_columns(TRANSACCIONES), *more, number, *ledger_texts(TRANSACCIONES))


def export(lines: DataFrame, ledger: Ledger, found: Reduced | None = None, *, keep_duplicates: bool = False) -> DataFrame:
    """Matched lines, one per code and acquirer id, and all lines without a match, with empty ledger columns and no tier.

    With ``keep_duplicates`` no matched line is dropped.
    """
    return _export(lines, ledger, found, keep_duplicates)


def export_merchant_id(lines: DataFrame, ledger: Ledger, found: Reduced | None = None, *, keep_duplicates: bool = False) -> DataFrame:
    """As :func:`export`, with the merchant's id in a column of its own beside the line number."""
    return _export(lines, ledger, found, keep_duplicates, null_default(F.col("comercio_id")).alias(MERCHANT_ID_V4))


def statistics(lines: DataFrame, ledger: Ledger, found: Reduced | None = None) -> DataFrame:
    """Lines in, lines declared as output, lines without a match, and true export rows.

    Only the narrow rows of the lines are read; matched ones are groups of code and acquirer id, and the rest follows
    by subtraction.
    """
    found = found or reduced(lines, ledger)
    of = statement_of(lines)
    groups = found.matched.groupBy(*of, "_key", "_id").agg(F.sum("_lines").alias("lines"))
    total, matched = F.lit(found.profile.lines), F.coalesce(F.sum("lines"), F.lit(0))
    if of:
        # A row for each statement that tells its lines, since one without a match is in no group.
        counted = found.profile.rows.groupBy(*of).agg(F.sum("_lines").alias("total"))
        groups = groups.unionByName(counted, allowMissingColumns=True)
        total, rows = F.max("total"), F.count("lines")
    else:
        rows = F.count(F.lit(1))
    totals = groups.groupBy(*of).agg(
        total.alias("input"), total.alias("output_declared"), (total - matched).alias("not_found"), (total - matched + rows).alias("output_rows")
    )
    return metric_rows(totals, ["input", "output_declared", "not_found", "output_rows"])
