"""Statements matched by order reference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.columns import missing, null_default
from tallymark.operators.prepare import nonempty, own_number, statement_of
from tallymark.operators.reduce import Reduced
from tallymark.plans.common import export_by_code, metric_rows
from tallymark.sources.layouts import PMC, TIER
from tallymark.sources.ledger import Ledger

# What a row of the statistics shows of the ledger.
SHOWN = [source for source in PMC.ledger_columns.values() if source not in (TIER, "ref_id")]


def reduced(lines: DataFrame, ledger: Ledger, *, shared: bool = False) -> Reduced:
    """What the ledger holds for these lines. ``shared``: for several outputs, which all read one written table of it."""
    return Reduced(lines, ledger, PMC, write_shown=shared)


def export(lines: DataFrame, ledger: Ledger, found: Reduced | None = None) -> DataFrame:
    """Every line with a key: one row per authorization reference it matches, or one row with empty ledger columns."""
    number = own_number(lines, PMC.line_id)
    return export_by_code(lines, found or reduced(lines, ledger), number, number)


def export_merchant_id(lines: DataFrame, ledger: Ledger, found: Reduced | None = None) -> DataFrame:
    """As :func:`export`, with the merchant's id in the id column, so that identical file lines become one row.

    All other columns follow from the file's columns, so the lines are collapsed before they are matched. A line
    without a merchant keeps its row, with an empty id.
    """
    found = found or reduced(lines, ledger)
    lines = lines.groupBy(*statement_of(lines), *PMC.columns).agg(F.min(PMC.line_id).alias(PMC.line_id))
    return export_by_code(lines, found, null_default(F.col("comercio_id")), F.lit(""))


def statistics(lines: DataFrame, ledger: Ledger, found: Reduced | None = None) -> DataFrame:
    """Lines in, lines declared as output, export rows without a state, and true export rows.

    The log counts rows without a state after equal rows were merged, and its rows do not show the group's reference:
    groups of a code that differ in their reference alone are one row there. Lines never merge, as they show their number.
    Both sides are counted per code before they meet, so a hot code is one row on each side of the join.
    """
    found = found or reduced(lines, ledger)
    merged = found.shown.groupBy(*SHOWN).agg(F.count(F.lit(1)).alias("groups"))
    groups = merged.groupBy(F.col(PMC.ledger_key).alias("_code")).agg(
        F.sum("groups").alias("groups"), F.count_if(missing(F.col("nombre_estado"))).alias("stateless")
    )
    keyed = nonempty("_key")

    def rows_of(groups_per_line: str) -> Column:
        return F.sum(F.when(keyed, F.col("_lines") * F.coalesce(F.col(groups_per_line), F.lit(1))))

    totals = found.profile.rows.join(groups, keyed & (F.col("_key") == F.col("_code")), "left").groupBy(*statement_of(lines)).agg(
        F.sum("_lines").alias("input"),
        F.sum("_lines").alias("output_declared"),
        rows_of("stateless").alias("not_found"),
        rows_of("groups").alias("output_rows"),
    )
    return metric_rows(totals, ["input", "output_declared", "not_found", "output_rows"])
