"""Terminal statements matched by the acquirer's code."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions.columns import missing
from tallymark.operators.grouping import distinct_keys
from tallymark.operators.lookup import narrow_ledger, with_all_transactions, with_links, with_states
from tallymark.operators.prepare import nonempty, own_number, statement_of
from tallymark.operators.reduce import Reduced
from tallymark.plans.common import METRICS, export_by_code, metric_rows
from tallymark.sources.layouts import MPOS
from tallymark.sources.ledger import Ledger

GROUP = ["codigo_referencia", "ref_id", "codigo_unico_adq"]


def reduced(lines: DataFrame, ledger: Ledger, *, shared: bool = False) -> Reduced:
    """What the ledger holds for these lines. ``shared``: for several outputs, which all read one written table of it."""
    return Reduced(lines, ledger, MPOS, empty_codes=True, write_matching=shared)


def export(lines: DataFrame, ledger: Ledger, found: Reduced | None = None) -> DataFrame:
    """Every line with a key: one row per authorization group it matches, or one row with empty ledger columns."""
    number = own_number(lines, MPOS.line_id)
    return export_by_code(lines, found or reduced(lines, ledger), number, number)


def not_found(found: Reduced) -> DataFrame:
    """Joined rows without a state, per authorization group; all lines without an authorization are one group.

    A row counts if its line has a key and its state is NULL, or if its state is the empty text, whatever the key.
    Joined rows are not built: lines are counted per code, and the merchant's acquirer links are a factor.
    """
    authorizations, ledger = narrow_ledger(found.source, found.matching) if found.small else (found.matching, found.source)
    states = with_states(with_all_transactions(authorizations, ledger), ledger)
    state = F.col("nombre_estado")
    linked = with_links(states.filter(missing(state)), ledger)
    groups = linked.groupBy(*GROUP).agg(
        F.sum(F.when(state.isNull(), F.col("_links")).otherwise(0)).alias("_null"),
        F.sum(F.when(state == "", F.col("_links")).otherwise(0)).alias("_empty"),
    )
    counts = found.profile.rows
    of = statement_of(counts)
    per_row = F.col("_empty") + F.when(nonempty("_key"), F.col("_null")).otherwise(0)
    matched = counts.join(groups, F.col("_key") == F.col(MPOS.ledger_key)).select(
        *of, *GROUP, (F.col("_lines") * per_row).alias("value")
    )
    codes = distinct_keys(authorizations.filter(nonempty(MPOS.ledger_key)), [MPOS.ledger_key], "id")
    without = found.profile.keyed.join(codes, F.col("_key") == F.col(MPOS.ledger_key), "left_anti").select(*of, F.col("_lines").alias("value"))
    rows = matched.filter("value > 0").unionByName(without, allowMissingColumns=True)
    return rows.groupBy(*of, *GROUP).agg(F.sum("value").alias("value"))


def statistics(lines: DataFrame, ledger: Ledger, found: Reduced | None = None) -> DataFrame:
    """Lines in, lines declared as output, and one not-found row per group; no such row if everything was found."""
    found = found or reduced(lines, ledger)
    of = statement_of(lines)
    totals = found.profile.rows.groupBy(*of).agg(F.sum("_lines").alias("input")).withColumn("output_declared", F.col("input"))
    groups = not_found(found).select(
        *of, F.lit("not_found").alias("metric"), F.lit(METRICS["not_found"]).alias("label"), "value"
    )
    return metric_rows(totals, ["input", "output_declared"]).unionByName(groups)
