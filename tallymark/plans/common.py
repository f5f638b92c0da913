"""What the pipelines share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.columns import CORE, null_default
from tallymark.operators.match import match_lines, unmatched_lines
from tallymark.operators.prepare import statement_of
from tallymark.operators.reduce import Reduced
from tallymark.sources.layouts import TIER, Layout

# Labels of the statistics log, in its order.
INPUT_LABEL = "Input: "
OUTPUT_LABEL = "Output: "
NOT_FOUND_LABEL = "No Encontrados: "

# metric -> label in the log; the true number of export rows has no line there.
METRICS = {
    "input": INPUT_LABEL,
    "output_declared": OUTPUT_LABEL,
    "not_found": NOT_FOUND_LABEL,
    "output_rows": None,
}


def file_columns(layout: Layout) -> list[Column]:
    """The file's columns, with the text some of them show for NULL."""
    defaults = dict(layout.defaults)
    return [null_default(F.col(c), defaults[c]).alias(c) if c in defaults else F.col(c) for c in layout.columns]


def ledger_texts(layout: Layout) -> list[Column]:
    """The ledger's columns as export texts, empty where NULL."""
    return [null_default(F.col(source)).alias(header) for header, source in layout.ledger_columns.items()]


def padding(layout: Layout, *, tier: str = "") -> list[Column]:
    """Ledger columns of a line without authorization: empty texts, except for the tier where the layout has one."""
    return [F.lit(tier if header == TIER else "").alias(header) for header in layout.ledger_columns]


def export_by_code(lines: DataFrame, found: Reduced, line_id: Column, missing_id: Column) -> DataFrame:
    """Export of the layouts that match by code alone: matched lines, one row per group, and then the others.

    Two arms instead of one outer join: adaptive execution can split a hot code of an inner join on both sides, of
    an outer join only on one. Both arms read the same shuffle of the lines.
    """
    layout, of = found.layout, statement_of(lines)
    matched = match_lines(lines, found.shown, layout).select(
        *of, *file_columns(layout), line_id.alias(layout.line_id), *ledger_texts(layout)
    )
    others = unmatched_lines(lines, found.codes, layout).select(
        *of, *file_columns(layout), missing_id.alias(layout.line_id), *padding(layout, tier=CORE)
    )
    return matched.unionByName(others)


def metric_rows(totals: DataFrame, metrics: list[str]) -> DataFrame:
    """Turn one row of totals, or one for each statement, into the log's rows (metric, label, value)."""
    rows = F.array(
        *(
            F.struct(
                F.lit(m).alias("metric"),
                F.lit(METRICS[m]).cast("string").alias("label"),
                F.coalesce(F.col(m), F.lit(0)).cast("bigint").alias("value"),
            )
            for m in metrics
        )
    )
    of = statement_of(totals)
    return totals.select(*of, F.explode(rows).alias("row")).select(*of, "row.*")
