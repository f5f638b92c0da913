"""Cleaning and numbering statement lines before they are matched."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallymark.sources.layouts import Layout
from tallymark.sources.ledger import Ledger
from tallymark.sources.scratch import write_packed

# Lines of several statements in one DataFrame: which statement a line is of, and how many lines stand before that one. Line
# numbers run through all of them there.
STATEMENT, BEFORE = "_statement", "_lines_before"

# A segment needs 24 bytes, so the largest broadcast of segment offsets is 24 MB.
MAX_BROADCAST_SEGMENTS = 1_000_000


def statement_of(lines: DataFrame) -> list[str]:
    """The column that tells statements apart, where there are several: what is counted or merged, is so for each."""
    return [STATEMENT] if STATEMENT in lines.columns else []


def own_number(lines: DataFrame, row_id: str) -> Column:
    """A line's number in its own statement."""
    return F.col(row_id) - F.col(BEFORE) if BEFORE in lines.columns else F.col(row_id)


def drop_empty_key(lines: DataFrame, key: str) -> DataFrame:
    """Delete lines whose key is the empty text. A NULL key is not empty and stays."""
    return lines.filter(F.col(key).isNull() | (F.col(key) != ""))


def nonempty(key: str) -> Column:
    """Keeps lines that can match: neither NULL nor empty."""
    return F.col(key).isNotNull() & (F.col(key) != "")


def assign_row_id(
    df: DataFrame,
    row_id: str,
    *,
    segment: Sequence[str] | None = None,
    order_by: Sequence[str] | None = None,
    place: str | None = None,
) -> DataFrame:
    """Dense numbers 1..n in ``segment`` order and, inside a segment, in the order the rows are read.

    Rows that are read back from a table may come in several runs of a segment; ``place``, ascending in each, then tells the
    order of the runs, and segment and place columns are kept.

    With ``order_by`` the rows are first sorted over the cluster and the sorted partitions are the segments. No task
    sees more than its own segment: rows get their position while they are written once to the shared folder, and
    the written segments are then counted and shifted. Positions are stored, so a retried task cannot renumber.
    """
    if order_by:
        df = df.orderBy(*order_by).withColumn("_partition", F.spark_partition_id())
        segment = ["_partition"]
    assert segment, "name the segment columns or an order"
    keep = [c for c in df.columns if place or c not in segment]
    if place:
        df, segment = df.withColumn("_run", F.spark_partition_id()), [*segment, "_run"]
    written = write_packed(
        df.withColumn("_position", F.monotonically_increasing_id()).withColumn("_segment", F.xxhash64(*segment)),
        "numbered",
    )
    least = [F.min(place).alias("_least")] if place else []
    sizes = written.groupBy("_segment", *segment).agg(F.count(F.lit(1)).alias("_rows"), F.min("_position").alias("_first"), *least)
    order = [*segment[:-1], "_least"] if place else segment
    # One row per input split or partition, so this window is small whatever the rows weigh.
    before = F.sum("_rows").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    offsets = write_packed(
        sizes.select("_segment", *segment, "_first", F.coalesce(before, F.lit(0)).alias("_before")), "offsets"
    )
    check = offsets.agg(F.count("_segment").alias("segments"), F.countDistinct("_segment").alias("hashes")).first()
    on = ["_segment", *segment]
    if check["segments"] == check["hashes"] <= MAX_BROADCAST_SEGMENTS:
        offsets, on = F.broadcast(offsets.select("_segment", "_first", "_before")), ["_segment"]
    number = F.col("_position") - F.col("_first") + F.col("_before") + 1
    return written.join(offsets, on).select(*keep, number.alias(row_id))


def collate_keys(lines: DataFrame, ledger: Ledger, layout: Layout, collation: str) -> tuple[DataFrame, Ledger]:
    """Compare codes by a collation, such as ``UTF8_LCASE_RTRIM`` for a database that ignores case and trailing blanks.

    Without this codes are compared byte by byte.
    """
    keys = ("codigo_referencia", "ref_id", "codigo_unico_adq")
    a = ledger.autorizacion.withColumns({c: F.collate(c, collation) for c in keys})
    return lines.withColumn(layout.key, F.collate(layout.key, collation)), ledger.with_tables(autorizacion=a)
