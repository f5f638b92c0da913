"""Writing exports and statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from tallymark.functions.columns import format_line
from tallymark.sources.scratch import shuffles_removed

ORDER = ["input", "output_declared", "not_found"]  # metrics as the log has them
PACKING = {"zlib.compress.level": "THREE"}  # half the time of the usual level, for files a sixth larger


# Names of the outputs.
def export_name(file_name: str) -> str:
    return f"OUT_{file_name}"


def statistics_name(file_name: str) -> str:
    return f"EST_{file_name}.log"


def rejected_name(file_name: str) -> str:
    return f"REJ_{file_name}"


def write_rejected(rejected: DataFrame, path: str, *, mode: str = "overwrite", by: Sequence[str] = ()) -> None:
    """Records that are not as their layout says, as JSON lines, since they may hold line ends and quotes."""
    with shuffles_removed(rejected.sparkSession):
        _writer(rejected, mode, by).json(path)


def _writer(rows: DataFrame, mode: str, by: Sequence[str]) -> DataFrameWriter:
    """``by`` names columns with a folder for each value. Rows of one value come together, and adaptive execution cuts what is
    too large for one task, so folders have few parts and no task a whole large one."""
    return rows.hint("rebalance", *by).write.mode(mode).partitionBy(*by) if by else rows.write.mode(mode)


def write_export(
    export: DataFrame, path: str, *, charset: str = "UTF-8", mode: str = "overwrite", by: Sequence[str] = (), compression: str | None = None
) -> None:
    """Quoted CSV with a header, one part per task. Quotes inside a value are doubled, NULL is an empty text.

    ``compression`` (``gzip``) packs each part, whose name then says so, and which one task reads.
    """
    writer = (
        _writer(export, mode, by)
        .option("header", True)
        .option("quoteAll", True)
        .option("escape", '"')
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("encoding", charset)
        .options(compression=compression or "none", **PACKING)
    )
    with shuffles_removed(export.sparkSession):
        writer.csv(path)


def write_lines(export: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """The same rows as bare quoted lines, unescaped and without a header; a row with a NULL in it is the line ``NULL``."""
    line = F.coalesce(format_line([F.col(c) for c in export.columns]), F.lit("NULL"))
    export.select(line.alias("value")).write.mode(mode).text(path)


def write_statistics(statistics: DataFrame, path: str, *, mode: str = "overwrite", by: Sequence[str] = ()) -> None:
    """The labelled lines of the log, label and count separated by a tab."""
    rows = statistics.filter(F.col("label").isNotNull())
    line = F.concat_ws("\t", "label", F.col("value").cast("string")).alias("value")
    if by:
        # The lines of one log are few, and in the order of the log's own.
        rows = rows.repartition(*by).sortWithinPartitions(*by, F.array_position(F.lit(ORDER), F.col("metric")), F.desc("value"))
        writer = rows.select(*by, line).write.mode(mode).partitionBy(*by)
    else:
        writer = rows.select(line).write.mode(mode)
    with shuffles_removed(rows.sparkSession):
        writer.text(path)
