"""Reading statement files: routing by name and delimited text with a fixed schema."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.operators.prepare import assign_row_id, drop_empty_key
from tallymark.sources import records
from tallymark.sources.layouts import LAYOUTS, Layout
from tallymark.sources.records import BLOCK, FILE, PLACE
from tallymark.sources.scratch import outside_run, run_scratch, write_packed

UNKNOWN_LAYOUT = "none"
SPLIT = (FILE, BLOCK)  # one input split of one file; the order of splits is the order of the file
FILE_BYTES = 1024


class BrokenStatement(ValueError):
    """A statement whose lines cannot be told apart."""


def route_layout(file_name: Column) -> Column:
    """Name of the layout a file belongs to; the first word found wins."""
    upper = F.upper(file_name)
    route = F
    for layout in LAYOUTS:
        route = route.when(upper.contains(layout.name), layout.name)
    return route.otherwise(UNKNOWN_LAYOUT)


def read_statement(
    spark: SparkSession,
    paths: str | Sequence[str],
    layout: Layout,
    *,
    charset: str = "ISO-8859-1",
    quote: str = '"',
    escape: str = "\\",
    multi_line: bool = False,
    null_tokens: Sequence[str] = ("\\N",),
) -> DataFrame:
    """Statement lines with the layout's text columns by position, plus the split each line came from.

    An empty or missing field is an empty text, as a bulk load into text columns leaves it; only ``null_tokens`` are NULL.
    The reader accepts LF and CRLF ends for every layout. Surplus fields are dropped. ``multi_line`` allows line
    ends inside quotes, but then a file cannot be split, so it is off unless asked for.
    """
    raw = (
        spark.read.schema(layout.schema)
        .option("sep", layout.delimiter)
        .option("header", True)
        .option("enforceSchema", True)
        .option("encoding", charset)
        .option("quote", quote)
        .option("escape", escape)
        .option("mode", "PERMISSIVE")
        .option("multiLine", multi_line)
        .csv(paths)
    )

    split = F.col("_metadata.file_path").alias(SPLIT[0]), F.col("_metadata.file_block_start").alias(SPLIT[1])
    return _texts(raw, layout, lambda c: F.col(c), null_tokens, *split)


def _texts(rows: DataFrame, layout: Layout, field: Callable[[str], Column], null_tokens: Sequence[str], *more: Column | str) -> DataFrame:
    """The layout's columns, and ``more``; an empty or missing field is an empty text, and a null token is NULL.

    In two steps: one expression of both for each of so many columns is a method that Java does not compile.
    """
    rows = rows.select(*(F.coalesce(field(c), F.lit("")).alias(c) for c in layout.columns), *more)
    if not null_tokens:
        return rows
    others = [c for c in rows.columns if c not in layout.columns]
    return rows.select(*(F.when(~F.col(c).isin(*null_tokens), F.col(c)).alias(c) for c in layout.columns), *others)


def broken_lines(spark: SparkSession, paths: str | Sequence[str], *, quote: str = '"', escape: str = "\\") -> int:
    """Lines with an odd number of quotes: a quoted value with a line end in it was cut there. Such a file needs ``multi_line``."""
    plain = F.replace("value", F.lit(escape + quote), F.lit(""))
    quotes = F.length(plain) - F.length(F.replace(plain, F.lit(quote), F.lit("")))
    return spark.read.text(paths).where(quotes % 2 == 1).count()


@dataclass(frozen=True)
class Staged:
    """A statement in the shared folder: its numbered lines, and what could not be read as its layout says.

    ``rejected`` has ``file, byte_offset, reason, loaded, record``. Records with too few or too many fields are loaded, filled up or
    cut; a line with a quote that is never closed is not.
    """

    lines: DataFrame
    rejected: DataFrame
    rejected_count: int


REJECTED = "file string, byte_offset long, reason string, loaded boolean, record string"


def stage(
    spark: SparkSession,
    paths: str | Sequence[str],
    layout: Layout,
    *,
    keep_blank_lines: bool = True,
    strict: bool = False,
    charset: str = "ISO-8859-1",
    quote: str = '"',
    escape: str = "\\",
    multi_line: bool = False,
    null_tokens: Sequence[str] = ("\\N",),
    keep_file: bool = False,
) -> Staged:
    """Clean and number the records of one or more files, and write them to the shared folder: the input of the pipelines.

    Files are read by all tasks, also where quoted values hold line ends. Blank lines are rows of empty texts in their place, as
    a bulk load makes them. ``strict`` refuses a file in which a line's end is inside quotes, unless ``multi_line`` allows that.
    In a character set whose lines cannot be cut as bytes, ``multi_line`` lets one task read each file. ``keep_file`` keeps the
    path of each line's file, in character sets whose lines can be cut; numbers run through all files, one file after the other.
    """
    reading = {"charset": charset, "quote": quote, "escape": escape}
    if strict and not multi_line and (broken := broken_lines(spark, paths, quote=quote, escape=escape)):
        raise BrokenStatement(f"{broken} lines of {paths} have an open quote; read it with multi_line")
    if not records.can_cut(charset, quote, layout.delimiter):
        lines = read_statement(spark, paths, layout, multi_line=multi_line, null_tokens=null_tokens, **reading)
        lines = drop_empty_key(lines, layout.key) if layout.drop_empty_key else lines
        return Staged(assign_row_id(lines, layout.line_id, segment=SPLIT), spark.createDataFrame([], REJECTED), 0)
    of = [FILE] if keep_file else []
    # The lines as they were read, several times as large as what is made of them, go as soon as that is written.
    with run_scratch(spark) as passing:
        lines = records.physical_lines(spark, paths, delimiter=layout.delimiter, **reading)
        parts = write_packed(records.splits(lines), "splits")
        total = parts.agg(F.sum("_opens").alias("opens"), F.countDistinct(FILE).alias("files")).first()
        # The first line of each file is its header, whatever it holds.
        header = parts.groupBy(FILE).agg(F.min_by("_first", BLOCK).alias(PLACE))
        few = total["files"] * FILE_BYTES <= records.MERGED_BYTES
        body, lost, small = records.merged(lines) if total["opens"] else (lines, None, True)
        body = body.join(F.broadcast(header) if few else header, [FILE, PLACE], "left_anti")
        if not keep_blank_lines:
            body = body.filter("_text <> ''")
        if not (few and small):
            body = body.repartition(*SPLIT)  # these joins left no split together
        body = body.sortWithinPartitions(PLACE)  # the order of the files; a table's parts need not be read in theirs
        with outside_run(passing):
            numbered = _numbered(body, layout, quote, escape, null_tokens)
        wrong = numbered.filter("_fields").select(FILE, BLOCK, PLACE, "_record")
        rejected, count = spark.createDataFrame([], REJECTED), 0
        if lost is not None or not wrong.isEmpty():
            told = _rejected(lines, wrong, lost)
            with outside_run(passing):
                rejected = write_packed(told, "rejected")
            count = rejected.count()
    return Staged(numbered.select(*of, *layout.columns, layout.line_id), rejected, count)


def _numbered(body: DataFrame, layout: Layout, quote: str, escape: str, null_tokens: Sequence[str]) -> DataFrame:
    """Records parsed, numbered in the order of their files, and written; ``_fields`` marks another number of fields, with the ``_record``."""
    schema = ", ".join([*(f"`{c}` string" for c in layout.columns), "_wrong string"])
    options = {"sep": layout.delimiter, "quote": quote, "escape": escape, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_wrong"}
    parsed = body.withColumn("_csv", F.from_csv("_text", schema, options))
    wrong = F.col("_csv._wrong").isNotNull()
    more = FILE, BLOCK, PLACE, wrong.alias("_fields"), F.when(wrong, F.col("_text")).alias("_record")
    rows = _texts(parsed, layout, lambda c: F.col("_csv").getField(c), null_tokens, *more)
    if layout.drop_empty_key:
        rows = drop_empty_key(rows, layout.key)
    return assign_row_id(rows, layout.line_id, segment=SPLIT, place=PLACE)


def _rejected(lines: DataFrame, wrong: DataFrame, lost: DataFrame | None) -> DataFrame:
    """Where in its file each record begins that has another number of fields, or no end."""
    at = records.offsets_of(lines, wrong).withColumnsRenamed({FILE: "_of", PLACE: "_at"})
    placed = wrong.join(at, (F.col(FILE) == F.col("_of")) & (F.col(PLACE) == F.col("_at")))
    told = placed.select(FILE, "_offset", F.lit("fields").alias("reason"), F.lit(True).alias("loaded"), "_record")
    if lost is not None:
        told = told.unionByName(lost.select(FILE, "_offset", F.lit("open quote").alias("reason"), F.lit(False).alias("loaded"), F.col("_text").alias("_record")))
    return told.withColumnsRenamed({FILE: "file", "_offset": "byte_offset", "_record": "record"})


def stage_statement(spark: SparkSession, paths: str | Sequence[str], layout: Layout, **options) -> DataFrame:
    """The lines of :func:`stage`."""
    return stage(spark, paths, layout, **options).lines
