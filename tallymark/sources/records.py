"""Records of delimited text files, cut by all tasks together: a quoted value may hold line ends, wherever a file is split.

Every split reads its physical lines. What a line does to the reader's state, inside a quoted value or not, is a function of
two states, and such functions are combined: inside a split by windows, over splits by one row for each. So every line
learns the state it starts in without any task having read what stands before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymark.sources.scratch import write_packed

FILE, BLOCK, PLACE = "_file", "_block", "_place"  # a line's file, where its split starts, and its place in the scan
MAX_RECORD_BYTES = 1 << 20
MAX_PATH_BYTES = 4096
TURN = "\x01"  # stands for a quote behind a delimiter
MERGED_BYTES = 64 << 20  # records of several lines: up to here they are broadcast to their places
# Character sets that Spark decodes; in each of them a line end is one byte.
CHARSETS = {"ISO-8859-1", "UTF-8", "US-ASCII"}


def can_cut(charset: str, quote: str, delimiter: str) -> bool:
    """Whether lines can be cut before they are decoded."""
    return charset.upper() in CHARSETS and len(quote) == len(delimiter) == 1


def physical_lines(spark: SparkSession, paths: str | Sequence[str], *, charset: str, delimiter: str, quote: str, escape: str) -> DataFrame:
    """All lines of the files, written once: file, split, place, text without its line end, bytes with it, and two states.

    ``_outside`` and ``_inside`` say whether a reader that starts the line outside or inside a quoted value is inside one at its
    end. LF and CRLF end a line.
    """
    raw = spark.read.option("lineSep", "\n").text(paths)
    value = F.col("value").cast("binary")
    text = F.decode(value, charset.upper())
    read = raw.select(
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(PLACE),
        F.when(F.contains(text, F.lit("\r")), F.regexp_replace(text, "\r$", "")).otherwise(text).alias("_text"),
        (F.octet_length(value) + 1).cast("long").alias("_bytes"),
    )
    read = read.withColumn("_plain", _plain(F.col("_text"), quote, escape))
    states = (_state_after(F.col("_plain"), state, delimiter, quote).alias(name) for name, state in (("_outside", False), ("_inside", True)))
    told = read.select("*", *states).drop("_plain")
    return write_packed(told, "physical-lines")


def _plain(text: Column, quote: str, escape: str) -> Column:
    """The text without escaped quotes."""
    plain = F.replace(text, F.lit(escape * 2), F.lit("")) if escape != quote else text
    plain = F.replace(plain, F.lit(escape + quote), F.lit(""))
    plain = F.when(F.contains(text, F.lit(escape)), plain).otherwise(text)
    return F.when(F.contains(text, F.lit(TURN)), F.replace(plain, F.lit(TURN), F.lit(" "))).otherwise(plain)


def _state_after(plain: Column, inside: bool, delimiter: str, quote: str) -> Column:
    """A quote opens a value at its first character, and the next quote closes it; anywhere else a quote is a character.

    So a quote behind a delimiter turns the state round, and any other leaves it outside: only the quotes behind delimiters that
    follow the last other one count. No step depends on the number of fields, and mostly the line's last quote decides.
    """
    line, behind = F.concat(F.lit(delimiter), plain), F.lit(delimiter + quote)
    other_last = ~F.endswith(line, F.concat(behind, F.substring_index(plain, quote, -1)))
    told = F.replace(line, behind, F.lit(TURN))
    last = F.substring_index(told, quote, -1)
    odd = (F.octet_length(last) - F.octet_length(F.replace(last, F.lit(TURN), F.lit("")))) % 2 == 1
    changed = odd != (F.lit(inside) & ~F.contains(told, F.lit(quote)))
    return F.when(~F.contains(plain, F.lit(quote)), F.lit(inside)).when(other_last, F.lit(False)).otherwise(changed)


def _after(rows: DataFrame, window: Window) -> DataFrame:
    """``_from_outside`` and ``_from_inside``: the state after each row and all before it in the window, from either start.

    The last row that ends in one state whatever it starts in decides, and every row since that only turns the state round.
    """
    turned = rows.withColumn("_turned", F.sum((F.col("_outside") & ~F.col("_inside")).cast("int")).over(window))
    fixed = F.when(F.col("_outside") == F.col("_inside"), F.struct(F.col("_outside").cast("int").alias("state"), "_turned"))
    known = turned.withColumn("_last", F.last(fixed, ignorenulls=True).over(window))
    for name, start in (("_from_outside", 0), ("_from_inside", 1)):
        since = F.coalesce(F.col("_last.state") + F.col("_turned") - F.col("_last._turned"), F.col("_turned") + start)
        known = known.withColumn(name, since % 2 == 1)
    return known.drop("_turned", "_last")


def splits(lines: DataFrame) -> DataFrame:
    """One row for each split: its first place, its lines and bytes, and how many of its lines leave a value open."""
    opens = F.count_if(F.col("_outside")).alias("_opens")
    return lines.groupBy(FILE, BLOCK).agg(F.min(PLACE).alias("_first"), F.count("*").alias("_lines"), F.sum("_bytes").alias("_size"), opens)


def located(lines: DataFrame) -> DataFrame:
    """``_file, _block, _place, _bytes`` of all lines with ``_offset``, their first byte in the file, whether they ``_start`` a record,
    and ``_record``, the offset of the record's first line; ``_ends``: no value is open behind the line."""
    inside = Window.partitionBy(FILE, BLOCK).orderBy(PLACE)
    after = _after(lines.select(FILE, BLOCK, PLACE, "_bytes", "_outside", "_inside"), inside).withColumn("_upto", F.sum("_bytes").over(inside))
    after = write_packed(after, "line-states")
    whole = after.groupBy(FILE, BLOCK).agg(F.max_by(F.struct("_from_outside", "_from_inside", "_upto"), PLACE).alias("s"))
    whole = whole.select(FILE, BLOCK, F.col("s._from_outside").alias("_outside"), F.col("s._from_inside").alias("_inside"), F.col("s._upto").alias("_size"))
    # One row for each split of a file, in order.
    over = Window.partitionBy(FILE).orderBy(BLOCK)
    states = _after(whole, over).select(
        FILE, BLOCK,
        F.coalesce(F.lag("_from_outside").over(over), F.lit(False)).alias("_open"),
        (F.sum("_size").over(over) - F.col("_size")).alias("_begin"),
    )
    told = after.join(states, [FILE, BLOCK])
    state = F.when(F.col("_open"), F.col("_from_inside")).otherwise(F.col("_from_outside"))
    before = F.coalesce(F.lag("_state").over(inside), F.col("_open"))
    told = told.withColumn("_state", state).withColumn("_start", ~before).withColumn("_offset", F.col("_begin") + F.col("_upto") - F.col("_bytes"))
    starts = F.when(F.col("_start"), F.col("_offset"))
    told = told.withColumn("_own", F.last(starts, ignorenulls=True).over(inside))
    last = told.groupBy(FILE, BLOCK).agg(F.max(starts).alias("_latest"))
    carried = last.select(FILE, BLOCK, F.last("_latest", ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, -1)).alias("_carried"))
    told = told.join(carried, [FILE, BLOCK])
    return told.select(FILE, BLOCK, PLACE, "_bytes", "_offset", "_start", F.coalesce("_own", "_carried").alias("_record"), (~F.col("_state")).alias("_ends"))


def merged(lines: DataFrame, max_bytes: int | None = None) -> tuple[DataFrame, DataFrame, bool]:
    """Records instead of lines, lines that no record could be made of, and whether all lines of a task stayed in it.

    The first line of a record takes the text of all its lines, with LF between them, and the others go. A record whose value is
    never closed, or that is longer than ``max_bytes``, is none: of its lines, those that leave a value open by themselves are
    rejected, and the others are records of their own. So one stray quote does not swallow a file.
    """
    max_bytes = MAX_RECORD_BYTES if max_bytes is None else max_bytes
    places = located(lines)
    several = write_packed(places.filter(~(F.col("_start") & F.col("_ends"))), "record-lines")
    records = several.groupBy(FILE, "_record").agg(F.sum("_bytes").alias("_size"), F.max_by("_ends", "_offset").alias("_closed"))
    good = records.filter(F.col("_closed") & (F.col("_size") <= max_bytes)).select(FILE, "_record")
    told = several.join(good.withColumn("_good", F.lit(True)), [FILE, "_record"], "left").select(FILE, PLACE, "_record", "_offset", "_start", "_bytes", F.coalesce("_good", F.lit(False)).alias("_good"))
    told = write_packed(told, "record-parts")
    small = (told.agg(F.sum("_bytes")).first()[0] or 0) <= MERGED_BYTES
    hint = F.broadcast if small else (lambda df: df)
    parts = lines.select(FILE, PLACE, "_text").join(hint(told.filter("_good")), [FILE, PLACE])
    whole = parts.groupBy(FILE, "_record").agg(F.array_sort(F.collect_list(F.struct("_offset", "_text"))).alias("_parts"), F.min_by(PLACE, "_offset").alias(PLACE))
    whole = write_packed(whole.select(FILE, PLACE, F.array_join(F.col("_parts._text"), "\n").alias("_whole")), "records")
    rest = told.filter("not (_good and _start)").select(FILE, PLACE, "_good", "_offset")
    joined = lines.join(hint(whole), [FILE, PLACE], "left").join(hint(rest), [FILE, PLACE], "left")
    # Not started by themselves, and not lines that a record could not be made of.
    kept = joined.filter("_good is null or (not _good and not _outside)").withColumn("_text", F.coalesce("_whole", "_text"))
    lost = joined.filter("not _good and _outside").select(FILE, F.col("_offset"), "_text")
    return kept.drop("_whole", "_good", "_offset"), lost, small


def offsets_of(lines: DataFrame, some: DataFrame) -> DataFrame:
    """``_file, _place, _offset`` of some lines, from the lengths of those before them; only their splits are read again."""
    before = splits(lines).withColumn("_begin", F.sum("_size").over(Window.partitionBy(FILE).orderBy(BLOCK)) - F.col("_size"))
    begins = before.join(some.select(FILE, BLOCK).distinct(), [FILE, BLOCK]).select(FILE, BLOCK, "_begin")
    inside = Window.partitionBy(FILE, BLOCK).orderBy(PLACE)
    places = lines.select(FILE, BLOCK, PLACE, "_bytes").join(begins, [FILE, BLOCK])
    placed = places.withColumn("_offset", F.col("_begin") + F.sum("_bytes").over(inside) - F.col("_bytes"))
    return placed.join(some.select(FILE, PLACE), [FILE, PLACE]).select(FILE, PLACE, "_offset")
