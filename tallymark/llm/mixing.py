"""Mixing sources to target weights by entropy balancing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymark.llm.common import BLANKS, on_key, row_key, table
from tallymark.sources.scratch import write_through

MOST_COPIES = 2
GROUP_ROWS = 50_000  # documents of one source and size that one task numbers
MAX_STEPS = 80
REPAIRS = 8
EXACT = "decimal(38,6)"  # sums of these do not depend on the order of their terms, so reruns agree


def token_size(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(BLANKS.replace("[", "[^") + "+")).cast("long")


def source_targets(sized: DataFrame, weights: Sequence[int], share: float) -> DataFrame:
    """One row per source: ``rank, source, source_size, mean_size, target``.

    Sources by code point, NULL last, take ``weights`` in turn. They share ``share`` times all sizes by weight; none gets
    more than twice its size, and what is over goes to the others by weight. In order of cap per weight the capped sources
    come first, so the level of the others follows from running sums over one row per source.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.avg("size").alias("mean_size"))
    ranked = sources.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    capped = ranked.withColumn("weight", weight.cast("double")).withColumn("cap", (MOST_COPIES * F.col("source_size")).cast("double"))
    everything = Window.partitionBy()
    tighter = Window.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    filled = capped.withColumns(
        {
            "total": F.sum("source_size").over(everything) * F.lit(share),
            "given": F.coalesce(F.sum("cap").over(tighter), F.lit(0.0)),
            "weights_left": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(tighter), F.lit(0.0)),
        }
    )
    level = (F.col("total") - F.col("given")) / F.col("weights_left")
    # The first source whose cap is above the level sets it for all that follow; before it every source is at its cap.
    open_level = F.min(F.when(F.col("cap") > level * F.col("weight"), F.struct(F.col("cap") / F.col("weight"), "rank", level.alias("level")))).over(everything)
    target = F.when(open_level.isNull(), F.col("cap")).otherwise(F.least("cap", open_level["level"] * F.col("weight")))
    return filled.select("rank", "source", "source_size", "mean_size", target.alias("target"))


def tilted_rates(groups: DataFrame, sources: DataFrame) -> DataFrame:
    """``sources`` with ``tilt``: rates 2 / (1 + exp(-tilt * size / mean size)) meet each source's target.

    This is the solution of entropy balancing with rates between 0 and 2 around 1; its dual is convex, with one unknown
    per source. Each step sums value and slope of the dual's gradient over ``groups`` (rank, size, rows), and takes a
    Newton step, or halves the bracket if that step would leave it. A target of zero or of the cap needs no tilt: ``fixed``
    is its rate.
    """
    fixed = F.when(F.col("target") >= MOST_COPIES * F.col("source_size"), F.lit(float(MOST_COPIES))).when(F.col("target") <= 0, F.lit(0.0))
    state = write_through(
        sources.withColumns(
            {"fixed": fixed, "tilt": F.lit(0.0), "low": F.lit(None).cast("double"), "high": F.lit(None).cast("double"), "done": fixed.isNotNull()}
        ),
        "mix-state",
    )
    for _ in range(MAX_STEPS):
        if state.where("not done").isEmpty():
            return state
        z = F.col("size") / F.col("mean_size")
        tokens = F.col("rows") * F.col("size") * rate()
        sums = (
            groups.join(state.where("not done"), "rank")
            .groupBy("rank")
            .agg(F.sum(tokens.cast(EXACT)).alias("tokens"), F.sum((tokens * z * (1 - rate() / MOST_COPIES)).cast(EXACT)).alias("slope"))
        )
        error = F.col("tokens").cast("double") - F.col("target")
        moved = state.join(sums, "rank", "left").withColumn("error", error)
        moved = moved.withColumns(
            {"low": F.when(F.col("error") < 0, F.col("tilt")).otherwise(F.col("low")), "high": F.when(F.col("error") > 0, F.col("tilt")).otherwise(F.col("high"))}
        )
        newton = F.col("tilt") - F.col("error") / F.nullif(F.col("slope").cast("double"), F.lit(0.0))
        low = F.coalesce("low", F.col("high") - 2 * F.abs("high") - 1)
        high = F.coalesce("high", F.col("low") + 2 * F.abs("low") + 1)
        step = F.when((newton > low) & (newton < high), newton).otherwise((low + high) / 2)
        settled = F.coalesce(F.col("done") | (F.abs("error") <= 0.25) | F.col("error").isNull(), F.lit(True))
        state = write_through(
            moved.select(*sources.columns, "fixed", F.when(settled, F.col("tilt")).otherwise(step).alias("tilt"), "low", "high", settled.alias("done")),
            "mix-state",
        )
    if not state.where("not done").isEmpty():
        raise RuntimeError(f"rates did not settle within {MAX_STEPS} steps")
    return state


def rate() -> Column:
    """Of a document of ``size`` in a source with ``tilt`` or ``fixed``."""
    return F.coalesce(F.col("fixed"), MOST_COPIES / (1 + F.exp(-F.col("tilt") * F.col("size") / F.col("mean_size"))))


def rounded(groups: DataFrame, sources: DataFrame) -> DataFrame:
    """``groups`` (rank, size, rows) with ``copies`` of each document and the number of documents, ``extra``, that get one more.

    Fractions are carried from size to size, so they are lost at most once per source. What is still missing or over is
    then given to, or taken from, the largest sizes that fit; each such pass at least halves the difference.
    """
    source = Window.partitionBy("rank")
    carried = source.orderBy("size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    down = source.orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = F.col("rows") * F.floor(F.round(rate(), 9))
    df = groups.where("size > 0").join(sources, "rank").withColumn("whole", whole)
    df = df.withColumn("part", (F.col("rows") * F.round(rate(), 9) - F.col("whole")).cast(EXACT)).withColumn("upto", F.sum("part").over(carried))
    extra = F.floor(F.col("upto") + 0.5) - F.floor(F.col("upto") - F.col("part") + 0.5)
    df = df.withColumn("total", F.greatest(F.lit(0), F.least(F.col("whole") + extra, MOST_COPIES * F.col("rows"))).cast("long"))
    for _ in range(REPAIRS):
        taken = F.sum(F.col("total") * F.col("size")).over(source)
        df = df.withColumn("missing", F.round(F.col("target")).cast("long") - taken)
        room = F.when(F.col("missing") > 0, MOST_COPIES * F.col("rows") - F.col("total")).otherwise(F.col("total"))
        df = df.withColumn("fits", F.when(F.col("size") <= F.abs("missing"), room).otherwise(0).cast("long"))
        before = F.coalesce(F.sum(F.col("fits") * F.col("size")).over(down), F.lit(0))
        number = F.greatest(F.lit(0), F.least(F.floor((F.abs("missing") - before) / F.col("size")), F.col("fits"))).cast("long")
        df = df.withColumn("total", F.col("total") + F.signum("missing").cast("long") * number)
    return df.select("rank", "size", F.floor(F.col("total") / F.col("rows")).alias("copies"), (F.col("total") % F.col("rows")).alias("extra"))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """How often each row of ``docs`` is taken: ``doc_id, hash`` (of the text), ``size, source_size, target, copies, taken``.

    Sources get their targets from ``weights`` and ``share`` (see ``source_targets``); within a source rates are tilted by
    size (``tilted_rates``) and rounded into 0, 1 or 2 copies (``rounded``). Which of several documents of one source and
    size get the odd copies is decided by a hash of the id and the text, so reruns agree.

    NULL and empty texts have size 0 and no copies. A NULL source is one source, the last. Rows that repeat an id and a text
    are separate documents. An empty table gives no rows; other columns are not read.

    Rows of a hot source or size are counted before any shuffle; those of one source and size are numbered in parts of at
    most about ``GROUP_ROWS``. Tables of sources and of (source, size) are small and written.
    """
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(source_col).alias("source"))
    sized = write_through(
        named.select("doc_id", F.xxhash64("text").alias("hash"), "source", token_size(F.col("text")).alias("size")), "mix-sizes"
    )
    sources = write_through(source_targets(sized, weights, share), "mix-sources")
    counts = sized.groupBy("source", "size").agg(F.count("*").alias("rows"))
    groups = write_through(
        counts.join(sources, on_key(counts, sources, "source")).select("rank", counts["source"], "size", "rows"), "mix-groups"
    )
    state = tilted_rates(groups.select("rank", "size", "rows"), sources)
    plan = rounded(groups.select("rank", "size", "rows"), state)
    parts = groups.join(plan, ["rank", "size"], "left").select(
        "rank", "source", "size", F.coalesce("copies", F.lit(0)).alias("copies"), F.coalesce("extra", F.lit(0)).alias("extra"),
        F.ceil(F.col("rows") / GROUP_ROWS).cast("int").alias("parts"),
    )
    parts = write_through(parts.join(state.select("rank", "source_size", "target"), "rank"), "mix-plan")
    order = F.xxhash64("doc_id", "hash")
    dealt = (
        sized.join(parts.withColumnRenamed("source", "of").withColumnRenamed("size", "long"), sized["source"].eqNullSafe(F.col("of")) & (sized["size"] == F.col("long")))
        .drop("of", "long")
        .withColumn("order", order)
        .withColumn("part", F.pmod("order", F.col("parts")).cast("int"))
    )
    dealt = write_through(dealt, "mix-dealt")
    filled = dealt.groupBy("rank", "size", "part").agg(F.count("*").alias("rows"))
    before = F.coalesce(F.sum("rows").over(Window.partitionBy("rank", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = filled.select("rank", "size", "part", before.alias("before"))
    place = F.row_number().over(Window.partitionBy("rank", "size", "part").orderBy("order", "doc_id", "hash"))
    copies = F.col("copies") + (F.col("before") + F.col("place") <= F.col("extra")).cast("long")
    return (
        dealt.withColumn("place", place)
        .join(offsets, ["rank", "size", "part"])
        .select(
            "doc_id", "hash", "size", "source_size", "target", copies.cast("int").alias("copies"), (copies * F.col("size")).alias("taken")
        )
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as ``mix`` takes it, with the columns of ``docs``.

    Rows that repeat an id and a text share the copies that ``mix`` takes of them evenly: they are numbered by ``numbered``,
    and the first of them take one more where the number does not divide. All others take theirs in one join.
    """
    key = row_key(options.get("id_col", "doc_id"), options.get("text_col", "text"))
    rows = docs.select(F.struct("*").alias("_doc"), *(column.alias(name) for name, column in key.items()))
    share = mix(docs, **options).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"), F.col("hash").alias("_hash"), "copies")
    shares = share.groupBy("_id", "_hash").agg(F.sum("copies").alias("_taken"), F.count("*").alias("_rows")).where("_taken > 0")
    shares = write_through(shares, "mix-shares")
    single = rows.join(shares.where("_rows = 1"), ["_id", "_hash"]).withColumn("_copies", F.col("_taken"))
    repeated = numbered(write_through(rows.join(shares.where("_rows > 1"), ["_id", "_hash"]).withColumn("_row", F.monotonically_increasing_id()), "mix-repeated"))
    evenly = F.floor(F.col("_taken") / F.col("_rows")) + (F.col("_number") <= F.col("_taken") % F.col("_rows")).cast("long")
    kept = single.select("_doc", "_copies").unionByName(repeated.select("_doc", evenly.alias("_copies"))).where("_copies > 0")
    return kept.select("_doc", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select("_doc.*")


def numbered(rows: DataFrame) -> DataFrame:
    """``rows``, a written table with a unique ``_row``, with ``_number``, from 1 in each group of one ``_id`` and ``_hash``.

    Groups are dealt into parts by a hash of the row, as many as they have ``GROUP_ROWS`` rows; parts are numbered by
    themselves and shifted by the counts of those before. Only keys and row numbers go through windows, never texts.
    """
    part = F.pmod(F.xxhash64("_row"), F.ceil(F.col("_rows") / GROUP_ROWS)).cast("long")
    dealt = rows.select("_id", "_hash", "_row", part.alias("_part"))
    filled = dealt.groupBy("_id", "_hash", "_part").agg(F.count("*").alias("_filled"))
    earlier = Window.partitionBy("_id", "_hash").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = filled.select("_id", "_hash", "_part", F.coalesce(F.sum("_filled").over(earlier), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_id", "_hash", "_part").orderBy("_row"))
    numbers = dealt.withColumn("_place", place).join(offsets, ["_id", "_hash", "_part"])
    return rows.join(numbers.select("_row", (F.col("_before") + F.col("_place")).alias("_number")), "_row")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
