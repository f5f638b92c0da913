"""Filter interaction audit: what every order of a set of filters removes, step by step, for each part of the documents."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm.common import BLANKS, bounded, table, words
from tallymark.sources.scratch import write_through

LEAST_WORDS = 200
FILTERS = ("A", "B", "C", "D", "E")
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
STEP = f"struct<filter:int,{','.join(f'{m}:bigint' for m in MEASURES)}>"
LABEL_BYTES, FIRST_BYTES = 48, 96


def text_failures(text: Column) -> dict[str, Column]:
    """Filters that look at one text: few words, few distinct words, many capitals, marks."""
    found = words(text, BLANKS)
    return {
        "A": F.size(found) < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct(found)) < 50 * F.size(found),
        "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 3 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``part, A, B, C, D, E, good, toxic``.

    Each text is read once, for its filters and its SHA-256, by which texts are equal; what follows are narrow rows. A row
    fails E if its id is larger than the least id of its text. Rows are pre-aggregated where that id is found, and a very
    common text is a hot key of a join whose other side is read from a table, so it is split.
    """
    text = F.coalesce("text", F.lit(""))
    read = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), *(c.alias(f) for f, c in text_failures(text).items()))
    rows = write_through(read, "audit-rows")
    repeated = rows.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows")).where("rows > 1").drop("rows")
    least = write_through(repeated, "audit-texts")
    of = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("labelled"))
    known = write_through(of.agg(*(F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(f"_{c}") for c in ("quality", "toxic"))), "audit-labels")
    joined = rows.join(bounded(least, FIRST_BYTES), "digest", "left").join(bounded(known, LABEL_BYTES), F.col("doc_id") == F.col("labelled"), "left")
    no = F.lit(False)
    again = F.coalesce(F.col("doc_id") > F.col("least"), no)
    return joined.select("part", "A", "B", "C", "D", again.alias("E"), F.coalesce("_quality", no).alias("good"), F.coalesce("_toxic", no).alias("toxic"))


def mask_cells(rows: DataFrame, filters: Sequence[str]) -> DataFrame:
    """Rows counted by which filters they fail: ``part, mask, n, good, toxic``; at most 2 ** len(filters) rows for a part."""
    mask = F.lit(0)
    for k, name in enumerate(filters):
        mask = mask + F.when(F.col(name), 1 << k).otherwise(0)
    count = [F.sum(F.col(c).cast("long")).alias(c) for c in ("good", "toxic")]
    return rows.groupBy("part", mask.alias("mask")).agg(F.count("*").alias("n"), *count)


def _steps(cell: Column, orders: Column) -> Column:
    """What one cell adds to every step of every order: each order is folded with whether the cell's rows are still there."""

    def step(state: Column, which: Column) -> Column:
        fails = F.getbit(cell["mask"], which) == 1
        here, alone = state["there"] & fails, fails & (F.bit_count(cell["mask"]) == 1)

        def rows(condition: Column, of: str = "n") -> Column:
            return F.when(condition, cell[of]).otherwise(F.lit(0).cast("long"))

        told = F.struct(
            which.alias("filter"), rows(state["there"] & ~fails).alias("kept"), rows(here).alias("removed"), rows(fails & ~state["there"]).alias("redundant"),
            rows(alone).alias("unique_fails"), rows(here, "good").alias("good_lost"), rows(here, "toxic").alias("toxic_lost"),
        )
        return F.struct((state["there"] & ~fails).alias("there"), F.concat(state["steps"], F.array(told)).alias("steps"))

    start = F.struct(F.lit(True).alias("there"), F.array().cast(f"array<{STEP}>").alias("steps"))
    return F.flatten(F.transform(orders, lambda order: F.aggregate(order, start, step, lambda state: state["steps"])))


def _added(a: Column, b: Column) -> Column:
    return F.struct(b["filter"].alias("filter"), *((a[m] + b[m]).alias(m) for m in MEASURES))


def audit(rows: DataFrame, filters: Sequence[str]) -> DataFrame:
    """For every part, order of ``filters`` and step: ``part, filter_order, step``, ``MEASURES`` and ``shapley``.

    ``rows`` has ``part``, a boolean column for every filter (true: fails), ``good`` and ``toxic``. Rows are first counted
    by part and mask, so what the orders are folded over are a few cells for each part, whatever the rows: the array of all
    orders is a literal of the plan, each cell is turned into one struct for each order and step, and the cells' arrays
    are added place by place. The number of orders is the factorial of the filters: meant for up to six of them.
    """
    ordered = list(permutations(range(len(filters))))
    orders = F.array(*(F.array(*map(F.lit, order)) for order in ordered))
    names = F.array(*(F.lit("".join(filters[k] for k in order)) for order in ordered))
    nothing = F.struct(F.lit(0).alias("filter"), *(F.lit(0).cast("long").alias(m) for m in MEASURES))
    zeros = F.array_repeat(nothing, len(ordered) * len(filters)).cast(f"array<{STEP}>")
    cells = mask_cells(rows, filters).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    summed = cells.select("part", F.aggregate("cells", zeros, lambda total, cell: F.zip_with(total, _steps(cell, orders), _added)).alias("steps"))

    def removed(which: Column) -> Column:
        return F.aggregate("steps", F.lit(0).cast("long"), lambda total, s: total + F.when(s["filter"] == which, s["removed"]).otherwise(F.lit(0).cast("long")))

    valued = summed.withColumn("shapleys", F.transform(F.sequence(F.lit(0), F.lit(len(filters) - 1)), removed))
    told = valued.select("part", "shapleys", F.posexplode("steps").alias("place", "s"))
    return told.select(
        "part", F.element_at(names, (F.floor(F.col("place") / len(filters)) + 1).cast("int")).alias("filter_order"), (F.col("place") % len(filters) + 1).cast("int").alias("step"),
        *(F.col(f"s.{m}").alias(m) for m in MEASURES), F.element_at("shapleys", F.col("s.filter") + 1).alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over whole documents, one part for each ``lang`` (NULL: the empty text).

    NULL texts are empty, and fail A alone, or E as well: the empty text counts as any other. A NULL id is larger than
    none, so such a row never fails E. Rows that repeat an id and a text are each counted; an id with several labels
    counts as good, or toxic, if any label says so. Length does not matter: texts are read whole. An empty table of
    documents gives no rows; other columns are not read.
    """
    return audit(failures(docs, labels), FILTERS)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP12_SQL = r"""
WITH d AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
        list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), least_id AS (
    SELECT t, min(doc_id) AS least FROM d GROUP BY t
), known AS (
    SELECT doc_id, max((quality = 1)::int) AS good, max((toxic = 1)::int) AS toxic FROM labels GROUP BY doc_id
), cell AS (
    SELECT part, (len(w) < 200)::int + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::int
        + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::int
        + 8 * regexp_matches(t, '[#$%&*|]')::int + 16 * coalesce(d.doc_id > least, false)::int AS mask,
        count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
    FROM d JOIN least_id USING (t) LEFT JOIN known ON known.doc_id = d.doc_id GROUP BY ALL
), f AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS name, unnest([1, 2, 4, 8, 16]) AS bit
), placed AS (
    SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
    FROM f a, f b, f c, f d, f e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5
), steps AS (
    SELECT filter_order, unnest(range(1, 6)) AS step, bits FROM placed
), seen AS (
    SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::int AS before FROM steps
), summed AS (
    SELECT part, filter_order, step, bit,
        sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN mask & before > 0 AND mask & bit > 0 THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN toxic ELSE 0 END) AS toxic_lost
    FROM cell CROSS JOIN seen GROUP BY ALL
)
SELECT part, filter_order, step::int AS step, kept::bigint AS kept, removed::bigint AS removed, redundant::bigint AS redundant,
    unique_fails::bigint AS unique_fails, good_lost::bigint AS good_lost, toxic_lost::bigint AS toxic_lost,
    (sum(removed) OVER (PARTITION BY part, bit))::bigint AS shapley
FROM summed
"""
