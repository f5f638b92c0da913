"""Exact duplicates: groups of one 128-bit content hash, whose bytes are compared, keep one row each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm.common import BLANKS, bounded, table
from tallymark.sources.scratch import write_through

HASH_ROW_BYTES = 64


def without_blanks(text: Column) -> Column:
    """What equality is decided on: the text without white space of ASCII; NULL counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{BLANKS}+", "")


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] = without_blanks,
    digest: Callable[[Column], Column] = F.md5,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Rows are equal if their normalised texts are equal bytes. The row with the most code points in its original text
    stays, then the one with the smallest id. Grouping is by ``digest``; every group of several rows is grouped once more
    by its bytes, so a collision of the hash splits the group.

    NULL texts count as empty, and empty texts are equal to each other. A NULL id is larger than any other. Rows with one
    and the same id and equal texts are all kept if that id is. An empty table gives no rows. Other columns are not read.

    Only ids, hashes and lengths are shuffled for all rows. Texts are shuffled for groups of several rows alone, one per
    group and map task, as equal ones are merged before.
    """
    text = normalise(F.col(text_col))
    narrow = [
        F.col(id_col).alias("doc_id"),
        digest(text).alias("hash"),
        F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("length"),
        F.sha2(text, 256).alias("text_sha256"),
    ]
    keys = write_through(docs.select(*narrow), "exact-keys")
    repeated = write_through(keys.groupBy("hash").agg(F.count("*").alias("rows")).where("rows > 1").select("hash"), "exact-repeated")
    variants = (
        docs.select(digest(text).alias("hash"), text.alias("bytes"))
        .join(bounded(repeated, HASH_ROW_BYTES), "hash", "left_semi")
        .groupBy("hash", "bytes")
        .agg(F.count("*").alias("rows"))
    )
    collided = write_through(
        variants.groupBy("hash").agg(F.count("*").alias("texts")).where("texts > 1").select("hash"), "exact-collided"
    )
    if collided.isEmpty():
        return _resolved(keys, ["hash"])
    whole = docs.select(*narrow, text.alias("bytes")).join(collided, "hash", "left_semi")
    return _resolved(keys.join(collided, "hash", "left_anti"), ["hash"]).unionByName(_resolved(whole, ["hash", "bytes"]))


def _resolved(rows: DataFrame, key: list[str]) -> DataFrame:
    """Which row of each group stays, told to all of its rows; a hot group is one row per map task before the shuffle.

    Groups are written before the join: read back, both sides have their exchange directly below the sort, so adaptive
    execution can split a hot group's rows.
    """
    first = F.max(F.struct("length", F.bitwise_not("doc_id").alias("order"), F.col("doc_id").alias("id")))
    groups = rows.groupBy(*key).agg(first.alias("first"), F.count("*").alias("group_size"))
    named = write_through(groups.select(*key, F.col("first.id").alias("keep_id"), "group_size"), "exact-groups")
    return rows.join(named, key).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH rows AS (
    SELECT doc_id, length(coalesce(text, '')) AS size, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents
), groups AS (
    SELECT norm, count(*) AS group_size, first(doc_id ORDER BY size DESC, doc_id ASC NULLS LAST) AS keep_id FROM rows GROUP BY norm
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256
FROM rows JOIN groups USING (norm)
"""
