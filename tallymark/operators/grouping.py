"""Groupings that stay safe when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Partial groups a hot key is spread over before the join on the key itself.
SPREAD = 32


def first_per_group(df: DataFrame, keys: Sequence[str | Column], order_by: Sequence[str]) -> DataFrame:
    """The least row of every group; NULL sorts first, and NULL keys form a group.

    The filter on the row number lets Spark keep one row per group in each map task, so what is shuffled for a hot
    group is at most one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*(F.asc_nulls_first(c) for c in order_by))
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def _spread(spread_by: str) -> Column:
    return F.pmod(F.xxhash64(spread_by), F.lit(SPREAD)).alias("_spread")


def distinct_keys(df: DataFrame, keys: Sequence[str], spread_by: str) -> DataFrame:
    """Keys with at most ``SPREAD`` copies each, for the right side of a semi or anti join, where copies do no harm.

    Grouping by key and spread collapses hot keys in the map tasks. The join then shuffles the copies by key alone,
    directly below its sort, which is what adaptive execution needs to split a hot key on the other side.
    """
    return df.select(*keys, _spread(spread_by)).distinct().select(*keys)


def partial_counts(df: DataFrame, keys: Sequence[str], spread_by: str, count: str) -> DataFrame:
    """Row counts per key in at most ``SPREAD`` parts, to be multiplied and then summed after a join on the key."""
    return df.groupBy(*keys, _spread(spread_by)).agg(F.count(F.lit(1)).alias(count)).drop("_spread")


def salted_lookup(rows: DataFrame, lookup: DataFrame, key: str, lookup_key: str, spread_by: str) -> DataFrame:
    """Left join with a lookup that has one row per key, every key spread over ``SPREAD`` tasks.

    For a grouped lookup: it is already partitioned by its key, so adaptive execution would not split a hot key.
    """
    salts = F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1)))
    copies = lookup.withColumn("_salt", salts)
    salted = rows.withColumn("_spread", F.pmod(F.xxhash64(spread_by), F.lit(SPREAD)))
    on = (F.col(key) == F.col(lookup_key)) & (F.col("_spread") == F.col("_salt"))
    return salted.join(copies, on, "left").drop("_spread", "_salt")
