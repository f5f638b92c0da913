"""What the operators share: tables, words, label folds, measured broadcasts, connected components."""

from __future__ import annotations

import functools
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.sources.scratch import write_through

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = r"[\x20\x09-\x0D]"
BROADCAST_BYTES = 64 << 20  # a table over this size is shuffled instead


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Let executors import this package, also where it is installed on the driver alone. Spark distributes the file."""
    _ship(spark.sparkContext.applicationId)


@functools.cache
def _ship(application_id: str) -> None:
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="llm-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in package.rglob("*.py"):
            out.write(file, file.relative_to(package.parent))
    SparkSession.active().sparkContext.addPyFile(str(archive))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; other letters stay, unlike with ``lower``."""
    return F.translate(text, UPPER, UPPER.lower())


def words(text: Column, separators: str) -> Column:
    """Runs of characters outside ``separators`` (a character class); an empty array for NULL."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"{separators}+"), lambda w: w != "")


def held_out(doc_id: Column) -> Column:
    """The fold that no model learns from: crc32 of the id's text divisible by five."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def bounded(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df``, a table of narrow rows, with a broadcast hint if its measured size is within ``limit``; beyond it the planner shuffles."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def components(edges: DataFrame, name: str, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a, b): one row per node with ``node`` and ``component``, its least reachable node.

    Each round every node moves to the first node around it, and edges between nodes that met vanish. Rounds take turns in
    what is first: the least node, which collapses what hangs on small hubs at once, and the least hash, with which on
    average a constant share of any graph's nodes is left. So rounds grow with the logarithm of the nodes, and later
    rounds are small. Each round's tables are written. A hub's edges are reduced in the map tasks where neighbours
    are compared, and are a hot key of an inner join elsewhere, which adaptive execution splits.
    """
    links = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a is not null and b is not null and a <> b")
    links = write_through(links.distinct(), f"{name}-edges")
    every = write_through(links.select(F.col("a").alias("node")).union(links.select("b")).distinct().withColumn("at", F.col("node")), f"{name}-nodes")
    for k in range(max_rounds):
        if links.isEmpty():
            least = every.groupBy("at").agg(F.min("node").alias("component"))
            return every.join(least, "at").select("node", "component")
        order = (lambda name: F.xxhash64(name, F.lit(k))) if k % 2 else F.col  # noqa: B023
        first = F.struct(order("near").alias("order"), "near")
        around = links.select(F.col("a").alias("here"), F.col("b").alias("near")).union(links.select("b", "a"))
        own = F.struct(order("here").alias("order"), F.col("here").alias("near"))
        nearest = around.groupBy("here").agg(F.min(first).alias("first"))
        moves = write_through(nearest.select("here", F.least("first", own)["near"].alias("there")), f"{name}-moves")
        if k:  # few nodes are left, and most of them in chains: follow those four steps at once
            moves = write_through(_followed(_followed(moves)), f"{name}-moves")
        left = links.join(moves.withColumnRenamed("here", "a"), "a").select(F.col("there").alias("a"), "b")
        both = left.join(moves.withColumnRenamed("here", "b"), "b").select("a", F.col("there").alias("b")).where("a <> b")
        links = write_through(both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}-edges")
        every = write_through(
            every.join(moves.withColumnRenamed("here", "at"), "at", "left").select("node", F.coalesce("there", "at").alias("at")), f"{name}-nodes"
        )
    raise RuntimeError(f"components did not settle within {max_rounds} rounds")


def _followed(moves: DataFrame) -> DataFrame:
    """Every node goes where the node it goes to goes; all nodes of ``there`` are in ``here`` too."""
    on = moves.select(F.col("here").alias("there"), F.col("there").alias("beyond"))
    return moves.join(on, "there").select("here", F.col("beyond").alias("there"))


def row_key(id_col: str = "doc_id", text_col: str = "text") -> dict[str, Column]:
    """``_id`` and ``_hash`` of the text, neither of them NULL. Only rows that repeat an id and a text share them."""
    return {"_id": F.coalesce(F.col(id_col).cast("string"), F.lit("")), "_hash": F.xxhash64(text_col)}


def on_key(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Equality of key columns in which NULL equals NULL."""
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition
