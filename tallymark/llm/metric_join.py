"""Exact metric range join of vectors: pivots cut them into cells, the triangle inequality says which vectors visit other cells."""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm.common import bounded, components, ship, table
from tallymark.sources.scratch import write_through

COSINE = 0.95
SAMPLE = 2048  # vectors that pivots are chosen from
CELL = 4096  # vectors of a cell that one task holds; a larger cell is dealt into several blocks
VISITORS = 16_384  # about as many visit one task; the block is copied for more
DENSE = 8  # as many neighbours in the sample make a pivot
TILE = 1024
SLACK = 1e-6  # of angles, far above their rounding error
MARGIN = 1e-4  # of cosines in single precision, for vectors of up to some thousand components
ROWS_AT_ONCE = 50_000
CELL_BYTES = 64


def usable(vector: Column) -> Column:
    """True for vectors that have a direction: not empty, without NULL and non-finite components, not zero."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows in length one, in double precision; scaled by the largest component first, so that no square overflows."""
    x = vectors / np.abs(vectors).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def padded(vectors: list[np.ndarray], width: int) -> np.ndarray:
    """Vectors side by side; shorter ones end in zeros, which changes no cosine of two of one length."""
    if all(len(v) == width for v in vectors):
        return np.stack(vectors).astype(np.float64)
    out = np.zeros((len(vectors), width))
    for row, vector in zip(out, vectors):
        row[: len(vector)] = vector
    return out


def angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1, 1))


def choose_pivots(sample: np.ndarray, vectors: int, reach: float) -> np.ndarray:
    """Directions that cells gather around: centres of dense places of the sample, largest first, and as many of its other
    vectors as cells of ``CELL`` vectors are needed, at most the sample itself."""
    if not len(sample):
        return sample
    near = (sample.astype(np.float32) @ sample.T.astype(np.float32)) >= math.cos(reach)
    free, pivots = np.ones(len(sample), bool), []
    while (counts := near[:, free].sum(1) * free).max() >= DENSE:
        members = near[counts.argmax()] & free
        centre = sample[members].sum(0)
        pivots.append(centre / np.linalg.norm(centre))
        free &= ~members
    rest = np.flatnonzero(free)[: math.ceil(vectors / CELL)]
    return np.concatenate([np.array(pivots).reshape(-1, sample.shape[1]), sample[rest] if len(rest) or pivots else sample[:1]])


class Cells(NamedTuple):
    """All cells in order of how far they reach, and the pivots: what every task knows. A row each of ``home`` (dim, pivot, ring)."""

    pivots: np.ndarray
    width: int
    reach: float
    cosine: float
    home: dict[tuple[int, int, int], int]
    dim: np.ndarray
    pivot: np.ndarray
    core: np.ndarray
    low: np.ndarray
    high: np.ndarray
    blocks: np.ndarray
    copies: np.ndarray  # how many tasks hold a copy of each block

    def first(self) -> np.ndarray:
        """Number of each cell's first task: a task is a copy of a block of a cell."""
        tasks = self.blocks * self.copies
        return np.cumsum(tasks) - tasks

    def foreign(self, x: np.ndarray, dims: np.ndarray, home: np.ndarray) -> np.ndarray:
        """For each vector, which other cells can hold a partner that its own cell's task does not meet.

        Of two cells the vectors of the one that reaches farther visit the other. y in a cell lies between ``low`` and ``high``
        from its pivot q, and nearer to q than to any other pivot p; with x within reach of y that leaves for x: between
        ``low - reach`` and ``high + reach`` from q, and no farther behind the plane between p and q than the chord of reach.
        """
        cosines = np.clip(x @ self.pivots.T, -1, 1)
        around = np.arccos(cosines)[:, self.pivot]
        own = self.pivot[home]
        apart = np.linalg.norm(self.pivots[:, None] - self.pivots[None], axis=2) if len(self.pivots) <= 64 else None
        span = (apart[own] if apart is not None else np.sqrt(np.maximum(0, 2 - 2 * self.pivots[own] @ self.pivots.T)))[:, self.pivot]
        behind = np.take_along_axis(cosines, own[:, None], 1) - cosines[:, self.pivot]
        near = behind <= (2 * math.sin(self.reach / 2) + SLACK) * span + SLACK
        ring = (around >= self.low - self.reach - SLACK) & (around <= self.high + self.reach + SLACK)
        return near & ring & (np.arange(len(self.pivot)) < home[:, None]) & (self.dim == dims[:, None])


def _ring(angle: np.ndarray, reach: float) -> np.ndarray:
    """0 up to half the reach, where all are linked with all; from there one for each reach."""
    return np.where(angle <= reach / 2 - SLACK, 0, 1 + np.maximum(0, np.floor((angle - reach / 2) / reach))).astype(np.int64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(8)).astype(np.int64)


def placed(classes: DataFrame, pivots: np.ndarray, width: int, reach: float) -> DataFrame:
    """``class, copies, dim, pivot, ring, angle, vector`` (the unit vector's doubles): each class at its nearest pivot."""
    shared = classes.sparkSession.sparkContext.broadcast(pivots)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = units(padded(list(batch["vector"]), width))
                cosines = np.clip(x @ shared.value.T, -1, 1)
                pivot = cosines.argmax(1)
                angle = np.arccos(cosines[np.arange(len(x)), pivot])
                yield batch[["class", "copies", "dim"]].assign(pivot=pivot, ring=_ring(angle, reach), angle=angle, vector=[row.tobytes() for row in x])

    rows = classes.select("class", "copies", F.size("vector").cast("long").alias("dim"), "vector")
    return rows.mapInPandas(place, "class long, copies long, dim long, pivot long, ring long, angle double, vector binary")


def survey(places: DataFrame, pivots: np.ndarray, width: int, reach: float, cosine: float) -> Cells:
    """What is in the cells; a row for each comes to the driver: pivots times rings, for each length of vectors."""
    found = places.groupBy("dim", "pivot", "ring").agg(F.count("*").alias("n"), F.min("angle").alias("low"), F.max("angle").alias("high"))
    rows = sorted(found.collect(), key=lambda r: (r["high"], r["dim"], r["pivot"], r["ring"]))
    column = lambda name, kind=np.int64: np.array([r[name] for r in rows], kind)
    blocks = -(-column("n") // CELL)
    home = {(r["dim"], r["pivot"], r["ring"]): k for k, r in enumerate(rows)}
    once = np.ones(len(rows), np.int64)
    cells = Cells(pivots, width, reach, cosine, home, column("dim"), column("pivot"), column("ring") == 0, column("low", float), column("high", float), blocks, once)
    shared = places.sparkSession.sparkContext.broadcast(cells)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        visits = np.zeros(len(rows), np.int64)
        for x, dims, home, _ in _parts(batches, shared.value):
            visits += shared.value.foreign(x, dims, home).sum(0)
        yield pd.DataFrame({"cell": np.flatnonzero(visits), "visits": visits[visits > 0]})

    visits = np.zeros(len(rows), np.int64)
    for row in places.mapInPandas(count, "cell long, visits long").groupBy("cell").agg(F.sum("visits").alias("visits")).collect():
        visits[row["cell"]] = row["visits"]
    visits += np.where(cells.core | (blocks == 1), 0, column("n"))
    return cells._replace(copies=np.maximum(1, -(-visits // VISITORS)))


def _parts(batches: Iterator[pd.DataFrame], cells: Cells) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, pd.DataFrame]]:
    """Unit vectors, lengths and home cells, so many at once that what they visit is bounded."""
    step = max(1, ROWS_AT_ONCE // max(1, int(cells.blocks.sum())))
    for batch in batches:
        for at in range(0, len(batch), step):
            part = batch.iloc[at : at + step]
            x = np.frombuffer(b"".join(part["vector"]), np.float64).reshape(len(part), cells.width)
            home = np.array([cells.home[key] for key in zip(part["dim"], part["pivot"], part["ring"])], np.int64)
            yield x, part["dim"].to_numpy(), home, part


def deal(places: DataFrame, cells: Cells) -> DataFrame:
    """Who meets in which task: ``task, inside, visitor, class, copies, vector``.

    Every vector is in one block of its cell, and in all copies of the block; ``inside`` tells the one copy in which members
    are compared with each other. It visits all blocks of the cells it has to, and earlier blocks of its own, one copy of each.
    Members of a core are all linked with each other and are not compared.
    """
    shared = places.sparkSession.sparkContext.broadcast(cells)

    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cells = shared.value
        first = cells.first()
        for x, dims, home, part in _parts(batches, cells):
            salt = _mixed(part["class"].to_numpy())
            block = salt % cells.blocks[home]
            who, where = np.nonzero(cells.foreign(x, dims, home))
            # All blocks of the visited cells, and the blocks before its own in its own cell.
            before = np.where(cells.core[home], 0, block)
            who, where, blocks = np.concatenate([who, np.arange(len(x))]), np.concatenate([where, home]), np.concatenate([cells.blocks[where], before])
            at = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            who, where = np.repeat(who, blocks), np.repeat(where, blocks)
            visited = first[where] + at * cells.copies[where] + (salt[who] // 7919) % cells.copies[where]
            copies = cells.copies[home]
            members = np.repeat(np.arange(len(x)), copies)
            copy = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
            own = first[home][members] + block[members] * copies[members] + copy
            rows = part[["class", "copies", "vector"]].iloc[np.concatenate([members, who])]
            inside = np.concatenate([(copy == 0) & ~cells.core[home][members], np.zeros(len(who), bool)])
            yield rows.assign(task=np.concatenate([own, visited]), inside=inside, visitor=np.arange(len(rows)) >= len(members))

    return places.mapInPandas(dealt, "class long, copies long, vector binary, task long, inside boolean, visitor boolean")


class Forest:
    """Edges that connect what links connect, taken from whole matrices of links; never all links."""

    def __init__(self, n: int):
        self.root, self.edges = np.arange(n), []

    def _top(self, x: int) -> int:
        while self.root[x] != x:
            self.root[x] = self.root[self.root[x]]
            x = self.root[x]
        return x

    def add(self, links: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
        """Every row's and every column's first link between two trees is an edge, until no link is left that is between two."""
        while True:
            left_root, right_root = ([self._top(int(k)) for k in side] for side in (left, right))
            links = links & (np.array(left_root)[:, None] != np.array(right_root)[None, :])
            i, j = np.flatnonzero(links.any(1)), np.flatnonzero(links.any(0))
            if not len(i):
                return
            for a, b in [*zip(left[i], right[links[i].argmax(1)]), *zip(left[links[:, j].argmax(0)], right[j])]:
                a_top, b_top = self._top(int(a)), self._top(int(b))
                if a_top != b_top:
                    self.root[a_top] = b_top
                    self.edges.append((int(a), int(b)))


def linked(a: np.ndarray, b: np.ndarray, cosine: float) -> np.ndarray | None:
    """Which rows of ``a`` and ``b`` reach the cosine; None if none do. Single precision tells where to look in double."""
    rough = a.astype(np.float32) @ b.T.astype(np.float32) >= cosine - MARGIN
    rows, columns = np.flatnonzero(rough.any(1)), np.flatnonzero(rough.any(0))
    if not len(rows):
        return None
    sure = np.zeros(rough.shape, bool)
    sure[np.ix_(rows, columns)] = a[rows] @ b[columns].T >= cosine
    return sure


def meeting(width: int, cosine: float):
    """One task: members among each other, where told, and visitors with members. Counts for classes, and edges."""

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("visitor", kind="stable")
        x = np.frombuffer(b"".join(rows["vector"]), np.float64).reshape(len(rows), width)
        weights, members = rows["copies"].to_numpy(), int((~rows["visitor"]).sum())
        counts, forest = np.zeros(len(rows), np.int64), Forest(len(rows))
        inside = members and bool(rows["inside"].iloc[0])
        starts = [(at, min(at + TILE, end)) for begin, end in ((0, members if inside else 0), (members, len(rows))) for at in range(begin, end, TILE)]
        for at, end in starts:
            left = np.arange(at, end)
            # Members are compared with themselves and all before them, visitors with all members.
            right = np.arange(min(members, int(left[-1]) + 1))
            links = linked(x[left], x[right], cosine)
            if links is None:
                continue
            if at < members:
                links &= right[None, :] < left[:, None]
            counts[left] += links @ weights[right]
            counts[right] += weights[left] @ links
            forest.add(links, left, right)
        ids, some = rows["class"].to_numpy(), np.flatnonzero(counts)
        told = pd.DataFrame({"a": ids[some], "n": counts[some]})
        edges = np.array(forest.edges, np.int64).reshape(-1, 2)
        return pd.concat([told.assign(b=None), pd.DataFrame({"a": ids[edges[:, 0]], "b": ids[edges[:, 1]], "n": 0})])[["a", "b", "n"]].astype({"b": "Int64"})

    return meet


def range_links(classes: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``a, b, n`` of ``class, copies, vector``: rows with ``n`` add to how many vectors a class is linked with, copies counted;
    rows with ``b`` are links, of which there are as many as connect what all links connect."""
    ship(classes.sparkSession)
    reach = math.acos(cosine)
    n, width = classes.agg(F.count("*"), F.max(F.size("vector"))).first()
    if not n:
        return classes.sparkSession.createDataFrame([], "a long, b long, n long")
    chosen = classes.orderBy(F.xxhash64("vector"), "class").select("vector").limit(SAMPLE).collect()
    pivots = choose_pivots(units(padded([np.array(r["vector"], np.float64) for r in chosen], width)), n, reach)
    places = write_through(placed(classes, pivots, width, reach), "metric-places")
    cells = survey(places, pivots, width, reach, cosine)
    met = deal(places, cells).groupBy("task").applyInPandas(meeting(width, cosine), "a long, b long, n long")
    # Inside half the reach of a pivot all are linked with all: that is counted, and one of them stands for all.
    core = places.where("ring = 0").select("class", "copies", "dim", "pivot")
    sums = write_through(core.groupBy("dim", "pivot").agg(F.min("class").alias("b"), F.sum("copies").alias("all")), "metric-cores")
    star = core.join(bounded(sums, CELL_BYTES), ["dim", "pivot"]).select(F.col("class").alias("a"), "b", (F.col("all") - F.col("copies")).alias("n"))
    return met.unionByName(star)


def vector_links(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id, n_links, component_id, kept``.

    Vectors are linked if the cosine of their ``embedding``, in double precision, is ``cosine`` or more. All such links are
    found: cells decide only what is not compared. Equal vectors are one class from the start, each a link of the others.
    The vector with the least id of all that links connect stays.

    Vectors that are NULL, empty, zero, or hold NULL or non-finite components link with nothing and stay, and so do vectors
    of different length with each other. A NULL id is counted as a partner, is never the least of several, and a row with
    one stays only where no other id is connected. Rows that repeat an id are vectors of their own. An empty table gives no
    rows; other columns are not read. Of very long vectors a task holds at most ``CELL`` and about ``VISITORS``.
    """
    kind = vectors.schema["embedding"].dataType.elementType
    exact = kind if isinstance(kind, (T.FloatType, T.DoubleType)) else T.DoubleType()
    rows = vectors.select("vec_id", F.transform(F.col("embedding").cast(T.ArrayType(exact)), lambda x: x + F.lit(0.0).cast(exact)).alias("vector"))  # no negative zeros
    rows = rows.select("vec_id", F.when(usable(F.col("vector")), F.col("vector")).alias("vector"))
    grouped = rows.where("vector is not null").groupBy("vector").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    classes = write_through(grouped.withColumn("class", F.monotonically_increasing_id()), "metric-classes")
    links = write_through(range_links(classes, cosine), "metric-links")
    counts = links.groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("n"))
    connected = components(links.where("b is not null").select("a", "b"), "metric").withColumnRenamed("node", "class")
    several = classes.select("class", "least").join(connected, "class")
    first = write_through(several.groupBy("component").agg(F.min("least").alias("first")), "metric-firsts")
    named = several.join(first, "component").select("class", "first")
    known = classes.join(counts, "class", "left").join(named, "class", "left")
    told = write_through(known.select("vector", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("first", "least").alias("first")), "metric-known")
    joined = rows.join(told, "vector", "left").select("vec_id", F.coalesce("n", F.lit(0).cast("long")).alias("n_links"), F.coalesce("first", "vec_id").alias("component_id"))
    return joined.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op11_metric_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_links(table(spark, sf_dir, "embeddings"))


OP11_SQL = r"""
WITH RECURSIVE v AS (
    SELECT row_number() OVER () AS row, vec_id, embedding::DOUBLE[] AS e FROM embeddings
), usable AS (
    SELECT * FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), link AS (
    SELECT a.row AS a, b.row AS b FROM usable a JOIN usable b ON a.row <> b.row AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
    SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), first AS (
    SELECT a AS row, min(v.vec_id) AS first FROM reach JOIN v ON v.row = b GROUP BY a
), n AS (
    SELECT a AS row, count(*) AS n_links FROM link GROUP BY a
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, first) AS component_id, vec_id = least(vec_id, first) AS kept
FROM v LEFT JOIN n USING (row) LEFT JOIN first USING (row)
"""
