"""Near duplicates: banded MinHash candidates, sequential Bayesian verification, exact check of the survivors."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm.common import bounded, components, ship, table
from tallymark.llm.features import Remembered, in_parts
from tallymark.sources.scratch import write_through

SHINGLE = 5
SIMILARITY = (75, 100)  # as a ratio of whole numbers, so the check has no rounding
BANDS, BAND_ROWS = 48, 5  # a pair at 0.75 shares no band with probability (1 - 0.75 ** 5) ** 48, two in a million
BATCH = 30  # signature places compared before the posterior is looked at again
MISS = 1e-7  # posterior probability of reaching the similarity under which a pair is given up
BLOCK_DOCUMENTS, BLOCK_SHINGLES = 256, 1_000_000  # of a candidate group that one side of a task holds
MEMBER_BYTES = 96
HASHES = BANDS * BAND_ROWS
PRIME = np.uint64(0x9E3779B97F4A7C15)

_WORD = Remembered(lambda word: xxhash.xxh64_intdigest(word))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """Hashes of the distinct runs of five words, in order; all words are one run if there are fewer.

    Bytes are lower-cased and split, which touches A-Z and white space of ASCII only.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    ids = np.array([_WORD[word] for word in words], np.uint64)
    width = min(SHINGLE, len(ids))
    runs = np.full(len(ids) - width + 1, width, np.uint64)
    for k in range(width):
        runs = runs * PRIME + ids[k : len(ids) - width + 1 + k]
    return np.unique(_mixed(runs))


@functools.cache
def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    return rng.integers(0, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, HASHES, np.uint64)


def signature(found: np.ndarray) -> np.ndarray:
    """Least value of every hash function over a set; long sets are taken in parts, whose minima are merged."""
    a, b = _multipliers()
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 1024):
        np.minimum(least, (found[at : at + 1024, None] * a + b).min(0), out=least)
    return least


def bands(sign: np.ndarray) -> np.ndarray:
    rows = sign.reshape(BANDS, BAND_ROWS)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(BAND_ROWS):
        keys = keys * PRIME + rows[:, k]
    return _mixed(keys).view(np.int64)


def set_key(found: np.ndarray) -> tuple[int, int]:
    """128 bits of a whole set: equal sets have equal keys."""
    digest = xxhash.xxh3_128_digest(found.tobytes())
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


@functools.cache
def least_agreement(places: int) -> int:
    """Fewest equal places, of ``places``, with which a pair may still be similar.

    With a flat prior the posterior of similarity is a beta distribution, whose tail beyond t is the probability that
    a binomial variable of places + 1 trials at t stays within the number of equal places.
    """
    t, below = SIMILARITY[0] / SIMILARITY[1], 0.0
    for equal in range(places + 1):
        below += math.comb(places + 1, equal) * t**equal * (1 - t) ** (places + 1 - equal)
        if below >= MISS:
            return equal
    return places + 1


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    shared = len(a) + len(b) - len(np.union1d(a, b))
    return SIMILARITY[1] * shared >= SIMILARITY[0] * (len(a) + len(b) - shared)


def links_within(sets: list[np.ndarray], side: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect whatever is similar among ``sets``: a spanning forest, not all pairs.

    ``side`` is 0 or 1: with both present only pairs across are compared, else all. Signature places are compared batch by
    batch; a pair drops out once its posterior is too low. Survivors are checked on their whole sets, likeliest first,
    unless links found before connect them already.
    """
    sizes = np.array([len(s) for s in sets])
    signs = np.stack([signature(s) for s in sets])
    left, right = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if side.any() else (np.arange(len(sets)), np.arange(len(sets)))
    equal = np.zeros((len(left), len(right)), np.int16)
    for k in range(BATCH):
        equal += signs[left, k][:, None] == signs[right, k][None, :]
    small, large = np.minimum(sizes[left][:, None], sizes[right][None, :]), np.maximum(sizes[left][:, None], sizes[right][None, :])
    open_pairs = (equal >= least_agreement(BATCH)) & (SIMILARITY[1] * small >= SIMILARITY[0] * large)
    if not side.any():
        open_pairs = np.triu(open_pairs, 1)
    i, j = np.nonzero(open_pairs)
    agreed = equal[i, j].astype(int)
    i, j = left[i], right[j]
    for at in range(BATCH, HASHES, BATCH):
        agreed = agreed + sum((signs[i, k] == signs[j, k]).astype(int) for k in range(at, at + BATCH))
        stay = agreed >= least_agreement(at + BATCH)
        i, j, agreed = i[stay], j[stay], agreed[stay]
    root = list(range(len(sets)))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    found = []
    for k in np.argsort(-agreed, kind="stable"):
        a, b = top(int(i[k])), top(int(j[k]))
        if a != b and similar(sets[i[k]], sets[j[k]]):
            root[a] = b
            found.append((int(i[k]), int(j[k])))
    return found


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, _hash, n_shingles, key_a, key_b, bands`` of every row of ``docs``; texts without words have no bands."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_parts(batches):
            sizes, keys, found_bands = [], [], []
            for text in part["text"].to_pylist():
                found = shingles(text)
                sizes.append(len(found))
                keys.append(set_key(found))
                found_bands.append(bands(signature(found)) if len(found) else [])
            columns = [sizes, [a for a, _ in keys], [b for _, b in keys]]
            made = [*(pa.array(c, pa.int64()) for c in columns), pa.array(found_bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*made, part["doc_id"], part["_hash"]], ["n_shingles", "key_a", "key_b", "bands", "doc_id", "_hash"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("_hash"), "text")
    return rows.mapInArrow(of, "n_shingles long, key_a long, key_b long, bands array<long>, doc_id long, _hash long")


def candidate_groups(classes: DataFrame) -> DataFrame:
    """Classes, named by their ``key_a``, that share a band, directly or through others: ``node, component``. Each bucket names one member as its hub."""
    placed = classes.select("key_a", F.posexplode("bands").alias("band", "value")).select("key_a", F.xxhash64("band", "value").alias("bucket"))
    hubs = placed.groupBy("bucket").agg(F.min("key_a").alias("hub"), F.count("*").alias("classes")).where("classes > 1").drop("classes")
    edges = placed.join(hubs, "bucket").where("key_a <> hub").select(F.col("hub").alias("a"), F.col("key_a").alias("b"))
    return components(edges.distinct(), "near-candidates")


def blocks(groups: DataFrame, classes: DataFrame) -> DataFrame:
    """Members of candidate groups in the tasks that compare them: ``class_id, key_a, component, first, second, side``.

    A group is dealt into blocks of bounded size, and every two blocks, and every block with itself, meet in one task.
    """
    members = groups.select(F.col("node").alias("key_a"), "component").join(classes.select("class_id", "key_a", "n_shingles"), "key_a")
    sizes = members.groupBy("component").agg(F.greatest(F.count("*") / BLOCK_DOCUMENTS, F.sum("n_shingles") / BLOCK_SHINGLES).alias("size"))
    dealt = members.join(sizes.select("component", F.ceil("size").cast("int").alias("parts")), "component")
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("key_a"), F.col("parts")).cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return met.select(
        "class_id", "key_a", "component", F.least("part", "other").alias("first"), F.greatest("part", "other").alias("second"),
        (F.col("part") > F.col("other")).cast("int").alias("side"),
    )


def verified_links(docs: DataFrame, members: DataFrame) -> DataFrame:
    """Links (a, b) between classes, found block by block from the classes' whole texts."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, sides, sets = None, [], [], []

        def close() -> pa.RecordBatch:
            found = links_within(sets, np.array(sides)) if len(ids) > 1 and (key[1] == key[2] or len(set(sides)) > 1) else []
            ends = [ids[i] for i, _ in found], [ids[j] for _, j in found]
            return pa.RecordBatch.from_arrays([pa.array(end, pa.int64()) for end in ends], ["a", "b"])

        for part in in_parts(batches):
            for component, first, second, side, key_a, text in zip(*(column.to_pylist() for column in part.columns)):
                if (here := (component, first, second)) != key:
                    if key is not None:
                        yield close()
                    key, ids, sides, sets = here, [], [], []
                found = shingles(text)
                if set_key(found)[0] == key_a:  # not another row that repeats the id
                    ids.append(key_a)
                    sides.append(side)
                    sets.append(found)
        if key is not None:
            yield close()

    texts = docs.select(F.col("doc_id").alias("class_id"), "text").join(bounded(members, MEMBER_BYTES), "class_id")
    dealt = texts.repartition("component", "first", "second").sortWithinPartitions("component", "first", "second", "class_id")
    return dealt.select("component", "first", "second", "side", "key_a", "text").mapInArrow(compare, "a long, b long")


def _linked(docs: DataFrame) -> DataFrame:
    """The columns of ``near_duplicates`` and ``_hash``, of the text. Classes are told apart by their keys, as ids can repeat."""
    ship(docs.sparkSession)
    prints = write_through(fingerprints(docs), "near-fingerprints")
    named = prints.where("n_shingles > 0 and doc_id is not null")
    classes = write_through(
        named.groupBy("key_a", "key_b").agg(F.min("doc_id").alias("class_id"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands")),
        "near-classes",
    )
    members = write_through(blocks(candidate_groups(classes), classes), "near-members")
    links = write_through(verified_links(docs, members), "near-links")
    connected = components(links, "near-links").withColumnRenamed("node", "key_a")
    connected = write_through(connected.join(classes.select("key_a", "class_id"), "key_a"), "near-connected")
    firsts = write_through(connected.groupBy("component").agg(F.min(F.struct("class_id", "key_a")).alias("first")), "near-firsts")
    told = connected.join(firsts, "component").select("key_a", "first")
    ids = classes.select("key_a", "key_b", "class_id").join(told, "key_a", "left")
    own = F.struct("class_id", "key_a")
    ids = ids.select(F.col("key_a").alias("a"), F.col("key_b").alias("b"), F.coalesce("first", own).alias("first"))
    rows = prints.select("doc_id", "_hash", "n_shingles", "key_a", "key_b")
    linked = rows.join(ids, (rows["key_a"] == ids["a"]) & (rows["key_b"] == ids["b"]) & (rows["n_shingles"] > 0) & rows["doc_id"].isNotNull(), "left")
    component = F.coalesce("first.class_id", "doc_id")
    kept = F.col("doc_id").eqNullSafe(component) & F.coalesce(F.col("first.key_a") == F.col("key_a"), F.lit(True))
    return linked.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"), "_hash")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Two documents are linked if their sets of shingles are similar by ``SIMILARITY``; a component is what links connect,
    and its smallest id stays. Documents with one and the same set are one class from the start and never compared.

    NULL and empty texts and those without words have an empty set and are linked with nothing. A NULL id has no component
    and stays. Rows that repeat an id each follow their own text: of several sets in one component with the least id, one
    stays; where the texts are equal they stay or go together. An empty table gives no rows; other columns are not read.

    A pair is missed with a probability of about two in a million (no shared band), plus ``MISS`` for each batch. A false
    link needs a collision of 64-bit hashes.
    """
    return _linked(docs).drop("_hash")


def distinct_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with the columns of ``docs``. Rows with a NULL id stay."""
    gone = _linked(docs).where("not kept").select(F.col("doc_id").alias("_gone_id"), F.col("_hash").alias("_gone_hash")).distinct()
    same = (docs["doc_id"] == gone["_gone_id"]) & (F.xxhash64(docs["text"]) == gone["_gone_hash"])
    return docs.join(gone, same, "left_anti").select(*docs.columns)


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


OP9_SQL = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), word AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS i, len(w) AS n FROM d
), run AS (
    SELECT doc_id, i, n, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS words FROM word
), shingle AS (
    SELECT DISTINCT doc_id, words FROM run WHERE i + least(n, 5) <= n
), size AS (
    SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingle a JOIN shingle b ON a.words = b.words AND a.doc_id < b.doc_id GROUP BY ALL
), link AS (
    SELECT a, b FROM shared JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * shared.n >= 75 * (x.n + y.n - shared.n)
), both_ways AS (
    SELECT a, b FROM link UNION ALL SELECT b, a FROM link
), reach AS (
    SELECT a, b FROM both_ways UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a
), least_id AS (
    SELECT a AS doc_id, least(a, min(b)) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id, doc_id = coalesce(component_id, doc_id) AS kept
FROM d LEFT JOIN size USING (doc_id) LEFT JOIN least_id USING (doc_id)
"""
