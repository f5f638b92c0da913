"""Benchmark decontamination: which words of documents lie in passages of benchmark items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymark.llm.common import BROADCAST_BYTES, ascii_lower, on_key, table, words
from tallymark.sources.scratch import write_through

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"  # after A-Z became a-z
WINDOW = 10
SHINGLE = 5
KEY_BYTES = 48


def benchmark_words(text: Column) -> Column:
    return words(ascii_lower(text), SEPARATORS)


def _window_of(start: Column, length: Column, tokens: Column) -> Column:
    """Words hold no blank, so a joined window stands for exactly one sequence of words."""
    return F.array_join(F.slice(tokens, start + 1, length), " ")


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """One row per item and distinct window: ``item_id`` (text), ``window``, ``length``."""
    tokens = items.select(F.col(id_col).cast("string").alias("item_id"), benchmark_words(F.col(text_col)).alias("words"))
    sized = tokens.where("size(words) > 0").withColumn("length", F.least(F.lit(window), F.size("words")))
    starts = sized.select("item_id", "words", "length", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("length"))).alias("start"))
    return starts.select("item_id", _window_of(F.col("start"), F.col("length"), F.col("words")).alias("window"), "length").distinct()


def window_shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """Every shingle of every window: ``window, length, offset, width, shingle`` (hash)."""
    split = windows.select("window", "length").distinct().withColumn("words", F.split("window", " "))
    split = split.withColumn("width", F.least(F.lit(shingle), F.col("length")))
    placed = split.select("*", F.explode(F.sequence(F.lit(0), F.col("length") - F.col("width"))).alias("offset"))
    return placed.select("window", "length", "offset", "width", _shingle(F.col("words"), F.col("offset"), F.col("width")).alias("shingle"))


def _shingle(tokens: Column, start: Column, width: Column) -> Column:
    return F.xxhash64(F.slice(tokens, start + 1, width))


def occurrences(docs: DataFrame, shingles: DataFrame, window: int, limit: int) -> DataFrame:
    """Where documents (_id, _hash, words) have a shingle of the benchmark.

    Columns ``_id, _hash, n_words, pos, width, shingle, near`` (the words around, from ``pos - window`` on) and ``from``.
    Up to ``limit`` bytes the benchmark's shingles are broadcast and words are cut out where one matches; beyond it
    positions alone are shuffled, and the words are read again for documents with a match.
    """
    keys = write_through(shingles.select("shingle", "width").distinct(), "benchmark-shingles")
    widths = sorted(row["width"] for row in keys.select("width").distinct().collect())  # at most as many as words in a shingle
    first = F.greatest(F.col("pos") - window, F.lit(0))
    around = [first.alias("from"), F.slice("words", first + 1, F.lit(2 * window + max(widths, default=1))).alias("near")]
    found = ["_id", "_hash", F.size("words").alias("n_words"), "pos", "width", "shingle"]

    def positions(df: DataFrame, *carried: str) -> DataFrame:
        placed = df.select(*carried, "words", F.posexplode("words").alias("pos", "word"))
        sized = placed.withColumn("width", F.explode(F.array(*map(F.lit, widths)))) if len(widths) > 1 else placed.withColumn("width", F.lit(widths[0] if widths else 1))
        inside = sized.where(F.col("pos") + F.col("width") <= F.size("words"))
        return inside.withColumn("shingle", _shingle(F.col("words"), F.col("pos"), F.col("width")))

    if keys.count() * KEY_BYTES <= limit:
        return positions(docs, "_id", "_hash").join(F.broadcast(keys), ["shingle", "width"]).select(*found, *around)
    narrow = positions(docs, "_id", "_hash").select("_id", "_hash", "pos", "width", "shingle").join(keys, ["shingle", "width"])
    spots = narrow.groupBy(F.col("_id").alias("a"), F.col("_hash").alias("b")).agg(F.collect_set(F.struct("pos", "width", "shingle")).alias("spots"))
    again = docs.join(spots, F.col("_id").eqNullSafe(F.col("a")) & F.col("_hash").eqNullSafe(F.col("b")))
    return again.select("_id", "_hash", "words", F.inline("spots")).select(*found, *around)


def verified_windows(found: DataFrame, shingles: DataFrame) -> DataFrame:
    """Occurrences of whole windows: ``_id, _hash, start, length, window``.

    A window needs only its rarest shingle in common with a document to be a candidate: that is its necessary prefix when
    shingles are ordered by how often the documents have them. A window with a shingle that no document has is left out
    at once. The offset of the shingle fixes where the window would start; it has to lie in the document, and its words
    have to be equal.
    """
    counts = found.groupBy("shingle", "width").agg(F.count("*").alias("frequency"))
    ranked = shingles.join(counts, ["shingle", "width"], "left").groupBy("window", "length").agg(
        F.min(F.struct(F.coalesce("frequency", F.lit(0)).alias("frequency"), "shingle", "width", "offset")).alias("rarest")
    )
    prefixes = ranked.where("rarest.frequency > 0").select("window", "length", "rarest.shingle", "rarest.width", "rarest.offset")
    placed = found.join(prefixes, ["shingle", "width"]).withColumn("start", F.col("pos") - F.col("offset"))
    fitting = placed.where((F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.col("n_words")))
    exact = fitting.where(_window_of(F.col("start") - F.col("from"), F.col("length"), F.col("near")) == F.col("window"))
    return exact.select("_id", "_hash", "start", "length", "window")


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` and ``_hash`` of the text.

    A window is ``window`` consecutive words of an item, or all words of a shorter one. ``n_hit`` counts document words
    inside any occurrence of a window, ``n_items`` the items such windows come from; ``items_sha256`` is the hash of their
    ids, sorted as texts and joined by commas.

    NULL and empty texts have no words and no hits; items without words have no windows. Items that repeat an id are one
    item; those with a NULL id count for ``n_hit`` only. Rows that repeat an id and a text get equal results. Empty tables
    are fine on either side; other columns are not read.

    Occurrences of a very common passage are rows of an inner join with the benchmark's side, so they are never paired
    with each other. Overlaps are counted from running maxima within one document.
    """
    texts = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_hash"), benchmark_words(F.col(text_col)).alias("words"))
    windows = write_through(item_windows(items, item_id_col, item_text_col, window), "benchmark-windows")
    shingles = write_through(window_shingles(windows, shingle), "benchmark-placed")
    found = write_through(occurrences(texts, shingles, window, broadcast_bytes), "benchmark-found")
    hits = write_through(verified_windows(found, shingles), "benchmark-hits")

    in_document = Window.partitionBy("_id", "_hash").orderBy("start", "length")
    covered = F.max(F.col("start") + F.col("length")).over(in_document.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("start") + F.col("length") - F.greatest(F.col("start"), F.coalesce(covered, F.lit(0))))
    spans = hits.select("_id", "_hash", "start", "length").distinct().withColumn("fresh", fresh.cast("long"))
    n_hit = spans.groupBy("_id", "_hash").agg(F.sum("fresh").alias("n_hit"))
    named = hits.select("_id", "_hash", "window").distinct().join(windows.select("item_id", "window"), "window")
    ids = named.groupBy("_id", "_hash").agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
    n_hit, ids = n_hit.withColumnsRenamed({"_id": "a", "_hash": "b"}), ids.withColumnsRenamed({"_id": "c", "_hash": "d"})
    report = n_hit.join(ids, F.col("a").eqNullSafe(F.col("c")) & F.col("b").eqNullSafe(F.col("d")), "left")
    sizes = texts.select("_id", "_hash", F.size("words").cast("long").alias("n_words"))
    hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    listed = F.coalesce("ids", F.array().cast("array<string>"))
    return sizes.join(report, F.col("_id").eqNullSafe(F.col("a")) & F.col("_hash").eqNullSafe(F.col("b")), "left").select(
        F.col("_id").alias("doc_id"),
        "n_words",
        hit.alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
        "_hash",
    )


def clean_documents(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without any word inside a window of ``items``, with the columns of ``docs``."""
    found = contamination(docs, items, **options).where("contaminated").select(F.col("doc_id").alias("_id"), "_hash").distinct()
    rows = docs.withColumns({"_id": F.col(options.get("id_col", "doc_id")), "_hash": F.xxhash64(options.get("text_col", "text"))})
    return rows.join(found, on_key(rows, found, "_id", "_hash"), "left_anti").select(*docs.columns)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("_hash")


OP1_SQL = r"""
WITH d AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
), b AS (
    SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark
), b_at AS (
    SELECT item_id, w, least(10, len(w)) AS n, unnest(range(0, greatest(len(w) - 10, 0) + 1)) AS i FROM b WHERE len(w) > 0
), win AS (
    SELECT DISTINCT item_id, n, array_to_string(w[i + 1:i + n], ' ') AS words FROM b_at
), d_word AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS i, len(w) AS n_words FROM d
), d_at AS (
    SELECT doc_id, i, n, n_words,
        string_agg(word, ' ') OVER (PARTITION BY doc_id, n ORDER BY i ROWS BETWEEN CURRENT ROW AND n - 1 FOLLOWING) AS words
    FROM d_word, (SELECT DISTINCT n FROM win)
), found AS (
    SELECT doc_id, i, win.n AS n, item_id FROM d_at JOIN win ON win.n = d_at.n AND win.words = d_at.words WHERE i + win.n <= n_words
), hit AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
    FROM found GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""
