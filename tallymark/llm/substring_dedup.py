"""Substring dedup: passages of several consecutive units (sentences, or parts of long ones) that were seen before are removed."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm.common import ship, table
from tallymark.sources.scratch import write_through

SENTENCES = 2  # a span has at least so many units
WORDS = 20  # and so many words
LONGEST = 16  # a sentence of more words is cut further
SPANS_IN_ROW = 100_000
WINDOW = 8  # of so many words in a row of a long sentence, the one with the least hash begins a unit
MARKS = "\u3002\uff01\uff1f\uff61\u0964\u0965\u061f\u06d4\u1362"  # full stops that need no white space behind them
BOUNDARY = re.compile(r"[.!?]+\s+|\s*\n\s*")
MARKED_BOUNDARY = re.compile(rf"[.!?]+\s+|\s*\n\s*|[{MARKS}]+\s*")
ANY_MARK = re.compile(f"[{MARKS}]")
# Scripts written without blanks: each character counts as a word.
UNSPACED = "\u0e00-\u0eff\u0f00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
ANY_UNSPACED = re.compile(f"[{UNSPACED}]")
BLANK = np.array([chr(k).isspace() for k in range(0x3002)])  # there are none beyond
PRIMES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.cache
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The first 2 ** bits powers of both primes and of their inverses modulo 2 ** 64."""
    inverse = np.array([pow(int(p), -1, 1 << 64) for p in PRIMES], np.uint64)
    return tuple(np.cumprod(np.concatenate([np.ones((1, 2), np.uint64), np.broadcast_to(of, ((1 << bits) - 1, 2))]), axis=0, dtype=np.uint64) for of in (PRIMES, inverse))


def run_hashes(values: np.ndarray, first: np.ndarray, end: np.ndarray, prime: int) -> np.ndarray:
    """Hash of each run ``values[first:end]``: a polynomial in a prime, from sums of all that stands before."""
    powers, inverse = (p[:, prime] for p in _powers(max(10, len(values).bit_length())))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers[: len(values)], out=sums[1:])
    return (sums[end] - sums[first]) * inverse[first]


def _sentences(text: str) -> list[int]:
    boundary = MARKED_BOUNDARY if not text.isascii() and ANY_MARK.search(text) else BOUNDARY
    return [0, *(m.end() for m in boundary.finditer(text) if m.end() < len(text))] if text else []


def _small(text: str) -> str:
    """In lower case, place by place: a letter whose small form is longer stays."""
    small = text.lower()
    return small if len(small) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def _units(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int], np.ndarray]:
    """Hashes of the words of a text, the number of the word each of its sentences begins with, and of each further unit;
    where sentences and words begin.

    Whether a word begins a unit depends on the words less than ``WINDOW`` before and behind it, so a passage is cut
    alike in whatever it stands, but for its first and last words. No unit of a long sentence has more than ``WINDOW`` words.
    """
    starts = _sentences(text)
    codes = np.frombuffer(_small(text).encode("utf-32-le", "surrogatepass"), np.uint32)
    solid = ~BLANK[np.minimum(codes, len(BLANK) - 1)]
    begin = solid.copy()
    begin[1:] &= ~solid[:-1]
    if not text.isascii() and ANY_UNSPACED.search(text):
        alone = np.zeros(len(codes), bool)
        alone[[m.start() for m in ANY_UNSPACED.finditer(text)]] = True
        begin |= alone
        begin[1:] |= alone[:-1] & solid[1:]
    begin[starts[1:]] = True
    places = np.flatnonzero(begin)
    hashes = _mixed(run_hashes((codes.astype(np.uint64) + np.uint64(1)) * solid, places, np.append(places[1:], len(codes)), 0)) if len(places) else np.zeros(0, np.uint64)
    begins = np.searchsorted(places, starts)
    counts = np.diff(np.append(begins, len(places)))
    if not len(counts) or counts.max() <= LONGEST:
        return hashes, begins, begins[:0], starts, places
    windows = len(hashes) - WINDOW + 1
    least, place = hashes[:windows], np.arange(windows)
    for k in range(1, WINDOW):
        here = hashes[k : windows + k]
        place = np.where(here <= least, np.arange(k, windows + k), place)
        least = np.minimum(here, least)
    sentence = np.repeat(np.arange(len(counts)), counts)
    whole = (sentence[:windows] == sentence[WINDOW - 1 :]) & (counts > LONGEST)[sentence[:windows]]
    further = np.zeros(len(hashes), bool)
    further[place[whole]] = True
    further[begins[counts > 0]] = False
    return hashes, begins, np.flatnonzero(further), starts, places


def sentence_starts(text: str) -> list[int]:
    """Where units begin: sentences, and parts of sentences of more than ``LONGEST`` words.

    Sentences begin at 0, after a sentence mark with white space, after a full stop of another script, and after a line end.
    Blanks belong to the unit before.
    """
    _, _, further, starts, places = _units(text)
    return sorted([*starts, *places[further].tolist()]) if len(further) else starts


def spans(text: str | None, least_sentences: int = SENTENCES, least_words: int = WORDS) -> np.ndarray:
    """Columns start, end (unit numbers), and two 64-bit hashes of the words of each span."""
    return counted_spans(text, least_sentences, least_words)[1]


def counted_spans(text: str | None, least_sentences: int = SENTENCES, least_words: int = WORDS) -> tuple[int, np.ndarray]:
    """The number of units, and the spans.

    From every unit on, and up to every unit, runs the shortest span with enough units and words: whatever a
    repeated passage starts or ends with is then covered by a span inside the passage.
    """
    hashes, begins, further, sentences, _ = _units(text or "")
    units_in_text = len(sentences) + len(further)
    counted = np.append(np.sort(np.concatenate([begins, further])), len(hashes))  # words before each unit
    n = len(counted) - 1
    if n < least_sentences:
        return units_in_text, np.zeros((0, 4), np.int64)
    first = np.arange(n)
    to = np.maximum(first + least_sentences, np.searchsorted(counted, counted[:-1] + least_words))
    last = np.arange(1, n + 1)
    since = np.minimum(last - least_sentences, np.searchsorted(counted, counted[1:] - least_words, side="right") - 1)
    found = np.unique(np.concatenate([(first * (n + 1) + to)[to <= n], (since * (n + 1) + last)[since >= 0]]))
    start, end = found // (n + 1), found % (n + 1)
    # Mixed, so that the words of a unit are not the words of two.
    units = _mixed(run_hashes(hashes, counted[:-1], counted[1:], 0) + PRIMES[1])
    checks = [run_hashes(units, start, end, prime).view(np.int64) for prime in (0, 1)]
    return units_in_text, np.stack([start, end, *checks], 1)


SPANS = "row long, _id long, _hash long, n_sentences int, start array<int>, units array<int>, hash array<long>, check array<int>"


def all_spans(docs: DataFrame) -> DataFrame:
    """Spans of all rows, as arrays: columns as in ``SPANS``. A text with more than ``SPANS_IN_ROW`` of them has several rows, of
    which the first tells the number of its units.

    ``hash`` and ``check`` together are 96 bits of a span's words.
    """

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [counted_spans(text) for text in batch.column("text").to_pylist()]
            found = [f for _, f in both]
            lengths = np.array([len(f) for f in found], np.int64)
            parts = np.maximum(1, -(-lengths // SPANS_IN_ROW))
            of = np.repeat(np.arange(len(found)), parts)
            first = (np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)) * SPANS_IN_ROW
            sizes = np.minimum(lengths[of] - first, SPANS_IN_ROW)
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            rows = np.concatenate(found) if found else np.zeros((0, 4), np.int64)
            start, end, hashes, checks = rows.T
            values = (start.astype(np.int32), (end - start).astype(np.int32), np.ascontiguousarray(hashes), (checks >> 32).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(column)) for column in values]
            keys = [batch.column(name).take(pa.array(of)) for name in ("row", "_id", "_hash")]
            units = pa.array(np.array([n for n, _ in both], np.int32)[of], mask=first > 0)
            yield pa.RecordBatch.from_arrays([*keys, units, *lists], ["row", "_id", "_hash", "n_sentences", "start", "units", "hash", "check"])

    return docs.select(F.monotonically_increasing_id().alias("row"), "_id", "_hash", "text").mapInArrow(arrays, SPANS)


def repeated_sentences(docs: DataFrame) -> DataFrame:
    """For every text ``_id, _hash, n`` (the number of its units) and ``cuts``, the ranges of units to remove (start, end), if any.

    Spans are computed and written once, as arrays; a place is a row's number, which is shorter than its hash. Hashes are counted over all documents first, narrow and pre-aggregated;
    places are then looked up only for hashes that occur more than once, shuffled at every size. The first place, by id and sentence,
    keeps its span; a very common span is one row per map task where it is counted, and a hot key of an inner join, which
    is split, where its first place is told to the others.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_hash"), "text")
    found = write_through(all_spans(rows), "spans")
    several = write_through(found.select(F.explode("hash").alias("hash")).groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), "span-hashes")
    each = found.select("row", "_id", F.explode(F.arrays_zip("start", "units", "hash", "check")).alias("s")).select("row", "_id", "s.*")
    places = write_through(each.join(several, "hash"), "span-places")
    firsts = places.groupBy("hash", "check").agg(F.min(F.struct(F.col("_id").isNull().alias("no_id"), "_id", "start")).alias("first"))
    firsts = write_through(firsts, "span-firsts")  # read back, it has an exchange of its own below the join, which can then be split
    told = places.join(firsts, ["hash", "check"])
    later = told.where(~(F.col("_id").eqNullSafe(F.col("first._id")) & (F.col("start") == F.col("first.start"))))
    cuts = later.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("units")).alias("end")))).alias("cuts"))
    whole = found.where("n_sentences is not null").select("row", "_id", "_hash", "n_sentences")
    # Rows that repeat an id and a text have equal cuts.
    return whole.join(cuts, "row", "left").groupBy("_id", "_hash").agg(F.max("n_sentences").alias("n"), F.max("cuts").alias("cuts"))


def without_cuts(text: str | None, n: int, cuts) -> tuple[str | None, int, int]:
    """What is left of a text of ``n`` units, how many it had, and how many were removed. Units are looked up again only where some are removed."""
    if cuts is None or not len(cuts):
        return text, n, 0
    starts = sentence_starts(text or "")
    gone = np.zeros(len(starts), bool)
    for cut in cuts:
        gone[cut["start"] : cut["end"]] = True
    ends = [*starts[1:], len(text)]
    return "".join(text[a:b] for a, b, g in zip(starts, ends, gone) if not g), len(starts), int(gone.sum())


def substring_dedup(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, text`` (what is left), ``n_sentences, n_removed``.

    A unit is a sentence, or a part of one of more than ``LONGEST`` words. A span is a run of consecutive units with at least
    ``SENTENCES`` units and ``WORDS`` words; spans are equal if their units' words are, in lower case. Every unit inside a
    span whose first place, by id and position, is another one is removed, with the white space after it, and both counts
    are of units. Any repeated passage of 52 words holds a span wherever it begins and ends: at most 16 words at either
    end belong to units that are not whole or are cut otherwise there. A document without repeated spans keeps its text.

    NULL texts stay NULL and have no sentences. Rows that repeat an id and a text are one place and keep or lose the same
    sentences. NULL ids come last. An empty table gives no rows; other columns are not read.
    """
    ship(docs.sparkSession)
    cuts = write_through(repeated_sentences(docs), "span-cuts")
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("of"))
    known = rows["doc_id"].eqNullSafe(cuts["_id"]) & (rows["of"] == cuts["_hash"])
    # Cuts grow with the documents, so texts are always shuffled to them, never the other way.
    joined = rows.join(cuts, known, "left").select("doc_id", "text", "n", "cuts")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            left = [without_cuts(*row) for row in zip(batch["text"], batch["n"], batch["cuts"])]
            yield pd.DataFrame(left, columns=["text", "n_sentences", "n_removed"]).assign(doc_id=batch["doc_id"].to_numpy())

    return joined.mapInPandas(cut, "text string, n_sentences long, n_removed long, doc_id long").select("doc_id", "text", "n_sentences", "n_removed")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))
