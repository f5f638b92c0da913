"""Labelled samples and hashed text features that the classifiers share."""

from __future__ import annotations

import functools
import gc
import re
import weakref
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import held_out

REMEMBERED, ALL_REMEMBERED = 300_000, 600_000
LEFT_BEHIND = 100_000  # so much of other memories goes when one is begun
PART_ROWS = 256  # rows of an Arrow batch whose texts are Python strings at once
EDGES = ".,;:!?\"'()[]{}<>«»“”‘’…*#%&$@-–—_/\\|~^+="


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, at_most: int) -> DataFrame:
    """Rows ``doc_id, text, label`` to learn from: at most ``at_most`` different ones outside the held-out fold.

    Which rows are taken depends on hashes of the id and the text alone. An id with several labels counts as 1 if any is 1;
    NULL ids and labels are left out. Rows are chosen as ids and hashes, of an id with any number of rows too, so only the
    texts of chosen rows move; rows that repeat an id and a text are one. What is broadcast to the scans of the documents is
    at most ``at_most`` ids or hashes. Empty tables give an empty sample.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).where(~held_out(F.col("doc_id")))
    one = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(at_most)
    texts = docs.select("doc_id", "text")
    hashed = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", F.xxhash64("text").alias("_hash")).distinct()
    rows = hashed.orderBy(F.xxhash64("doc_id"), "doc_id", "_hash").limit(at_most)
    taken = texts.withColumn("_hash", F.xxhash64("text")).join(F.broadcast(rows), ["doc_id", "_hash"])
    return taken.select("doc_id", "text", "label").distinct()


def uncollected(function):
    """Run ``function`` without the cycle collector: it makes no cycles, and a memory is walked in every collection."""

    @functools.wraps(function)
    def run(*args, **options):
        on = gc.isenabled()
        gc.disable()
        try:
            return function(*args, **options)
        finally:
            if on:
                gc.enable()

    return run


def in_parts(batches: Iterable[pa.RecordBatch | pa.Array]) -> Iterator[pa.RecordBatch | pa.Array]:
    """All rows of Arrow batches in order, ``PART_ROWS`` at a time: a task's texts are often one batch, and as Python strings they would
    stand beside it. When the batches end, the worker, which outlives the task, gives back what Arrow holds free."""
    for batch in batches:
        for at in range(0, len(batch), PART_ROWS):
            yield batch.slice(at, PART_ROWS)
    batch = None
    pa.default_memory_pool().release_unused()


class Memory(dict):
    """What a Python worker remembers across tasks. All memories of a worker together have a bound: one that needs room
    empties the others, which belong to other steps of a job. So does one that is begun, of what a step before it left behind."""

    _all: list[weakref.ref] = []

    def __init__(self):
        super().__init__()
        Memory._all.append(weakref.ref(self))

    def make_room(self) -> None:
        Memory._all[:] = [r for r in Memory._all if r() is not None]
        memories = [r() for r in Memory._all]
        if sum(map(len, memories)) > (ALL_REMEMBERED if self else LEFT_BEHIND):
            for other in memories:
                if other is not self:
                    other.clear()


class Remembered(Memory):
    """A bounded memory of a function of one text."""

    def __init__(self, function):
        super().__init__()
        self.function, self.made = function, 0

    def __missing__(self, key):
        value = self.function(key)
        self.made += 1
        if self.made % 10_000 == 0 or not self:
            self.make_room()
        if len(self) >= REMEMBERED:
            self.clear()
        if len(key) <= 64:
            self[key] = value
        return value


def bucket(text: str, size: int, seed: int = 0) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass"), seed) % size


def shape(piece: str) -> str:
    """Letters as a or A, digits as 0, other characters as they are; runs of three or more of one kind become two.

    The whole piece is looked at, whatever its length. A word of small letters, or with a capital first, is told at once;
    marks behind it stay.
    """
    core = piece.rstrip(".,;:!?")
    marks = piece[len(core) :]
    if core.isalpha():
        if core.islower():
            return "aa" + marks
        if core[1:].islower():
            return "Aaa" + marks
    kinds = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in piece)
    return re.sub(r"(.)\1{2,}", r"\1\1", kinds)


def _byte_classes() -> np.ndarray:
    """Class of each byte of UTF-8: upper case, lower case, digit, blank, line end, sentence mark, other mark, beyond ASCII."""
    classes = np.full(256, 6)
    for k, chars in enumerate(("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", " \t", "\n\r", ".,;:!?'\"-")):
        classes[[ord(c) for c in chars]] = k
    classes[128:] = 7
    return classes


BYTE_CLASSES = _byte_classes()
STATISTICS = 8 + 8


def statistics(text: str, pieces: list[str], distinct: int) -> list[float]:
    """Shares of the byte classes, and sizes, repetition and shape of words and lines."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    shares = np.bincount(BYTE_CLASSES, np.bincount(data, minlength=256), 8) / max(1, len(data))
    lines = [line for line in text.split("\n") if line]
    n = max(1, len(pieces))
    return [
        *shares,
        np.log1p(len(text)),
        np.log1p(len(pieces)),
        len(text) / n,
        distinct / n,
        len(set(lines)) / max(1, len(lines)),
        len(lines) / n,
        np.log1p(max(map(len, pieces), default=0)),
        np.log1p(max(map(len, lines), default=0)),
    ]


def logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def rows_of(arrays: Iterable[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All arrays in one, and where each begins."""
    arrays = list(arrays)
    lengths = np.array([len(a) for a in arrays], dtype=np.int64)
    starts = np.cumsum(lengths) - lengths
    return (np.concatenate(arrays) if arrays else np.zeros(0)), starts
