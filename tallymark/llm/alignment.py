"""Cross-tokenizer alignment: where two tokenizers cut a text at the same byte, and which of their tokens overlap."""

from __future__ import annotations

import functools
import hashlib
import os
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm.common import bounded, ship, table
from tallymark.llm.features import Memory, uncollected
from tallymark.sources.scratch import write_through

TEXTS_AT_ONCE, CHARACTERS_AT_ONCE = 512, 2_000_000
PIECES_KNOWN = 400_000
LONGEST_KNOWN = 64
GALLOP = 512  # ends of the shorter list that are searched for together
PAIRS_IN_ROW = 100_000
COUNT_BYTES = 48
BLANK_BETWEEN = re.compile(r"(?<=\S) (?=\S)")
OTHER_BLANKS = re.compile(r"\s\s|^\s|\s$")
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


@functools.cache
def byte_of_letter() -> dict[str, int]:
    """How byte-level vocabularies spell bytes: printable ones as themselves, the others in order from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


def galloping_intersection(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and in ``b`` of the values that both ascending lists hold.

    The shorter list leads. From where the last of its values was found, steps that double in length bracket the next
    ones in the longer list, and a binary search finds them inside the bracket; so the cost is the shorter list times
    the logarithm of the gaps, and what lies between is not read. ``GALLOP`` values go together.
    """
    if len(a) > len(b):
        second, first = galloping_intersection(b, a)
        return first, second
    places, at = [], 0
    for start in range(0, len(a), GALLOP):
        values = a[start : start + GALLOP]
        step, end = len(values), min(len(b), at + len(values))
        while end < len(b) and b[end - 1] < values[-1]:
            step *= 2
            end = min(len(b), end + step)
        found = at + np.searchsorted(b[at:end], values)
        places.append(found)
        at = int(found[-1])
    place = np.concatenate(places) if places else np.zeros(0, np.int64)
    common = np.flatnonzero((place < len(b)) & (b[np.minimum(place, len(b) - 1)] == a)) if len(b) else np.zeros(0, np.int64)
    return common, place[common]


class Pair:
    """Two tokenizers, A (byte level) and B (pieces with byte fallback), and what they make of pieces of text.

    Where a single blank stands between two other characters both tokenizers cut before the blank: A's pattern starts a
    new word there, and no entry of B has its blank mark behind another character (checked). So a text is encoded piece by
    piece, and the ids of frequent pieces are remembered.
    """

    def __init__(self, a_definition: str, b_model: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_definition)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        letters, a_size = byte_of_letter(), self.a.get_vocab_size()
        self.a_bytes = [b""] * a_size
        for token, number in self.a.get_vocab().items():
            self.a_bytes[number] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(m[1], 16)]) if (m := BYTE_PIECE.fullmatch(p)) else p.replace("▁", " ").encode() for p in pieces]
        self.in_pieces = not any("▁" in p.lstrip("▁") for p in pieces)
        self.lengths = [np.array([len(t) for t in entries], np.int64) for entries in (self.a_bytes, self.b_bytes)]
        self.names = [{mark: np.array([f"{k}{mark}" for k in range(len(entries))], object) for mark in ",|;"} for entries in (self.a_bytes, self.b_bytes)]
        self.width = len(pieces)
        self.known: dict[str, tuple[bytes, bytes] | None] = Memory()

    def _pieces(self, text: str) -> list[str]:
        if not text:
            return []
        if not self.in_pieces:
            return [text]
        return BLANK_BETWEEN.split(text) if OTHER_BLANKS.search(text) else text.split(" ")

    def _learn(self, pieces: list[str]) -> None:
        """Ids of each piece behind a blank; None where the bytes of either side are not the blank and the piece."""
        spaced = [" " + piece for piece in pieces]
        a_ids = [e.ids for e in self.a.encode_batch_fast(spaced, add_special_tokens=False)]
        b_ids = self.b.encode(pieces, num_threads=1)
        for piece, text, a, b in zip(pieces, spaced, a_ids, b_ids):
            want = text.encode()
            same = b"".join(map(self.a_bytes.__getitem__, a)) == want == b"".join(map(self.b_bytes.__getitem__, b))
            self.known[piece] = (np.array(a, "<u4").tobytes(), np.array(b, "<u4").tobytes()) if same else None

    @uncollected
    def encode(self, texts: Sequence[str | None]) -> list[tuple[bytes, bytes]]:
        """Ids of each text by A and by B; none where the bytes of one side are not those of a blank and the text."""
        split = [self._pieces(text or "") for text in texts]
        known = self.known
        every = set().union(*split)
        new = [piece for piece in every if piece not in known]
        if len(known) + len(new) > PIECES_KNOWN:
            known.clear()
            new = list(every)
        known.make_room()
        self._learn(new)
        told = []
        for pieces in split:
            both = [known[piece] for piece in pieces]
            told.append((b"", b"") if None in both else (b"".join([a for a, _ in both]), b"".join([b for _, b in both])))
        for piece in new:
            if len(piece) > LONGEST_KNOWN:
                del known[piece]
        return told


class Alignment:
    """Tokens of several texts, one behind the other, cut into groups at the bytes where tokens of A and of B both end."""

    def __init__(self, pair: Pair, encoded: Sequence[tuple[bytes, bytes]]):
        self.pair = pair
        self.sides = [np.frombuffer(b"".join(e[side] for e in encoded), "<u4") for side in (0, 1)]
        self.bounds = [np.cumsum([0, *(len(e[side]) // 4 for e in encoded)]) for side in (0, 1)]  # tokens before each text
        self.ends = [np.cumsum(lengths[ids]) for lengths, ids in zip(pair.lengths, self.sides)]
        common = galloping_intersection(*self.ends)
        self.group_ends = [places + 1 for places in common]  # tokens up to the end of each group
        # Texts end where tokens of both end, so a text's groups are those that end within its tokens.
        self.groups = np.searchsorted(self.group_ends[0], self.bounds[0], side="right")

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of A and of B whose bytes overlap. A token's first partner is the one that its first byte lies in, its last
        the one that its last byte lies in: ranks of its two ends among the other side's ends."""
        a_ends, b_ends = self.ends
        a_starts = np.concatenate([np.zeros(min(1, len(a_ends)), np.int64), a_ends[:-1]])
        first, last = np.searchsorted(b_ends, a_starts, side="right"), np.searchsorted(b_ends, a_ends, side="left")
        counts = last - first + 1
        a = np.repeat(np.arange(len(a_ends)), counts)
        return a, np.arange(len(a)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(first, counts)

    def digests(self) -> list[str]:
        """SHA-256 of each text's groups, written as ``a1,a2|b1;a3|b2,b3``; the empty text without groups."""
        (a, b), (a_to, b_to), total = self.sides, self.group_ends, sum(map(len, self.sides))
        written = np.empty(total, object)
        sizes = [np.diff(to, prepend=0) for to in (a_to, b_to)]
        # A token of A stands behind all tokens of B in groups before its own; one of B also behind its own group's A.
        a_place = np.arange(len(a)) + np.repeat(b_to - sizes[1], sizes[0])
        b_place = np.arange(len(b)) + np.repeat(a_to, sizes[1])
        for ids, place, to, mark, names in ((a, a_place, a_to, "|", self.pair.names[0]), (b, b_place, b_to, ";", self.pair.names[1])):
            written[place] = names[","][ids]
            written[place[to - 1]] = names[mark][ids[to - 1]]
        tokens, bounds = written.tolist(), (self.bounds[0] + self.bounds[1]).tolist()
        return [hashlib.sha256("".join(tokens[s:e])[:-1].encode()).hexdigest() if e > s else "" for s, e in zip(bounds, bounds[1:])]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each text the distinct linked pairs of ids (a * width + b) and how often, where each text's begin, and its links."""
        a, b = self.links()
        text = np.searchsorted(self.bounds[0], a, side="right") - 1
        of = self.sides[0][a].astype(np.int64) * self.pair.width + self.sides[1][b]
        reach = len(self.pair.a_bytes) * self.pair.width
        found, times = np.unique(text * reach + of, return_counts=True)
        n = len(self.bounds[0]) - 1
        return found % reach, times, np.searchsorted(found, np.arange(n + 1) * reach), np.bincount(text, minlength=n)


_PAIRS: dict[int, Pair] = {}


def pair_of(a_definition: str, b_model: bytes) -> Pair:
    """One per Python worker, so what it remembers serves all its tasks."""
    key = zlib.crc32(b_model, zlib.crc32(a_definition.encode()))
    if key not in _PAIRS:
        _PAIRS.clear()
        _PAIRS[key] = Pair(a_definition, b_model)
    return _PAIRS[key]


def together(texts: Sequence[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts that are aligned at once: bounded by number and by characters, one text at least."""
    start = size = 0
    for k, text in enumerate(texts):
        if k > start and (k - start >= TEXTS_AT_ONCE or size + len(text or "") > CHARACTERS_AT_ONCE):
            yield start, k
            start, size = k, 0
        size += len(text or "")
    if start < len(texts):
        yield start, len(texts)


ALIGNED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"


def aligned(docs: DataFrame, a_definition: str, b_model: bytes) -> DataFrame:
    """Each text's digest columns, and its linked pairs of ids with how often; columns as in ``ALIGNED``.

    ``row`` names the row. Pairs beyond ``PAIRS_IN_ROW`` come in further rows, whose digest columns are NULL.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((a_definition, b_model))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(*shared.value)
        for batch in batches:
            rows, ids, texts = (batch.column(name) for name in ("row", "doc_id", "text"))
            texts = texts.to_pylist()
            for start, end in together(texts):
                found = Alignment(pair, pair.encode(texts[start:end]))
                of, times, begin, links = found.pairs()
                digest = [rows[start:end], ids[start:end], *(np.diff(x) for x in (*found.bounds, found.groups)), links, pa.array(found.digests(), pa.string())]
                cuts = np.minimum(begin[:-1] + PAIRS_IN_ROW, begin[1:])
                # Each text's first pairs stand beside its digest; a list of pairs is a slice of all.
                for lists in ([(begin[:-1], cuts, digest)], _rest(rows[start:end], cuts, begin[1:])):
                    for first, last, columns in lists:
                        yield _batch(columns, first, last, of, times)

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return numbered.mapInArrow(align, ALIGNED)


def _batch(columns: list, first: np.ndarray, last: np.ndarray, of: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
    sizes = last - first
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    at = np.repeat(first - offsets[:-1], sizes) + np.arange(offsets[-1])
    lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[at].astype(np.int64))) for values in (of, times)]
    names = [field.split()[0] for field in ALIGNED.split(", ")]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c.astype(np.int64)) for c in columns] + lists, names)


def _rest(rows: pa.Array, first: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, list]]:
    """Pairs beyond the first row of a text, ``PAIRS_IN_ROW`` at a time."""
    for k in np.flatnonzero(first < end):
        for at in range(int(first[k]), int(end[k]), PAIRS_IN_ROW):
            empty = [pa.nulls(1, pa.string() if name == "groups_sha256" else pa.int64()) for name in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")]
            yield np.array([at]), np.array([min(at + PAIRS_IN_ROW, end[k])]), [rows[int(k) : int(k) + 1], *empty]


def tokenizer_files(a_path: str | None = None, b_path: str | None = None) -> tuple[str, bytes]:
    """The two tokenizers' files; by default a byte-level and a piece vocabulary of ``public_tokenizers``."""
    with open(a_path or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as a, open(b_path or public_tokenizers.path("piece_bpe_32k.model"), "rb") as b:
        return a.read(), b.read()


def token_alignment(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    Both tokenizers encode a blank and the whole text; strings of special tokens are plain text. Byte offsets at which a
    token of A and a token of B both end cut the tokens into groups. A link is a token of A and one of B that share
    bytes; the count of a pair of ids is the number of its links over all documents. ``n_best`` are a document's links
    whose count is the highest of their id of B, ties included, and ``count_sum`` adds the counts up.

    Texts that are NULL or empty, or that a tokenizer does not give back byte by byte, have no tokens: zeros and an empty
    digest. Very long texts are aligned whole, by themselves, and their pairs are written in several rows. Rows that
    repeat an id, or have none, are each counted and returned. An empty table gives no rows; other columns are not read.

    Texts are read and encoded once, and their distinct pairs written. Pairs are added up before they are shuffled. Their
    counts go to all tasks if their measured size is bounded, and a document's pairs then stay in the task that reads
    them; beyond that they are shuffled by pair, inner, against a written table, so that very common pairs can be split.
    """
    a_definition, b_model = tokenizer_files(a_path, b_path)
    found = write_through(aligned(docs, a_definition, b_model), "aligned")
    width = pair_of(a_definition, b_model).width
    linked = found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    counts = write_through(linked.groupBy("pair").agg(F.sum("times").alias("count")), "pair-counts")
    most = counts.groupBy((F.col("pair") % width).alias("b")).agg(F.max("count").alias("most"))
    ranked = counts.join(most, F.col("pair") % width == F.col("b")).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    ranked = write_through(ranked, "pair-ranks")
    valued = linked.join(bounded(ranked, COUNT_BYTES), "pair")
    sums = valued.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    told = found.where("n_a is not null").drop("pairs", "times").join(sums, "row", "left")
    none = F.lit(0).cast("long")
    return told.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", none).alias("n_best"), F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256"
    )


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment(table(spark, sf_dir, "documents"))
