"""Token ids in shards whose document boundaries are Elias-Fano encoded."""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymark.llm.common import bounded, ship, table
from tallymark.llm.features import Memory, uncollected
from tallymark.sources.scratch import scratch_path

END_ID = 1
SHARD_IDS = 4 << 20  # a shard is closed at the first document end from here on
WORD_END = "</w>"  # how the vocabulary marks a word's last token
BEYOND_LATIN = "[^\x01-\u012f\u0131-\u024f]"  # up to there lower case is the same in every library, but that of one letter
ADDED = "<|"  # how tokens begin that are looked for before anything is lower-cased
PLAIN, MARKS = "^[a-zß-öø-ÿ]+$", ".,;:!?"
LETTERS = "".join(c for c in map(chr, range(256)) if re.match(PLAIN, c))
TOTAL_ROW_BYTES = 32
MAGIC = b"TMEF"
HEADER = struct.Struct("<4sBBHQQQQ")  # magic, version, bytes of an id, low bits, documents, ids, bytes of upper bits, select samples
SAMPLE = 256  # every so many set bits the position is kept


class EliasFano:
    """A non-decreasing sequence of n values up to ``last`` in about n * (2 + log2(last / n)) bits.

    The low bits of each value stand side by side; the high parts are a bit vector with value i's bit at (high part + i).
    ``samples`` holds the position of every ``SAMPLE``-th set bit, so ``select`` reads a few words wherever it looks.
    """

    def __init__(self, n: int, low_bits: int, low: np.ndarray, upper: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.upper, self.samples = n, low_bits, low, upper, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n, last = len(values), int(values[-1])
        low_bits = max(0, (last // n).bit_length() - 1)
        low = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        places = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(places[-1]) + 1, dtype=np.uint8)
        bits[places] = 1
        packed = np.packbits(low.astype(np.uint8).ravel(), bitorder="little")
        return cls(n, low_bits, packed, np.packbits(bits, bitorder="little"), places[::SAMPLE].astype("<u4"))

    def values(self) -> np.ndarray:
        places = np.flatnonzero(np.unpackbits(self.upper, bitorder="little"))[: self.n]
        high = (places - np.arange(self.n)).astype(np.uint64)
        return ((high << np.uint64(self.low_bits)) | self._low(0, self.n)).astype(np.int64)

    def _low(self, start: int, count: int) -> np.ndarray:
        if not self.low_bits or not count:
            return np.zeros(count, dtype=np.uint64)
        first, end = start * self.low_bits, (start + count) * self.low_bits
        bits = np.unpackbits(self.low[first // 8 : -(-end // 8)], bitorder="little")[first % 8 :][: end - first]
        return bits.reshape(count, self.low_bits).astype(np.uint64) @ (np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64))

    def select(self, i: int) -> int:
        """Value ``i``, from the nearest sample on."""
        place, passed = int(self.samples[i // SAMPLE]), i % SAMPLE
        at = place // 8
        bits = np.unpackbits(self.upper[at : at + 1], bitorder="little")
        bits[: place % 8] = 0
        left = passed
        while (ones := int(bits.sum())) <= left:
            left -= ones
            at += 1
            bits = np.unpackbits(self.upper[at : at + 1], bitorder="little")
        place = at * 8 + int(np.flatnonzero(bits)[left])
        return ((place - i) << self.low_bits) | int(self._low(i, 1)[0])


def pack_shard(ids: np.ndarray, offsets: Sequence[int]) -> bytes:
    """Header, low bits, upper bits, select samples, ids. ``offsets`` has one more entry than there are documents."""
    ef = EliasFano.of(np.asarray(offsets))
    header = HEADER.pack(MAGIC, 1, ids.dtype.itemsize, ef.low_bits, ef.n - 1, len(ids), len(ef.upper), len(ef.samples))
    return b"".join((header, ef.low.tobytes(), ef.upper.tobytes(), ef.samples.tobytes(), ids.tobytes()))


class Shard:
    """A packed shard: ``len()`` documents, ``[i]`` the ids of one of them, ``offsets()`` where each begins."""

    def __init__(self, blob: bytes):
        magic, version, width, low_bits, self.documents, self.ids_total, upper, samples = HEADER.unpack_from(blob)
        if magic != MAGIC or version != 1:
            raise ValueError("not a shard of token ids")
        at = HEADER.size
        low = np.frombuffer(blob, np.uint8, -(-low_bits * (self.documents + 1) // 8), at)
        at += len(low)
        high = np.frombuffer(blob, np.uint8, upper, at)
        at += upper
        self.bounds = EliasFano(self.documents + 1, low_bits, low, high, np.frombuffer(blob, "<u4", samples, at))
        self.ids = np.frombuffer(blob, f"<u{width}", self.ids_total, at + 4 * samples)

    def __len__(self) -> int:
        return self.documents

    def __getitem__(self, i: int) -> np.ndarray:
        return self.ids[self.bounds.select(i) : self.bounds.select(i + 1)]

    def offsets(self) -> np.ndarray:
        return self.bounds.values()


def gathered(values: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> np.ndarray:
    """``values`` holds runs of ``lengths`` side by side; the runs ``which`` in a row."""
    starts, taken = np.cumsum(lengths) - lengths, lengths[which]
    places = np.repeat(starts[which] - (np.cumsum(taken) - taken), taken)
    places += np.arange(len(places))
    return values[places]


class Encoder:
    """Ids of whole texts by the tokenizers library, piece by piece between blanks and line ends.

    The vocabulary drops white space and lower-cases, and no token, normalisation or special token reaches across a blank,
    so the pieces' ids in a row are the text's ids. A plain word (small Latin letters) and the sentence marks behind it
    are pieces of their own; normalising and splitting change nothing about plain words, so a copy of the tokenizer that
    leaves these steps out encodes them, many at once: each word's last token says that it ends a word. Texts are taken many
    at once: each piece of theirs is encoded once, and nothing is remembered beyond them.
    """

    def __init__(self, definition: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer, self.plain = Tokenizer.from_str(definition), Tokenizer.from_str(definition)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.ends[number] = token.endswith(WORD_END)

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        ids, bounds = self.encode_all(pa.array(texts, pa.string()))
        return [ids[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]

    @uncollected
    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, each text with its ``END_ID``, and where each begins, with one more entry than there are texts."""
        texts = pc.fill_null(texts, "")
        as_it_is = pc.or_(pc.match_substring(texts, ADDED), pc.match_substring_regex(texts, BEYOND_LATIN))
        lowered = pc.if_else(as_it_is, texts, pc.utf8_lower(texts))
        split = pc.split_pattern(pc.replace_substring(lowered, "\n", " "), " ")
        found = split.flatten().dictionary_encode()
        ids, lengths = self._pieces(found.dictionary)
        ids, lengths = np.append(ids, self.dtype.type(END_ID)), np.append(lengths, 1)
        ends = np.cumsum(split.value_lengths().to_numpy(zero_copy_only=False))
        pieces = np.insert(found.indices.to_numpy(), ends, len(lengths) - 1)
        bounds = np.cumsum(lengths[pieces])[ends + np.arange(len(ends))]
        return gathered(ids, lengths, pieces), np.concatenate([np.zeros(1, np.int64), bounds])

    def _pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of different pieces side by side, and how many each has. A piece is a word and the marks behind it, or something else and nothing."""
        cores = pc.utf8_rtrim(pieces, characters=MARKS)
        plain = pc.match_substring_regex(cores, PLAIN)
        words = pc.filter(cores, plain).dictionary_encode()
        marks = pc.utf8_ltrim(pc.filter(pieces, plain), characters=LETTERS).dictionary_encode()
        others = pc.filter(pieces, pc.invert(plain)).to_pylist()
        word_ids, word_lengths = self._words(words.dictionary.to_pylist())
        encoded = self._ids(self.tokenizer, ["", *others, *marks.dictionary.to_pylist()], 10_000)
        lengths = np.concatenate([word_lengths, np.fromiter(map(len, encoded), np.int64, len(encoded))])
        nothing = len(words.dictionary)
        parts, is_word = np.full((len(pieces), 2), nothing), plain.to_numpy(zero_copy_only=False)
        parts[is_word, 0] = words.indices.to_numpy()
        parts[is_word, 1] = nothing + 1 + len(others) + marks.indices.to_numpy()
        parts[~is_word, 0] = nothing + 1 + np.arange(len(others))
        ids = np.concatenate([word_ids, *encoded])
        return gathered(ids, lengths, parts.ravel()), lengths[parts].sum(1)

    def _ids(self, tokenizer, texts: list[str], at_once: int) -> list[np.ndarray]:
        """What the library tells of a token besides its id takes more than the texts do, so it is dropped soon."""
        parts = (texts[at : at + at_once] for at in range(0, len(texts), at_once))
        return [np.array(e.ids, self.dtype) for part in parts for e in tokenizer.encode_batch_fast(part, add_special_tokens=False)]

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lines = [" ".join(words[at : at + 100]) for at in range(0, len(words), 100)]
        flat = np.concatenate([np.zeros(0, self.dtype), *self._ids(self.plain, lines, 100)])
        bounds = np.flatnonzero(self.ends[flat]) + 1
        if len(bounds) != len(words):
            raise ValueError("a plain word is not one piece of the tokenizer")
        return flat, np.diff(bounds, prepend=0)


_ENCODERS: dict[int, Encoder] = {}


def encoder(definition: str) -> Encoder:
    """One per Python worker, as it takes a while to build."""
    key = zlib.crc32(definition.encode())
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(definition)
    return _ENCODERS[key]


SHARD_SCHEMA = "part int, shard int, first_id long, documents long, ids long, doc_ids array<long>, blob binary"
SHARD_ARROW = pa.schema(
    [("part", pa.int32()), ("shard", pa.int32()), ("first_id", pa.int64()), ("documents", pa.int64()), ("ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("blob", pa.binary())]
)
TEXTS_AT_ONCE = 512
TEXT_BYTES = 4 << 20  # about so much text is encoded at once, by one text over it at most


def runs_of_texts(keys: pa.Array, texts: pa.Array) -> Iterator[tuple[pa.Array, pa.Array]]:
    """All rows, in runs of about ``TEXT_BYTES``."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    cuts = [0, *(np.flatnonzero(np.diff(ends // TEXT_BYTES)) + 1).tolist(), len(texts)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield keys.slice(a, b - a), texts.slice(a, b - a)


def write_tokens(docs: DataFrame, path: str, definition: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of ``docs`` in ascending order of id to ``path``: Parquet files with one packed shard in each row.

    Parts are ranges of ids (part 0 has the smallest), shards are in order inside a part, ``first_id`` counts the ids
    before a shard in its part. NULL texts are empty; every document ends with ``END_ID``. NULL ids come first. Rows that
    repeat an id stay side by side. Spark writes the files, so every file system it knows and its commit protocol hold.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(definition)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        Memory().make_room()
        encode, part = encoder(shared.value), TaskContext.get().partitionId()
        shard, first = 0, 0
        doc_ids: list[int | None] = []
        packed: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal shard, first, held
            ids = np.concatenate(packed)
            offsets = np.cumsum([0, *map(len, packed)])
            row = {"part": part, "shard": shard, "first_id": first, "documents": len(packed), "ids": len(ids), "doc_ids": doc_ids, "blob": pack_shard(ids, offsets)}
            row = pa.RecordBatch.from_pylist([row], SHARD_ARROW)
            shard, first, held = shard + 1, first + len(ids), 0
            doc_ids.clear()
            packed.clear()
            return row

        for batch in batches:
            for keys, texts in runs_of_texts(batch.column("doc_id"), batch.column("text")):
                ids, bounds = encode.encode_all(texts)
                for key, a, b in zip(keys.to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                    doc_ids.append(key)
                    packed.append(ids[a:b])
                    held += b - a
                    if held >= SHARD_IDS:
                        yield flush()
        if packed:
            yield flush()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ranged = ordered.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id")
    ranged.mapInArrow(pack, SHARD_SCHEMA).write.mode("overwrite").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Documents of ``path``: ``doc_id, start`` (ids of all documents before), ``n_tokens, ids`` (little-endian, 32 bits each)."""
    ship(spark)
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    totals = shards.groupBy("part").agg(F.sum("ids").alias("ids"))
    before = F.coalesce(F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = bounded(totals.select("part", before.alias("base")), TOTAL_ROW_BYTES)  # one row per part

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first, keys, blob in zip(batch["first"], batch["doc_ids"], batch["blob"]):
                shard = Shard(blob)
                offsets = shard.offsets()
                keys = list(keys)
                for at in range(0, len(shard), TEXTS_AT_ONCE):
                    end = min(at + TEXTS_AT_ONCE, len(shard))
                    yield pd.DataFrame(
                        {
                            "doc_id": pd.array([None if pd.isna(k) else int(k) for k in keys[at:end]], dtype="Int64"),
                            "start": first + offsets[at:end],
                            "n_tokens": np.diff(offsets[at : end + 1]),
                            "ids": [shard.ids[a:b].astype("<u4").tobytes() for a, b in zip(offsets[at:end], offsets[at + 1 : end + 1])],
                        }
                    )

    placed = shards.join(bases, "part").select((F.col("base") + F.col("first_id")).alias("first"), "doc_ids", "blob")
    return placed.mapInPandas(unpack, "doc_id long, start long, n_tokens long, ids binary")


def tokenizer_definition(path: str | None = None) -> str:
    with open(path or public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        return file.read()


def token_digest(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """Write ``docs`` as token ids, read the files back: ``doc_id, start, n_tokens, ids_crc32``."""
    path = scratch_path(docs.sparkSession, "token-ids")
    write_tokens(docs, path, tokenizer_definition(tokenizer_path))
    return read_tokens(docs.sparkSession, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digest(table(spark, sf_dir, "documents"))
