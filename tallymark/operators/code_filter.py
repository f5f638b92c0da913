"""A filter of codes too many to broadcast: some bits for each, by which a scan drops nearly all rows of other codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_FILTER_BYTES = 128 << 20
BITS_PER_CODE, PROBES = 12, 3  # one row in a hundred of other codes gets through
LEAST_BITS = 4  # in a filter that is as large as it may be: one row in seven
WORD, WORDS = 64, 512  # a block is 512 words of 64 bits; all bits of a code are in one block
BLOCK_BITS = WORD * WORDS
BLOCK_BYTES = BLOCK_BITS // 8
BLOCK_SHIFT = BLOCK_BITS.bit_length() - 1


def _places(key: Sequence[Column], blocks: int) -> tuple[Column, list[Column]]:
    block = F.pmod(F.xxhash64(*key), F.lit(blocks))
    return block, [F.pmod(F.xxhash64(F.lit(k), *key), F.lit(BLOCK_BITS)).cast("int") for k in range(PROBES)]


def _wanted(codes: int, bits: int = BITS_PER_CODE) -> int:
    return -(-max(1, codes) * bits // BLOCK_BITS)


def _blocks(codes: int) -> int:
    return max(1, min(_wanted(codes), MAX_FILTER_BYTES // BLOCK_BYTES))


def filter_fits(codes: int) -> bool:
    """Whether the filter of so many codes stays within ``MAX_FILTER_BYTES``: the size is known before it is made."""
    return _wanted(codes) * BLOCK_BYTES <= MAX_FILTER_BYTES


def filter_helps(codes: int) -> bool:
    """Whether a filter of ``MAX_FILTER_BYTES`` still drops most rows of other codes."""
    return _wanted(codes, LEAST_BITS) * BLOCK_BYTES <= MAX_FILTER_BYTES


def code_filter(keys: DataFrame, count: int) -> DataFrame:
    """A row for each block, ``_block, _words``, of keys in all columns. Bits are or-ed in the map tasks before they are shuffled.

    Of so many codes that ``BITS_PER_CODE`` would make it larger than it may be, each has fewer.
    """
    block, bits = _places([F.col(c) for c in keys.columns], _blocks(count))
    return _filled(keys.select(block.alias("_block"), F.explode(F.array(*bits)).alias("_bit")))


def _filled(placed: DataFrame) -> DataFrame:
    """A row for each block with its bits, ``_block, _words``, of rows ``_block, _bit``."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_bit") % WORD)
    words = placed.groupBy("_block", F.floor(F.col("_bit") / WORD).cast("int").alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    found = words.groupBy("_block").agg(F.collect_list(F.struct("_word", "_bits")).alias("_found"))
    # Both maps are read once; a look into one for each word would read it, or make it, as often as a block has words.
    none = F.map_from_arrays(F.sequence(F.lit(0), F.lit(WORDS - 1)), F.array_repeat(F.lit(0).cast("long"), WORDS))
    filled = F.map_zip_with(none, F.map_from_entries("_found"), lambda _, zero, bits: F.coalesce(bits, zero))
    return found.select("_block", F.map_values(filled).alias("_words"))


def may_match(rows: DataFrame, key: Sequence[Column], found: DataFrame, count: int) -> DataFrame:
    """The rows whose key may be one of the filter's; none that is gets lost. ``count`` is that of :func:`code_filter`."""
    block, bits = _places(key, _blocks(count))
    tested = rows.withColumn("_block", block).join(F.broadcast(found), "_block")
    for bit in bits:
        tested = tested.filter(F.getbit(F.get("_words", F.floor(bit / WORD).cast("int")), bit % WORD) == 1)
    return tested.drop("_block", "_words")


def number_set(numbers: DataFrame) -> DataFrame:
    """The numbers of the only column as ``_block, _words``: a bit for each, in blocks of neighbours, so dense ones are small."""
    number = F.col(numbers.columns[0])
    block, bit = _number_places(number)
    return _filled(numbers.where(number.isNotNull()).select(block.alias("_block"), bit.alias("_bit")))


def _number_places(number: Column) -> tuple[Column, Column]:
    return F.call_function("shiftright", number, F.lit(BLOCK_SHIFT)), number.bitwiseAND(BLOCK_BITS - 1).cast("int")


def with_membership(rows: DataFrame, number: Column, numbers: DataFrame, name: str) -> DataFrame:
    """Whether each row's number is in a set of :func:`number_set`, which is broadcast, as the column ``name``; NULL is in none."""
    block, bit = _number_places(number)
    found = numbers.select(F.col("_block").alias("_of"), F.col("_words").alias("_bits"))
    told = rows.withColumn("_block", block).join(F.broadcast(found), F.col("_block") == F.col("_of"), "left")
    held = F.getbit(F.get("_bits", F.floor(bit / WORD).cast("int")), bit % WORD) == 1
    return told.withColumn(name, F.coalesce(held, F.lit(False))).drop("_block", "_of", "_bits")
