"""Telling apart, before a join, the rows that can have none of its keys.

A join too large to broadcast shuffles whole rows, most of which then meet nothing. The keys,
hashed to the bits of a bitmap, are a hundredth of their size or less, so that the bitmap can be
broadcast where the keys cannot. A row whose bit is not set has none of the keys. One whose bit
is set may have one (another key may share the bit): the join decides on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnmart.scratch import staged

FEWEST = 1 << 18  # keys; Spark can broadcast fewer itself
BITS_PER_KEY = 8  # or up to twice as many: one other row in 9 to 16 has its bit set
MOST_BITS = 1 << 28  # 32 MB, however many keys there are
PIECE = 1 << 15  # bits of what bitmap_construct_agg makes
WORD = 64


def bits_for(keys: int) -> int:
    """How many bits so many keys get: a power of two, one piece at least."""
    return min(MOST_BITS, max(PIECE, 1 << (BITS_PER_KEY * keys - 1).bit_length()))


def _bit(key: str, bits: int) -> Column:
    return F.xxhash64(key).bitwiseAND(F.lit(bits - 1))


def bitmap(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """The bitmap of ``keys``, a row ``_piece``, ``_words`` per piece that has any."""
    bit = keys.where(F.col(key).isNotNull()).select(_bit(key, bits).alias("_bit"))
    dealt = bit.select(
        F.shiftright("_bit", PIECE.bit_length() - 1).alias("_piece"),
        F.col("_bit").bitwiseAND(F.lit(PIECE - 1)).alias("_at"),
    ).repartition("_piece")
    pieces = dealt.groupBy("_piece").agg(F.bitmap_construct_agg("_at").alias("_bytes"))

    def word(i: Column) -> Column:
        return F.conv(F.hex(F.substring("_bytes", i * 8 + 1, F.lit(8))), 16, -10).cast("long")

    return pieces.select("_piece", F.transform(F.sequence(F.lit(0), F.lit(PIECE // WORD - 1)), word).alias("_words"))


def apart(rows: DataFrame, keys: DataFrame, key: str, count: int) -> tuple[DataFrame, DataFrame | None]:
    """``rows`` in two parts: those that may have one of the ``count`` keys, and those that have
    none of them or NULL. Where Spark can broadcast the keys, or they are too many for the bitmap
    to tell much, or no whole numbers of one type, all rows are in the first and the second is None.

    The rows are read once for each part and should be a table, or a projection of one."""
    kind = rows.schema[key].dataType
    if not isinstance(kind, T.IntegralType) or keys.schema[key].dataType != kind:
        return rows, None
    bits = bits_for(count)
    if count < FEWEST or 2 * count > bits:
        return rows, None
    pieces = F.broadcast(staged(bitmap(keys, key, bits), "bitmap"))
    at = _bit(key, bits)
    # The words hold their first byte highest, and each byte its first bit lowest.
    in_word = at.bitwiseAND(F.lit(WORD - 1)).bitwiseXOR(F.lit(WORD - 8))
    word = F.get("_words", F.shiftright(at, 6).bitwiseAND(F.lit(PIECE // WORD - 1)).cast("int"))
    is_set = F.getbit(word, in_word.cast("int")) == 1
    marked = rows.join(pieces, F.shiftright(at, PIECE.bit_length() - 1) == F.col("_piece"), "left")
    may = F.col(key).isNotNull() & F.coalesce(is_set, F.lit(False))
    return marked.where(may).select(rows.columns), marked.where(~may).select(rows.columns)
