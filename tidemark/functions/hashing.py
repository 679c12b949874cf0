"""Bit offsets for hashed visitor bitmaps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bitmap size in bits and hash multiplier that published offsets rely on.
BITMAP_BITS = 1 << 30
HASH_MULTIPLIER = 79


def rolling_offset(text: Column, multiplier: int = HASH_MULTIPLIER, bits: int = BITMAP_BITS) -> Column:
    """Polynomial hash over the UTF-16 units of `text`, reduced to `bits` (a power of two).

    Only the low bits survive the reduction, so it can be applied after every step, which keeps
    the accumulator far from overflow.
    """
    mask = F.lit(bits - 1).cast("bigint")

    def step(acc: Column, unit: Column) -> Column:
        return (acc * F.lit(multiplier) + unit).bitwiseAND(mask)

    def add_char(acc: Column, char: Column) -> Column:
        point = F.ascii(char).cast("bigint")
        beyond = point - F.lit(0x10000)
        high = F.lit(0xD800) + F.shiftright(beyond, 10)
        low = F.lit(0xDC00) + beyond.bitwiseAND(F.lit(0x3FF))
        return F.when(point < 0x10000, step(acc, point)).otherwise(step(step(acc, high), low))

    return F.aggregate(F.split(text, ""), F.lit(0).cast("bigint"), add_char)
