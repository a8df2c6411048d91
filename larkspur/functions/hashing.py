"""Home region of a key: the 32-bit string hash, folded to regions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

REGIONS = 3
_WORD = 1 << 32


def string_hash(text: Column) -> Column:
    """h = 31·h + unit over the UTF-16 code units, wrapping at 32 bits, as a signed BIGINT."""
    points = F.when(
        F.char_length(text) > 0,
        F.transform(
            F.sequence(F.lit(1), F.char_length(text)),
            lambda i: F.ascii(F.substring(text, i, F.lit(1))).cast("bigint"),
        ),
    ).otherwise(F.array().cast("array<bigint>"))

    def push(h: Column, unit: Column) -> Column:
        return (h * 31 + unit) % F.lit(_WORD)

    def step(h: Column, point: Column) -> Column:
        above = point - 0x10000
        high = F.floor(above / 1024).cast("bigint") + 0xD800
        low = above % 1024 + 0xDC00
        return F.when(point < 0x10000, push(h, point)).otherwise(push(push(h, high), low))

    unsigned = F.aggregate(points, F.lit(0).cast("bigint"), step)
    return F.when(unsigned >= _WORD // 2, unsigned - F.lit(_WORD)).otherwise(unsigned)


def home_region(key: Column) -> Column:
    """(abs(hash) - 1) % 3 + 1 in 32-bit arithmetic; a hash of 0 gives region 0."""
    signed = string_hash(key)
    lowest = F.lit(-(_WORD // 2))
    wrapped = F.when(signed == lowest, F.lit(_WORD // 2 - 1)).otherwise(F.abs(signed) - 1)
    return (wrapped % REGIONS + 1).cast("int")
