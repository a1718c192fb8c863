"""Status bits and big-endian binary fields, decoded on the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bit names of the 16-bit status words, least significant first.
FILE_STATUS = (
    "has_data", "is_spectrum", "is_int32", "is_float", "is_complex", "is_hypercomplex", "bit6", "acq_par",
    "is_second_ft", "is_transformed", "bit10", "np_complex", "nf_complex", "ni_complex", "ni2_complex", "bit15",
)
BLOCK_STATUS = FILE_STATUS[:7] + (
    "more_blocks", "np_complex", "nf_complex", "ni_complex", "ni2_complex", "bit12", "bit13", "bit14", "bit15",
)
DATA_BIT, INT32_BIT, FLOAT_BIT = 0, 2, 3


def get_bit(word: Column, bit: int) -> Column:
    return F.shiftright(word, bit).bitwiseAND(F.lit(1)) == 1


def flag_columns(word: Column, names: Sequence[str] = FILE_STATUS) -> list[Column]:
    return [get_bit(word, i).alias(n) for i, n in enumerate(names)]


def pack_flags(flags: Sequence[Column]) -> Column:
    """16 booleans, least significant first, as one integer."""
    total = F.lit(0)
    for i, flag in enumerate(flags):
        total = total + F.shiftleft(flag.cast("int"), i)
    return total


def sample_type(status: Column) -> Column:
    """The float bit beats the int32 bit; neither means int16."""
    return (F.when(get_bit(status, FLOAT_BIT), "float32")
            .when(get_bit(status, INT32_BIT), "int32").otherwise("int16"))


def sample_bytes(status: Column) -> Column:
    return F.when(get_bit(status, FLOAT_BIT) | get_bit(status, INT32_BIT), 4).otherwise(2)


def unsigned(data: Column, start: int, size: int) -> Column:
    """Big-endian unsigned field; ``start`` is a 0-based byte offset."""
    return F.conv(F.hex(F.substring(data, start + 1, size)), 16, 10).cast("bigint")


def signed(data: Column, start: int, size: int) -> Column:
    half = 2 ** (8 * size - 1)
    return (unsigned(data, start, size) + half) % (2 * half) - half


def float32(data: Column, start: int) -> Column:
    """IEEE single precision from four bytes (finite values)."""
    word = unsigned(data, start, 4)
    sign = F.when(get_bit(word, 31), -1.0).otherwise(1.0)
    exponent = F.shiftright(word, 23).bitwiseAND(F.lit(255))
    fraction = word.bitwiseAND(F.lit(2 ** 23 - 1)).cast("double") / 2.0 ** 23
    normal = (1.0 + fraction) * F.pow(F.lit(2.0), exponent - 127)
    return sign * F.when(exponent == 0, fraction * 2.0 ** -126).otherwise(normal)


def to_bytes(value: Column, size: int) -> Column:
    """Big-endian two's complement field of ``size`` bytes."""
    digits = F.lpad(F.hex(value.cast("bigint")), 16, "0")
    return F.unhex(F.substring(digits, 17 - 2 * size, 2 * size))
