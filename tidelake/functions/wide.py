"""Unsigned numbers of 256 bits as Column expressions: arrays of eight 32-bit limbs, the highest first.

Arrays compare limb by limb, so <, =, min, max and ORDER BY are those of the numbers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType

LIMBS, BITS = 8, 32
_ZERO = "cast(0 as bigint)"


def words(data: Column, n: int) -> Column:
    """The n 32-byte words of 0x data as text of 64 digits; null unless it is just that long and hexadecimal."""
    # no pattern: to match one costs more than all else that is done with a log
    whole = (F.octet_length(data) == 2 + 64 * n) & data.startswith("0x") & F.unhex(F.substring(data, 3, 64 * n)).isNotNull()
    return F.when(whole, F.array(*(F.lower(F.substring(data, 3 + 64 * i, 64)) for i in range(n))))


@F.arrow_udf(ArrayType(LongType()))
def _limbs(numbers: pa.Array) -> pa.Array:
    """The limbs of numbers of 32 bytes, a batch of numbers at a time."""
    there = np.asarray(numbers.is_valid().to_numpy(zero_copy_only=False), dtype=bool)
    limbs = np.frombuffer(b"".join(numbers.drop_null().to_pylist()), dtype=">u4").astype(np.int64)
    ends = np.append(0, np.cumsum(there * LIMBS)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(limbs), mask=pa.array(~there))


def u256(word: Column) -> Column:
    """The number that 64 hexadecimal digits write."""
    return _limbs(F.when(F.octet_length(word) == 64, F.unhex(word)))


def hexed(number: Column) -> Column:
    """0x and 64 digits."""
    return F.concat(F.lit("0x"), F.array_join(F.transform(number, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), ""))


def fits(number: Column, bits: int) -> Column:
    """Whether a number is under 2 ** bits."""
    most = [min(max(bits - BITS * (LIMBS - 1 - i), 0), BITS) for i in range(LIMBS)]
    limit = F.array(*(F.lit((1 << b) - 1).cast("long") for b in most))
    return F.forall(F.zip_with(number, limit, lambda a, b: a <= b), lambda x: x)


def add(a: Column, b: Column) -> Column:
    """a + b; null if that needs more than 256 bits."""
    start = F.struct(F.array().cast("array<bigint>").alias("limbs"), F.expr(_ZERO).alias("carry"))
    pairs = F.reverse(F.arrays_zip(a.alias("a"), b.alias("b")))

    def step(state: Column, pair: Column) -> Column:
        total = pair["a"] + pair["b"] + state["carry"]
        return F.struct(F.concat(F.array(total % (1 << BITS)), state["limbs"]).alias("limbs"), F.shiftright(total, BITS).alias("carry"))

    return F.when(a.isNotNull() & b.isNotNull(), F.aggregate(pairs, start, step, lambda s: F.when(s["carry"] == 0, s["limbs"])))


@F.arrow_udf(StringType())
def decimal_text(numbers: pa.Array) -> pa.Array:
    """A number in decimal digits: Python's own, a batch of numbers at a time."""
    limbs = numbers.flatten().to_numpy(zero_copy_only=False).astype(">u4").tobytes()  # those of nulls are not there
    width = LIMBS * BITS // 8
    texts = (str(int.from_bytes(limbs[i : i + width], "big")) for i in range(0, len(limbs), width))
    return pa.array([next(texts) if there else None for there in numbers.is_valid().to_pylist()], pa.string())
