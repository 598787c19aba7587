"""The partition that other clients give to a key (K4)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from topictables.operators.partitioning import Partitioner, fixed

# Seed, factor and shifts of the 32-bit MurmurHash2 that clients take for keys.
SEED, FACTOR, SHIFT, LAST_SHIFTS = 0x9747B28C, 0x5BD1E995, 24, (13, 15)
MASK = 0xFFFFFFFF


def murmur2(value: Column) -> Column:
    """The hash of bytes as a number from 0 to 2^32 - 1, without leaving the JVM.

    Products of a 32-bit number with the factor stay below 2^63, so longs are enough.
    """
    digits, length = F.hex(value), F.octet_length(value)

    def byte(position: Column) -> Column:
        return F.conv(F.substring(digits, position * 2 + 1, F.lit(2)), 16, 10).cast("bigint")

    def times(number: Column) -> Column:
        return (number * F.lit(FACTOR).cast("bigint")).bitwiseAND(F.lit(MASK).cast("bigint"))

    def folded(number: Column, shift: int) -> Column:
        return number.bitwiseXOR(F.shiftrightunsigned(number, shift))

    def word(state: Column, at: Column) -> Column:
        part = sum((F.shiftleft(byte(at * 4 + i), 8 * i) for i in range(1, 4)), byte(at * 4))
        return times(state).bitwiseXOR(times(folded(times(part), SHIFT)))

    words = F.floor(length / 4).cast("int")
    rest = length - words * 4
    whole = F.when(words > 0, F.sequence(F.lit(0), words - 1)).otherwise(F.array().cast("array<int>"))
    start = F.lit(SEED).cast("bigint").bitwiseXOR(length.cast("bigint"))
    state = F.aggregate(whole, start, word)

    def ended(state: Column) -> Column:
        tail = F.lit(0).cast("bigint")
        for i in (2, 1, 0):
            tail = tail + F.when(rest > i, F.shiftleft(byte(words * 4 + i), 8 * i)).otherwise(F.lit(0).cast("bigint"))
        return F.when(rest > 0, times(state.bitwiseXOR(tail))).otherwise(state)

    for step in (ended, lambda s: times(folded(s, LAST_SHIFTS[0])), lambda s: folded(s, LAST_SHIFTS[1])):
        state = F.get(F.transform(F.array(state), step), F.lit(0))  # the state is computed once a step
    return state


def keyed(key: Column) -> Partitioner:
    """Rows of one key to the partition where other clients put it; text is taken as UTF-8. Rows
    without a key go where their writer writes, as with `fixed`."""

    def assign(partitions: int) -> Column:
        positive = murmur2(key.cast("binary")).bitwiseAND(F.lit(0x7FFFFFFF).cast("bigint"))
        return F.coalesce((positive % partitions).cast("int"), fixed(partitions))

    return assign
