"""Bit interleaving for Z-order values."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _spread(value: Column, stride: int, bits: int, offset: int) -> Column:
    """Bit ``i`` of the value moved to bit ``i * stride + offset``."""
    wide = value.cast("bigint")
    placed = [
        F.shiftleft(F.shiftright(wide, i).bitwiseAND(F.lit(1).cast("bigint")), i * stride + offset)
        for i in range(bits)
    ]
    return reduce(Column.bitwiseOR, placed)


def interleave(values: Sequence[Column], bits: int) -> Column:
    """Z-value: the low ``bits`` bits of every value, interleaved; the first value's bit comes first."""
    count = len(values)
    if count * bits > 63:
        raise ValueError(f"{count} columns of {bits} bits do not fit a bigint")
    return reduce(Column.bitwiseOR, [_spread(v, count, bits, count - 1 - i) for i, v in enumerate(values)])
