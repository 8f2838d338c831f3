"""IEEE-754 bit patterns as built-in expressions.

Spark has no function that reinterprets a float's bits, but scaling by powers of two is
exact in double arithmetic, so a float in a key can be turned into its bytes with
arithmetic only and without Python.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the two formats: mantissa bits, exponent bias, largest exponent field.
FORMATS = {"float": (23, 127, 255), "double": (52, 1023, 2047)}


def _pow2(exponent: Column) -> Column:
    return F.pow(F.lit(2.0), exponent.cast("double"))


def _guess(value: Column) -> Column:
    """floor(log2 |value|), possibly one off next to a power of two."""
    return F.floor(F.log2(F.abs(value.cast("double"))))


def _exponent(value: Column, guess: Column, kind: str) -> Column:
    """The guess corrected by comparison, within the exponents of the format."""
    bias = FORMATS[kind][1]
    size = F.abs(value.cast("double"))
    exact = F.when(size < _pow2(guess), guess - 1).when(size >= _pow2(guess + 1), guess + 1).otherwise(guess)
    return F.greatest(F.least(exact, F.lit(bias)), F.lit(1 - bias)).cast("bigint")


def _significand(value: Column, exponent: Column, kind: str) -> Column:
    """|value| scaled to an integer of the mantissa's width."""
    # Two factors keep the scale finite for the smallest doubles.
    shift = F.lit(FORMATS[kind][0]) - exponent
    half = F.shiftright(shift, 1)
    return (F.abs(value.cast("double")) * _pow2(half) * _pow2(shift - half)).cast("bigint")


def _pattern(value: Column, exponent: Column, significand: Column, kind: str) -> Column:
    mantissa_bits, bias, top = FORMATS[kind]
    hidden = 1 << mantissa_bits
    wide = value.cast("double")
    normal = F.shiftleft(exponent + F.lit(bias), mantissa_bits) + significand - F.lit(hidden)
    magnitude = (
        F.when(F.abs(wide) == float("inf"), F.lit(top << mantissa_bits).cast("bigint"))
        .when(wide == 0, F.lit(0).cast("bigint"))
        .when(significand < hidden, significand)
        .otherwise(normal)
    )
    sign_value = F.lit(-(1 << 63) if kind == "double" else 1 << 31).cast("bigint")
    negative = (wide < 0) | ((wide == 0) & F.startswith(wide.cast("string"), F.lit("-")))
    signed = F.when(negative, magnitude.bitwiseOR(sign_value)).otherwise(magnitude)
    canonical_nan = F.lit((top << mantissa_bits) | (1 << (mantissa_bits - 1))).cast("bigint")
    return F.when(value.isNull(), F.lit(None).cast("bigint")).when(F.isnan(wide), canonical_nan).otherwise(signed)


def _finite(value: Column) -> Column:
    """``value`` where it has an exponent, else 1.0; the special patterns do not need one."""
    wide = value.cast("double")
    special = wide.isNull() | F.isnan(wide) | (F.abs(wide) == float("inf")) | (wide == 0)
    return F.when(special, F.lit(1.0)).otherwise(wide)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def to_bits(value: Column, kind: str) -> Column:
    """The pattern of a float or double as a bigint (NaN gives the canonical one)."""

    def scaled(finite: Column) -> Column:
        def with_exponent(exponent: Column) -> Column:
            return _let(_significand(finite, exponent, kind), lambda s: _pattern(value, exponent, s, kind))

        return _let(_guess(finite), lambda guess: _let(_exponent(finite, guess, kind), with_exponent))

    return _let(_finite(value), scaled)
