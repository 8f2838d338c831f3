"""Canonical bytes of key values, as built-in expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import ieee754

MICROS_PER_DAY = 86_400_000_000
# Largest decimal precision that fits an 8-byte unscaled value (fixed value).
SHORT_DECIMAL_PRECISION = 18


def big_endian(value: Column, width: int) -> Column:
    """``width`` bytes, most significant first, two's complement."""
    digits = F.lpad(F.hex(value.cast("bigint")), 16, "0")
    return F.unhex(F.substring(digits, 17 - 2 * width, 2 * width))


def ntz_micros(value: Column) -> Column:
    """Epoch microseconds of a zone-less timestamp, independent of the session zone."""
    seconds = (F.hour(value) * 3600 + F.minute(value) * 60).cast("bigint")
    fraction = (F.date_part(F.lit("SECOND"), value) * 1_000_000).cast("bigint")
    return F.unix_date(value.cast("date")) * F.lit(MICROS_PER_DAY) + seconds * F.lit(1_000_000) + fraction


def _decimal_bytes(value: Column, kind: T.DecimalType) -> Column:
    if kind.precision <= SHORT_DECIMAL_PRECISION:
        unscaled = value.cast(f"decimal(18,{kind.scale})") * F.lit(10**kind.scale).cast("decimal(19,0)")
        return big_endian(unscaled.cast("decimal(19,0)").cast("bigint"), 8)
    # 128-bit two's complement: split the unscaled digits into a signed high word and an
    # unsigned low word. The digits are taken as text because scale + precision may exceed 38.
    digits = F.regexp_replace(value.cast(kind.simpleString()).cast("string"), r"\.", "")
    unscaled = digits.cast("decimal(38,0)")
    word = F.lit(Decimal(1 << 64)).cast("decimal(20,0)")
    low = F.pmod(unscaled, word).cast("decimal(20,0)")
    high = ((unscaled - low) / word).cast("decimal(20,0)").cast("bigint")
    signed_low = F.when(low >= F.lit(Decimal(1 << 63)).cast("decimal(20,0)"), low - word).otherwise(low)
    return F.concat(big_endian(high, 8), big_endian(signed_low.cast("decimal(20,0)").cast("bigint"), 8))


def value_bytes(value: Column, kind: T.DataType) -> Column:
    """Canonical bytes of one key value by its type; NULL stays NULL."""
    if isinstance(kind, T.BooleanType):
        return big_endian(value.cast("int"), 1)
    if isinstance(kind, T.ByteType):
        return big_endian(value, 1)
    if isinstance(kind, (T.ShortType, T.IntegerType)):
        return big_endian(value, 4)
    if isinstance(kind, T.DateType):
        return big_endian(F.unix_date(value), 4)
    if isinstance(kind, T.LongType):
        return big_endian(value, 8)
    if isinstance(kind, T.TimestampType):
        return big_endian(F.unix_micros(value), 8)
    if isinstance(kind, T.TimestampNTZType):
        return big_endian(ntz_micros(value), 8)
    if isinstance(kind, T.FloatType):
        return big_endian(ieee754.to_bits(value, "float"), 4)
    if isinstance(kind, T.DoubleType):
        return big_endian(ieee754.to_bits(value, "double"), 8)
    if isinstance(kind, T.DecimalType):
        return _decimal_bytes(value, kind)
    if isinstance(kind, T.StringType):
        return F.encode(value, "UTF-8")
    if isinstance(kind, T.BinaryType):
        return value
    raise TypeError(f"unsupported key type: {kind.simpleString()}")


def require_not_null(key: Column, name: str, result: Column) -> Column:
    """``result``, failing the query where ``key`` is NULL."""
    return F.when(key.isNull(), F.raise_error(F.lit(f"a row has no value in its key column {name}"))).otherwise(result)


def key_bytes(df: DataFrame, keys: list[str] | tuple[str, ...]) -> Column:
    """Canonical bytes of the key: the parts' bytes joined in key order; NULL is an error."""
    parts = [
        require_not_null(F.col(k), k, value_bytes(F.col(k), field(df.schema, k).dataType)) for k in keys
    ]
    return F.concat(*parts)


def field(schema: T.StructType, name: str) -> T.StructField:
    """Case-insensitive field look-up."""
    for candidate in schema.fields:
        if candidate.name.lower() == name.lower():
            return candidate
    raise ValueError(f"column not found in schema: {name}")
