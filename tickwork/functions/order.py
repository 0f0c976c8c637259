"""Several ordering columns as one fixed-width number."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwork.functions.time import epoch_ntz

# Bits that hold every value of a type, and of a decimal(38,0).
BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64, T.DateType: 32, T.TimestampType: 64,
        T.TimestampNTZType: 64, T.DoubleType: 64, T.FloatType: 64, T.BooleanType: 8}
MOST_BITS = 128  # with times before the year 50000, whose high bits are unused


def double_rank(c: Column) -> Column:
    """A long that sorts like the double ``c``: exponent and mantissa, taken apart by exact arithmetic.

    Dividing by a power of two is exact, so distinct doubles keep distinct ranks. Zeros of either sign are equal;
    infinities and NaN sort last, as in Spark.
    """
    size = F.abs(c.cast("double"))
    finite = ~F.isnan(size) & (size < F.lit(float("inf")))
    normal = finite & (size >= F.lit(2.0**-1022))
    guess = F.floor(F.log2(F.when(normal, size).otherwise(F.lit(1.0))))  # rounding may make it one too large or small
    power = F.pow(F.lit(2.0), guess)
    exponent = guess + F.when(power > size, -1).when(size / F.lit(2.0) >= power, 1).otherwise(0)
    mantissa = (size / F.pow(F.lit(2.0), exponent.cast("double")) - 1) * F.lit(2.0**52)
    rank = (
        F.when(normal, (exponent.cast("long") + 1023) * F.lit(1 << 52) + F.when(normal, mantissa).otherwise(0.0).cast("long"))
        .when(finite, (size * F.lit(2.0**537) * F.lit(2.0**537)).cast("long"))
        .when(F.isnan(size), F.lit((2047 << 52) + 1))
        .otherwise(F.lit(2047 << 52))
    )
    return F.when(c < 0, -rank).otherwise(rank)


def _as_long(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return double_rank(c)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", epoch_ntz(), c)
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long")
    return c.cast("long")


def packed_order(df: DataFrame, columns: Sequence[str]) -> Column:
    """One value that orders rows like ``columns`` do, the first one first.

    A ``decimal(38,0)`` where their types fit into it, else a struct. It is NULL where the first column is, so that
    ``min_by`` and ``max_by`` pass over such rows; a NULL in a later column sorts before all values.
    """
    kinds = [df.schema[c].dataType for c in columns]
    bits = [BITS.get(type(k), MOST_BITS + 1) for k in kinds]
    if sum(bits) > MOST_BITS:
        return F.struct(*columns)
    whole = _as_long(F.col(columns[0]), kinds[0]).cast("decimal(38,0)")
    for c, kind, n in zip(columns[1:], kinds[1:], bits[1:]):
        part = F.coalesce(_as_long(F.col(c), kind), F.lit(-(1 << (n - 1)))).cast("decimal(20,0)") + F.lit(Decimal(1 << (n - 1)))
        whole = (whole * F.lit(Decimal(1 << n)) + part).cast("decimal(38,0)")
    return whole
