"""Hash expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A SHA-256 hex digest is cut into limbs that fit a BIGINT, so that digests can be summed.
LIMB_HEX = 15
LIMBS = 4
# Limbs of 48 bits, for sums of up to 32,768 digests inside a BIGINT.
SHORT_HEX = 12
SHORT_LIMBS = 5


def seeded_digest(seed: int, key: Column) -> Column:
    """Uniform, reproducible sort key for random picks."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string")))


def float_bits(value: Column) -> Column:
    """The IEEE 754 single-precision pattern of a number as a BIGINT, by exact arithmetic.

    With `e` the binary exponent, at least -126, and `m` the value over 2^e, the pattern without sign is
    (e + 126 + m) * 2^23, for subnormal values and zero as well. Every NaN is the quiet one; NULL stays NULL.
    """
    number = value.cast("float").cast("double")
    size = F.abs(number)
    exponent = F.greatest(F.lit(-126.0), F.floor(F.log2(size)).cast("double"))
    finite = ((exponent + 126) * 2**23 + size / F.pow(F.lit(2.0), exponent) * 2**23).cast("long")
    # The logarithm of zero is NULL, which `greatest` skips. Only its text tells the sign of a zero.
    negative = (number < 0) | ((number == 0) & number.cast("string").startswith("-"))
    unsigned = F.when(size == float("inf"), F.lit(255 * 2**23)).otherwise(finite)
    return F.when(F.isnan(number), F.lit(511 * 2**22).cast("long")).otherwise(
        unsigned + F.when(negative, F.lit(2**31)).otherwise(F.lit(0))
    )


def bits_text(value: Column) -> Column:
    return F.coalesce(float_bits(value).cast("string"), F.lit("null"))


def limb(digest: Column, position: int) -> Column:
    return F.conv(F.substring(digest, position * LIMB_HEX + 1, LIMB_HEX), 16, 10).cast("decimal(38,0)")


def short_limb(digest: Column, position: int) -> Column:
    return F.conv(F.substring(digest, position * SHORT_HEX + 1, SHORT_HEX), 16, 10).cast("long")
