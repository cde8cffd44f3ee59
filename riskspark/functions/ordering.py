"""Order-preserving buckets for doubles, used to keep global ordering distributed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FINE_BITS = 30
COARSE_SHIFT = 16

_LARGEST = 1.7976931348623157e308
_OFFSET = 1100.0


def magnitude_bucket(value: Column, bits: int = FINE_BITS) -> Column:
    """A bigint that never decreases as ``value`` grows, with 2**bits steps per octave.

    The position is a piecewise-linear log2, so the bucket width follows the
    spacing of doubles themselves: whatever the distribution of the values, one
    bucket of the default width spans at most 2**22 distinct doubles, and the
    bucket depends on the value alone, never on how rows are partitioned.
    """
    number = value.cast("double")
    size = F.least(F.abs(number), F.lit(_LARGEST))
    octave = F.greatest(
        F.lit(-1022.0), F.least(F.lit(1023.0), F.floor(F.log2(size)).cast("double"))
    )
    position = octave + size / F.pow(F.lit(2.0), octave) - 1.0
    signed = F.when(size == 0.0, F.lit(0.0)).otherwise(
        F.signum(number) * (position + F.lit(_OFFSET))
    )
    return F.floor(signed * F.lit(float(2**bits)))


def coarse_bucket(fine: Column) -> Column:
    """The wider bucket a fine bucket lies in (2**16 fine buckets each)."""
    return F.shiftright(fine, COARSE_SHIFT)
