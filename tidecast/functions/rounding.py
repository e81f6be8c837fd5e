"""Rounding that gives the same digits whatever engine or partitioning computed the input."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_half_up(value: Column, digits: int) -> Column:
    """Round by ``floor(x * 10^d + 0.5) / 10^d``.

    Plain ``round`` goes through a decimal rendering of the double and disagrees with other engines on
    near-ties; this form is three IEEE operations and does not.  From 2^52 on a double has no fraction, and ``floor``
    would run out of 64 bits, so such a value stays as it is.
    """
    scale = F.lit(float(10 ** digits))
    scaled = value * scale
    return F.when(F.abs(scaled) < F.lit(float(2 ** 52)), F.floor(scaled + F.lit(0.5)) / scale).otherwise(value.cast("double"))
