"""Column-level numeric functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing_to_null(value: Column) -> Column:
    """NaN and NULL both mean missing; inside the engine only NULL is used."""
    return F.nanvl(value, F.lit(None).cast("double"))


def clean_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.withColumns({f: missing_to_null(F.col(f).cast("double")) for f in features})


def snap(value: Column, decimals: int | None) -> Column:
    """Round to ``decimals`` places with plain double arithmetic, for values of known size.

    ``round`` on a double goes through BigDecimal for every row; ``rint`` stays a
    machine instruction and is exact while ``value * 10^decimals`` is below 2^53.
    """
    if decimals is None:
        return value
    scale = float(10**decimals)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def settle(value: Column, bits: int | None) -> Column:
    """Round to ``53 - bits`` significant bits, by splitting the double with three exact operations.

    Relative to the value, so small and large magnitudes are treated alike; beyond 1e290,
    where the split would overflow, a value stays as it is.
    """
    if bits is None:
        return value
    wide = value * F.lit(float(2**bits + 1))
    return F.when(F.abs(value) < F.lit(1e290), wide - (wide - value)).otherwise(value)


def decay_weight(position: Column, half_life: float) -> Column:
    """Weight of a row, doubling every ``half_life`` positions."""
    return F.pow(F.lit(2.0), position / F.lit(float(half_life)))


def presence(value: Column) -> Column:
    return value.isNotNull()


def keep_or_fill(value: Column, replacement: Column) -> Column:
    return F.coalesce(value, replacement)


def close_to(left: Column, right: Column, tolerance: float = 1e-9) -> Column:
    """Approximate equality; two missing values are equal."""
    both = left.isNull() & right.isNull()
    return both | F.coalesce(F.abs(left - right) <= F.lit(tolerance), F.lit(False))
