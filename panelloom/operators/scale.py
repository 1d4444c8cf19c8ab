"""Cross-sectional standardising and clipping.

Both are known by name only, so these are our definitions: ``standardize`` takes
the sample standard deviation, and ``winsorize`` clips at linearly interpolated
quantiles of the present values. Up to ``NARROW`` columns are scalar aggregates or windows; more of
them travel as one array (``wide_scale``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.operators.rank import NARROW, SPLIT_ROWS, VECTOR_BYTES, largest_group, value_totals
from panelloom.operators.wide_scale import quantile_columns, standardize_columns, standardize_large, winsorize_columns
from panelloom.session import same_keys
from panelloom.spec import CROSS_SECTION


def fits_task(columns: int, largest: int) -> bool:
    return largest * columns * 8 <= VECTOR_BYTES


def standardize(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = CROSS_SECTION, largest: int | None = None
) -> DataFrame:
    """Replace ``columns`` by (x - mean) / deviation; NULL where the deviation is 0 or undefined.

    The moments are aggregated map-side, so a group of any size ships one row per
    task; which side of the join back is broadcast is left to the run-time sizes.
    """
    if len(columns) > NARROW:
        largest = largest_group(df, by) if largest is None else largest
        return (standardize_columns if fits_task(len(columns), largest) else standardize_large)(df, columns, by)
    moments = df.groupBy(*by).agg(
        *(F.avg(c).alias(f"_m_{c}") for c in columns), *(F.stddev_samp(c).alias(f"_s_{c}") for c in columns)
    )
    kept = [c for c in df.columns if c not in set(columns)]
    return same_keys(df, moments, by).select(
        *kept,
        *(F.try_divide(F.col(c) - F.col(f"_m_{c}"), F.nullif(F.col(f"_s_{c}"), F.lit(0.0))).alias(c) for c in columns),
    )


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    by: Sequence[str] = CROSS_SECTION,
    split: bool | None = None,
) -> DataFrame:
    """Exact interpolated quantiles, one row per group: ``{column}_q0``, ``{column}_q1``, ...

    They are read off the cumulative counts of distinct values. With ``split`` no task
    holds the distinct values of a whole group; by default the largest group decides. A group
    without any value has a row of NULLs.
    """
    if split is None:
        largest = largest_group(df, by)
        if len(columns) > NARROW and fits_task(len(columns), largest):
            return quantile_columns(df, columns, probabilities, by)
        split = largest > SPLIT_ROWS
    long = df.unpivot(list(by), list(columns), "_column", "_value")
    totals = value_totals(long, [*by, "_column"], "_value", split)
    aggs = []
    for c in columns:
        for i, p in enumerate(probabilities):
            at = F.lit(float(p)) * (F.col("total") - 1)

            def holding(place):
                here = (F.col("below") <= place) & (place < F.col("below") + F.col("tied"))
                return F.max(F.when((F.col("_column") == c) & here, F.col("_value")))

            low, high = holding(F.floor(at)), holding(F.ceil(at))
            share = F.max(F.when(F.col("_column") == c, at - F.floor(at)))
            aggs.append((low + (high - low) * share).alias(f"{c}_q{i}"))
    return same_keys(df.select(*by).distinct(), totals.groupBy(*by).agg(*aggs), by)


def winsorize(
    df: DataFrame,
    columns: Sequence[str],
    lower: float = 0.01,
    upper: float = 0.99,
    by: Sequence[str] = CROSS_SECTION,
    largest: int | None = None,
    split_above: int = SPLIT_ROWS,
) -> DataFrame:
    """Clip ``columns`` to the quantiles ``lower`` and ``upper`` of their group."""
    largest = largest_group(df, by) if largest is None else largest
    if len(columns) > NARROW and fits_task(len(columns), largest):
        return winsorize_columns(df, columns, lower, upper, by)
    bounds = quantiles(df, columns, (lower, upper), by, split=largest > split_above)
    kept = [c for c in df.columns if c not in set(columns)]
    return same_keys(df, bounds, by).select(
        *kept,
        *(
            F.when(
                F.col(c).isNotNull(), F.least(F.greatest(F.col(c), F.col(f"{c}_q0")), F.col(f"{c}_q1"))
            ).alias(c)
            for c in columns
        ),
    )
