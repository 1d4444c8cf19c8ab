"""Causal exponentially weighted averages and imputation, as window functions.

The average at row t of a series uses the observed values up to and including t,

    sum(x_i * 2^(i / half_life)) / sum(2^(i / half_life)),

where i counts rows: a missing value adds nothing, yet the weights go on decaying.
Leading rows without any observation stay NULL. This equals an adjusted,
NaN-respecting exponential mean.

With ``adjust=False`` every observation but the first of its series is weighted by
``1 - 2^(-1 / half_life)``, which is the plain recurrence on series without gaps.

Three forms give the same numbers. Few columns share one window specification: one
exchange, one sort and two Window nodes. Many columns travel as one array, and a series is
worked on as a matrix. A series too long for either is cut into blocks (``long_series``).
Which form holds follows from the rows of the longest series; where the caller does not
know them, they are counted first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelloom.functions.numeric import decay_weight, keep_or_fill, settle
from panelloom.operators.long_series import long_ewma
from panelloom.operators.rank import NARROW, VECTOR_BYTES, largest_group
from panelloom.operators.vector import average_columns
from panelloom.spec import IMPUTE_HALF_LIFE, SERIES, EwmaSpec

# 2^(i / half_life) must stay a finite double, sums and products included.
MAX_EXPONENT = 800
# Beyond this many rows a series is no longer left to one window partition.
MAX_SERIES_ROWS = 200_000


def fits_one_window(half_life: float, max_rows: int | None) -> bool:
    """Whether a series of at most ``max_rows`` rows may be averaged in one window."""
    return max_rows is not None and max_rows <= MAX_SERIES_ROWS and max_rows / half_life <= MAX_EXPONENT


def fits_one_task(columns: int, specs: int, max_rows: int) -> bool:
    """Whether the longest series may be worked on as one matrix, results included."""
    return max_rows * columns * (specs + 1) * 8 <= VECTOR_BYTES


def causal_ewma(
    df: DataFrame,
    columns: Sequence[str],
    specs: Sequence[EwmaSpec],
    series: Sequence[str] = SERIES,
    order: Sequence[str] = ("timeid",),
    max_rows: int | None = None,
    adjust: bool = True,
    bits: int | None = None,
    keep: bool = True,
) -> DataFrame:
    """Add ``{column}_{suffix}`` for every column and spec; without ``keep`` in place of the columns themselves.

    ``max_rows`` is a bound on the rows of one series that the caller can vouch for, e.g. from
    the time range of the reader; by default the longest series is counted.
    """
    max_rows = largest_group(df, series) if max_rows is None else max_rows
    if len(columns) > NARROW and fits_one_task(len(columns), len(specs), max_rows):
        names = [[f"{c}_{s.suffix}" for c in columns] for s in specs]
        lives, least = [s.half_life for s in specs], [s.min_count for s in specs]
        return average_columns(df, columns, lives, least, names, series, order, adjust, bits, keep=keep)
    if not all(fits_one_window(s.half_life, max_rows) for s in specs):
        out = long_ewma(df, columns, specs, series, order, adjust=adjust)
        out = out.withColumns({n: settle(F.col(n), bits) for s in specs for n in (f"{c}_{s.suffix}" for c in columns)})
        return out if keep else out.drop(*columns)

    ordered = Window.partitionBy(*series).orderBy(*order)
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    position = F.row_number().over(ordered)
    weights = {s.suffix: f"_w_{s.suffix}" for s in specs}
    framed = df.withColumns({weights[s.suffix]: decay_weight(position, s.half_life) for s in specs})
    helpers = list(weights.values())
    if not adjust:
        seen = {c: f"_seen_{c}" for c in columns}
        framed = framed.withColumns({seen[c]: F.count(c).over(running) for c in columns})
        helpers += list(seen.values())

    def weight(column: str, spec: EwmaSpec) -> Column:
        w = F.col(weights[spec.suffix])
        if adjust:
            return w
        later = 1.0 - 2.0 ** (-1.0 / spec.half_life)
        return F.when(F.col(seen[column]) > 1, w * F.lit(later)).otherwise(w)

    def average(column: str, spec: EwmaSpec) -> Column:
        value, w = F.col(column), weight(column, spec)
        total = F.sum(value * w).over(running)
        norm = F.sum(F.when(value.isNotNull(), w)).over(running)
        if spec.min_count <= 1:
            return total / norm
        return F.when(F.count(value).over(running) >= spec.min_count, total / norm)

    added = {f"{c}_{s.suffix}": average(c, s) for s in specs for c in columns}
    made = framed.withColumns(added).drop(*helpers, *([] if keep else columns))
    return made if bits is None else made.withColumns({n: settle(F.col(n), bits) for n in added})


def causal_impute(
    df: DataFrame,
    columns: Sequence[str],
    half_life: float = IMPUTE_HALF_LIFE,
    series: Sequence[str] = SERIES,
    order: Sequence[str] = ("timeid",),
    min_count: int = 1,
    max_rows: int | None = None,
    names: Mapping[str, str] | None = None,
    bits: int | None = None,
) -> DataFrame:
    """Fill each missing value with the causal average at its row.

    Filled values do not feed back into the average. ``names`` puts the result
    under new names and keeps the raw column; by default it is replaced. ``bits``
    settles what is filled in; observed values stay as they are.
    """
    max_rows = largest_group(df, series) if max_rows is None else max_rows
    keep = names is not None
    if len(columns) > NARROW and fits_one_task(len(columns), 1, max_rows):
        made = [[(names or {}).get(c, c) for c in columns]]
        return average_columns(
            df, columns, [half_life], [min_count], made, series, order, bits=bits, fill=True, keep=keep
        )
    spec = EwmaSpec(half_life, "fill", min_count)
    filled = causal_ewma(df, columns, [spec], series, order, max_rows, bits=bits)
    names = names or {c: c for c in columns}
    return filled.withColumns(
        {names[c]: keep_or_fill(F.col(c), F.col(f"{c}_fill")) for c in columns}
    ).drop(*(f"{c}_fill" for c in columns))
