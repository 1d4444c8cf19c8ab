"""Standardising, clipping and quantiles of wide frames: arrays instead of hundreds of scalar aggregates.

Groups that fit a task are worked on where their rows meet, many groups at once, and nothing is joined
back. For larger groups a row is never shuffled to its group: every task sums up what it has of a group in
one row of vectors (count, mean, squared deviation from the mean), these merge pairwise, and the
result, one row a group, goes back to the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.operators.vector import (
    BATCH_BYTES,
    batch_rows,
    by_group,
    group_starts,
    pack,
    to_columns,
    to_lists,
    to_matrix,
    whole_groups,
)
from panelloom.session import same_keys, spread

# What a task holds of partial moments before it gives them out.
HELD_BYTES = 4 * BATCH_BYTES
# Values in the vectors of all groups up to which they are broadcast: 32 MB.
BROADCAST_CELLS = 4 * 1024 * 1024


def quantile_rows(values: np.ndarray, probabilities: Sequence[float]) -> np.ndarray:
    """Interpolated quantiles of the present values of each column, one row for each probability."""
    ordered = np.sort(values, axis=0)
    present = (~np.isnan(values)).sum(axis=0)
    out = np.full((len(probabilities), values.shape[1]), np.nan)
    some = np.flatnonzero(present)
    for i, p in enumerate(probabilities):
        at = float(p) * (present[some] - 1)
        low, high = (ordered[side.astype(int), some] for side in (np.floor(at), np.ceil(at)))
        out[i, some] = low + (high - low) * (at - np.floor(at))
    return out


def clip_rows(values: np.ndarray, lower: float, upper: float) -> np.ndarray:
    """Present values clipped to two quantiles of their column."""
    low, high = quantile_rows(values, (lower, upper))
    return np.minimum(np.maximum(values, low), high)


def deviation(count: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """Sample deviation; NaN where it is zero or undefined."""
    with np.errstate(invalid="ignore", divide="ignore"):
        found = np.sqrt(squares / (count - 1))
    return np.where((count > 1) & (found > 0), found, np.nan)


def moments(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Count, mean and squared deviations of each column's present values; equal values deviate by nothing at all."""
    there = ~np.isnan(values)
    count = there.sum(axis=0).astype(float)
    # Counted from a value of the column itself, so that equal values leave zeros.
    base = np.take_along_axis(values, there.argmax(axis=0)[None], axis=0)[0] if len(values) else np.full(values.shape[1], np.nan)
    shifted = np.where(there, values - base, 0.0)
    with np.errstate(invalid="ignore"):
        mean = shifted.sum(axis=0) / count
        squares = np.where(there, shifted - mean, 0.0) ** 2
    return count, np.where(count > 0, mean + base, 0.0), squares.sum(axis=0)


def group_moments(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``moments`` of every group of rows, one row a group."""
    sizes = np.diff(np.append(starts, len(values)))
    there = ~np.isnan(values)
    count = np.add.reduceat(there, starts, axis=0, dtype=float)
    first = np.minimum.reduceat(np.where(there, np.arange(len(values))[:, None], len(values) - 1), starts, axis=0)
    base = np.take_along_axis(values, first, axis=0)
    shifted = np.where(there, values - np.repeat(base, sizes, axis=0), 0.0)
    with np.errstate(invalid="ignore"):
        mean = np.add.reduceat(shifted, starts, axis=0) / count
        squares = np.where(there, shifted - np.repeat(mean, sizes, axis=0), 0.0) ** 2
    return count, np.where(count > 0, mean + base, 0.0), np.add.reduceat(squares, starts, axis=0)


def merge(a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Moments of two sets together."""
    count = a[0] + b[0]
    delta = np.where((a[0] > 0) & (b[0] > 0), b[1] - a[1], 0.0)
    share = b[0] / np.maximum(count, 1.0)
    mean = np.where(a[0] > 0, a[1] + delta * share, b[1])
    return count, mean, a[2] + b[2] + delta**2 * a[0] * share


def scaled_rows(values: np.ndarray) -> np.ndarray:
    count, mean, squares = moments(values)
    return (values - mean) / deviation(count, squares)


def _in_place(df: DataFrame, columns: Sequence[str], by: Sequence[str], kernel: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """``columns`` replaced by what ``kernel`` makes of each group's matrix."""
    ids = [c for c in df.columns if c not in set(columns)]
    packed = spread(df.select(*ids, pack(columns).alias("_x")), *by, task_bytes=BATCH_BYTES)
    types = {f.name: f.dataType.simpleString() for f in packed.schema}
    made, keys, least = [*ids, *columns], list(by), batch_rows(2 * len(columns))
    fields = ", ".join(f"`{c}` {types.get(c, 'double')}" for c in made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, keys, least):
            done = by_group(to_matrix(table.column("_x")), starts, kernel, 1)
            yield from pa.table([*(table.column(c) for c in ids), *to_columns(done)], made).combine_chunks().to_batches()

    return packed.sortWithinPartitions(*keys).mapInArrow(run, fields)


def standardize_columns(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    return _in_place(df, columns, by, scaled_rows)


def winsorize_columns(df: DataFrame, columns: Sequence[str], lower: float, upper: float, by: Sequence[str]) -> DataFrame:
    return _in_place(df, columns, by, lambda values: clip_rows(values, lower, upper))


def quantile_columns(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], by: Sequence[str]) -> DataFrame:
    """One row a group: its keys, and ``{column}_q0``, ``{column}_q1``, ... of each column."""
    packed = spread(df.select(*by, pack(columns).alias("_x")), *by, task_bytes=BATCH_BYTES)
    types = {f.name: f.dataType.simpleString() for f in packed.schema}
    asked, keys, least = list(probabilities), list(by), batch_rows(2 * len(columns))
    made = [*keys, *(f"{c}_q{i}" for c in columns for i in range(len(asked)))]
    fields = ", ".join(f"`{c}` {types.get(c, 'double')}" for c in made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, keys, least):
            values = to_matrix(table.column("_x"))
            ends = np.append(starts[1:], len(values))
            rows = [quantile_rows(values[a:b], asked).T.reshape(-1) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            heads = table.select(keys).take(pa.array(starts))
            yield from pa.table([*heads.columns, *to_columns(np.vstack(rows))], made).combine_chunks().to_batches()

    return packed.sortWithinPartitions(*keys).mapInArrow(run, fields)


VECTORS = ("_count", "_mean", "_squares")


def gathered_rows(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Batches put together until they hold ``rows`` rows."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        if size >= rows:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def moment_vectors(packed: DataFrame, by: Sequence[str], columns: int) -> DataFrame:
    """``by``, ``_count``, ``_mean``, ``_squares`` of the arrays of ``columns`` values in ``_x``: one row a group, from
    one row a task and group."""
    keys, least = list(by), batch_rows(columns)
    types = {f.name: f.dataType.simpleString() for f in packed.schema}
    fields = ", ".join([*(f"`{c}` {types[c]}" for c in keys), *(f"{v} array<double>" for v in VECTORS)])
    schema = pa.schema([])

    def rows_of(held: dict, keys_type: pa.Schema) -> pa.Table:
        named = pa.Table.from_pylist([dict(zip(keys, k, strict=True)) for k in held], schema=keys_type)
        for i, v in enumerate(VECTORS):
            named = named.append_column(v, to_lists(np.vstack([m[i] for m in held.values()])))
        return named

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, kind = {}, 0, schema
        for table in gathered_rows(batches, least):
            order = [(k, "ascending") for k in keys]
            table = table.sort_by(order) if order else table
            kind = table.select(keys).schema
            starts = group_starts(table, keys)
            all_moments = group_moments(to_matrix(table.column("_x")), starts)
            names = table.select(keys).take(pa.array(starts)).to_pylist()
            for i, name in enumerate(names):
                key, own = tuple(name.values()), tuple(m[i] for m in all_moments)
                if key in held:
                    held[key] = merge(held[key], own)
                else:
                    held[key] = own
                    size += 3 * own[0].nbytes
            if size > HELD_BYTES:
                yield from rows_of(held, kind).to_batches()
                held, size = {}, 0
        if held:
            yield from rows_of(held, kind).to_batches()

    def together(rows: pa.Table) -> pa.Table:
        parts = [to_matrix(rows.column(v)) for v in VECTORS]
        whole = tuple(p[0] for p in parts)
        for i in range(1, rows.num_rows):
            whole = merge(whole, tuple(p[i] for p in parts))
        out = rows.select(keys).slice(0, 1)
        for v, m in zip(VECTORS, whole, strict=True):
            out = out.append_column(v, to_lists(m[None]))
        return out

    return packed.select(*keys, "_x").mapInArrow(partial, fields).groupBy(*keys).applyInArrow(together, fields)


def standardize_large(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The same for groups of any size: rows stay where they are but for the join with their group's vectors."""
    ids = [c for c in df.columns if c not in set(columns)]
    packed = df.select(*ids, pack(columns).alias("_x"))
    types = {f.name: f.dataType.simpleString() for f in packed.schema}
    made = [*ids, *columns]
    fields = ", ".join(f"`{c}` {types.get(c, 'double')}" for c in made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if not table.num_rows:
                continue
            values, count, mean, squares = (to_matrix(table.column(c)) for c in ("_x", *VECTORS))
            done = to_columns((values - mean) / deviation(count, squares))
            yield from pa.table([*(table.column(c) for c in ids), *done], made).combine_chunks().to_batches()

    vectors = moment_vectors(packed, by, len(columns))
    # Where the groups are few, their vectors go to the rows, which are then not shuffled at all.
    few = df.select(*by).distinct().count() * len(columns) * len(VECTORS) <= BROADCAST_CELLS
    return same_keys(packed, F.broadcast(vectors) if few else vectors, by).select(*ids, "_x", *VECTORS).mapInArrow(run, fields)
