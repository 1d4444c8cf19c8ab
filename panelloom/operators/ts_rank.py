"""Trailing time-series rank: each value among the last rows of its own stock.

A stock's history is never put into one task. Rows get their position from day
counts, are cut into blocks of ``block_rows`` positions, and the last ``rows - 1``
rows of a block are also sent to the next one as its look-back. A group is thus at
most ``block_rows + rows - 1`` rows, whatever the length of the history.

Inside a task all columns of many blocks are ranked together. The values of a column are replaced by
their places in its order, and a wavelet matrix over these counts how many in any span of rows are
smaller and how many are equal, one bit of the place at a time; the work for a row is the number
of those bits, whatever the length of the look-back.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.operators.long_series import with_position
from panelloom.operators.vector import batch_rows, by_group, pack, to_columns, to_matrix, whole_groups
from panelloom.session import spread
from panelloom.spec import TIMES_PER_DAY, TS_RANK_ROWS, ts_rank_name

BLOCK_ROWS = 4 * TS_RANK_ROWS


def span_counts(places: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the rows ``[low, high)`` of each column, how many have a smaller place than the row itself, and how many
    the same; ``places`` is rows x columns, small whole numbers, and the bounds are one for each row."""
    rows, width = places.shape
    # Columns one after another, each with one more entry than rows, for counts before a row.
    column = (np.arange(width, dtype=np.int32) * (rows + 1))[:, None]
    own = np.ascontiguousarray(places.T)
    left = np.repeat(low[None].astype(np.int32), width, axis=0)
    right = np.repeat(high[None].astype(np.int32), width, axis=0)
    level, smaller = own, np.zeros((width, rows), dtype=np.int32)
    zeros = np.zeros((width, rows + 1), dtype=np.int32)
    for bit in range(int(places.max(initial=0)).bit_length() - 1, -1, -1):
        one = (level >> bit & 1).astype(bool)
        np.cumsum(~one, axis=1, out=zeros[:, 1:])
        begin, end = zeros.ravel()[left + column], zeros.ravel()[right + column]
        asked = (own >> bit & 1).astype(bool)
        smaller += np.where(asked, end - begin, 0)
        # Rows with the bit unset come first on the next level, in their order.
        behind = zeros[:, -1:]
        left = np.where(asked, behind + left - begin, begin)
        right = np.where(asked, behind + right - end, end)
        at = np.where(one, behind + np.arange(rows, dtype=np.int32) - zeros[:, :-1], zeros[:, :-1])
        moved = np.empty_like(level)
        np.put_along_axis(moved, at, level, axis=1)
        level = moved
    return smaller.T, (right - left).T


def places_of(values: np.ndarray) -> np.ndarray:
    """Each value's place in the order of its column, equal ones shared; missing values come last, behind all."""
    order = np.argsort(values, axis=0)
    ranked = np.take_along_axis(values, order, axis=0)
    steps = np.zeros(values.shape, dtype=np.int32)
    steps[1:] = (ranked[1:] != ranked[:-1]) & ~(np.isnan(ranked[1:]) & np.isnan(ranked[:-1]))
    places = np.empty_like(steps)
    np.put_along_axis(places, order, np.cumsum(steps, axis=0, dtype=np.int32), axis=0)
    return places


def trailing_rank(values: np.ndarray, rows: int, starts: np.ndarray | None = None) -> np.ndarray:
    """Per column, the rank of each value among the present ones of the ``rows`` ending at it, within its group."""
    count, width = values.shape
    if not count:
        return np.empty((0, width))
    starts = np.zeros(1, dtype=np.int64) if starts is None else starts
    at = np.arange(count)
    first = np.repeat(starts, np.diff(np.append(starts, count)))
    low, high = np.maximum(first, at - rows + 1), at + 1
    below, tied = span_counts(by_group(values, starts, places_of, 1).astype(np.int32), low, high)
    upto = np.vstack([np.zeros((1, width), dtype=np.int32), np.cumsum(~np.isnan(values), axis=0, dtype=np.int32)])
    present = upto[high] - upto[low]
    scaled = (below + (tied - 1) / 2.0) / np.maximum(present - 1, 1)
    return np.where(np.isnan(values), np.nan, np.where(present == 1, 0.5, scaled))


def ts_rank(
    df: DataFrame,
    columns: Sequence[str],
    rows: int = TS_RANK_ROWS,
    block_rows: int = BLOCK_ROWS,
    times_per_day: int = TIMES_PER_DAY,
) -> DataFrame:
    """Replace ``columns`` by their rank among the last ``rows`` rows of the stock."""
    if block_rows < rows - 1:
        raise ValueError("a block must hold the whole look-back of the next one")
    ids = [c for c in df.columns if c not in set(columns)]
    placed = with_position(
        df.select(*ids, pack(columns).alias("_x")), ["stockid"], ["dateid", "timeid"], times_per_day
    )
    own = F.floor(F.col("_pos") / F.lit(block_rows))
    following = F.floor((F.col("_pos") + F.lit(rows - 1)) / F.lit(block_rows))
    blocks = placed.withColumn("_own", own).withColumn(
        "_block", F.explode(F.array_distinct(F.array("_own", following)))
    )
    made = [*ids, *(ts_rank_name(c) for c in columns)]
    types = {f.name: f.dataType.simpleString() for f in blocks.schema}
    fields = ", ".join(f"`{n}` {types[n] if n in ids else 'double'}" for n in made)
    least = batch_rows(8 * len(columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, ["stockid", "_block"], least):
            ranks = trailing_rank(to_matrix(table.column("_x")), rows, starts)
            own = np.equal(table.column("_own").to_numpy(), table.column("_block").to_numpy())
            out = pa.table([*(table.column(c) for c in ids), *to_columns(ranks)], made).filter(pa.array(own))
            yield from out.combine_chunks().to_batches()

    placed = spread(blocks, "stockid", "_block").sortWithinPartitions("stockid", "_block", "_pos")
    return placed.mapInArrow(run, fields)
