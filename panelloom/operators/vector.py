"""Wide panels as one array per row, worked on as matrices inside Arrow tasks.

Hundreds of double columns cost far more in window frames, and in per-column Arrow
traffic of small batches, than their bytes. Packed into one array the row is a single block of
memory for shuffle, sort and Arrow. Inside the arrays missing is NaN.

Spark partitions, shuffles and sorts; a task takes as many whole groups at once as fill
``BATCH_BYTES`` (callers bound a single group), and groups of one length lie side by side in one matrix, so
that a kernel call ranks or averages them all. Results leave a task as columns under their final
names: a projection over hundreds of columns behind it would cost as much as the ranking.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.session import spread

LIST = pa.list_(pa.field("element", pa.float64()))
# Values that a task works on at once.
BATCH_BYTES = 16 * 1024 * 1024
# Values of groups that one kernel call takes side by side.
CACHE_CELLS = 64 * 1024
# Values of one large group that a kernel call takes at most, in whole columns.
KERNEL_CELLS = 16 * CACHE_CELLS
# Half-lives over which weights may grow before they are scaled down again.
STRETCH = 400


def pack(columns: Sequence[str]) -> Column:
    return F.array(*(F.coalesce(F.col(c), F.lit(float("nan"))) for c in columns))


def unpack(array: str, names: Sequence[str]) -> list[Column]:
    return [F.col(array)[i].alias(n) for i, n in enumerate(names)]


def to_matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def to_lists(matrix: np.ndarray) -> pa.ListArray:
    """Rows as lists; NaN becomes NULL."""
    rows, width = matrix.shape
    values = pa.array(np.ascontiguousarray(matrix).reshape(-1), from_pandas=True)
    offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * np.int32(width))
    return pa.ListArray.from_arrays(offsets, values, type=LIST)


def to_columns(matrix: np.ndarray) -> list[pa.Array]:
    """One array per column; NaN becomes NULL."""
    turned = np.ascontiguousarray(matrix.T)
    return [pa.array(row, from_pandas=True) for row in turned]


def _changes(column: pa.ChunkedArray) -> np.ndarray:
    """Where a value differs from the one before; missing equals missing, NaN equals NaN."""
    whole = column.combine_chunks()
    whole = pa.concat_arrays(whole.chunks) if isinstance(whole, pa.ChunkedArray) else whole
    here, before = whole.slice(1), whole.slice(0, len(whole) - 1)
    differs = pc.fill_null(pc.not_equal(here, before), False).to_numpy(zero_copy_only=False)
    differs = differs | pc.xor(here.is_null(), before.is_null()).to_numpy(zero_copy_only=False)
    if pa.types.is_floating(whole.type):
        nan = pc.fill_null(pc.is_nan(whole), False).to_numpy(zero_copy_only=False)
        differs &= ~(nan[1:] & nan[:-1])
    return differs


def group_starts(table: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """First row of each run of equal keys."""
    new = np.ones(table.num_rows, dtype=bool)
    if len(new) > 1:
        new[1:] = np.logical_or.reduce([_changes(table.column(k)) for k in keys]) if keys else False
    return np.flatnonzero(new)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str], rows: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted rows cut into tables of whole groups, of ``rows`` rows or more but for the last one, with their starts."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            table = pa.Table.from_batches(held)
            starts = group_starts(table, keys)
            last = int(starts[-1])
            if last:
                yield table.slice(0, last), starts[:-1]
            held = table.slice(last).to_batches()
            size -= last
    if held:
        table = pa.Table.from_batches(held)
        yield table, group_starts(table, keys)


def side_by_side(starts: np.ndarray, rows: int) -> Iterator[tuple[int, int, int, int]]:
    """Runs of neighbouring groups of one length: first row, end row, groups, length."""
    lengths = np.diff(np.append(starts, rows))
    heads = np.flatnonzero(np.r_[True, lengths[1:] != lengths[:-1]]) if len(lengths) else []
    for head, end in zip(heads, [*heads[1:], len(lengths)], strict=True):
        begin, length = int(starts[head]), int(lengths[head])
        yield begin, begin + (end - head) * length, int(end - head), length


def by_group(values: np.ndarray, starts: np.ndarray, kernel: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """``kernel`` of every group; it takes rows x columns and works down columns, and gives ``width`` times as many columns.

    Of a group with more than ``KERNEL_CELLS`` values it gets some columns at a time, so that its own memory is bounded.
    """
    columns = values.shape[1]
    out = np.empty((values.shape[0], width, columns))
    for begin, end, groups, length in side_by_side(starts, len(values)):
        # Beyond what a processor's cache holds, larger matrices only get slower.
        step = length * max(1, CACHE_CELLS // max(1, length * columns))
        some = columns if length * columns <= KERNEL_CELLS else max(1, KERNEL_CELLS // length)
        for a in range(begin, end, step):
            b = min(end, a + step)
            for c in range(0, columns, max(1, some)):
                block = values[a:b, c : c + some].reshape(-1, length, min(some, columns - c)).transpose(1, 0, 2)
                made = kernel(block.reshape(length, -1)).reshape(length, width, -1, block.shape[2])
                out[a:b, :, c : c + some] = made.transpose(2, 0, 1, 3).reshape(b - a, width, -1)
    return out.reshape(len(out), width * columns)


def batch_rows(columns: int) -> int:
    return max(1, BATCH_BYTES // (8 * max(1, columns)))


def value_order(work: np.ndarray) -> np.ndarray:
    """``argsort`` of each row, NaN last, by a plain sort of whole numbers, which is several times as fast.

    A double's bits, turned so that they order like the value, give way in their lowest places to the position. Where
    values differ in those places only, the order may be wrong; rows in which that shows are sorted again.
    """
    rows = work.shape[1]
    places = max(1, (rows - 1).bit_length())
    if places > 20 or not rows:
        return np.argsort(work, axis=1)
    mask = np.int64((1 << places) - 1)
    bits = (np.where(np.isnan(work), np.nan, work) + 0.0).view(np.int64)  # one NaN, one zero
    keys = bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))
    keys &= ~mask
    keys |= np.arange(rows, dtype=np.int64)
    keys.sort(axis=1)
    order = keys & mask
    ranked = np.take_along_axis(work, order, axis=1)
    wrong = np.flatnonzero((ranked[:, 1:] < ranked[:, :-1]).any(axis=1))
    if len(wrong):
        order[wrong] = np.argsort(work[wrong], axis=1)
    return order


def rank_matrix(values: np.ndarray) -> np.ndarray:
    """Normalised average-tie rank of each column."""
    rows = values.shape[0]
    work = np.array(values.T, order="C")
    order = value_order(work)
    order += np.arange(work.shape[0])[:, None] * rows
    ranked = work.take(order)
    missing = np.isnan(ranked)
    present = rows - missing.sum(axis=1, keepdims=True)
    place = np.arange(rows, dtype=np.float64)
    # Sorted position is the number of smaller values, plus half the other tied ones.
    scaled = place / np.maximum(present - 1, 1)
    same = ranked[:, 1:] == ranked[:, :-1]
    tied = np.flatnonzero(same.any(axis=1))
    if len(tied):
        inner = same[tied]
        edge = np.ones((len(tied), 1), dtype=bool)
        first = np.maximum.accumulate(np.where(np.hstack([edge, ~inner]), place, 0.0), axis=1)
        last = np.where(np.hstack([~inner, edge]), place, rows)[:, ::-1]
        last = np.minimum.accumulate(last, axis=1)[:, ::-1]
        scaled[tied] = (first + last) / 2.0 / np.maximum(present[tied] - 1, 1)
    scaled[(present == 1)[:, 0]] = 0.5
    scaled[missing] = np.nan
    work.put(order, scaled)
    return work.T


def weighted_rank_matrix(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The same with row weights in place of counts; a missing or zero weight counts nothing."""
    rows, width = values.shape
    work = values.T
    order = np.argsort(work, axis=1, kind="stable")
    ranked = np.take_along_axis(work, order, axis=1)
    missing = np.isnan(ranked)
    own = np.where(missing, 0.0, np.where(np.isnan(weights), 0.0, weights)[order])
    upto = np.cumsum(own, axis=1)
    total = upto[:, -1:]
    edge = np.ones((width, 1), dtype=bool)
    differs = ranked[:, 1:] != ranked[:, :-1]
    place = np.arange(rows)
    first = np.maximum.accumulate(np.where(np.hstack([edge, differs]), place, 0), axis=1)
    last = np.minimum.accumulate(np.where(np.hstack([differs, edge]), place, rows)[:, ::-1], axis=1)[:, ::-1]
    below = np.take_along_axis(upto, first, axis=1) - np.take_along_axis(own, first, axis=1)
    tied = np.take_along_axis(upto, last, axis=1) - below
    rest = total - own
    with np.errstate(invalid="ignore", divide="ignore"):
        scaled = np.where(rest == 0, 0.5, (below + (tied - own) / 2.0) / rest)
    scaled[missing] = np.nan
    out = np.empty_like(scaled)
    np.put_along_axis(out, order, scaled, axis=1)
    return out.T


def settle_matrix(values: np.ndarray, bits: int | None) -> np.ndarray:
    """``numeric.settle`` on a matrix."""
    if bits is None:
        return values
    with np.errstate(over="ignore", invalid="ignore"):
        wide = values * float(2**bits + 1)
        return np.where(np.abs(values) < 1e290, wide - (wide - values), values)


def stretch_weights(rows: int, life: float) -> tuple[float, np.ndarray]:
    """Weight of what came before a stretch, and of its rows; even about 1, so that neither end runs out of range."""
    middle = rows / 2.0
    return 2.0 ** (-middle / life), 2.0 ** ((np.arange(1, rows + 1) - middle) / life)[:, None]


def decayed_means(
    values: np.ndarray, half_lives: Sequence[float], source: Sequence[int], start: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Causal averages down a series of value sets, ``rows x sets x width``.

    Average k runs over set ``source[k]`` and comes out as ``[:, k]``. Inside a stretch of
    at most ``STRETCH`` half-lives weights grow as 2^(i / half_life), so two running sums do;
    from stretch to stretch the sums are carried, scaled down. The sums at the end are
    returned too, weighted as seen from the last row; given as ``start`` they continue a series.
    """
    rows, _, width = values.shape
    lives = np.asarray(half_lives, dtype=float)
    sums = np.zeros((2, len(lives), width)) if start is None else start.copy()
    means = np.empty((rows, len(lives), width))
    for k, (life, which) in enumerate(zip(lives, source, strict=True)):
        step = max(1, int(STRETCH * life))
        for at in range(0, rows, step):
            part = values[at : at + step, which]
            present = ~np.isnan(part)
            shift, weight = stretch_weights(len(part), life)
            total = np.cumsum(np.where(present, part, 0.0) * weight, axis=0) + sums[0, k] * shift
            norm = np.cumsum(present * weight, axis=0) + sums[1, k] * shift
            with np.errstate(invalid="ignore"):
                means[at : at + step, k] = total / norm
            sums[:, k] = total[-1] / weight[-1], norm[-1] / weight[-1]
    return means, sums


def gated_means(
    values: np.ndarray, half_lives: Sequence[float], min_counts: Sequence[int], adjust: bool = True
) -> np.ndarray:
    """Averages of every column of one series, ``rows x specs x width``; NaN where there are too few values.

    Without ``adjust`` all observations but the first weigh ``1 - 2^(-1 / half_life)``: the sums are
    those of the adjusted form, scaled, plus what the first observation then lacks.
    """
    rows, width = values.shape
    present = ~np.isnan(values)
    seen = np.cumsum(present, axis=0)
    means = decayed_means(values[:, None], half_lives, [0] * len(half_lives))[0]
    if not adjust and rows:
        first = present.argmax(axis=0)
        head = np.where(np.arange(rows)[:, None] == first, values, np.nan)
        for k, life in enumerate(half_lives):
            later = 1.0 - 2.0 ** (-1.0 / life)
            both = np.stack([np.where(present, values, 0.0), present.astype(float)])
            lone = np.stack([np.where(np.isnan(head), 0.0, head), ~np.isnan(head)])
            sums = decayed_sums(later * both + (1.0 - later) * lone, life)
            with np.errstate(invalid="ignore", divide="ignore"):
                means[:, k] = sums[0] / sums[1]
    for k, least in enumerate(min_counts):
        means[:, k][seen < max(1, least)] = np.nan
    return means


def decayed_sums(terms: np.ndarray, life: float) -> np.ndarray:
    """Running sums down axis 1, halving every ``life`` rows."""
    out, carry = np.empty_like(terms), np.zeros_like(terms[:, 0])
    step = max(1, int(STRETCH * life))
    for at in range(0, terms.shape[1], step):
        part = terms[:, at : at + step]
        shift, weight = stretch_weights(part.shape[1], life)
        out[:, at : at + step] = (np.cumsum(part * weight, axis=1) + (carry * shift)[:, None]) / weight
        carry = out[:, at + part.shape[1] - 1]
    return out


def ewma_matrix(values: np.ndarray, half_life: float, min_count: int = 1, bits: int | None = None) -> np.ndarray:
    """Causal average down each column; rows are the series in order."""
    return settle_matrix(gated_means(values, [half_life], [min_count])[:, 0], bits)


def impute_matrix(values: np.ndarray, half_life: float) -> np.ndarray:
    return np.where(np.isnan(values), ewma_matrix(values, half_life), values)


def rank_columns(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str],
    names: Mapping[str, str],
    weight: str | None = None,
    placed: bool = False,
) -> DataFrame:
    """``xsec_rank`` for wide frames whose groups fit a task. Rows are packed before they are shuffled, unless they are
    ``placed``, that is partitioned by some of ``by``, already."""
    ids = [c for c in df.columns if c not in set(columns)]
    packed = df.select(*ids, pack(columns).alias("_x"))
    packed = packed if placed else spread(packed, *by, task_bytes=BATCH_BYTES)
    return rank_wide(packed, by, "_x", [names[c] for c in columns], weight, ids)


def _group_ranks(table: pa.Table, starts: np.ndarray, array: str, weight: str | None) -> np.ndarray:
    values = to_matrix(table.column(array))
    if weight is None:
        return by_group(values, starts, rank_matrix, 1)
    own = table.column(weight).cast(pa.float64()).to_numpy()
    ends = np.append(starts[1:], len(values))
    parts = [weighted_rank_matrix(values[a:b], own[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    return np.vstack(parts) if parts else values


def rank_wide(
    packed: DataFrame, by: Sequence[str], array: str, names: Sequence[str], weight: str | None = None, kept: Sequence[str] | None = None
) -> DataFrame:
    """``kept`` columns, then the ranks of the array's values within ``by`` under ``names``."""
    kept = list(kept) if kept is not None else [c for c in packed.columns if c != array]
    types = {f.name: f.dataType.simpleString() for f in packed.schema}
    fields = ", ".join([*(f"`{c}` {types[c]}" for c in kept), *(f"`{n}` double" for n in names)])
    keys, made, least = list(by), [*kept, *names], batch_rows(len(names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, keys, least):
            ranks = to_columns(_group_ranks(table, starts, array, weight))
            yield from pa.table([*(table.column(c) for c in kept), *ranks], made).combine_chunks().to_batches()

    return packed.sortWithinPartitions(*keys).mapInArrow(run, fields)


def rank_packed(packed: DataFrame, by: Sequence[str], array: str, weight: str | None = None) -> DataFrame:
    """The same with the ranks in place of the array."""
    names = packed.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in packed.schema)

    def rank_group(group: pa.Table) -> pa.Table:
        ranks = _group_ranks(group, np.zeros(min(1, group.num_rows), dtype=np.int64), array, weight)
        return group.set_column(names.index(array), array, to_lists(ranks))

    return packed.groupBy(*by).applyInArrow(rank_group, fields)


def average_columns(
    df: DataFrame,
    columns: Sequence[str],
    half_lives: Sequence[float],
    min_counts: Sequence[int],
    names: Sequence[Sequence[str]],
    series: Sequence[str],
    order: Sequence[str],
    adjust: bool = True,
    bits: int | None = None,
    fill: bool = False,
    keep: bool = True,
) -> DataFrame:
    """Averages of wide series that fit a task; ``names`` has one list of new columns per half-life.

    ``fill`` puts the first average in place of missing values only, and observed values stay as they are.
    ``keep`` keeps ``columns`` too; without it they do not come back from the tasks.
    """
    ids = [c for c in df.columns if c not in set(columns)]
    packed = df.select(*ids, pack(columns).alias("_x"))
    lives, least, width = list(half_lives), list(min_counts), len(columns)
    made = [*ids, *(columns if keep else []), *(n for block in names for n in block)]
    types = {f.name: f.dataType.simpleString() for f in packed.schema}
    fields = ", ".join(f"`{c}` {types[c] if c in ids else 'double'}" for c in made)
    keys, blocks = list(series), len(lives)
    rows = batch_rows(width * (blocks + 1))

    def means_of(values: np.ndarray) -> np.ndarray:
        means = settle_matrix(gated_means(values, lives, least, adjust), bits)
        if fill:
            means[:, 0] = np.where(np.isnan(values), means[:, 0], values)
        return means

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, keys, rows):
            values = to_matrix(table.column("_x"))
            means = by_group(values, starts, means_of, blocks)
            new = [c for k in range(blocks) for c in to_columns(means[:, k * width : (k + 1) * width])]
            old = to_columns(values) if keep else []
            yield from pa.table([*(table.column(c) for c in ids), *old, *new], made).combine_chunks().to_batches()

    placed = spread(packed, *keys, task_bytes=BATCH_BYTES).sortWithinPartitions(*keys, *(F.col(c).asc_nulls_last() for c in order))
    return placed.mapInArrow(run, fields)
